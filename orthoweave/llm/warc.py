"""WARC archives, index first: writing gives an index of byte ranges; reading sorts the
ranges of the wanted records, merges neighbours and reads each merged range at once."""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import attempt_name, materialise, open_fs
from orthoweave.session import work_dir

#: Payloads of at least so many bytes are written once; equal ones become revisits.
MIN_REVISIT_BYTES = 0
#: A new archive file starts when one has grown beyond this.
ARCHIVE_BYTES = 1 << 30
#: Ranges closer than the gap are read as one, up to the size.
GAP, READ_BYTES = 64 << 10, 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "page_id long, url string, archive string, offset long, length long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long")
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_STRINGS = {"url", "archive", "payload_digest", "record_type"}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    tail = record_id.strip("<>").rpartition(":")[2]
    return None if tail == "null" else int(tail)


def build_record(page_id: int | None, url: str | None, payload: bytes, response: int | None, revisit: bool) -> bytes:
    """One gzip member: WARC header, HTTP header, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$&'()*+,/:;=?@[]~%"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(response)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(member: bytes) -> dict:
    """The record of one gzip member; raises ValueError if it does not hold what it says."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record starts here")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if fields["warc-block-digest"] != "sha1:" + sha1_base32(block):
        raise ValueError("the block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.partition(":")[2] for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")]
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and (digest != sha1_base32(payload) or len(payload) != int(sizes[0])):
        raise ValueError("the payload does not match its digest")
    return {
        "page_id": _page_of(fields["warc-record-id"]), "payload_bytes": int(sizes[0]), "payload_digest": digest,
        "record_type": fields["warc-type"], "payload": None if revisit else payload,
        "refers_to": _page_of(fields["warc-refers-to"]) if revisit else None}


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes a record per row and gives the index, a table in the shared folder.

    Of rows with equal payloads of at least min_bytes the one with the smallest page_id
    is the response, the others revisit it. Null html is an empty payload. A null
    page_id comes after all others; rows that share the smallest page_id and the payload
    are all responses. Null urls have no target line. Columns other than page_id, url
    and html are not read; an empty table gives an empty index. The smallest page_id per
    payload is aggregated before the shuffle; a payload that many rows share is then
    joined, which Spark splits where skewed.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("response"))
    joined = rows.join(first, "digest")
    revisit = ~F.col("page_id").eqNullSafe(F.col("response")) & (F.length("payload") >= min_bytes)
    ready = joined.select("page_id", "url", "payload", "response", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, offset, out, name = TaskContext.get().partitionId(), 0, 0, None, ""
        for batch in batches:
            found = {k: [] for k in _INDEX_NAMES}
            for page_id, url, payload, response, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset, number = f"{folder}/{attempt_name('pages', task)}-{number:04d}.warc.gz", 0, number + 1
                    system, path = open_fs(name)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                record = build_record(page_id, url, payload, response, again)
                out.write(record)
                values = (page_id, url, name, offset, len(record), len(payload), sha1_base32(payload),
                          "revisit" if again else "response", response if again else None)
                for k, v in zip(_INDEX_NAMES, values, strict=True):
                    found[k].append(v)
                offset += len(record)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[k], pa.string() if k in _STRINGS else pa.int64()) for k in _INDEX_NAMES], _INDEX_NAMES)
        if out is not None:
            out.close()

    return materialise(ready.mapInArrow(run, INDEX), "warc-index")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows name, parsed and checked against their digests.

    Selected rows are range-sorted by archive and offset; each task merges neighbouring
    byte ranges and reads them front to back. Without payloads that column is null.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for archive, low, members in merged(wanted):
                system, path = open_fs(archive)
                with system.open_input_file(path) as file:
                    data = file.read_at(members[-1][0] + members[-1][1] - low, low)
                rows = [parse_record(data[at - low:at - low + n]) for at, n in members]
                if not payloads:
                    for row in rows:
                        row["payload"] = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in zip(names, kinds, strict=True)], names)

    ordered = index.select("archive", "offset", "length").repartitionByRange("archive", "offset")
    return ordered.sortWithinPartitions("archive", "offset").mapInArrow(run, RECORD)


def merged(ranges: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """Sorted (archive, offset, length) joined into reads: archive, first byte, members."""
    group: list[tuple[int, int]] = []
    current, end = None, 0
    for archive, offset, length in ranges:
        if group and (archive != current or offset - end > GAP or offset + length - group[0][0] > READ_BYTES):
            yield current, group[0][0], group
            group = []
        group.append((offset, length))
        current, end = archive, offset + length
    if group:
        yield current, group[0][0], group


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes all pages, reads all records back: what the archives say of each page."""
    found = read_records(write_archives(pages, min_bytes=min_bytes), payloads=False)
    return found.drop("payload")
