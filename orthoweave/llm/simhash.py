"""SimHash near-dedup with deletion-variant signatures.

A fingerprint has 64 bits. Cut into three segments, two fingerprints at most four bits
apart have a segment in which they differ by one bit at most (five would be needed
for two in each). A segment is therefore indexed under each of its variants with one
bit left out; two segments at most one bit apart share a variant. Candidates come from
an equality join on (variant, left-out bit) and are verified by counting bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import connected_components, materialise

#: First bits of the segments, and the end.
SEGMENTS = (0, 21, 42, 64)
MAX_BITS = 4
SHINGLE = 4
SEED = 42

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Hashes whose bits are counted at once.
_CHUNK = 65536


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of the shingles' XXH64: a bit is set if set in over half of the hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    begin, end = starts[:n].tolist(), ends[min(width, len(words)) - 1:].tolist()
    return majority(np.array([digest(joined[b:e], SEED) for b, e in zip(begin, end, strict=True)], "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed long. Null and empty texts
    have fingerprint zero; every input row gives a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def variants(fp: Column) -> Column:
    """The 64 keys of a fingerprint: for each bit, its segment without that bit, and
    the bit's number."""
    keys = []
    for low, high in zip(SEGMENTS, SEGMENTS[1:], strict=False):
        segment = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys += [segment.bitwiseAND(F.lit(~(1 << (bit - low)))) * 64 + bit for bit in range(low, high)]
    return F.array(*keys)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most max_bits (1 to 5) apart.

    Copies share a fingerprint and are one row here. A pair meets under several keys; the
    join itself keeps it under one only: in the first segment with at most one difference,
    under the bit that differs, or the segment's first bit if none does.
    """
    if not 0 < max_bits < 2 * (len(SEGMENTS) - 1):
        raise ValueError("three segments cover 1 to 5 bits")
    keyed = fps.select("fp", F.explode(variants(F.col("fp"))).alias("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    left_out = F.col("a.key").bitwiseAND(F.lit(63))
    chosen, earlier = F.lit(False), F.lit(True)
    for low, high in zip(SEGMENTS, SEGMENTS[1:], strict=False):
        within = F.shiftrightunsigned(differ, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        place = F.when(within == 0, low).otherwise(F.round(F.log2(within)).cast("int") + low)
        one = F.bit_count(within) <= 1
        chosen = chosen | (earlier & one & (left_out == place))
        earlier = earlier & ~one
    near = (F.bit_count(differ) <= max_bits) & chosen
    # 64 rows of each fingerprint, which Spark counts as one: never a broadcast
    pairs = a.join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near)
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def components(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over
    fingerprints at most max_bits apart, the document itself included.

    Empty texts share fingerprint zero and link like any other. Rows with a null id
    stay; a group in which every id is null has a null component. Repeated rows are in
    one group; an empty table gives no rows.
    """
    each = materialise(fingerprints(docs, width), "simhash-fp")
    fps = materialise(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(links(fps, max_bits), "a", "b", "simhash-edges")
    roots = roots.withColumnRenamed("vertex", "fp")
    grouped = fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = grouped.join(ids, "root").select("fp", "component_id")
    return each.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE) -> DataFrame:
    """The input rows with one document left of each group: its smallest id. Rows with
    a null id cannot be told apart and stay; other columns pass through."""
    found = components(docs, max_bits, width)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, docs["doc_id"] == first["_first"], "left_semi").unionByName(
        docs.where(docs["doc_id"].isNull()))
