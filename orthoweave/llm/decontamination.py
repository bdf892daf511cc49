"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping regions. A place in a document within e edits
of a region of w bytes shares at least ``w + 1 - q - q * e`` of its q-grams with it, all
on diagonals (document position less region position) at most e apart. Shared q-grams
are therefore counted per region in diagonal bands 2e wide that overlap by half; bands
that reach the bound are verified by a banded alignment. Texts are compared lower-cased,
with runs of ASCII marks and blanks as one blank, in UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import packed_rows, unpacked_rows

Q = 8  # a q-gram is the eight bytes of one unsigned 64-bit number
REGION, STRIDE = 80, 40
#: Edits allowed per hundred bytes of a region.
EDIT_PERCENT = 10
#: Items shorter than this after normalisation are too common to tell a leak.
MIN_REGION = 24
#: Bytes of benchmark text indexed at a time; a larger benchmark is searched in blocks.
BLOCK_BYTES = 16 << 20
#: Bytes of documents looked at in one step, and the overlap of steps.
STEP = 1 << 20

_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_FILTER_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACE).split())


def _grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, Q)).view(np.uint64).ravel()


def _slots(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((grams * _FACTOR) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


class Index:
    """Regions of a block of items and the postings of their q-grams."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.item, self.text, self.start = [], [], []
        for item_id, text in items:
            if len(text) < MIN_REGION:
                continue
            last = max(0, len(text) - REGION)
            for start in sorted({*range(0, last + 1, STRIDE), last}):
                self.item.append(item_id)
                self.text.append(text[start:start + REGION])
                self.start.append(start)
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.edits = self.size * EDIT_PERCENT // 100
        self.bound = np.maximum(1, self.size + 1 - Q - Q * self.edits)
        grams = [_grams(np.frombuffer(t, np.uint8)) for t in self.text]
        places = [np.arange(len(g)) for g in grams]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        region = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.zeros(0, np.int64)
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.grams, first, self.many = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.region, self.place = first, region[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[_slots(self.grams)] = True

    def __len__(self) -> int:
        return len(self.text)

    def search(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(region, end, edits) of verified places in the bytes; end is the first byte after."""
        grams = _grams(data)
        at = np.flatnonzero(self.filter[_slots(grams)])
        # a place has its shared q-grams within the region's length and edits
        span, least = REGION + 2 * int(self.edits.max()), int(self.bound.min())
        if least > 1 and len(at):
            n = np.searchsorted(at, at + span) - np.searchsorted(at, at - span)
            at = at[n >= least]
        found = np.searchsorted(self.grams, grams[at])
        found[found == len(self.grams)] = 0
        good = self.grams[found] == grams[at]
        at, found = at[good], found[good]
        if not len(at):
            return
        many = self.many[found]
        posting = np.repeat(self.first[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
        region, where = self.region[posting], np.repeat(at, many)
        diagonal = where - self.place[posting] + REGION
        step = np.maximum(1, self.edits[region])
        bands = np.concatenate([diagonal // step, diagonal // step - 1])
        width = np.int64(len(data) + 4 * REGION)
        key, counts = np.unique(np.tile(region, 2) * width + bands + 1, return_counts=True)
        region, band = key // width, key % width - 1
        good = counts >= self.bound[region]
        region, band = region[good], band[good]
        for size in np.unique(self.size[region]).tolist():
            own = self.size[region] == size
            r = region[own]
            edits = int(size * EDIT_PERCENT // 100)
            low = band[own] * max(1, edits) - REGION
            for k in range(0, len(r), 4096):
                yield from self._verify(data, r[k:k + 4096], low[k:k + 4096], size, edits)

    def _verify(self, data: np.ndarray, region: np.ndarray, low: np.ndarray, size: int, edits: int):
        """Banded alignment of whole regions, many at a time. Cell (i, k) stands for i
        bytes of the region and the document up to low - edits + i + k."""
        width = 4 * max(1, edits) + 1
        pattern = np.stack([np.frombuffer(self.text[x], np.uint8) for x in region.tolist()])
        first = low - edits
        column = np.arange(width)
        cost = np.zeros((len(region), width), np.int32)
        cost[(first[:, None] + column < 0) | (first[:, None] + column > len(data))] = size + 1
        big = np.int32(10 * REGION)
        for i in range(size):
            place = first[:, None] + i + column
            inside = (place >= 0) & (place < len(data))
            same = inside & (data[np.clip(place, 0, len(data) - 1)] == pattern[:, i, None])
            step = np.where(inside, cost + np.where(same, 0, 1), big)
            skipped = np.concatenate([cost[:, 1:], np.full((len(cost), 1), big)], axis=1) + 1
            cost = np.minimum(step, skipped).astype(np.int32)
            cost = np.minimum.accumulate(cost - column, axis=1) + column
        best, shift = cost.min(axis=1), cost.argmin(axis=1)
        for x in np.flatnonzero(best <= edits).tolist():
            yield int(region[x]), int(first[x]) + size + int(shift[x]), int(best[x])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of bounded size, read through one partition after the other."""
    items, size = [], 0
    for row in benchmark.select(benchmark["item_id"].cast("long"), benchmark["text"]).toLocalIterator():
        text = normalise(row[1])
        items.append((row[0], text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield items
            items, size = [], 0
    if items:
        yield items


MATCH = "doc_id long, item_id long, n_regions long, edits long, end_byte long"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document row and item found in it: doc_id, item_id, the number of regions
    found, the edits of the closest, and where the first one ends (byte of the normalised
    text).

    Every document is searched whole against every item; a benchmark larger than
    BLOCK_BYTES is searched in blocks, each sent to the tasks with a bounded index. Null
    and empty texts hold nothing; items that are null or shorter than MIN_REGION are not
    searched; null ids are carried; repeated rows are reported each; empty tables give no
    rows; other columns are not read.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    parts = [_search_block(narrow, items) for items in _blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts or [narrow.selectExpr(
        "doc_id", "0L AS item_id", "0L AS n_regions", "0L AS edits", "0L AS end_byte").where("false")])


def _hits(index: Index, texts: pa.Array) -> dict[tuple[int, int], list]:
    """(row, item) of the items found in texts: edits of the closest region, first end, regions."""
    hits: dict[tuple[int, int], list] = {}
    for chunk, rows, begins in _chunks(texts):
        for region, end, edits in index.search(chunk):
            at = int(np.searchsorted(begins[:, 0], end - 1, side="right")) - 1
            hit = hits.setdefault((rows[at], index.item[region]), [edits, 1 << 62, set()])
            hit[0] = min(hit[0], edits)
            hit[1] = min(hit[1], end - int(begins[at, 0]) + int(begins[at, 1]))
            hit[2].add(region)
    return hits


def _search_block(narrow: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    shared = narrow.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            if not len(index):
                continue
            hits, ids = _hits(index, batch.column(1)), batch.column(0)
            keys = sorted(hits)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array([r for r, _ in keys], pa.int64())),
                pa.array([i for _, i in keys], pa.int64()),
                pa.array([len(hits[k][2]) for k in keys], pa.int64()),
                pa.array([hits[k][0] for k in keys], pa.int64()),
                pa.array([hits[k][1] for k in keys], pa.int64())], [c.split()[0] for c in MATCH.split(", ")])

    return narrow.mapInArrow(run, MATCH)


def _chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """Normalised texts packed into steps of about STEP bytes: the bytes, the rows, and
    for each row where it begins in the step and the offset in its text. Texts are kept
    apart by bytes that no text has; a long text is cut into overlapping steps."""
    gap, overlap = bytes(2 * REGION), 3 * REGION
    pieces: list[bytes] = []
    rows: list[int] = []
    begins: list[tuple[int, int]] = []
    size = 0
    for row, text in enumerate(texts):
        data = normalise(text.as_py())
        for offset in range(0, max(1, len(data) - overlap), STEP):
            piece = data[offset:offset + STEP + overlap]
            if len(piece) < MIN_REGION - MIN_REGION * EDIT_PERCENT // 100:
                continue
            pieces += [piece, gap]
            rows.append(row)
            begins.append((size, offset))
            size += len(piece) + len(gap)
            if size >= STEP:
                yield np.frombuffer(b"".join(pieces), np.uint8), rows, np.array(begins)
                pieces, rows, begins, size = [], [], [], 0
    if pieces:
        yield np.frombuffer(b"".join(pieces), np.uint8), rows, np.array(begins)


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input rows in which no benchmark item is found, all columns. The task that
    searches a row decides on it: rows without an id too, and rows that share one apart."""
    rows = packed_rows(docs)
    for items in _blocks(benchmark):
        rows = _keep_clean(rows, items)
    return unpacked_rows(rows, docs.columns)


def _keep_clean(rows: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            if len(index):
                clean[[row for row, _ in _hits(index, batch.column(2))]] = False
            yield batch.filter(pa.array(clean))

    return rows.mapInArrow(run, rows.schema)
