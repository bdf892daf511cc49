"""Removal of repeated 100-byte strings by a distributed merge sort of suffixes.

Sorting every suffix of a large corpus would move many times its size, so suffixes are
thinned without loss. Each window of LENGTH bytes has an anchor: its 32-byte gram with
the smallest hash. Equal windows have equal anchors at equal offsets. Neighbouring
windows with one anchor form a stretch, about 35 windows long; a stretch is sorted as
one suffix: hash of the anchor's gram, the text from the anchor on, then the text before
it read backwards. Stretches whose gram occurs once in the corpus cannot repeat and are
left out after a first pass that counts grams.

Each task sorts its stretches into runs, front-coded (length of the prefix shared with
the entry before, and the rest) and cut at even ranges of the hash. A range's runs are
merged by a loser tree that keeps with each loser the length of the prefix it shares
with the last output: prefixes known to be equal are never compared again. In the merged
order equal stretches are neighbours, and so are stretches with one gram, whose windows
are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.array_files import SortedNumbers, save_arrays
from orthoweave.llm.common import attempt_name, materialise
from orthoweave.session import work_dir

LENGTH = 100
GRAM = 32
#: A key, a stretch of at most twice the length less a gram and ten bytes, has one-byte lengths.
MAX_LENGTH = (255 - 10 + GRAM) // 2
#: Bytes of text looked at in one step; positions inside a step take twenty bits.
STEP = 1 << 20
#: Stretches a task sorts into one run, stretches per range of the merge, and spans that
#: are gathered before they are joined and sent on.
RUN_ENTRIES, RANGE_ENTRIES, SPAN_ENTRIES = 60_000, 60_000, 50_000

_FACTORS = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_PLACE = np.uint64(STEP * 2 - 1)
_MARK = b"\xff"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each position."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,)).copy()
    with np.errstate(over="ignore"):
        h = words[:n] * _FACTORS[0]
        for k in (1, 2, 3):
            h ^= h >> np.uint64(31)
            h += words[8 * k:8 * k + n] * _FACTORS[k]
        h ^= h >> np.uint64(29)
        h *= _FACTORS[4]
        h ^= h >> np.uint64(32)
    return h


def anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window of length bytes the position of its anchor: leftmost smallest."""
    wide = length - GRAM + 1
    if len(hashes) < wide:
        return np.zeros(0, np.int64)
    best = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= wide:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < wide:
        best = np.minimum(best[:len(best) - (wide - reach)], best[wide - reach:])
    return (best & _PLACE).astype(np.int64)


def stretches(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, hash of the gram) of each stretch of windows
    with one anchor. valid: which windows lie inside one document."""
    hashes = gram_hashes(data)
    anchor = anchors(hashes, length)
    valid = valid[:len(anchor)]
    at = np.flatnonzero(valid)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.int64),)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (anchor[at[1:]] != anchor[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    return first, last, anchor[first], hashes[anchor[first]].view(np.int64)


class _Step:
    """Some documents, or a piece of a long one, in one array."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], length: int):
        self.rows = np.array([p[0] for p in pieces])
        self.offsets = np.array([p[1] for p in pieces])
        sizes = np.array([len(p[2]) for p in pieces])
        self.begins = np.cumsum(sizes) - sizes
        self.raw = b"".join(p[2] for p in pieces)
        self.data = np.frombuffer(self.raw, np.uint8)
        valid = np.zeros(len(self.data) + 1, np.int64)
        full = sizes >= length
        np.add.at(valid, self.begins[full], 1)
        np.add.at(valid, self.begins[full] + sizes[full] - length + 1, -1)
        self.valid = np.cumsum(valid[:-1]) > 0

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and position in the document of positions in the step."""
        piece = np.searchsorted(self.begins, at, side="right") - 1
        return self.rows[piece], at - self.begins[piece] + self.offsets[piece]


def _steps(texts: pa.Array, length: int) -> Iterator[_Step]:
    pieces, size = [], 0
    for row, text in enumerate(texts):
        data = text.as_py() or b""
        for offset in range(0, max(1, len(data) - length + 1), STEP):
            piece = data[offset:offset + STEP + length - 1]
            if len(piece) < length:
                continue
            if size + len(piece) > STEP + length and pieces:
                yield _Step(pieces, length)
                pieces, size = [], 0
            pieces.append((row, offset, piece))
            size += len(piece)
    if pieces:
        yield _Step(pieces, length)


def _documents(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
        text.cast("binary").alias("text"))


def _repeated_grams(documents: DataFrame, length: int) -> tuple[list[str], int]:
    """Hashes of the grams that anchor two stretches or more, as files of sorted numbers,
    and the number of such stretches."""
    folder = work_dir(documents.sparkSession, "suffix-grams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [stretches(s.data, s.valid, length)[3] for s in _steps(batch.column(2), length)]
            grams, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            grams = np.concatenate([p[0] for p in parts])
            name = f"{folder}/{attempt_name('grams', TaskContext.get().partitionId())}"
            save_arrays(name, {"numbers": grams})
            yield pa.RecordBatch.from_pydict(
                {"low": [int(grams[0])], "file": [name], "n": [int(sum(p[1].sum() for p in parts))]})

    counted = documents.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    ordered = materialise(counted, "suffix-grams").repartitionByRange("gram").sortWithinPartitions("gram")
    rows = materialise(ordered.mapInArrow(write, "low long, file string, n long"), "suffix-files").orderBy("low").collect()
    return [r.file for r in rows], sum(r.n for r in rows)


Position = tuple[int, int, int]  # doc_id, hash of the text, first byte


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which known bytes are known."""
    n = min(len(a), len(b))
    while known + 16 <= n and a[known:known + 16] == b[known:known + 16]:
        known += 16
    while known < n and a[known] == b[known]:
        known += 1
    return known


class Run:
    """A sorted, front-coded run: keys, prefixes shared with the key before, positions."""

    def __init__(self, keys: list[bytes], shared: list[int], ids: list, texts: list, starts: list):
        self.keys, self.shared, self.ids, self.texts, self.starts = keys, shared, ids, texts, starts

    @staticmethod
    def pack(entries: list[tuple[bytes, Position]]) -> bytes:
        tails, shared, before = [], [], b""
        for key, _ in entries:
            n = shared_prefix(before, key, 0)
            shared.append(n)
            tails.append(key[n:])
            before = key
        numbers = np.array([p for _, p in entries], "<i8").T
        raw = [np.array([len(entries)], "<i8").tobytes(), np.array(shared, np.uint8).tobytes(),
               np.array([len(t) for t in tails], np.uint8).tobytes(), np.ascontiguousarray(numbers).tobytes(), *tails]
        return zstandard.ZstdCompressor(3).compress(b"".join(raw))

    @classmethod
    def unpack(cls, packed: bytes) -> Run:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        shared = np.frombuffer(raw, np.uint8, n, 8).tolist()
        sizes = np.frombuffer(raw, np.uint8, n, 8 + n).tolist()
        ids, texts, starts = np.frombuffer(raw, "<i8", 3 * n, 8 + 2 * n).reshape(3, n).tolist()
        at, keys, before = 8 + 26 * n, [], b""
        for common, size in zip(shared, sizes, strict=True):
            before = before[:common] + raw[at:at + size]
            keys.append(before)
            at += size
        return cls(keys, shared, ids, texts, starts)


def merge(runs: list[Run]) -> Iterator[tuple[bytes, int, Position]]:
    """(key, prefix shared with the output before, position) of all entries in order.

    A loser tree. With each candidate goes the length of the prefix it shares with the
    last output. Of two candidates the one that shares more is smaller; only if they
    share equally much are they compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [r.keys[0] if r.keys else None for r in runs] + [None] * (size - len(runs))
    shared, next_ = [0] * size, [0] * size

    def play(p: int, q: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes that with the winner."""
        a, b = heads[p], heads[q]
        if a is None or b is None:
            return (q, p) if a is None else (p, q)
        if shared[p] != shared[q]:
            return (p, q) if shared[p] > shared[q] else (q, p)
        n = shared_prefix(a, b, shared[p])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            shared[q] = n
            return p, q
        shared[p] = n
        return q, p

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    winner = winners[1] if size > 1 else 0
    while heads[winner] is not None:
        run, i = runs[winner], next_[winner]
        yield heads[winner], shared[winner], (run.ids[i], run.texts[i], run.starts[i])
        next_[winner] = i = i + 1
        if i < len(run.keys):
            heads[winner], shared[winner] = run.keys[i], run.shared[i]
        else:
            heads[winner] = None
        node = (winner + size) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1


class _Spans:
    """Repeated windows gathered as byte spans per document."""

    def __init__(self, length: int):
        self.length, self.rows = length, []

    def add(self, position: Position, last: int) -> None:
        """Windows from the position to the window that starts at last."""
        self.rows.append((*position, last + self.length))

    def batch(self) -> pa.RecordBatch:
        joined: list[list[int]] = []
        for row in sorted(self.rows):
            if joined and joined[-1][:2] == list(row[:2]) and row[2] <= joined[-1][3]:
                joined[-1][3] = max(joined[-1][3], row[3])
            else:
                joined.append(list(row))
        self.rows = []
        columns = np.array(joined, np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _SPAN_NAMES)


_SPAN_NAMES = ["doc_id", "text_key", "first", "end"]
SPANS = "doc_id long, text_key long, first long, end long"


def _key(gram: int, text: bytes, first: int, anchor: int, end: int) -> bytes:
    return b"".join((
        (gram + (1 << 63)).to_bytes(8, "big"), text[anchor:end], _MARK, text[first:anchor][::-1],
        bytes((anchor - first,))))


def _text_of(key: bytes) -> bytes:
    """The bytes of a stretch."""
    before = key[-1]
    cut = len(key) - 1 - before
    return key[cut:-1][::-1] + key[8:cut - 1]


def _write_runs(files: list[str], ranges: int, length: int):
    """(range, run): sorted runs, and under range -1 spans already known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = SortedNumbers(files)
        first_of: dict[bytes, Position] = {}
        spans = _Spans(length)

        def flush() -> pa.RecordBatch:
            by_range: dict[int, list] = {}
            for key in sorted(first_of):
                by_range.setdefault(int.from_bytes(key[:8], "big") * ranges >> 64, []).append((key, first_of[key]))
            numbers, packed = list(by_range), [Run.pack(x) for x in by_range.values()]
            first_of.clear()
            known = spans.batch()
            if known.num_rows:
                raw = np.stack([c.to_numpy() for c in known.columns]).astype("<i8")
                numbers.append(-1)
                packed.append(zstandard.ZstdCompressor(3).compress(raw.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["range", "run"])

        for batch in batches:
            ids = batch.column(0).fill_null(int(np.iinfo(np.int64).min)).to_pylist()
            keys = batch.column(1).to_pylist()
            for step in _steps(batch.column(2), length):
                first, last, anchor, gram = stretches(step.data, step.valid, length)
                good = repeated.has(gram) if len(gram) else np.zeros(0, bool)
                first, last, anchor, gram = (x[good] for x in (first, last, anchor, gram))
                row, start = step.place(first)
                for f, z, a, g, r, p in zip(*(x.tolist() for x in (first, last, anchor, gram, row, start)), strict=True):
                    key = _key(g, step.raw, f, a, z + length)
                    position = (ids[r], keys[r], p)
                    other = first_of.setdefault(key, position)
                    if other is not position and other != position:
                        if position < other:
                            first_of[key] = position
                            position = other
                        spans.add(position, position[2] + z - f)
                if len(first_of) > RUN_ENTRIES or len(spans.rows) > SPAN_ENTRIES:
                    yield flush()
        yield flush()
    return run


def _resolve(group: list[tuple[bytes, Position]], length: int, spans: _Spans) -> None:
    """Distinct stretches with one gram: of equal windows all but the first repeat.
    Windows are taken by their offset to the anchor, one offset at a time."""
    texts = [(_text_of(key), key[-1], position) for key, position in group]
    offsets: dict[int, list[int]] = {}
    for i, (text, before, _) in enumerate(texts):
        for offset in range(before, before - (len(text) - length) - 1, -1):
            offsets.setdefault(offset, []).append(i)
    for offset, members in offsets.items():
        if len(members) < 2:
            continue
        first_of: dict[bytes, Position] = {}
        for i in members:
            text, before, (doc, key, start) = texts[i]
            at = before - offset
            window, position = text[at:at + length], (doc, key, start + at)
            other = first_of.setdefault(window, position)
            if other is not position and other != position:
                if position < other:
                    first_of[window] = position
                    position = other
                spans.add(position, position[2])


def _merge_range(length: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [Run.unpack(x.as_py()) for batch in batches for x in batch.column("run")]
        spans = _Spans(length)
        group: list[tuple[bytes, Position]] = []
        for entry, shared, position in merge(runs):
            if shared < 8 + GRAM and group:
                if len(group) > 1:
                    _resolve(group, length, spans)
                group = []
            if group and entry == group[-1][0]:
                other = group[-1][1]
                if other == position:
                    continue
                if position < other:
                    group[-1] = (entry, position)
                    position = other
                spans.add(position, position[2] + len(_text_of(entry)) - length)
            else:
                group.append((entry, position))
            if len(spans.rows) > SPAN_ENTRIES:
                yield spans.batch()
        if len(group) > 1:
            _resolve(group, length, spans)
        yield spans.batch()
    return run


def _known_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("run"):
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), "<i8").reshape(4, -1)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in raw], _SPAN_NAMES)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_key, first, end): byte spans covered by strings of length bytes that
    also start earlier. Spans of one document may overlap or touch."""
    if not GRAM <= length <= MAX_LENGTH:
        raise ValueError(f"the length must be {GRAM} to {MAX_LENGTH} bytes")
    documents = _documents(docs)
    files, n = _repeated_grams(documents, length)
    if not files:
        return documents.select("doc_id", "text_key", F.lit(0).cast("long").alias("first"),
                                F.lit(0).cast("long").alias("end")).where("false")
    ranges = max(1, -(-n // RANGE_ENTRIES))
    runs = materialise(documents.mapInArrow(_write_runs(files, ranges, length), "range int, run binary"), "suffix-runs")
    merged = runs.where("range >= 0").repartition(ranges, "range").groupBy("range").applyInArrow(
        _merge_range(length), SPANS)
    return merged.union(runs.where("range < 0").mapInArrow(_known_spans, SPANS))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the
    remaining bytes (null without with_text, and for null texts).

    Earlier means in a document of smaller id, or of equal id and smaller hash of the
    text, or earlier in the same document. Null ids come before all others; rows that
    agree in id and text are one document and get equal results; null and empty texts
    have no bytes; an empty table gives no rows; columns other than id and text are not
    read. Texts of any length are taken whole.
    """
    low = F.lit(int(np.iinfo(np.int64).min))
    spans = repeated_spans(docs, length).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "end")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans")
    documents = _documents(docs)
    joined = documents.join(
        spans, (F.coalesce("doc_id", low) == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left").select(
        "doc_id", "text", F.col("spans.first").alias("first"), F.col("spans.end").alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, first, end in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                data, begins, ends = text.as_py(), first.as_py(), end.as_py()
                rows.append(_cut(data or b"", begins or [], ends or []) + ((data is not None and with_text),))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
                pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows]),
                pa.array([r[3] if r[4] else None for r in rows], pa.binary())], [c.split()[0] for c in RESULT.split(", ")])

    return joined.mapInArrow(run, RESULT)


def _cut(data: bytes, begins: list[int], ends: list[int]) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, maximal removed runs, what remains)."""
    runs: list[list[int]] = []
    for first, end in sorted(zip(begins, ends, strict=True)):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([first, end])
    edges = [0, *(x for r in runs for x in r), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return len(data), len(data) - len(kept), len(runs), kept
