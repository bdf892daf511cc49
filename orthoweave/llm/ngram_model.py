"""Language-model scoring with an n-gram trie in Elias-Fano levels.

Words are numbered by the order of their 64-bit hashes. Level k of the trie holds the
n-grams of length k; the parent of an n-gram is the entry of its first k-1 words one
level up (at level 2 the word itself). A level is cut into segments by a hash of the
parent. A segment has Elias-Fano arrays of its parents, of the monotone pointers to
where each parent's successors begin, and of the successors, made monotone as ``rank of
the parent * words + word``: a lookup is a successor search among one parent's words.
Each entry has a quantised discounted probability, each parent a quantised weight of
the shorter context. Segments are files in the shared folder, memory-mapped by tasks.

Probability (interpolated absolute discounting): ``p_k = (c - d) / c(parent) +
weight(parent) * p_(k-1)``; ``p_1 = (c + 0.5) / (N + 0.5 (V + 1))``. The registered query
keeps every n-gram; by default entries of level 3 that occur once are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.llm.array_files import load_arrays, save_arrays
from orthoweave.llm.common import attempt_name, bucket_of_id, materialise
from orthoweave.llm.elias_fano import EliasFano, encode
from orthoweave.session import work_dir

ORDER = 3
DISCOUNT = 0.75
#: Occurrences an n-gram needs to enter its level: by default, and to keep all.
MIN_COUNT = {2: 1, 3: 2}
EVERY = {2: 1, 3: 1}
#: Steps of a unit of log10 in which probabilities and weights are kept, in 16 bits.
QUANTA = 2048
#: Tokens of the corpus per segment of a level.
SEGMENT_TOKENS = 4_000_000
#: Tokens handled at once, and words whose numbers a worker remembers.
CHUNK_TOKENS, REMEMBERED = 500_000, 400_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
END = b""  # no word is empty


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII blanks, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(), END]


def word_hash(word: bytes) -> int:
    """A signed 64-bit hash; words are told apart by it."""
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def _segment_of(parents: np.ndarray, segments: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = parents.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)


class Words:
    """Numbers and counts of words, from the files of the vocabulary in hash order."""

    def __init__(self, files: list[str]):
        parts = [load_arrays(f) for f in files]
        self.hashes, self.counts = [p["hash"] for p in parts], [p["count"] for p in parts]
        self.bases = np.concatenate(([0], np.cumsum([len(h) for h in self.hashes])))
        self.lows = np.array([h[0] for h in self.hashes], np.int64)
        self.memory: dict[bytes, int] = {}

    def __len__(self) -> int:
        return int(self.bases[-1])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """-1 for unknown words."""
        new = list(set(words).difference(self.memory))
        if len(self.memory) + len(new) > REMEMBERED and self.memory:
            self.memory = {}
            new = list(set(words))
        if new:
            self.memory.update(zip(new, self._search(np.array([word_hash(w) for w in new], np.int64)).tolist(), strict=True))
        memory = self.memory
        return np.array([memory[w] for w in words], np.int64)

    def _search(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        home = np.searchsorted(self.lows, hashes, side="right") - 1
        for part in np.unique(home[home >= 0]).tolist():
            own = np.flatnonzero(home == part)
            at = np.searchsorted(self.hashes[part], hashes[own])
            at = np.minimum(at, len(self.hashes[part]) - 1)
            same = self.hashes[part][at] == hashes[own]
            out[own[same]] = self.bases[part] + at[same]
        return out

    def count_of(self, numbers: np.ndarray) -> np.ndarray:
        """Counts, 0 for unknown words."""
        out = np.zeros(len(numbers), np.int64)
        home = np.searchsorted(self.bases, numbers, side="right") - 1
        for part in np.unique(home[numbers >= 0]).tolist():
            own = np.flatnonzero((home == part) & (numbers >= 0))
            out[own] = self.counts[part][numbers[own] - self.bases[part]]
        return out


class Segment:
    def __init__(self, uri: str):
        arrays = load_arrays(uri)
        pick = lambda name: {k[len(name) + 1:]: v for k, v in arrays.items() if k.startswith(name + ".")}
        self.parents, self.pointers, self.successors = (EliasFano(pick(x)) for x in ("parents", "pointers", "successors"))
        self.codes, self.weights, self.counts = arrays["codes"], arrays["weights"], arrays["counts"]


class Level:
    """The segments of one level. files: by segment, '' for an empty one."""

    def __init__(self, files: list[str], sizes: list[int], words: int):
        self.files, self.words, self.opened = files, words, {}
        self.bases = np.concatenate(([0], np.cumsum(sizes)))

    def segment(self, i: int) -> Segment:
        if i not in self.opened:
            self.opened[i] = Segment(self.files[i])
        return self.opened[i]

    def search(self, parents: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pairs (parent >= 0, word; -1 unknown): number of the entry or -1, its
        discounted probability, and the weight of the shorter context."""
        entry = np.full(len(parents), -1, np.int64)
        p, weight = np.zeros(len(parents)), np.ones(len(parents))
        if not len(self.files):
            return entry, p, weight
        # parents repeat, so each is looked up once; segments keep their rows together
        kinds, back = np.unique(parents, return_inverse=True)
        home = _segment_of(kinds, len(self.files))
        by_home = home[back]
        order, kind_order = np.argsort(by_home, kind="stable"), np.argsort(home, kind="stable")
        every = np.arange(len(self.files) + 1)
        cuts, kind_cuts = np.searchsorted(by_home[order], every), np.searchsorted(home[kind_order], every)
        ranks = np.full(len(kinds), -1, np.int64)
        for i, file in enumerate(self.files):
            own = kind_order[kind_cuts[i]:kind_cuts[i + 1]]
            if not len(own) or not file:
                continue
            segment = self.segment(i)
            ranks[own] = segment.parents.find(kinds[own])
            rows = order[cuts[i]:cuts[i + 1]]
            rank = ranks[back[rows]]
            rows, rank = rows[rank >= 0], rank[rank >= 0]
            weight[rows] = _unpack(segment.weights[rank])
            known = words[rows] >= 0
            rows, rank = rows[known], rank[known]
            at = segment.successors.find(rank * self.words + words[rows])
            rows, at = rows[at >= 0], at[at >= 0]
            entry[rows] = self.bases[i] + at
            p[rows] = _unpack(segment.codes[at])
        return entry, p, weight

    def counts_of(self, entries: np.ndarray) -> np.ndarray:
        out = np.zeros(len(entries), np.int64)
        home = np.searchsorted(self.bases, entries, side="right") - 1
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(len(self.files) + 1))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[i]:cuts[i + 1]]
            out[own] = self.segment(i).counts[entries[own] - self.bases[i]]
        return out


def _pack(p: np.ndarray) -> np.ndarray:
    """65535 stands for zero."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-np.log10(p) * QUANTA)
    return np.where(p > 0, np.clip(steps, 0, 65534), 65535).astype("<u2")


def _unpack(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == 65535, 0.0, 10.0 ** (-codes.astype(np.float64) / QUANTA))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def _vocabulary(training: DataFrame, folder: str) -> tuple[list[str], int, int]:
    """Counts words and writes them in hash order; gives the files, V and N."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([word_hash(w) for w in found], pa.int64()), pa.array(found.values(), pa.int64())],
                ["hash", "n"])
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(1):
                found.update(tokens(text.as_py()))
            if len(found) > REMEMBERED:
                yield batch_of(found)
                found = Counter()
        yield batch_of(found)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not sum(len(h) for h, _ in parts):
            return
        hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        name = f"{folder}/{attempt_name('words', TaskContext.get().partitionId())}"
        save_arrays(name, {"hash": hashes, "count": counts})
        yield pa.RecordBatch.from_pydict(
            {"low": [int(hashes[0])], "file": [name], "words": [len(hashes)], "tokens": [int(counts.sum())]})

    counted = training.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    ordered = materialise(counted, "lm-words").repartitionByRange("hash").sortWithinPartitions("hash")
    files = materialise(ordered.mapInArrow(write, "low long, file string, words long, tokens long"), "lm-words-files")
    rows = files.orderBy("low").collect()  # one row per file
    return [r.file for r in rows], sum(r.words for r in rows), sum(r.tokens for r in rows)


def _runs(model: Model, level: int):
    """Counts the n-grams of a level per task and sends them as packed sorted runs:
    (segment, run)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.open()
        words = np.int64(len(reader.words))
        press = zstandard.ZstdCompressor(1)
        for numbers, starts in _chunks(batches, reader.words):
            parents, last = reader.parents(numbers, starts, level)
            good = (parents >= 0) & (last >= 0)
            keys, n = np.unique(np.stack([parents[good], last[good]]), axis=1, return_counts=True) \
                if reader.wide(level) else _unique_pairs(parents[good], last[good], words)
            home = _segment_of(keys[0], model.segments)
            order = np.argsort(home, kind="stable")
            cuts = np.searchsorted(home[order], np.arange(model.segments + 1))
            segments, runs = [], []
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                rows = order[cuts[i]:cuts[i + 1]]
                first = np.diff(keys[0][rows], prepend=0)
                raw = np.concatenate([first, keys[1][rows], n[rows]]).astype("<i8").reshape(3, -1)
                narrow = raw.view(np.uint8).reshape(3, -1, 8).transpose(0, 2, 1)  # bytes of equal weight together
                segments.append(i)
                runs.append(press.compress(np.ascontiguousarray(narrow).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(runs, pa.binary())], ["segment", "run"])
    return run


def _unique_pairs(a: np.ndarray, b: np.ndarray, words: np.int64) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.unique(a * words + b, return_counts=True)
    return np.stack([key // words, key % words]), n


def _unpack_run(run: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), np.uint8)
    raw = np.ascontiguousarray(raw.reshape(3, 8, -1).transpose(0, 2, 1)).view("<i8").reshape(3, -1).copy()
    raw[0] = np.cumsum(raw[0])
    return raw


def _chunks(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the tokens of some documents, and where each document begins. A long
    document is one chunk: its n-grams are whole."""
    for batch in batches:
        found, starts = [], []
        for text in batch.column(1):
            starts.append(len(found))
            found += tokens(text.as_py())
            if len(found) >= CHUNK_TOKENS:
                yield words.numbers(found), np.array(starts)
                found, starts = [], []
        if found:
            yield words.numbers(found), np.array(starts)


def _write_segments(model: Model, level: int, parent_counts: bool):
    """Merges the runs of a segment and writes its arrays."""
    least = model.min_count[level]

    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.open()
        segment, merged, waiting, size = key[0].as_py(), None, [], 0
        for batch in tables:
            for packed in batch.column("run"):
                waiting.append(_unpack_run(packed.as_py()))
                size += waiting[-1].shape[1]
                if size > max(2_000_000, 0 if merged is None else merged.shape[1]):
                    merged, waiting, size = _merge([merged, *waiting]), [], 0
        merged = _merge([merged, *waiting])
        merged = merged[:, merged[2] >= least]
        parent, word, n = merged
        if not len(parent):
            return
        unique, first = np.unique(parent, return_index=True)
        rank = np.repeat(np.arange(len(unique)), np.diff(first, append=len(parent)))
        total = (reader.words.count_of(unique) if level == 2 else reader.levels[level - 3].counts_of(unique)).astype(np.float64)
        p = np.maximum(n - DISCOUNT, 0) / total[rank]
        weight = np.maximum(1 - np.add.reduceat(p, first), 1e-9)
        words = len(reader.words)
        arrays: dict[str, np.ndarray] = {"codes": _pack(p), "weights": _pack(weight)}
        arrays["counts"] = n.astype("<u4") if parent_counts else np.zeros(0, "<u4")
        universe = int(parent.max()) + 1
        for name, values, top in (
                ("parents", unique, universe), ("pointers", first, len(parent) + 1),
                ("successors", rank * words + word, len(unique) * words)):
            arrays |= {f"{name}.{k}": v for k, v in encode(values, top).items()}
        name = f"{model.folder}/{attempt_name(f'level{level}', segment)}"
        save_arrays(name, arrays)
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([name]), pa.array([len(parent)], pa.int64())],
            ["segment", "file", "entries"])
    return run


def _merge(runs: list) -> np.ndarray:
    runs = [r for r in runs if r is not None]
    every = np.concatenate(runs, axis=1) if runs else np.zeros((3, 0), np.int64)
    order = np.lexsort((every[1], every[0]))
    every = every[:, order]
    if not every.shape[1]:
        return every
    new = np.ones(every.shape[1], bool)
    new[1:] = (np.diff(every[0]) != 0) | (np.diff(every[1]) != 0)
    first = np.flatnonzero(new)
    return np.stack([every[0][first], every[1][first], np.add.reduceat(every[2], first)])


class Model:
    """What tasks need to open the trie: names of files and totals."""

    def __init__(self, folder: str, word_files: list[str], vocabulary: int, n_tokens: int,
                 min_count: dict[int, int] = MIN_COUNT):
        self.min_count = min_count
        self.folder, self.word_files, self.vocabulary, self.n_tokens = folder, word_files, vocabulary, n_tokens
        self.segments = max(1, -(-n_tokens // SEGMENT_TOKENS))
        self.levels: list[tuple[list[str], list[int]]] = []

    def open(self) -> Reader:
        key = (self.folder, len(self.levels))
        if key not in _READERS:
            _READERS.clear()
            _READERS[key] = Reader(self)
        return _READERS[key]


_READERS: dict[tuple, Reader] = {}


class Reader:
    """The trie, opened in a task."""

    def __init__(self, model: Model):
        self.words = Words(model.word_files)
        self.n_tokens, self.vocabulary = model.n_tokens, model.vocabulary
        self.min_count = model.min_count
        self.levels = [Level(files, sizes, len(self.words)) for files, sizes in model.levels]
        self.end = int(self.words.numbers([END])[0])

    def wide(self, level: int) -> bool:
        """Whether parent and word do not fit one 64-bit number."""
        parents = len(self.words) if level == 2 else int(self.levels[level - 3].bases[-1])
        return parents * len(self.words) >= 1 << 62

    def before(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The word before each token; documents begin after an end."""
        out = np.concatenate(([self.end], numbers[:-1]))
        out[starts] = self.end
        return out

    def parents(self, numbers: np.ndarray, starts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Parent entries (or -1) and last words of the n-grams that end at each token. At
        level 3 a document's first token has none, nor has one whose parent is too rare to
        have a kept child."""
        parent = self.before(numbers, starts)
        if level == 2:
            return parent, numbers
        entry = self._entries(parent, numbers)
        out = np.concatenate(([-1], entry[:-1]))
        out[starts] = -1
        return self._with_children(out), numbers

    def _with_children(self, entries: np.ndarray) -> np.ndarray:
        """-1 for entries of level 2 that are too rare to be a parent at level 3."""
        if self.min_count[3] <= self.min_count[2]:
            return entries
        known = np.flatnonzero(entries >= 0)
        often = self.levels[0].counts_of(entries[known]) >= self.min_count[3]
        entries[known[~often]] = -1
        return entries

    def _entries(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(word), -1, np.int64)
        good = np.flatnonzero((parent >= 0) & (word >= 0))
        out[good] = self.levels[0].search(parent[good], word[good])[0]
        return out

    def probabilities(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(interpolated, base, counts) for each token."""
        counts = self.words.count_of(numbers)
        base = (counts + 0.5) / (self.n_tokens + 0.5 * (self.vocabulary + 1))
        p, entry = base.copy(), np.full(len(numbers), -1, np.int64)
        for depth, level in enumerate(self.levels):
            if depth == 0:
                parent = self.before(numbers, starts)
            else:
                parent = np.concatenate(([-1], entry[:-1]))
                parent[starts] = -1
                parent = self._with_children(parent)
            good = np.flatnonzero(parent >= 0)
            found, own, weight = level.search(parent[good], numbers[good])
            p[good] = own + weight * p[good]
            entry = np.full(len(numbers), -1, np.int64)
            entry[good] = found
        return p, base, counts


def build(training: DataFrame, order: int = ORDER, min_count: dict[int, int] = MIN_COUNT) -> Model:
    """Counts the corpus level by level and writes the trie to the shared folder. Counts
    travel as packed sorted runs, one per task, segment and half a million tokens."""
    spark = training.sparkSession
    folder = work_dir(spark, "lm-trie")
    texts = _texts(training)
    model = Model(folder, *_vocabulary(texts, folder), min_count)
    for level in range(2, order + 1):
        if not model.n_tokens:
            break
        runs = texts.mapInArrow(_runs(model, level), "segment int, run binary")
        written = runs.repartition(model.segments, "segment").groupBy("segment").applyInArrow(
            _write_segments(model, level, level < order), "segment int, file string, entries long")
        files, sizes = [""] * model.segments, [0] * model.segments
        for row in materialise(written, "lm-level-files").collect():  # one row per segment
            files[row.segment], sizes[row.segment] = row.file, row.entries
        model.levels.append((files, sizes))
    return model


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per input row: n_tokens (with the end), n_known, train_tokens, base_score
    (add-half words) and score (the trie), both log10 of the whole text's probability.

    Null and empty texts are one end; null ids stay; repeated rows are scored each; an
    empty table gives no rows. A model of an empty corpus knows no word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.open() if model.n_tokens else None
        for batch in batches:
            parts = []
            for numbers, starts in _chunks([batch], reader.words if reader else _NoWords()):
                if reader:
                    p, base, counts = reader.probabilities(numbers, starts)
                else:
                    p = base = np.ones(len(numbers))
                    counts = np.zeros(len(numbers), np.int64)
                add = lambda x, at=starts: np.add.reduceat(x, at)
                parts.append((np.diff(starts, append=len(numbers)), add((counts > 0).astype(np.int64)),
                              add(np.log10(base)), add(np.log10(p))))
            if not parts:
                continue
            n, known, base, own = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                pa.array(np.full(len(n), model.n_tokens), pa.int64()), pa.array(base, pa.float64()),
                pa.array(own, pa.float64())], [c.split()[0] for c in SCORES.split(", ")])

    return _texts(docs).mapInArrow(run, SCORES)


class _NoWords:
    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.full(len(words), -1, np.int64)


def held_out_scores(spark: SparkSession, docs: DataFrame, min_count: dict[int, int] = MIN_COUNT) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fifth."""
    held = bucket_of_id(5) == 1
    model = build(docs.where(~held), min_count=min_count)
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
