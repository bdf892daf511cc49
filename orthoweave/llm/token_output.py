"""Token ids as raw payload shards with a minimal perfect hash index.

A shard is two files. ``.ids`` holds the ids of its documents one after the other
(little-endian, 2 or 4 bytes an id), ``.mph`` the index: a minimal perfect hash of the
document keys in levels of bits, and per slot a 32-bit fingerprint of the key, the
document's first id and its number of ids. A lookup probes a level or two, ranks one
bit and compares one fingerprint, whatever the size of the shard; keys themselves are
not stored. Key: doc_id and its ordinal among rows of equal id.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orthoweave.llm.common import attempt_name, materialise, open_fs, write_file
from orthoweave.session import work_dir

END_ID = 0
MAGIC = b"MPHIDS01"
#: Words in a generation of a worker's memory. When one is full, the words used since
#: then are kept and older ones forgotten.
REMEMBERED = 400_000
#: Marks at a word's end that are a token of their own after a letter or digit.
END_MARKS = ",.!?;:"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Blanks other than space and line end.
_OTHER_BLANK = re.compile(r"[^\S \n]")
_BLANK = re.compile(r"\s")
#: Words of Latin letters only.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
#: Bytes as byte-level vocabularies write them: printable ones as themselves, others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(sorted(set(range(256)).difference(_PRINTABLE)))}
_INNER_BLANK = re.compile(r"(?<=\S) (?=\S)")


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer (splitmix), vectorised."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN * np.uint64(2 * seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_keys(ids: np.ndarray, nulls: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
    """64-bit hashes of (doc_id or null, ordinal)."""
    first = _mix(np.where(nulls, 0, ids).astype(np.int64).view(np.uint64), 1) ^ np.where(nulls, _GOLDEN, np.uint64(0))
    return _mix(first ^ _mix(ordinals.astype(np.uint64), 2), 3)


class PerfectHash:
    """Level i keeps the keys that no other key of the level meets at its bit; the others
    go on to level i + 1. A key's number is the rank of its bit over all levels."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # arrays of bool
        ends = np.cumsum([int(x.sum()) for x in levels]) if levels else np.zeros(0, np.int64)
        self.firsts = np.concatenate(([0], ends))[:len(levels)]
        self.ranks = [np.cumsum(x) - 1 for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) > 200:
                raise ValueError("two keys have equal hashes")
            at = (_mix(left, 10 + len(levels)) % np.uint64(2 * len(left) + 1)).astype(np.int64)
            alone = np.bincount(at, minlength=2 * len(left) + 1) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The key's number, or -1 where no level has its bit."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            at = (_mix(keys[todo], 10 + i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.firsts[i] + self.ranks[i][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out


class ShardIndex:
    """The index of one shard, in memory."""

    def __init__(self, hashed: PerfectHash, prints: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int):
        self.hashed, self.prints, self.starts, self.counts, self.width = hashed, prints, starts, counts, width

    @classmethod
    def build(cls, keys: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int) -> ShardIndex:
        hashed = PerfectHash.build(keys)
        order = np.argsort(hashed.numbers(keys))
        prints = (_mix(keys, 5) >> np.uint64(32)).astype("<u4")
        return cls(hashed, prints[order], starts[order].astype("<u8"), counts[order].astype("<u4"), width)

    def pack(self) -> bytes:
        sizes = [len(x) for x in self.hashed.levels]
        head = struct.pack(f"<8sIIQ{len(sizes)}Q", MAGIC, self.width, len(sizes), len(self.prints), *sizes)
        bits = [np.packbits(x, bitorder="little").tobytes() for x in self.hashed.levels]
        return b"".join([head, *bits, self.prints.tobytes(), self.starts.tobytes(), self.counts.tobytes()])

    @classmethod
    def unpack(cls, data: bytes) -> ShardIndex:
        magic, width, n_levels, n = struct.unpack_from("<8sIIQ", data)
        if magic != MAGIC:
            raise ValueError("not an index of token ids")
        at = struct.calcsize("<8sIIQ")
        sizes = struct.unpack_from(f"<{n_levels}Q", data, at)
        at += 8 * n_levels
        levels = []
        for size in sizes:
            raw = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(raw, count=size, bitorder="little").astype(bool))
            at += len(raw)
        prints = np.frombuffer(data, "<u4", n, at)
        starts = np.frombuffer(data, "<u8", n, at + 4 * n)
        counts = np.frombuffer(data, "<u4", n, at + 12 * n)
        return cls(PerfectHash(levels), prints, starts, counts, width)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 for keys that the shard does not hold."""
        slots = self.hashed.numbers(keys)
        prints = (_mix(keys, 5) >> np.uint64(32)).astype("<u4")
        known = (slots >= 0) & (self.prints[np.maximum(slots, 0)] == prints) if len(self.prints) else slots > 0
        return np.where(known, slots, -1)


def _odd_blanks(text: str) -> bool:
    """Whether blanks stand next to each other or at an end, or are of another kind: there
    a cut at each blank could change the tokens."""
    return (
        text[:1] in " \n" or text[-1:] in " \n" or "  " in text or "\n\n" in text or " \n" in text
        or "\n " in text or _OTHER_BLANK.search(text) is not None)


class Memory:
    """Ids of words in two generations."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> list[str]:
        """The words not remembered; the others are in this generation afterwards."""
        old = words.difference(self.now)
        known = old.intersection(self.before)
        self.now.update((w, self.before[w]) for w in known)
        return list(old.difference(known))

    def turn(self) -> None:
        if len(self.now) > REMEMBERED:
            self.now, self.before = {}, self.now


class Encoder:
    """Texts to packed ids. For byte-level vocabularies a text is cut at line ends and
    before blanks that stand between two other characters, where its tokens part anyway,
    and the ids of each distinct word are computed once. New words are encoded as the
    lines of one text, since the call costs more than the word. Letters, with or without the
    blank before them, are one piece of the cut, so Latin words go to the model without it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_word = (
            spec.get("normalizer") is None and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and spec.get("model", {}).get("dropout") is None and len(line_end) == 1)
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.line_end = line_end[0] if self.by_word else None
        self.line_end_packed = self._pack(line_end)
        self.marks = {c: self._pack(self.tokenizer.encode(c, add_special_tokens=False).ids) for c in END_MARKS}
        self.first, self.later = Memory(), Memory()

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _encode_plain(self, words: list[str], blank: str) -> list[bytes]:
        """Ids of words without blanks in them."""
        letters = [w for w in words if _LETTERS(w)]
        found = dict(zip(letters, self._encode_letters(letters, blank), strict=True))
        others = [w for w in words if w not in found]
        found.update(zip(others, self._encode_lines(others, blank), strict=True))
        return [found[w] for w in words]

    def _encode_letters(self, words: list[str], blank: str) -> list[bytes]:
        """Ids of words that are one piece, blank included."""
        tokenize, kind = self.tokenizer.model.tokenize, "H" if self.width == 2 else "I"
        before, out = blank.translate(_BYTE_LEVEL), []
        for word in words:
            piece = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LEVEL)
            ids = [token.id for token in tokenize(before + piece)]
            out.append(struct.pack(f"<{len(ids)}{kind}", *ids))
        return out

    def _encode_lines(self, words: list[str], blank: str) -> list[bytes]:
        """Ids of words, many at a time as lines of a text."""
        out: list[bytes] = []
        parts = [words[at:at + 2000] for at in range(0, len(words), 2000)]
        texts = [blank + ("\n" + blank).join(part) for part in parts]
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(found.ids, f"<u{self.width}")
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids)) * self.width
            begins = np.concatenate(([0], ends[:-1] + self.width))
            raw = ids.tobytes()
            out += [raw[b:e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
        return out

    def _learn(self, memory: Memory, words: set[str], blank: str) -> None:
        new = memory.missing(words)
        if not new:
            return
        if "\n".join(new).split() != new:
            for word in [w for w in new if not w or _BLANK.search(w)]:
                memory.now[word] = self._pack(self.tokenizer.encode(blank + word, add_special_tokens=False).ids)
            new = [w for w in new if w not in memory.now]
        marked = [w for w in new if len(w) > 1 and w[-1] in END_MARKS and w[-2].isalnum()]
        stems = memory.missing({w[:-1] for w in marked})
        plain = list(set(new).difference(marked).union(stems))
        memory.now.update(zip(plain, self._encode_plain(plain, blank), strict=True))
        memory.now.update((w, memory.now[w[:-1]] + self.marks[w[-1]]) for w in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        self.first.turn()
        self.later.turn()
        out: list[bytes] = [b""] * len(texts)
        starts: list[str] = []  # first words of lines
        rest: list[str] = []  # the words after them
        lines: list[int] = []  # where the rest of each line ends
        docs: list[tuple[int, int]] = []  # (text, where its lines end)
        for i, text in enumerate(texts):
            if not self.by_word or any(x in text for x in self.added):
                out[i] = self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            odd = _odd_blanks(text)
            for line in [text] if odd else text.split("\n"):
                words = _INNER_BLANK.split(line) if odd else line.split(" ")
                starts.append(words[0])
                rest += words[1:]
                lines.append(len(rest))
            docs.append((i, len(lines)))
        heads, tails = self._look_up(self.first, starts, ""), self._look_up(self.later, rest, " ")
        at = begin = 0
        for i, last in docs:
            parts = []
            for k in range(begin, last):
                parts.append(heads[k] + b"".join(tails[at:lines[k]]))
                at = lines[k]
            out[i], begin = self.line_end_packed.join(parts), last
        return out

    def _look_up(self, memory: Memory, words: list[str], blank: str) -> list[bytes]:
        """Ids of the words; one look into the memory each, a second for new ones only."""
        found = list(map(memory.now.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self._learn(memory, {words[i] for i in new}, blank)
            for i in new:
                found[i] = memory.now[words[i]]
        return found


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


MANIFEST = "shard long, ids_path string, index_path string, low long, high long, has_null boolean, n_docs long, n_ids long"


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes one shard per range of doc_id, in ascending order (nulls first), and gives
    the manifest: files, range of ids, number of documents and ids.

    Every row gives one document, null texts an empty one, each ended by end_id. Rows of
    equal id follow each other in order of their texts. Files have names of their own
    per attempt; the manifest, a table in the shared folder, names those that count.
    """
    folder = folder or work_dir(docs.sparkSession, "token-shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer_path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        base = f"{folder}/{attempt_name('shard', shard)}"
        system, path = open_fs(base)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        ids, nulls, counts = [], [], []
        with system.open_output_stream(path + ".ids") as out:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for at in range(0, len(texts), 1000):
                    packed = encoder.encode([t or "" for t in texts[at:at + 1000]])
                    out.write(b"".join(x for p in packed for x in (p, end)))
                    counts += [len(p) // encoder.width + 1 for p in packed]
                nulls.append(np.asarray(batch.column(0).is_null()))
                ids.append(batch.column(0).fill_null(0).to_numpy())
        if not counts:
            system.delete_file(path + ".ids")
            return
        key, null, size = np.concatenate(ids), np.concatenate(nulls), np.array(counts, np.int64)
        index = ShardIndex.build(
            hash_keys(key, null, ordinals(key, null)), np.cumsum(size) - size, size, encoder.width)
        write_file(base + ".mph", [index.pack()])
        known = key[~null]
        row = [shard, base + ".ids", base + ".mph", known.min() if len(known) else None,
               known.max() if len(known) else None, bool(null.any()), len(size), int(size.sum())]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in MANIFEST.split(", ")])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    before = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def ordinals(key: np.ndarray, null: np.ndarray) -> np.ndarray:
    """0, 1, ... among neighbours of equal key."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
    at = np.arange(len(key))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def read_documents(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents with the given ids, through
    the index. keys: doc_id and copies (how many rows of that id are asked for). An id
    that no shard holds gives no row. start counts the ids of all documents before.

    The manifest has a row per shard and is small; keys are sorted so that a task reads
    few shards, front to back.
    """
    shards = manifest.orderBy("shard").toArrow().to_pydict()
    low = np.array([x if x is not None else np.iinfo(np.int64).min for x in shards["low"]], np.int64)
    high = np.array([x if x is not None else np.iinfo(np.int64).min for x in shards["high"]], np.int64)
    null_shard = next((i for i, x in enumerate(shards["has_null"]) if x), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, tuple] = {}
        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            times = batch.column(1).to_numpy()
            key = np.repeat(batch.column(0).fill_null(0).to_numpy(), times)
            null = np.repeat(null, times)
            nth = ordinals(key, null)
            home = np.minimum(np.searchsorted(high, key, side="left"), max(0, len(high) - 1))
            inside = (key >= low[home]) & (key <= high[home]) if len(high) else np.zeros(len(key), bool)
            home = np.where(null, null_shard, np.where(inside, home, -1))
            hashes = hash_keys(key, null, nth)
            for shard in np.unique(home[home >= 0]).tolist():
                if shard not in opened:
                    for _, file in opened.values():
                        file.close()
                    system, path = open_fs(shards["index_path"][shard])
                    with system.open_input_file(path) as file:
                        index = ShardIndex.unpack(file.read())
                    system, path = open_fs(shards["ids_path"][shard])
                    opened = {shard: (index, system.open_input_file(path))}
                index, file = opened[shard]
                rows = np.flatnonzero(home == shard)
                slots = index.find(hashes[rows])
                rows, slots = rows[slots >= 0], slots[slots >= 0]
                starts, counts = index.starts[slots].astype(np.int64), index.counts[slots].astype(np.int64)
                sums = []
                for start, count in zip(starts.tolist(), counts.tolist(), strict=True):
                    raw = file.read_at(count * index.width, start * index.width)
                    sums.append(zlib.crc32(np.frombuffer(raw, f"<u{index.width}").astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[rows], pa.int64(), mask=null[rows]),
                    pa.array(starts + shards["first_id"][shard], pa.int64()),
                    pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])
        for _, file in opened.values():
            file.close()

    ordered = keys.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes all documents and reads each back by its key: doc_id, start, n_tokens with
    the end id, ids_crc32 of the ids as little-endian 32-bit integers.

    Null ids come first in the order, null and empty texts hold the end id only, rows of
    equal id are told apart by an ordinal, an empty table gives no rows, and columns
    other than id and text are not read.
    """
    manifest = materialise(write_shards(docs, tokenizer_path), "token-manifest")
    keys = docs.select(docs["doc_id"].cast("long").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("copies"))
    return read_documents(manifest, keys)
