"""Sum-of-squares packing of documents into training windows.

A window holds WINDOW token ids. Each task packs its documents online: the full windows
of a long document go out at once, and what remains is placed into the fill level for
which the sum over all levels of (number of windows at that level) squared is smallest,
the empty window being one of the choices. A level array holds those numbers, so a
placement is two array operations and never looks at single windows. The sum stays small
when the fill levels stay spread, and spread levels meet most remainders exactly.

At the end of a task, and whenever MAX_OPEN windows are open, the open windows are closed:
the emptiest are cut up to fill the fullest. Only one part-filled window per task is left;
it goes out as shorter sequences whose lengths are powers of two, which need no padding.
Tasks pack on their own: no shuffle, and memory of MAX_OPEN windows.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.token_output import Memory

WINDOW = 4096
END_ID = 2
#: So many windows may be part-filled at a time in a task (16 MB of ids).
MAX_OPEN = 2048
#: Documents encoded and placed together.
STEP = 1000
#: Marks that are a token of their own at a word's end.
END_MARKS = ",.!?;:"
#: Below this letter, lower case is one letter and nothing composes with its neighbours.
LATIN_END = "\u0130"
#: Bits of a sequence id below the task's number.
_TASK_SHIFT = 40


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as a letter: printable Latin-1 bytes as they
    are, the others as the letters from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class WordEncoder:
    """Texts to packed ids. Where the vocabulary drops white space and normalises within
    words only, a text is cut at spaces and line ends and each distinct word is encoded
    once; other vocabularies, and texts with added tokens in them, are encoded whole.

    Printable words of Latin letters need no normalisation but lower case, so they are
    cut by the vocabulary's own pattern and go straight to its merges; other words pass
    through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        norms = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = cuts[0].get("pattern", {}).get("Regex", "")
        self.by_word = (
            norms == ["NFC", "Replace", "Lowercase"] and cuts[0].get("type") == "Split" and cuts[0].get("invert") is True
            and cuts[0].get("behavior") == "Removed" and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and [x.get("type") for x in cuts[1:]] == ["ByteLevel"] and not cuts[1].get("add_prefix_space")
            and not cuts[1].get("use_regex") and spec.get("model", {}).get("dropout") is None)
        self.parts = regex.compile(pattern).findall
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.code = "H" if self.width == 2 else "I"
        self.marks = {c: self._whole(c) for c in END_MARKS}
        self.memory = Memory()

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        """Ids of one part of a word, in lower case."""
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS)
        return self._pack([t.id for t in self.model.tokenize(letters)])

    def _learn(self, words: set[str]) -> None:
        now, memory, marks = self.memory.now, self.memory, self.marks
        for word in memory.missing(words):
            mark = marks.get(word[-1:])
            stem = word[:-1] if mark else word
            if stem.isalpha() and (stem.isascii() or max(stem) < LATIN_END):
                stem = stem.lower()
                if (known := now.get(stem)) is None:
                    known = now[stem] = self._part(stem)
                now[word] = known + mark if mark else known
            elif word.isprintable() and max(word, default="") < LATIN_END:
                now[word] = b"".join([now.get(x) or now.setdefault(x, self._part(x)) for x in self.parts(word.lower())])
            else:
                now[word] = self._whole(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        self.memory.turn()
        whole = [not self.by_word or any(x in text for x in self.added) for text in texts]
        words: list[str] = []
        ends = []
        for text, w in zip(texts, whole, strict=True):
            if not w:
                words += text.replace("\n", " ").split(" ")
            ends.append(len(words))
        found = list(map(self.memory.now.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self._learn({words[i] for i in new})
            now = self.memory.now
            for i in new:
                found[i] = now[words[i]]
        out, begin = [], 0
        for text, w, end in zip(texts, whole, ends, strict=True):
            out.append(self._whole(text) if w else b"".join(found[begin:end]))
            begin = end
        return out


#: (document, first id, number of ids) of a piece.
Piece = tuple[int, int, int]


class SquaresPacker:
    """Places pieces into windows by the sum of squares. Gives finished windows as lists
    of pieces, in the order in which they are finished."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        # half the change of the sum of squares when a window goes from one level to
        # another is gain[to] - loss[from]; levels without windows cannot be left
        self.gain = np.full(window + 1, 0.5)
        self.gain[window] = 0.0
        self.loss = np.full(window + 1, -np.inf)
        self.loss[0] = 0.0
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = 0

    def _count(self, level: int) -> None:
        n = len(self.open[level])
        self.gain[level] = n + 0.5
        self.loss[level] = n - 0.5 if n else -np.inf

    def _put(self, level: int, pieces: list[Piece]) -> None:
        self.open[level].append(pieces)
        self._count(level)
        self.n_open += 1

    def place(self, document: int, length: int) -> Iterator[list[Piece]]:
        start = 0
        while length - start >= self.window:
            yield [(document, start, self.window)]
            start += self.window
        size = length - start
        if not size:
            return
        # the fullest level of those with the least sum
        last = self.window - size
        change = self.gain[size:][::-1] - self.loss[:last + 1][::-1]
        level = last - int(change.argmin())
        pieces = [(document, start, size)]
        if level:
            pieces = self.open[level].pop() + pieces
            self._count(level)
            self.n_open -= 1
        if level + size == self.window:
            yield pieces
        else:
            self._put(level + size, pieces)
            if self.n_open >= self.max_open:
                yield from self.close()

    def close(self) -> Iterator[list[Piece]]:
        """Fills the fullest windows with what is cut from the emptiest. One is left open
        at most."""
        rows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        levels = [level for level in sorted(self.open, reverse=True) for _ in self.open[level]]
        for level in list(self.open):
            self.open[level] = []
            self._count(level)
        self.n_open = 0
        first, last = 0, len(rows) - 1
        while first < last:
            missing = self.window - levels[first]
            if levels[last] <= missing:
                rows[first] = rows[first] + rows[last]
                levels[first] += levels[last]
                last -= 1
            else:
                rows[last], taken = cut(rows[last], levels[last] - missing)
                rows[first] = rows[first] + taken
                levels[first], levels[last] = self.window, levels[last] - missing
            if levels[first] == self.window:
                yield rows[first]
                first += 1
        if first == last:
            self._put(levels[first], rows[first])

    def finish(self) -> Iterator[list[Piece]]:
        """Closes; the window left over becomes sequences as long as powers of two."""
        yield from self.close()
        for level, rows in self.open.items():
            for left in rows:
                while level:
                    size = 1 << (level.bit_length() - 1)
                    done, left = cut(left, size)
                    yield done
                    level -= size


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after so many ids; one piece may be cut."""
    before: list[Piece] = []
    for i, (document, start, size) in enumerate(pieces):
        if at < size:
            here = [(document, start, at)] if at else []
            return before + here, [(document, start + at, size - at), *pieces[i + 1:]]
        before.append((document, start, size))
        at -= size
    return before, []


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class _Rows:
    """Output rows of finished windows, with the ids of the documents still needed."""

    def __init__(self, width: int, first_sequence: int):
        self.width, self.sequence = width, first_sequence
        self.held: dict[int, tuple[int | None, bytes, int]] = {}  # id, ids, ids not yet given out
        self.rows: list[tuple] = []

    def add(self, pieces: list[Piece]) -> None:
        offset = 0
        for document, start, size in pieces:
            doc_id, raw, left = self.held[document]
            ids = np.frombuffer(raw, f"<u{self.width}", size, start * self.width).astype("<u4").tobytes()
            self.rows.append((doc_id, start, size, len(raw) // self.width, self.sequence, offset, ids))
            offset += size
            if left == size:
                del self.held[document]
            else:
                self.held[document] = (doc_id, raw, left - size)
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        kinds = [pa.int64()] * 6 + [pa.binary()]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PIECE.split(", ")])


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, window: int = WINDOW,
         max_open: int = MAX_OPEN) -> DataFrame:
    """A row per piece: doc_id, start (the document's ids before it), length, doc_tokens,
    sequence_id, offset in the sequence, ids (little-endian 32-bit).

    Every row gives a document that ends with end_id; null and empty texts have that id
    only. Documents longer than a window are cut at its multiples. Sequences hold `window`
    ids, but for the last ones of a task, whose lengths are powers of two. Null ids are
    carried, repeated rows are documents of their own, an empty table gives no rows, and
    columns other than id and text are not read. Sequence ids are unique; their upper
    bits name the task.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        packer = SquaresPacker(window, max_open)
        out = _Rows(encoder.width, TaskContext.get().partitionId() << _TASK_SHIFT)
        number = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), STEP):
                packed = encoder.encode([t or "" for t in texts[at:at + STEP]])
                for doc_id, raw in zip(ids[at:at + STEP], packed, strict=True):
                    raw += end
                    n = len(raw) // encoder.width
                    out.held[number] = (doc_id, raw, n)
                    for pieces in packer.place(number, n):
                        out.add(pieces)
                    number += 1
                yield out.batch()
        for pieces in packer.finish():
            out.add(pieces)
        yield out.batch()

    return narrow.mapInArrow(run, PIECE)


def pack_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The pieces of pack() with a checksum in place of the ids."""
    pieces = pack(docs, tokenizer_path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
