"""Packing against a plain sum of squares, a round trip and the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from orthoweave.llm import packing
from orthoweave.llm.common import table

from .conftest import SMALL, sentence

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_levels(sizes, window):
    """Fill levels chosen by trying every level and adding up all squares."""
    count, chosen = defaultdict(int), []
    for size in sizes:
        size %= window
        if not size:
            continue
        best = None
        for level in [0, *sorted(k for k, n in count.items() if n)]:
            if level + size > window:
                continue
            after = dict(count)
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] = after.get(level + size, 0) + 1
            total = sum(n * n for n in after.values())
            if best is None or (total, -level) < best[:2]:
                best = (total, -level, after)
        chosen.append(-best[1])
        count = defaultdict(int, best[2])
    return chosen


@pytest.mark.parametrize("window", [16, 100])
def test_levels(window):
    rng = random.Random(window)
    sizes = [rng.choice([1, 3, window // 2, window - 1, rng.randint(1, 3 * window)]) for _ in range(400)]
    packer, seen = packing.SquaresPacker(window, 10_000), {}
    levels = []
    for i, size in enumerate(sizes):
        before = {level: len(x) for level, x in packer.open.items() if x}
        done = [w for w in packer.place(i, size) if len(w) > 1 or w[0][2] < window]
        after = {level: len(x) for level, x in packer.open.items() if x}
        if size % window:
            if done:
                levels.append(window - size % window)
            else:
                to = next(k for k, n in after.items() if n > before.get(k, 0))
                levels.append(to - size % window)
        seen[i] = size
    assert levels == plain_levels(sizes, window)


def check(pieces, sizes, window):
    """Every id in one piece, sequences without gaps, lengths the window or a power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for d, start, length, sequence, offset in pieces:
        docs[d].append((start, length))
        sequences[sequence].append((offset, length))
    assert set(docs) == set(sizes)
    for d, parts in docs.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == sizes[d]
    odd = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0
        odd += at != window
    return odd


@pytest.mark.parametrize("max_open", [2, 7, 10_000])
def test_packer_keeps_every_id(max_open):
    rng, window = random.Random(max_open), 64
    sizes = {i: rng.choice([1, 33, 40, 64, 128, rng.randint(1, 300)]) for i in range(500)}
    packer = packing.SquaresPacker(window, max_open)
    windows = [w for i, n in sizes.items() for w in packer.place(i, n)]
    assert packer.n_open < max_open
    windows += list(packer.finish())
    pieces = []
    for s, w in enumerate(windows):
        offset = 0
        for d, start, length in w:
            pieces.append((d, start, length, s, offset))
            offset += length
    assert check(pieces, sizes, window) <= 6
    assert len(pieces) < 500 + sum(sizes.values()) // window + (500 if max_open < 100 else 100)


AWKWARD = [
    "", " ", "\n\n", "Ab-c d's we'll I'm  x\t\ty z\x1cq", "İstanbul Σίσυφος ΣΑΣ. J̌x ̌y", "é É. K 5 ½ ① 日本。",
    "<|endoftext|> a <|ENDOFTEXT|> b<|startoftext|>c", "\x01 a\x01 \x01\x01 b", "a.b, c.,! d?? 3.14: x;", " u v\x85w\x0bq\x0cr\rs", "\x00 ﻿x ﬁ Ⅷ"]


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(3)
    alphabet = list("abcXYZ '.,!?;:\n\t ́éÉßΣ日1٣<|>_-\x01\x1c")
    texts = AWKWARD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(4000)]
    encoder, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    assert encoder.by_word
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def digest_rows(rows):
    return [((r.doc_id, r.doc_tokens), r.start, r.length, r.sequence_id, r.offset) for r in rows]


def test_query_against_the_tokenizer(spark):
    docs = table(spark, SMALL, "documents")
    rows = entry.queries()["op11_packing"](spark, SMALL).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    check(digest_rows(rows), {(d, len(x)): len(x) for d, x in ids.items()}, packing.WINDOW)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids[r.doc_id])
    total = sum(map(len, ids.values()))
    assert sum(r.length for r in rows) == total
    # only the pieces of the windows that were closed early are cut
    whole = sum(1 + (len(x) - 1) // packing.WINDOW for x in ids.values())
    assert len(rows) <= whole + 100


def test_awkward_rows(spark, awkward, clashing, empty, rng):
    wanted = sorted((r.doc_id is None, r.doc_id or 0) for r in awkward.collect())
    for docs in (awkward, clashing):
        rows = packing.pack(docs, PATH).collect()
        firsts = sorted((r.doc_id is None, r.doc_id or 0) for r in rows if r.start == 0)
        assert firsts == wanted
        assert all(len(r.ids) == 4 * r.length for r in rows)
        blank = [r for r in rows if r.doc_id in (4, 5, 6)]
        assert [(r.length, r.ids) for r in blank] == [(1, b"\x02\0\0\0")] * 3
    assert packing.pack(empty, PATH).collect() == []
    one = spark.createDataFrame([(1, sentence(rng, 3000))], "doc_id long, text string")
    assert sum(r.length for r in packing.pack(one, PATH, window=256).collect()) > 3000
