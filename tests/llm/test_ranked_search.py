"""Ranked search against a plain loop over all documents and items."""

import math
import random
import re
from collections import Counter

import pytest

from orthoweave.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, top=20):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in set(items):
        scored = []
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                        for t in plain_terms(text) if b[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item_id, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["Alpha", "beta", "γάμμα", "delta9", "e", "ζ-η", "x_y", "THE", "the", "日本", "a\x00b"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(100)] + [(i, docs[9][1]) for i in range(5000, 4900, -1)]
    docs += [(2000 + i, docs[9][1] + " unheard of") for i in range(30)]
    docs += [(3, "the the the"), (3, "the the the"), (None, "w1 w2"), (None, None), (4, ""), (5, " .,;"), (6, text(20_000))]
    items = [(i, text(rng.randint(1, 20))) for i in range(25)]
    items += [(1, "w1 w1 w1 w2"), (1, "w1 w1 w1 w2"), (1, "w3"), (None, "the"), (30, None), (31, ""), (32, "never seen"), (33, docs[7][1])]
    return docs, items


def test_against_a_plain_loop(spark, corpus):
    docs, items = corpus
    found = ranked_search.search(*frames(spark, docs, items))
    assert Counter(map(tuple, found.collect())) == plain_search(docs, items)


def test_small_steps_and_blocks(spark, corpus, monkeypatch):
    """Items in several blocks, and steps of a few classes and cells, change nothing."""
    docs, items = corpus
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 400)
    folder, blocks = ranked_search.write_items(frames(spark, docs, items)[1])
    assert len(blocks) > 2
    found = ranked_search.search(*frames(spark, docs, items), top=3)
    assert Counter(map(tuple, found.collect())) == plain_search(docs, items, 3)


@pytest.mark.parametrize("cells", [1, 7, 100])
def test_score_step(spark, corpus, monkeypatch, cells):
    import numpy as np
    docs, items = corpus
    folder, blocks = ranked_search.write_items(frames(spark, docs, items)[1])
    block = ranked_search.Items(folder, blocks[0])
    rng = np.random.default_rng(cells)
    pairs = sorted({(int(r), int(t)) for r, t in zip(rng.integers(0, 9, 80), rng.integers(0, len(block.number), 80), strict=True)})
    row, term = (np.array(x) for x in zip(*pairs, strict=True))
    tf, m, weight = rng.integers(1, 9, len(row)), rng.integers(75, 200, 9), rng.integers(0, 5000, len(block.number))
    wanted = np.zeros((len(block.key), 9), np.int64)
    for r, t, f in zip(row, term, tf, strict=True):
        for i, x, n in zip(block.item, block.term, block.times, strict=True):
            if x == t:
                wanted[i, r] += n * weight[t] * (10**9 * f // (1000 * f + 12 * m[r]))
    monkeypatch.setattr(ranked_search, "STEP_CELLS", cells * 9)
    got = np.zeros_like(wanted)
    for found, scores in ranked_search.score_step(block, weight, term, tf, row, m):
        assert not got[found].any()
        got[found] = scores
    assert (got == wanted).all()


def test_awkward_rows(spark, awkward, clashing, empty):
    items = [(1, "ba ko ri"), (2, "É à 日本"), (None, "a")]
    frame = frames(spark, [], items)[1]
    plain = plain_search([(r.doc_id, r.text) for r in awkward.collect()], items)
    for docs in (awkward, clashing):
        assert Counter(map(tuple, ranked_search.search(docs, frame).collect())) == plain
    assert ranked_search.search(empty, frame).collect() == []
    assert ranked_search.search(awkward, frame.where("false")).collect() == []
