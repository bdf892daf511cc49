"""Quality rules, mixing and SimHash against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from orthoweave.llm import mixing, quality_rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def figures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("table", ["awkward", "clashing"])
def test_base_figures(table, request):
    docs = request.getfixturevalue(table)
    want = Counter((r.doc_id, *figures(r.text)) for r in docs.select("doc_id", "text").collect())
    rows = quality_rules.clean_lines(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)


def test_line_rules(spark):
    rng = random.Random(1)
    body = "\n".join(" ".join(rng.choice("abcdefg") * rng.randint(2, 9) for _ in range(12)) + "." for _ in range(6))
    texts = {
        1: body, 2: body + "\nHome | News | Sport | About", 3: "\n".join(["BUY!! NOW!! CHEAP!! STUFF!! " * 3] * 8),
        4: body + "\nPlease accept cookies to go on."}
    docs = spark.createDataFrame([(k, v) for k, v in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules.clean_lines(docs).collect()}
    assert [rows[i].kept for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert rows[2].clean_text == body and rows[4].clean_text == body and rows[1].clean_text == body


def test_repeated_words_random():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice("ab") if rng.random() < 0.5 else "c" for _ in range(rng.randint(0, 60))]
        assert quality_rules.repeated_words(words) == figures(" ".join(words))[4]


@pytest.mark.parametrize("table", ["awkward", "clashing", "empty"])
def test_mix_targets(table, request):
    docs = request.getfixturevalue(table)
    rows = mixing.mix_summary(docs).collect()
    sizes = [(r.source, len(WORD.findall(r.text or ""))) for r in docs.select("source", "text").collect()]
    assert len(rows) == len(sizes)
    by = defaultdict(int)
    for s, n in sizes:
        by[s] += n
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total, open_ = {s: 0.0 for s in by}, sum(by.values()), set(by)
    left = total
    while open_:  # share what is left, stop what is above its limit, again
        price = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if price * weight[s] > 3 * by[s]}
        for s in over or open_:
            target[s] = 3.0 * by[s] if over else price * weight[s]
        left -= sum(target[s] for s in over)
        open_ -= over or open_
    want = Counter((by[s], round(target[s], 6)) for s, _ in sizes)
    assert Counter((r.source_size, round(r.target, 6)) for r in rows) == want
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_summary(docs).collect()), key=str)


def test_mix_order_and_rows(clashing):
    plan = mixing.order_by_time(mixing.plan_mix(clashing).where(F.size("_times") > 0))
    positions = [r.position for r in plan.select("position").collect()]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and mixed.count() == len(positions)


def test_taken_words_come_near_the_target(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(1, 50)), f"s{rng.choice([0, 0, 0, 1, 2, 3])}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_summary(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("size").alias("most")).collect()
    assert len(found) == 4 and all(abs(r.taken - r.target) <= r.most for r in found)


def plain_fingerprint(text):
    words = re.findall(WORD, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """pairs: (doc_id, fp). The smallest id reachable, by brute force."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return Counter((i, f, least.get(find(f))) for i, f in pairs)


@pytest.mark.parametrize("table", ["awkward", "clashing", "empty"])
def test_simhash_components(table, request):
    docs = request.getfixturevalue(table)
    pairs = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    rows = simhash.components(docs).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in rows) == plain_components(pairs)


def test_simhash_links_every_close_pair(spark):
    rng = random.Random(11)
    fps = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    fps |= {0, (1 << 64) - 1, 1 << 63, 1 << 42, 1 << 21}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 4}
    rows = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).count()
    assert found == want and rows == len(want)


def test_keep_first(clashing):
    kept = simhash.keep_first(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").select("doc_id").collect())
    assert 1 in ids and 2 not in ids and 10 not in ids and 4 in ids and 5 not in ids
