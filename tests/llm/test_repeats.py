"""Decontamination, line dedup and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoweave.llm import common, decontamination, line_dedup, suffix_dedup

from .conftest import DOCS, sentence


def edit(rng, text, share):
    out = []
    for c in text:
        roll = rng.random()
        out.append("" if roll < share / 3 else c + "x" if roll < 2 * share / 3 else "q" if roll < share else c)
    return "".join(out)


def best_distance(pattern, data):
    """Fewest edits between the pattern and any part of the data."""
    row = [0] * (len(data) + 1)
    for i, c in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(data, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return min(row)


def plain_found(docs, items):
    """(row, doc_id, item_id) of the items found, by the edit distance of every region."""
    found = set()
    for row, (doc_id, text) in enumerate(docs):
        data = decontamination.normalise(text)
        for item_id, item in items:
            pattern = decontamination.normalise(item)
            if len(pattern) < decontamination.MIN_REGION:
                continue
            last = max(0, len(pattern) - decontamination.REGION)
            for start in {*range(0, last + 1, decontamination.STRIDE), last}:
                part = pattern[start:start + decontamination.REGION]
                if best_distance(part, data) <= len(part) // 10:
                    found.add((row, doc_id, item_id))
    return found


def plain_leaks(docs, items):
    return Counter((d, i) for _, d, i in plain_found(docs, items))


def test_leaks(spark, rng):
    items = [(i, sentence(rng, rng.randint(4, 24))) for i in range(8)] + [(50, None), (51, "ba ko"), (None, sentence(rng, 20))]
    docs = []
    for i in range(30):
        item = items[i % 8][1]
        inside = [item, edit(rng, item, 0.04), edit(rng, item, 0.09), item[:len(item) // 2], edit(rng, item, 0.25), item.upper()][i % 6]
        docs.append((i if i % 7 else None, f"{sentence(rng, 10)} {inside} {sentence(rng, 10)}"))
    docs += [(92, sentence(rng, 30)), (90, None), (91, ""), (92, items[0][1]), (92, items[0][1]), (93, items[1][1] * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS edits")
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id")
    rows = decontamination.find_leaks(frame, benchmark).collect()
    assert Counter((r.doc_id, r.item_id) for r in rows) == plain_leaks(docs, items)
    kept = decontamination.drop_leaked(frame, benchmark)
    assert kept.columns == frame.columns
    # rows decide: those without an id go too, and a clean row stays beside a bad one of its id
    bad = {row for row, _, _ in plain_found(docs, items)}
    assert any(docs[row][0] is None for row in bad)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(d for row, d in enumerate(docs) if row not in bad)


def test_benchmark_in_blocks_and_long_texts_in_steps(spark, rng, monkeypatch):
    items = [(i, sentence(rng, 20)) for i in range(6)]
    filler = " ".join(sentence(rng, 30) for _ in range(60))
    docs = [(i, filler[:i * 977] + items[i][1] + filler[i * 977:]) for i in range(6)]
    frame, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    blocks = list(decontamination._blocks(benchmark))
    assert len(blocks) > 1
    found = {(r.doc_id, r.item_id, r.edits) for r in decontamination.find_leaks(frame, benchmark).collect()}
    assert found >= {(i, i, 0) for i in range(6)}
    index = decontamination.Index([(i, decontamination.normalise(t)) for i, t in items])
    monkeypatch.setattr(decontamination, "STEP", 500)
    import pyarrow as pa
    seen = {(rows[0], index.item[r]) for data, rows, _ in decontamination._chunks(pa.array([docs[3][1]])) for r, _, _ in index.search(data)}
    assert seen == {(0, 3)}


def test_no_leaks_in_empty_tables(spark, empty, awkward):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(empty, nothing).count() == 0
    assert decontamination.find_leaks(awkward, nothing).count() == 0


def plain_removed(rows, length):
    """(doc_id, bytes, removed, runs, sha) per row; rows in order of id and hash."""
    seen, results = {}, {}
    for doc_id, key, data in sorted({r[:3] for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        cover = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p:p + length] in seen:
                cover[p:p + length] = b"\1" * length
            else:
                seen[data[p:p + length]] = True
        kept = bytes(c for c, x in zip(data, cover, strict=True) if not x)
        runs = sum(bool(x) and (not i or not cover[i - 1]) for i, x in enumerate(cover))
        results[doc_id, key] = (len(data), sum(cover), runs, hashlib.sha256(kept).hexdigest())
    return Counter((d, *results[d, k]) for d, k, _ in rows)


def keyed_rows(docs):
    found = docs.select("doc_id", F.xxhash64("text").alias("k"), "text").collect()
    return [(r.doc_id, r.k, (r.text or "").encode()) for r in found]


@pytest.mark.parametrize("name", ["awkward", "clashing", "empty"])
def test_suffix_dedup_awkward(request, name):
    docs = request.getfixturevalue(name).where("doc_id is null or doc_id <> 7")
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert Counter(tuple(r[:5]) for r in rows) == plain_removed(keyed_rows(docs), 100)


@pytest.mark.parametrize("length", [32, 60, 100, 138])
def test_suffix_dedup_random(spark, monkeypatch, length):
    rng = random.Random(length)
    monkeypatch.setattr(suffix_dedup, "RANGE_ENTRIES", 7)
    monkeypatch.setattr(suffix_dedup, "RUN_ENTRIES", 11)
    passages = [sentence(rng, 40) for _ in range(4)] + ["é" * 90, "ab" * 150]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randint(1, 20)) if rng.random() < 0.5 else edit(rng, rng.choice(passages), rng.choice([0, 0, 0.01]))
                 for _ in range(rng.randint(0, 6))]
        rows.append((i, " ".join(parts), "en", "a", 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = suffix_dedup.remove_repeats(docs, length).collect()
    assert Counter(tuple(r[:5]) for r in found) == plain_removed(keyed_rows(docs), length)


def test_merge_orders_and_counts_prefixes():
    rng = random.Random(4)
    for n in (1, 2, 3, 5, 8):
        keys = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 30))) for _ in range(n)]
        runs = [suffix_dedup.Run.unpack(suffix_dedup.Run.pack([(k, (r, i, 0)) for i, k in enumerate(ks)])) for r, ks in enumerate(keys)]
        out = list(suffix_dedup.merge(runs))
        assert [k for k, _, _ in out] == sorted(k for ks in keys for k in ks)
        before = b""
        for key, shared, (r, i, _) in out:
            assert shared == suffix_dedup.shared_prefix(before, key, 0) and keys[r][i] == key
            before = key


def norm(line):
    return re.sub(r"[^\w]+|_", " ", line.lower()).strip()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return row[-1]


def plain_lines(rows, fps):
    """Groups of lines by brute force: SimHash at most three bits apart and similar."""
    lines = {}
    for doc_id, key, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            n = re.sub(r" +", " ", norm(line))
            if len(n.split(" ")) >= 5:
                lines.setdefault(n, []).append((doc_id is not None, doc_id or 0, key, no))
    kinds = sorted(lines)
    root = {k: k for k in kinds}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if bin((fps[a] ^ fps[b]) & (1 << 64) - 1).count("1") <= 3 and distance(a, b) <= max(len(a), len(b)) * 20 // 100:
                root[find(a)] = find(b)
    groups = {}
    for k in kinds:
        groups.setdefault(find(k), []).extend(lines[k])
    return {p for g in groups.values() for p in g if p != min(g)}


@pytest.mark.parametrize("name", ["awkward", "clashing", "empty", "near"])
def test_line_dedup(spark, request, rng, name):
    if name == "near":
        lines = [sentence(rng, rng.randint(6, 60)) for _ in range(12)]
        rows = []
        for i in range(40):
            own = [rng.choice(lines) for _ in range(4)]
            own = [" ".join(w if rng.random() > 0.02 else "zz" for w in x.split()) for x in own]
            rows.append((i, "\n".join([*own, "short one", sentence(rng, 12)]), "en", "a", 1))
        docs = spark.createDataFrame(rows, DOCS)
    else:
        docs = request.getfixturevalue(name).where("doc_id is null or doc_id <> 7")
    keyed = [(r.doc_id, r.k, r.text) for r in docs.select("doc_id", F.xxhash64("text").alias("k"), "text").collect()]
    found = line_dedup.occurrences(docs).select("line_key", "norm").distinct()
    fps = {r.norm: r.fp for r in line_dedup.simhash(found).join(found, "line_key").collect()}
    gone = plain_lines(keyed, fps)
    want = Counter()
    for doc_id, key, text in keyed:
        lines = [] if text is None else text.split("\n")
        left = [x for no, x in enumerate(lines) if (doc_id is not None, doc_id or 0, key, no) not in gone]
        want[doc_id, None if text is None else "\n".join(left), len(lines), len(lines) - len(left)] += 1
    rows = line_dedup.dedup_lines(docs).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in rows) == want


def test_line_simhash(spark, rng):
    import pandas as pd
    texts = ["a b c d e", "one", sentence(rng, 300)]
    words = sorted({w for t in texts for w in t.split(" ")})
    hashed = {r.w: r.h for r in spark.createDataFrame(pd.DataFrame({"w": words})).select("w", F.xxhash64("w").alias("h")).collect()}
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line_key long, norm string")
    for row in line_dedup.simhash(frame).collect():
        hs = [hashed[w] & (1 << 64) - 1 for w in texts[row.line_key].split(" ")]
        assert row.fp & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_similarity_shortcuts(spark, rng):
    pairs = []
    for _ in range(200):
        a = norm(sentence(rng, rng.randint(1, 30)))
        pairs.append((a, norm(edit(rng, a, rng.choice([0, 0.05, 0.1, 0.2, 0.3]))) or "x"))
        pairs.append((a, " ".join(w for w in a.split(" ") if rng.random() > 0.1) or "x"))
    frame = spark.createDataFrame(pairs, "a string, b string")
    for r in frame.select("a", "b", line_dedup.similar(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == (distance(r.a, r.b) <= max(len(r.a), len(r.b)) * 20 // 100), (r.a, r.b)


def test_similarity_of_repeated_words(spark):
    """Common beginning and end overlap in such lines."""
    pairs = [(" ".join(["no"] * n), " ".join(["no"] * m)) for n in range(1, 12) for m in range(1, 12)]
    pairs += [(" ".join(["a b c d"] * n), " ".join(["a b c d"] * m)) for n in range(1, 7) for m in range(1, 7)]
    pairs += [("la la di la la", "la la la la"), ("1 2 1 2 1 2 3", "1 2 1 2 3"), ("x " * 9 + "y", "x " * 9 + "z")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for r in frame.select("a", "b", line_dedup.similar(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == (distance(r.a, r.b) <= max(len(r.a), len(r.b)) * 20 // 100), (r.a, r.b)


def similar_groups(rows, least):
    """Removed (doc_id, line) by brute force: edit similarity only, from `least` characters."""
    lines = {}
    for doc_id, text in rows:
        for no, line in enumerate(text.split("\n")):
            if n := re.sub(r" +", " ", norm(line)):
                lines.setdefault(n, []).append((doc_id, no))
    kinds = sorted(lines)
    root = {k: k for k in kinds}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= max(len(a), len(b)) // 5 and find(a) != find(b) \
                    and distance(a, b) <= max(len(a), len(b)) * 20 // 100:
                root[find(a)] = find(b)
    groups = {}
    for k in kinds:
        groups.setdefault(find(k), []).extend(lines[k])
    return {p for g in groups.values() for p in g if p != min(g)}


def query_removes(spark, folder, rows):
    from orthoweave.llm.queries import QUERIES
    spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    return {(r.doc_id, no) for r in QUERIES["op7_line_dedup"](spark, str(folder)).collect() for no in r.removed}


def test_line_query_finds_changed_words(spark, tmp_path):
    """Copies with one or two changed words, far more than three bits of a SimHash apart."""
    rng = random.Random(11)
    rows = []
    for i in range(20):
        words = sentence(rng, rng.choice([8, 12, 20, 40])).split(" ")
        for k in range(3):
            own = list(words)
            for _ in range(k and 1 + len(words) // 20):
                own[rng.randrange(len(own))] = "".join(rng.choice("bdfgzx") for _ in range(4))
            rows.append((3 * i + k, " ".join(own) + "\n" + sentence(rng, 15)))
    want, found = similar_groups(rows, 20), query_removes(spark, tmp_path, rows)
    assert len(want) > 30 and found <= want and len(found) >= 0.95 * len(want)


def test_line_query_takes_short_lines(spark, tmp_path):
    """Exact copies of short lines and of lines without blanks go, similar short lines stay."""
    menu = ["Home", "share this page", "Page 12", "Page 13", "你好世界欢迎来到这里", "これは一行の長い日本語の文章ですので空白がありません", "ยินดีต้อนรับ", "--", ""]
    rng = random.Random(5)
    rows = [(i, "\n".join([*rng.sample(menu, 6), sentence(rng, 14)])) for i in range(12)]
    want = similar_groups(rows, 20)
    assert len(want) > 30 and query_removes(spark, tmp_path, rows) == want


def test_line_keys_tell_long_lines_apart(spark):
    """Lines of one language share many grams and short words, yet few keys; copies share some."""
    rng = random.Random(3)
    parts = ["an", "ber", "che", "der", "en", "er", "ge", "heit", "ich", "keit", "lich", "nd", "sch", "tz", "un", "ver"]
    lines = []
    for _ in range(250):
        words = ["".join(rng.choices(parts, k=rng.choice((1, 1, 2, 3)))) for _ in range(90)]
        lines += [" ".join(words), " ".join("zzz" if i % 20 == 7 else w for i, w in enumerate(words))]
    frame = spark.createDataFrame(list(enumerate(lines)), "line_key long, norm string")
    groups = {}
    for r in line_dedup.line_keys(frame).collect():
        for k in r["keys"]:
            groups.setdefault(k, set()).add(r.line_key)
    pairs = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    copies = {(i, i + 1) for i in range(0, len(lines), 2)}
    assert copies <= pairs and len(pairs - copies) <= len(lines)


def test_agreeing_minima(spark):
    """Equal bytes of two sketches, their signs included."""
    rng = random.Random(4)
    rows = [[rng.getrandbits(64) - (1 << 63) for _ in range(4)] for _ in range(50)]
    rows = [[a, b, a ^ (0xFF << 8 * rng.randrange(7)), d] for a, b, _, d in rows] + [[-1, 1, -1, 1], [0, 0, -1, -1]]
    frame = spark.createDataFrame(rows, "a0 long, a1 long, b0 long, b1 long")
    for r in frame.select("*", line_dedup.agreeing("a", "b", 2).alias("n")).collect():
        mine, other = ((np.array(x, np.int64).view(np.uint8)) for x in ([r.a0, r.a1], [r.b0, r.b1]))
        assert r.n == (mine == other).sum()


def test_linked_in_parts(spark, rng):
    """Buckets in parts; pairs with a pivot are compared once, and pairs that are not near
    are never given to the comparison."""
    rows = sorted({(v, 0, rng.randint(0, 8)) for v in range(60) for _ in range(2)})
    parts = [spark.createDataFrame([r for r in rows if r[2] % 3 == k], "vertex long, mark int, bucket long") for k in range(3)]
    members = {b: sorted(v for v, _, x in rows if x == b) for b in range(9)}
    pairs = {(a, b) for m in members.values() for a in m for b in m if a < b}
    close = lambda a, b: (a * 7 + b * 3) % 5 < 2
    is_right = lambda a, b: (a + b) % 11 == 0
    is_near = lambda p, q: (F.col(f"{p}.vertex") * 7 + F.col(f"{q}.vertex") * 3) % 5 < 2
    given = []

    def passed(found):
        given.extend((r.a, r.b) for r in found.collect())
        return found.where((F.col("a") + F.col("b")) % 11 == 0)

    def prepare(vertices):
        right = lambda found: found.where(((F.col("a") * 7 + F.col("b") * 3) % 5 < 2) & ((F.col("a") + F.col("b")) % 11 == 0))
        return common.Candidates(right, vertices, is_near, passed)

    roots = {v: v for v in range(60)}
    while True:
        before = dict(roots)
        for a, b in pairs:
            if close(a, b) and is_right(a, b):
                roots[a] = roots[b] = min(roots[a], roots[b])
        if roots == before:
            break
    found = common.linked(parts, lambda p, q: p == q, prepare, "test").collect()
    assert {r.vertex: r.root for r in found} == {v: r for v, r in roots.items() if v != r}
    inner = {(a, b) for m in members.values() for a in m[1:-1] for b in m[1:-1] if a < b}
    assert given and len(given) == len(set(given))
    assert set(given) <= {(a, b) for a, b in inner if close(a, b)}


def test_line_query_removes_its_keys(spark, tmp_path, monkeypatch):
    """Parts are written one after the other, and the keys go when the sketches are there."""
    numbers = iter(range(1000))
    monkeypatch.setattr(common, "work_dir", lambda spark, purpose: f"{tmp_path}/shared/{purpose}-{next(numbers)}")
    real, seen = line_dedup.materialise_parts, []

    def watched(parts, purpose):
        seen.append((purpose, len(parts)))
        return real(parts, purpose)

    monkeypatch.setattr(line_dedup, "materialise_parts", watched)
    line = "the quick brown fox jumps over the lazy dog while nobody at all is looking at number {}"
    docs = spark.createDataFrame([(i, line.format(i) + "\nother text", "en", "a", 1) for i in range(9)], DOCS)
    got = {r.doc_id: r.n_removed for r in line_dedup.decisions(docs, whole=True).collect()}
    assert got == {i: 0 if i == 0 else 2 for i in range(9)}
    assert seen == [("lines-keys", line_dedup.PARTS), ("lines-texts", line_dedup.PARTS)]
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared").iterdir()}
    assert "lines-sketches" in left and "lines-keys" not in left
