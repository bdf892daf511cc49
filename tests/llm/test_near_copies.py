"""The pipeline's near-duplicate stage against brute force over shingle sets."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from orthoweave.llm import near_copies, simhash
from orthoweave.llm.common import table

from .conftest import DOCS, SMALL, sentence


def plain_first(rows):
    sets, root = {}, {i: i for i, _ in rows}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i for i in sets if find(i) == i}


def stage():
    return [f for _, f in corpus_pipeline.STAGES][1]


def test_near_stage(spark):
    """Copies with changed words, between 0.75 and 1 in similarity, and exact copies."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        words = sentence(rng, rng.choice([3, 60, 120, 400])).split(" ")
        for k in range(3):
            own = list(words)
            for _ in range(k * len(words) // 60):
                own[rng.randrange(len(own))] = "".join(rng.choice("bdfgzx") for _ in range(6))
            rows.append((3 * i + k, " ".join(own)))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows] + [(None, rows[0][1], "en", "a", 1)], DOCS)
    found = [r.doc_id for r in stage()(spark, docs, SMALL).collect()]
    want = plain_first(rows)
    assert len(rows) - len(want) > 40 and None not in found and sorted(found) == sorted(want)


def test_repeated_and_null_ids(spark, clashing, empty):
    """Rows decide, not ids: copies go whatever their id, other texts stay."""
    rng = random.Random(4)
    a, b, c = (sentence(rng, 40) for _ in range(3))
    rows = [(1, a), (1, a), (2, a), (None, a), (None, a), (1, b), (None, c), (3, ""), (4, None), (None, " \t")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in stage()(spark, docs, SMALL).collect())
    assert kept == sorted([(False, 1, a), (False, 1, b), (True, 0, c), (False, 3, "")])
    assert stage()(spark, clashing, SMALL).columns == clashing.columns
    assert stage()(spark, empty, SMALL).collect() == []


def test_crowds(spark, monkeypatch):
    """Copies of one text that are no copies of each other, texts that share a passage, and
    exact copies: the groups are those of brute force, and pairs stay few."""
    monkeypatch.setattr(near_copies, "CROWD", 8)
    rng = random.Random(6)
    base, passage = sentence(rng, 120).split(" "), sentence(rng, 60)
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        own = list(base)
        for at in rng.sample(range(len(own)), rng.randint(0, 4)):
            own[at] = "".join(rng.choice("bdfgzx") for _ in range(6))
        rows.append((i, " ".join(own)))
    rows += [(200 + i, sentence(rng, 50) + " " + passage + " " + sentence(rng, 5)) for i in range(60)]
    rows += [(300 + i, " ".join(base)) for i in range(50)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    tried = []
    real = near_copies.materialise

    def watched(df, purpose):
        done = real(df, purpose)
        if purpose in ("near-tried", "near-rest"):
            tried.append(done.count())
        return done
    monkeypatch.setattr(near_copies, "materialise", watched)
    found = sorted(r.doc_id for r in stage()(spark, docs, SMALL).collect())
    assert found == sorted(plain_first(rows))
    assert tried[0] < 400 and tried[1] < 100


def test_recall_on_the_given_documents(spark):
    """All groups of the smallest table, by brute force over all pairs."""
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert sorted(r.doc_id for r in stage()(spark, docs, SMALL).collect()) == sorted(plain_first(rows))


def test_pairs_of_a_crowd_are_bounded_and_formed_once(spark):
    """A member just outside the original's group meets only those that share with it what
    the original lacks, and these in one of their crowds only."""
    rows = []
    for bucket in (1, 2, 3):
        rows.append((bucket, 0, 146, 0, 0, 146))  # the original
        rows += [(bucket, v, 146, 10, 0, 136) for v in range(1, 200)]  # ten shingles of their own
        rows.append((bucket, 200, 146, 16, 200, 129))  # outside; shares one shingle more with ...
        rows.append((bucket, 201, 146, 9, 0, 136))  # ... this one
    named = spark.createDataFrame(
        [(b, v, n, own, root, 0, 146, common, [1, 2, 3]) for b, v, n, own, root, common in rows],
        "bucket long, vertex long, n long, own long, root long, home long, least long, common long, buckets array<long>")
    assert [tuple(r) for r in near_copies._outside_pairs(named).collect()] == [(200, 201)]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_exploded_keys_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes a table of keys to be as small as the table that they come from."""
    rows = spark.range(500).select(F.xxhash64("id").alias("fp"), F.col("id").alias("vertex"), F.lit(9).cast("long").alias("n"),
                                   F.array(F.xxhash64("id")).alias("keys"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = plan_of(simhash.links(rows.select("fp")))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    plans = {}
    real = near_copies.materialise

    def watched(df, purpose):
        plans[purpose] = plan_of(df)
        return real(df, purpose)

    monkeypatch.setattr(near_copies, "materialise", watched)
    near_copies.roots(rows, lambda v: v.select("vertex", F.array(F.col("vertex")).alias("shingles"))).collect()
    assert "SortMergeJoin" in plans["near-shared"] and "Broadcast" not in plans["near-shared"]
