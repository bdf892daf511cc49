"""Quality classifier, n-gram model and Elias-Fano coding."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from orthoweave.llm import ngram_model, quality_classifier
from orthoweave.llm.common import table
from orthoweave.llm.elias_fano import EliasFano, encode

from .conftest import SMALL


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 6), (1000, 1001), (1000, 50_000), (3000, 10**9), (2000, 10**13)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n))
    coded = EliasFano(encode(values, universe))
    assert (coded.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe, 500), [0, universe - 1]])
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    found = coded.find(asked)
    assert ((found >= 0) == np.isin(asked, values)).all() and (values[found[found >= 0]] == asked[found >= 0]).all()


def plain_scores(rows):
    """The model of the module's docstring in dictionaries, without quantising."""
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    words = [ngram_model.tokens(t) for _, t in rows]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for w, h in zip(words, held, strict=True):
        if not h:
            s = [b"", *w]
            c1.update(w)
            c2.update(zip(s, s[1:], strict=False))
            c3.update(zip(s, s[1:], s[2:], strict=False))
    total, kinds = sum(c1.values()), len(c1)
    w2, w3 = Counter(), Counter()
    for (a, _), n in c2.items():
        w2[a] += (n - 0.75) / c1[a]
    for (a, b, _), n in c3.items():
        if n > 1:
            w3[a, b] += (n - 0.75) / c2[a, b]
    out = []
    for (i, _), w, h in zip(rows, words, held, strict=True):
        s, base, score = [b"", *w], 0.0, 0.0
        for k in range(1, len(s)):
            p = q = (c1[s[k]] + 0.5) / (total + 0.5 * (kinds + 1)) if total else 1.0
            if s[k - 1] in w2:
                n = c2[s[k - 1], s[k]]
                p = max(n - 0.75, 0) / c1[s[k - 1]] + (1 - w2[s[k - 1]]) * p
            if k > 1 and (s[k - 2], s[k - 1]) in w3:
                n = c3[s[k - 2], s[k - 1], s[k]]
                p = (n - 0.75 if n > 1 else 0) / c2[s[k - 2], s[k - 1]] + (1 - w3[s[k - 2], s[k - 1]]) * p
            base, score = base + math.log10(q), score + math.log10(p)
        out.append((i, h, len(w), sum(x in c1 for x in w), total, base, score))
    return out


@pytest.mark.parametrize("name,segment", [("awkward", 4_000_000), ("clashing", 5_000), ("empty", 1000)])
def test_scores(spark, request, name, segment, monkeypatch):
    monkeypatch.setattr(ngram_model, "SEGMENT_TOKENS", segment)
    docs = request.getfixturevalue(name)
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    want = sorted(plain_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]), key=key)
    rows = sorted(ngram_model.held_out_scores(spark, docs).collect(), key=key)
    assert len(rows) == len(want)
    for row, plain in zip(rows, want, strict=True):
        assert tuple(row[:5]) == plain[:5]
        assert row[5] == pytest.approx(plain[5], rel=1e-9) and row[6] == pytest.approx(plain[6], abs=2e-3 * plain[2] + 1e-9)


def test_probabilities_sum_to_one(spark, awkward):
    """Over all known words and the unknown one, after any context."""
    model = ngram_model.build(awkward)
    reader = model.open()
    v = len(reader.words)
    for context in ([b"ba"], [b"ba", b"ko"], [ngram_model.tokens(awkward.where("doc_id = 1").first().text)[0]]):
        numbers = reader.words.numbers(context)
        rows = [np.concatenate([numbers, [w]]) for w in [*range(v), -1]]
        starts = np.arange(len(rows)) * (len(context) + 1)
        p, _, _ = reader.probabilities(np.concatenate(rows), starts)
        assert p[len(context)::len(context) + 1].sum() == pytest.approx(1, abs=2e-3)


def test_held_out_text_scores_above_single_words(spark):
    rows = ngram_model.held_out_scores(spark, table(spark, SMALL.replace("0.001", "0.01"), "documents")).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)  # both are negative


@pytest.mark.parametrize("name", ["awkward", "clashing", "empty"])
def test_classifier_takes_awkward_rows(spark, request, name):
    docs = request.getfixturevalue(name)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 1), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_classifier.score(docs, labels).collect()
    ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert Counter(r.doc_id for r in rows) == ids
    for r in rows:
        text = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(text) % 4 == 2)
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns
    # the task decides on the row: as many stay as are predicted good, with or without an id
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in rows if r.predicted)


def test_no_labels(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_classifier.score(awkward, labels).collect()} == {0.5}


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.01")
    labels = table(spark, folder, "labels")
    rows = quality_classifier.score(table(spark, folder, "documents"), labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(quality_classifier.FEATURES)))
    y = ((x[:, 3] > 0) ^ (x[:, 7] > 0)).astype(int)
    model = quality_classifier.train(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_statistics_are_finite():
    rng = random.Random(2)
    for text in [None, "", " ", "\n\n", "a", "!" * 1000, "".join(chr(rng.randint(1, 0x2FF)) for _ in range(500))]:
        values = quality_classifier.statistics(text)
        assert len(values) == len(quality_classifier.FEATURES) and all(map(math.isfinite, values))


def test_query_keeps_trigrams_that_occur_once(spark, tmp_path, rng):
    """Against dictionaries that hold every n-gram, on texts where most trigrams occur once."""
    from orthoweave.llm.queries import QUERIES

    from .conftest import DOCS, sentence
    rows = [(i, sentence(rng, 60)) for i in range(30)]
    spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    c1, c2, c3 = Counter(), Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            s = [b"", *ngram_model.tokens(t)]
            c1.update(s[1:])
            c2.update(zip(s, s[1:], strict=False))
            c3.update(zip(s, s[1:], s[2:], strict=False))
    w2, w3, total = Counter(), Counter(), sum(c1.values())
    for (a, _), n in c2.items():
        w2[a] += (n - 0.75) / c1[a]
    for (a, b, _), n in c3.items():
        w3[a, b] += (n - 0.75) / c2[a, b]
    assert sum(n == 1 for n in c3.values()) > len(c3) // 2
    found = {r.doc_id: r.score for r in QUERIES["op5_lm_scoring"](spark, str(tmp_path)).collect()}
    for i, t in rows:
        s, score = [b"", *ngram_model.tokens(t)], 0.0
        for k in range(1, len(s)):
            p = (c1[s[k]] + 0.5) / (total + 0.5 * (len(c1) + 1))
            if s[k - 1] in w2:
                p = max(c2[s[k - 1], s[k]] - 0.75, 0) / c1[s[k - 1]] + (1 - w2[s[k - 1]]) * p
            if k > 1 and (s[k - 2], s[k - 1]) in w3:
                p = max(c3[s[k - 2], s[k - 1], s[k]] - 0.75, 0) / c2[s[k - 2], s[k - 1]] + (1 - w3[s[k - 2], s[k - 1]]) * p
            score += math.log10(p)
        assert found[i] == pytest.approx(score, abs=2e-3 * len(s) + 1e-9)


def plain_walk(model, x):
    """Log odds by walking every tree from its root."""
    total = model.start
    inner = model.feature.shape[1]
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
        node = 0
        while node < inner:
            node = 2 * node + 1 + (x[feature[node]] > threshold[node])
        total += leaf[node - inner]
    return total


def test_flat_trees_against_a_plain_walk():
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality_classifier.FEATURES)))
    x[:, 3] = rng.integers(0, 3, 400)  # ties
    y = ((x[:, 0] + x[:, 3] > 1) ^ (x[:, 5] > 0.5)).astype(int)
    model = quality_classifier.train(x, y)
    scores = model.scores(x)
    assert np.allclose(scores, [1 / (1 + np.exp(-plain_walk(model, r))) for r in x])
    assert ((scores > 0.5) == y).mean() > 0.9


def test_first_split_against_every_split():
    """The root of the first tree cuts where the gain over all features and cuts is largest."""
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (300, len(quality_classifier.FEATURES))).astype(float)
    y = (x[:, 7] > 12).astype(int)
    y[rng.random(300) < 0.1] ^= 1
    model = quality_classifier.train(x, y)
    p = 1 / (1 + np.exp(-model.start))
    grad, hess = y - p, np.full(300, p * (1 - p))
    l2, least = quality_classifier.L2, quality_classifier.MIN_LEAF / 4

    def gain(f, cut):
        low = x[:, f] <= cut
        if hess[low].sum() < least or hess[~low].sum() < least:
            return 0.0
        part = lambda m: -grad[m].sum() ** 2 / (hess[m].sum() + l2)
        return part(low | ~low) - part(low) - part(~low)

    best = max(gain(f, c) for f in range(x.shape[1]) for c in np.unique(x[:, f])[:-1])
    f, cut = int(model.feature[0, 0]), float(model.threshold[0, 0])
    assert f == 7 and abs(gain(f, cut) - best) <= 1e-9 * abs(best)
