"""The pipeline stage by stage against plain versions, and its registration."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
from orthoweave.llm import decontamination, mixing, quality_classifier
from orthoweave.llm.common import table

from .conftest import SMALL
from .test_near_copies import plain_first


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5
    quality, near, clean, mix, tokens = stages.values()
    texts = {r.doc_id: r.text for r in docs.collect()}

    good = quality(spark, docs, SMALL)
    bad = quality_classifier.score(docs, table(spark, SMALL, "labels")).where("predicted = 0")
    assert good.columns == docs.columns and ids(good) == ids(docs) - ids(bad)

    first = near(spark, good, SMALL)
    assert ids(first) == Counter(plain_first([(i, texts[i] or "") for i in ids(good)]))

    left = clean(spark, first, SMALL)
    items = [decontamination.normalise(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    holding = {i for i in ids(first) if any(x in decontamination.normalise(texts[i]) for x in items)}
    found = {r.doc_id for r in decontamination.find_leaks(first, table(spark, SMALL, "benchmark")).collect()}
    assert holding <= found and set(ids(left)) == set(ids(first)) - found and left.columns == docs.columns

    mixed = mix(spark, left, SMALL)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_summary(left).collect() if r.taken}
    assert mixed.columns == docs.columns and ids(mixed) == Counter(taken)

    rows = tokens(spark, mixed, SMALL).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(tokenizer.encode(texts[i], add_special_tokens=False).ids) + 1 for i in taken}
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter({(i, sizes[i]): n for i, n in taken.items()})
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    whole = corpus_pipeline.run(spark, SMALL)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, rows))


def test_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_take_awkward_rows(spark, clashing, empty):
    for docs in (clashing, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMALL).columns == docs.columns, name
            stage(spark, docs, SMALL).count()
