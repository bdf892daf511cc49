import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# workers unpickle the operators by module name
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    words = ["".join(rng.choice(["ba", "ko", "ri", "mu", "te", "sa", "lo"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def awkward(spark, rng):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text."""
    base = "\n".join(sentence(rng, 30) for _ in range(4))
    long = " ".join(sentence(rng, 25) for _ in range(3000))
    rows = [
        (1, base, "en", "b", 1), (2, base, "en", "a", 2), (3, base.replace("ba", "bo", 1), None, "a", None),
        (4, None, "en", None, 0), (5, "", "en", "a", 0), (6, " \t\n ", "en", "b", 3), (None, base, "en", "a", 1),
        (None, None, None, None, None), (7, long, "de", "c", 5), (8, sentence(rng, 40), "fr", "c", 1),
        (8, sentence(rng, 40), "fr", "c", 1), (9, "É à ü ß 日本 <|endoftext|>  x\n\n y", "ja", "d", 4),
        (10, base, "en", "b", 1), (10, base, "en", "b", 1), (11, "a" * 500, "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with further columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["score", "kept", "size", "source_size", "target", "_row", "_part", "_hash", "fp", "line_key", "root", "n",
             "removed", "first", "end", "_id", "_key", "position", "copy", "vertex", "key", "f", "quality", "_bad",
             "_first", "_leaked", "text_key", "record_type", "digest", "payload", "copies", "html_", "Text_"]
    return awkward.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
