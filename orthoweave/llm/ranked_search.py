"""Ranked lexical search with bags of words scored once.

A document matters to a search only through its bag: how often it holds each term of the
items' vocabulary, and its length measure m. Documents are restricted to that vocabulary,
and those with equal bag and m form a class; Spark groups by a hash and the whole bag, so
classes are verified. Each class is scored once against all items, and only the classes
that rank are expanded into their members, by ascending doc_id.

Items are searched in blocks of bounded size, read by the tasks from the shared folder;
neither items nor documents pass through the driver. A task keeps the best classes of each
item, Spark merges them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orthoweave.llm.common import materialise, open_fs
from orthoweave.session import work_dir

TOP = 20
#: Text of the items that are searched together.
BLOCK_BYTES = 16 << 20
#: (class, term) counts that are scored together, classes at most, and cells of a step's table.
STEP_COUNTS, STEP_CLASSES, STEP_CELLS = 1 << 15, 256, 1 << 22

_KEPT = [b for b in range(256) if b >= 0x80 or chr(b).isalnum()]  # ASCII letters and digits, and all bytes beyond ASCII
#: Letters, digits and all beyond ASCII stay, A-Z in lower case; other bytes part terms.
_TABLE = bytes(ord(chr(b).lower()) if b < 0x80 and b in _KEPT else b if b in _KEPT else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


ITEM_TERMS = "item_key long, item_id long, block long, term binary, times long"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, item_id, block, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            rows += [(key, item_id, block, t, n) for t, n in sorted(Counter(terms(text)).items())]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in ITEM_TERMS.split(", ")])


def write_items(items: DataFrame) -> tuple[str, list[int]]:
    """Writes the items' terms in blocks of about BLOCK_BYTES; gives the folder and the
    blocks that hold terms. Rows equal in id and text are one item."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = F.xxhash64("item_id", "text")
    keyed = rows.select(key.alias("item_key"), "item_id", F.pmod(key, F.lit(size // BLOCK_BYTES + 1)).alias("block"), "text")
    folder = work_dir(items.sparkSession, "search-items")
    keyed.mapInArrow(_item_terms, ITEM_TERMS).repartition("block").write.partitionBy("block").parquet(folder)
    spark = items.sparkSession
    blocks = spark.read.schema(ITEM_TERMS).parquet(folder).select("block").distinct().collect()
    return folder, sorted(r.block for r in blocks)


class Items:
    """One block of items: its vocabulary in order, and the term numbers of each item."""

    def __init__(self, folder: str, block: int):
        system, path = open_fs(f"{folder}/block={block}")
        found = pq.read_table(path, filesystem=system, columns=["item_key", "item_id", "term", "times"], partitioning=None)
        found = found.sort_by([("item_key", "ascending"), ("term", "ascending")])
        words = found.column("term").to_pylist()
        self.number = {t: i for i, t in enumerate(sorted(set(words)))}
        self.term = np.array([self.number[t] for t in words], np.int64)
        self.times = found.column("times").to_numpy()
        keys = found.column("item_key").to_numpy()
        self.key, first, self.item = np.unique(keys, return_index=True, return_inverse=True)
        self.item_id = found.column("item_id").take(pa.array(first)).combine_chunks()


BAG = "doc_id long, n long, bag binary"


def bags(docs: DataFrame, folder: str, block: int) -> DataFrame:
    """(doc_id, n, bag) of every row: its number of terms, and its counts of the block's
    terms as pairs of 32-bit numbers (term, count) in order of the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Items(folder, block).number
        for batch in batches:
            sizes, out = [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                sizes.append(len(words))
                counts = Counter(map(number.get, words))
                counts.pop(None, None)
                out.append(np.array(sorted(counts.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n", "bag"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(run, BAG)


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and counts of a column of bags, and the number of pairs of each row."""
    raw = column.to_pylist()
    flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int64).reshape(-1, 2)
    return flat[:, 0], flat[:, 1], np.array([len(x) // 8 for x in raw], np.int64)


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of the task's bags hold each term."""
    held = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(_pairs(batch.column(0))[0], minlength=len(held))
        found[:len(held)] += held
        held = found
    term = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(held[term], pa.int64())], ["term", "df"])


class Best:
    """The best classes of each item so far: scores, then smallest ids first."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.score = np.zeros((n_items, top), np.int64)
        self.first = np.full((n_items, top), np.iinfo(np.int64).max)
        self.kind = np.full((n_items, top), -1, np.int64)

    def add(self, items: np.ndarray, scores: np.ndarray, first: np.ndarray, kind: np.ndarray) -> None:
        """scores: a row per item, a column per class with its first id and its number."""
        least, last = self.score[items, -1, None], self.first[items, -1, None]
        better = (scores > least) | ((scores == least) & (first < last) & (scores > 0))
        for row in np.flatnonzero(better.any(axis=1)).tolist():
            item, new = items[row], np.flatnonzero(better[row])
            score = np.concatenate([self.score[item], scores[row, new]])
            ids = np.concatenate([self.first[item], first[new]])
            kinds = np.concatenate([self.kind[item], kind[new]])
            order = np.lexsort((ids, -score))[:self.top]
            self.score[item], self.first[item], self.kind[item] = score[order], ids[order], kinds[order]


def score_step(items: Items, weight: np.ndarray, term: np.ndarray, tf: np.ndarray, row: np.ndarray, m: np.ndarray):
    """Scores of a few classes: items that share a term with one, and a table of a row per
    such item and a column per class. Steps over many items keep the table bounded."""
    gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
    here, local = np.unique(term, return_inverse=True)
    table = np.zeros((len(here), len(m)), np.int64)
    table[local, row] = gain
    at = np.minimum(np.searchsorted(here, items.term), max(0, len(here) - 1))
    shared = np.flatnonzero(here[at] == items.term) if len(here) else np.zeros(0, np.int64)
    step = max(1, STEP_CELLS // max(1, len(m)))
    begin = 0
    while begin < len(shared):
        end = min(len(shared), begin + step)
        if end < len(shared):  # whole items only; an item larger than a step is a step
            while end > begin + 1 and items.item[shared[end]] == items.item[shared[end - 1]]:
                end -= 1
            if end == begin + 1:
                end = begin + int(np.searchsorted(items.item[shared[begin:]], items.item[shared[begin]], side="right"))
        part = shared[begin:end]
        found, starts = np.unique(items.item[part], return_index=True)
        yield found, np.add.reduceat(table[at[part]] * items.times[part, None], starts, axis=0)
        begin = end


CLASS_SCORE = "item_key long, item_id long, score long, first long, class long"


def score_classes(classes: DataFrame, folder: str, block: int, weights: str, n_docs: int, top: int) -> DataFrame:
    """The `top` best classes of each item in each task. classes: (class, first, m, bag)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(folder, block)
        system, path = open_fs(weights)
        holders = pq.read_table(path, filesystem=system)
        weight = np.zeros(len(items.number), np.int64)
        df = holders.column("df").to_numpy()
        weight[holders.column("term").to_numpy()] = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        best = Best(len(items.key), top)
        for batch in batches:
            kind = batch.column(0).to_numpy()
            first = batch.column(1).fill_null(np.iinfo(np.int64).max).to_numpy()
            m = batch.column(2).to_numpy()
            term, tf, sizes = _pairs(batch.column(3))
            ends = np.cumsum(sizes)
            at = 0
            while at < len(m):
                base = ends[at] - sizes[at]
                to = max(at + 1, min(at + STEP_CLASSES, int(np.searchsorted(ends, base + STEP_COUNTS, side="right"))))
                own = slice(int(base), int(ends[to - 1]))
                row = np.repeat(np.arange(to - at), sizes[at:to])
                for found, scores in score_step(items, weight, term[own], tf[own], row, m[at:to]):
                    best.add(found, scores, first[at:to], kind[at:to])
                at = to
        item, place = np.nonzero(best.score > 0)
        first = best.first[item, place]
        yield pa.RecordBatch.from_arrays([
            pa.array(items.key[item], pa.int64()), items.item_id.take(pa.array(item, pa.int64())),
            pa.array(best.score[item, place]), pa.array(first, pa.int64(), mask=first == np.iinfo(np.int64).max),
            pa.array(best.kind[item, place])], [c.split()[0] for c in CLASS_SCORE.split(", ")])

    return classes.select("class", "first", "m", "bag").mapInArrow(run, CLASS_SCORE)


def _search_block(spark: SparkSession, docs: DataFrame, folder: str, block: int, top: int) -> DataFrame:
    every = materialise(bags(docs, folder, block), "search-bags")
    n_docs, total = every.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    holding = every.where(F.octet_length("bag") > 0)
    weights = work_dir(spark, "search-weights")
    holding.select("bag").mapInArrow(_holders, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).write.parquet(weights)

    m = F.expr(f"100 - 25 + ((25L * n * {n_docs}L) div {total or 1}L)")
    holding = holding.select("doc_id", m.alias("m"), "bag").withColumn("hash", F.xxhash64("bag", "m"))
    classes = holding.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("first"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "search-classes")

    # a document among the best `top` belongs to one of the best `top` classes
    best = score_classes(classes, folder, block, weights, n_docs, top)
    order = Window.partitionBy("item_key").orderBy(F.col("score").desc(), F.col("first").asc_nulls_last(), "class")
    best = materialise(best.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top), "search-best")
    ranking = classes.join(best.select("class").distinct(), "class", "left_semi").select(
        "class", F.col("hash").alias("_h"), F.col("m").alias("_m"), F.col("bag").alias("_b"))
    members = holding.join(ranking, (F.col("hash") == F.col("_h")) & (F.col("m") == F.col("_m")) & (F.col("bag") == F.col("_b")))
    inside = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last())
    members = members.select("class", "doc_id").withColumn("_n", F.row_number().over(inside)).where(F.col("_n") <= top)
    found = best.select("item_key", "item_id", "score", "class").join(members, "class")
    final = Window.partitionBy("item_key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest-scoring document rows of each item
    with a score above 0, equal scores by ascending doc_id.

    All documents count in the statistics and are ranked whole. Null and empty texts have
    no terms and are never found; a null doc_id is found and comes last among equal scores;
    repeated documents rank each; items equal in id and text are one item, those that share
    only the id are each ranked; null item ids are carried; empty tables give no rows;
    columns other than ids and texts are not read.
    """
    spark = docs.sparkSession
    folder, blocks = write_items(items)
    found = [_search_block(spark, docs, folder, block, top) for block in blocks]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
