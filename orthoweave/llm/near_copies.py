"""Near copies of documents: SimHash and minima propose, shingle sets decide.

A document is its set of 5-word shingles. Candidates are documents whose SimHashes are at
most four bits apart, found by the deletion variants of :mod:`simhash`, and documents that
share one of 20 keys of four minima of hashed shingles; at a Jaccard similarity of 0.8 the
keys miss about one pair in 40,000, if minima were independent. A pair counts if its sets
agree to 80 % or more, and groups are joined over chains of such pairs.

A key that many documents share is a crowd: thousands of copies of one text, or a passage
in many texts. There, the shingles that no other member of a crowd has are counted first.
They bound the similarity of a pair exactly, so documents that only share a passage are
never a pair, and they point to the original: the member with the fewest is compared with
all others. Only pairs that are not connected by then and still within the bound are
compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orthoweave.llm import simhash
from orthoweave.llm.common import connected_components, materialise, packed_rows, unpacked_rows

WIDTH, SIMILARITY_PERCENT = 5, 80
KEYS, KEY_MINIMA = 20, 4
#: A key with more documents is a crowd. Others are compared pair by pair.
CROWD = 32
SEED = 42

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_NUMBERS = np.random.default_rng(2).integers(0, 1 << 64, KEYS * KEY_MINIMA, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of WIDTH words; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    runs = {b" ".join(words[i:i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))}
    return np.sort(np.array([xxhash.xxh64_intdigest(x, SEED) for x in runs], np.uint64))


def keys(hashes: np.ndarray) -> np.ndarray:
    least = np.array([(hashes ^ x).min() for x in _NUMBERS], "<u8").reshape(KEYS, KEY_MINIMA)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least)], np.uint64).view(np.int64)


_SKETCH = [T.StructField("vertex", T.LongType()), T.StructField("n", T.LongType()), T.StructField("fp", T.LongType()),
           T.StructField("keys", T.ArrayType(T.LongType()))]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the hash of their set, its size, its SimHash and its keys."""
    for batch in batches:
        vertex, n, prints, found = [], [], [], []
        for text in batch.column(2):
            hashes = shingles(text.as_py())
            vertex.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
            n.append(len(hashes))
            prints.append(simhash.majority(hashes))
            found.append(keys(hashes))
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:2], pa.array(vertex, pa.int64()), pa.array(n, pa.int64()),
            pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64()))],
            [*batch.schema.names[:2], *[f.name for f in _SKETCH]])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(x.as_py()).view(np.int64) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["vertex", "shingles"])


def _within(p: str, q: str) -> Column:
    """Whether two sets can reach the similarity: what they share is at most what either
    has besides its own shingles (rows n, own)."""
    most = F.least(F.col(f"{p}.n") - F.col(f"{p}.own"), F.col(f"{q}.n") - F.col(f"{q}.own"))
    return most * 100 >= (F.col(f"{p}.n") + F.col(f"{q}.n") - most) * SIMILARITY_PERCENT


def _pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of the rows (vertex, n, own, bucket) that share a bucket."""
    p, q = rows.alias("p"), rows.alias("q")
    met = (F.col("p.bucket") == F.col("q.bucket")) & (F.col("p.vertex") < F.col("q.vertex")) & _within("p", "q")
    return p.join(q, met).select(F.col("p.vertex").alias("a"), F.col("q.vertex").alias("b"))


def _outside_pairs(named: DataFrame) -> DataFrame:
    """Pairs (p, q) of a crowd's members that can be similar and are not connected, p outside
    the original's group: rows (vertex, n, own, bucket, root, home, least, common, buckets).

    What two members share is at most what either shares with the original, and besides
    that what either has that is neither the original's nor its own. A pair is formed in
    the first of its crowds only.
    """
    # members that are within the bound of the smallest member at least
    outside = (F.col("root") != F.col("home")) & (9 * (F.col("n") - F.col("own")) - 4 * F.col("n") >= 4 * F.col("least"))
    named = named.withColumn("outside", outside).withColumn(
        "also", F.greatest(F.col("n") - F.col("common") - F.col("own"), F.lit(0)))
    p, q = named.where("outside").alias("p"), named.alias("q")
    most = F.least("p.common", "q.common") + F.least("p.also", "q.also")
    within = most * 100 >= (F.col("p.n") + F.col("q.n") - most) * SIMILARITY_PERCENT
    # of two members outside, the smaller one finds the other
    once = ~F.col("q.outside") | (F.col("p.vertex") < F.col("q.vertex"))
    first = F.get(F.array_intersect("p.buckets", "q.buckets"), F.lit(0)) == F.col("p.bucket")
    met = (F.col("p.bucket") == F.col("q.bucket")) & (F.col("p.root") != F.col("q.root")) & within & once & first
    return p.join(q, met).select(F.col("p.vertex").alias("p"), F.col("q.vertex").alias("q"))


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose members are not connected."""
    named = pairs.join(joined.toDF("a", "root_a"), "a", "left").join(joined.toDF("b", "root_b"), "b", "left")
    return named.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _by_simhash(distinct: DataFrame) -> DataFrame:
    """Candidates whose SimHashes are close: through one set of each SimHash."""
    first = distinct.groupBy("fp").agg(F.min("vertex").alias("first"))
    near = simhash.links(first.select("fp"))
    near = near.join(first.toDF("a", "first_a"), "a").join(first.toDF("b", "first_b"), "b")
    return _ordered(distinct.join(first, "fp"), "vertex", "first").unionByName(_ordered(near, "first_a", "first_b"))


def roots(distinct: DataFrame, sets_of) -> DataFrame:
    """(vertex, root) of the sets that have a near copy, from rows (vertex, n, fp, keys);
    sets_of gives (vertex, shingles) for a table of vertices."""
    keyed = distinct.select("vertex", "n", F.explode("keys").alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    # KEYS rows of each set, which Spark counts as one: never a broadcast
    shared = materialise(keyed.join(sizes.hint("merge"), "bucket").withColumn("own", F.lit(0).cast("long")), "near-shared")
    by_print = materialise(_by_simhash(distinct), "near-prints")
    involved = shared.select("vertex").union(by_print.select("a")).union(by_print.select("b")).distinct()
    sets = materialise(sets_of(involved), "near-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        every = F.size("set_a") + F.size("set_b") - common
        return both.where(common * 100 >= every * SIMILARITY_PERCENT).select("a", "b")

    crowds = shared.where(F.col("members") > CROWD)
    members = crowds.select("vertex").distinct()
    held = sets.join(members, "vertex", "left_semi").select("vertex", F.explode("shingles").alias("shingle"))
    alone = held.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("vertex").alias("vertex")).where("holders = 1")
    alone = alone.groupBy("vertex").agg(F.count("*").alias("_own"))
    crowds = materialise(crowds.join(alone, "vertex", "left").select(
        "vertex", "n", "bucket", F.coalesce("_own", F.lit(0)).cast("long").alias("own")), "near-crowds")
    original = crowds.groupBy("bucket").agg(F.min(F.struct("own", "vertex", "n")).alias("q"), F.min("n").alias("least"))
    stars = crowds.join(original, "bucket").select("q", F.struct("vertex", "n", "own").alias("p")).where(_within("p", "q"))
    stars = materialise(stars.select(F.col("p.vertex").alias("vertex"), F.col("q.own").alias("own"), F.col("q.vertex").alias("to")).distinct(),
                        "near-stars")

    # each member with the best original of all its keys first, then what is not connected yet
    best = stars.where("vertex <> to").groupBy("vertex").agg(F.min(F.struct("own", "to")).alias("q"))
    few = _pairs(shared.where(F.col("members") <= CROWD))
    tried = materialise(few.union(_ordered(best, "vertex", "q.to")).distinct(), "near-tried")
    first = materialise(verified(tried), "near-first")
    joined = connected_components(first, "a", "b", "near-edges")
    more = _apart(_ordered(stars, "vertex", "to").union(by_print).distinct(), joined)
    more = materialise(more.join(tried, ["a", "b"], "left_anti"), "near-more")
    first = first.union(materialise(verified(more), "near-second"))
    tried = tried.union(more)
    linked = materialise(connected_components(first, "a", "b", "near-edges"), "near-roots")
    home = original.select("bucket", "least", F.col("q.vertex").alias("to")).join(
        linked.toDF("to", "root"), "to", "left").select("bucket", "least", "to", F.coalesce("root", "to").alias("home"))
    named = crowds.join(linked, "vertex", "left").withColumn("root", F.coalesce("root", "vertex")).join(home, "bucket")
    # what each member shares with its original
    both = named.select("vertex", "to").distinct().join(sets.toDF("vertex", "set_a"), "vertex").join(sets.toDF("to", "set_b"), "to")
    common = materialise(both.select("vertex", "to", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common")), "near-common")
    among = crowds.groupBy("vertex").agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))
    rest = _ordered(_outside_pairs(named.join(common, ["vertex", "to"]).join(among, "vertex")), "p", "q")
    # pairs already refused need no second comparison
    rest = materialise(verified(rest.join(tried, ["a", "b"], "left_anti")), "near-rest")
    return connected_components(first.union(rest), "a", "b", "near-edges")


def keep_first(docs: DataFrame) -> DataFrame:
    """The input rows with one row left of each group of near copies, joined over chains of
    them: the row with the smallest id, null ids last, ties to the row stored first.

    Decides on rows, not ids: repeated rows, and rows that share an id or have none, are
    copies where their texts are and stay where they are not. Texts without words are copies
    of each other; a text shorter than a shingle is one shingle. All columns pass through,
    whatever their names; an empty table stays empty.
    """
    packed = packed_rows(docs)
    each = packed.mapInArrow(_sketches, T.StructType([*packed.schema.fields[:2], *_SKETCH]))
    each = materialise(each.withColumn("_nth", F.monotonically_increasing_id()), "near-rows")
    text = F.col("_in")[f"c{docs.columns.index('text')}"].cast("string")
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("doc_id"), F.col("_nth").alias("nth"))
    distinct = materialise(each.groupBy("vertex").agg(
        F.min(place).alias("place"), *[F.first(c).alias(c) for c in ("n", "fp", "keys")]), "near-distinct")

    def sets_of(vertices: DataFrame) -> DataFrame:
        # one text of each set, and of those only that are a candidate
        own = distinct.join(vertices, "vertex", "left_semi").select("vertex", F.col("place.nth").alias("_own"))
        return each.select("_nth", text.alias("_text")).join(own, F.col("_nth") == F.col("_own")).select("vertex", "_text").mapInArrow(
            _sets, "vertex long, shingles array<long>")

    found = roots(distinct.select("vertex", "n", "fp", "keys"), sets_of)
    groups = distinct.select("vertex", "place").join(found, "vertex", "left")
    first = groups.groupBy(F.coalesce("root", "vertex").alias("root")).agg(F.min("place").alias("place"))
    kept = each.join(first.select(F.col("place.nth").alias("_kept")), F.col("_nth") == F.col("_kept"), "left_semi")
    return unpacked_rows(kept, docs.columns)
