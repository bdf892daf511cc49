"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]: share of the source
times ``1 + slope * (2t - 1)``. Its integral from 0 to t, times the source's target,
is the cumulative demand in words; over the whole run it integrates to the target.
A document that begins after c words of its source (c counts the earlier documents,
and whole passes for repeats) takes the time t at which the demand reaches the middle
of the document. Documents are range-sorted by that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orthoweave.llm.common import WORD

#: Weights dealt to the sources in code-point order, nulls last.
WEIGHTS = (5, 2, 1)
#: Slopes of the schedules, dealt likewise: the heaviest sources fade, others grow.
SLOPES = (-0.5, 0.25, 0.5)
MAX_PASSES = 3
#: Hex digits of the id's hash that name a part of a source. Running totals are formed
#: in parts, then over the parts.
PART_DIGITS = 4


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, slope) from rows (source, size).

    Targets: the weights share the total; a source stops at MAX_PASSES times its size
    and the excess goes to the others by weight. In order of ``limit / weight`` the
    sources that stop form a prefix, found by running sums instead of rounds. The
    windows see one row per source.
    """
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = F.lit(1)
    rank = F.row_number().over(Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("_rank") % len(values) + 1).cast("int"))
    ranked = every.withColumn("_rank", rank).withColumn("weight", pick(WEIGHTS)).withColumn("slope", pick(SLOPES))
    ranked = ranked.withColumn("_limit", F.col("source_size") * MAX_PASSES)
    whole = Window.partitionBy(one)
    before = whole.orderBy(F.col("_limit") / F.col("weight"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_weights", F.sum("weight").over(whole))
        .withColumn("_used", F.coalesce(F.sum("_limit").over(before), F.lit(0)))
        .withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the price of a unit of weight if all sources before this one stop at their limits
    ranked = ranked.withColumn("_price", (F.col("_total") - F.col("_used")) / (F.col("_weights") - F.col("_gone")))
    fits = F.when(F.col("_price") * F.col("weight") <= F.col("_limit"), F.col("_price"))
    price = F.max(fits).over(whole)
    ranked = ranked.withColumn("_final", price)
    target = F.least(F.col("_limit").cast("double"), F.col("weight") * F.col("_final"))
    return ranked.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"), "slope")


def plan_mix(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The input's columns in a struct ``_row``, with source_size, target, size and
    ``_times``: the training positions of the document's copies, none to MAX_PASSES.
    (source, _part, _nth) names an input row.

    Order inside a source is by a hash of the id, so reruns agree; rows with equal id,
    size and text may swap, which changes nothing in the result. A copy is taken when
    its middle lies before the target, so a source misses its target by half a document
    at most. Running totals are formed in 16 ** PART_DIGITS parts of a source and then over parts:
    no task sorts a whole source.
    """
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    d = d.select(
        "_row", F.col(f"_row.{id_col}").alias("_id"), F.col("_row.source").alias("source"),
        word_count(F.col("_row.text")).alias("size"), F.xxhash64("_row.text").alias("_text"))
    return _positions(d)


def _positions(d: DataFrame) -> DataFrame:
    d = d.withColumn("_hash", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")))
    d = d.withColumn("_part", F.substring("_hash", 1, PART_DIGITS))
    parts = d.groupBy("source", "_part").agg(F.sum("size").alias("_part_size"))
    targets = source_targets(parts.select("source", F.col("_part_size").alias("size")))
    running = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_part_size").over(running), F.lit(0)))
    keys = parts.join(
        targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), F.col("_part").alias("_p"), "_before", "source_size", "target", "slope")
    inside = Window.partitionBy("source", "_part").orderBy("_hash", "_id", "size", "_text")
    earlier = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_inside", F.coalesce(earlier, F.lit(0))).withColumn("_nth", F.row_number().over(inside))
    d = d.join(keys, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    first = F.col("_before") + F.col("_inside") + F.col("size") / 2
    middles = F.array(*[first + F.col("source_size") * k for k in range(MAX_PASSES)])
    taken = F.filter(middles, lambda m: (m <= F.col("target")) & (F.col("size") > 0))
    times = F.transform(taken, lambda m: _time(m / F.col("target"), F.col("slope")))
    return d.select(
        "_row", "source", "size", "source_size", "target", "_part", "_nth", "_hash", times.alias("_times"))


def _time(share: Column, slope: Column) -> Column:
    """The t at which t + slope * (t² - t) reaches the share: the integral inverted."""
    b = 1 - slope
    return 2 * share / (b + F.sqrt(b * b + 4 * slope * share))


def order_by_time(plan: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by training position; rows without a copy keep
    one row with a null position, first in the order."""
    copies = plan.select("*", F.posexplode_outer("_times").alias("copy", "position")).drop("_times")
    return copies.repartitionByRange("position", "_hash").sortWithinPartitions("position", "_hash")


def mix(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: the input's columns, a row per copy, in training order.

    Needs the columns id, text and source; all others pass through untouched, whatever
    their names. Null and empty texts have size 0 and are never taken, a null source is
    a source, a null id is an id; an empty table stays empty.
    """
    return order_by_time(plan_mix(docs, id_col).where(F.size("_times") > 0)).select("_row.*")


def mix_summary(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, size, source_size, target of its source, words taken.

    The schedule of mix() with the texts left behind: positions are assigned and
    range-sorted in the same way, then counted per row.
    """
    light = docs.select(
        F.struct(docs["doc_id"]).alias("_row"), docs["doc_id"].alias("_id"), docs["source"],
        word_count(docs["text"]).alias("size"), F.xxhash64(docs["text"]).alias("_text"))
    order = order_by_time(_positions(light))
    rows = order.groupBy("source", "_part", "_nth").agg(
        F.first("_row.doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.when(F.col("position").isNotNull(), F.col("size")).otherwise(0)).alias("taken"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")
