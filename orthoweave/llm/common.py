"""Helpers that several operators share: tables, the shared folder, files, components."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orthoweave.session import work_dir

#: Word of the contracts: a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters that separate words.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting to remove the shuffle files of a query when it has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: cuts lineage and
    survives the loss of an executor. The table stands for its shuffles, whose files go."""
    return materialise_parts([df], purpose)


def materialise_parts(parts: Sequence[DataFrame], purpose: str) -> DataFrame:
    """One table of parts of equal columns, written one after the other: the shuffle files of
    a part go before the next part is begun."""
    spark = parts[0].sparkSession
    path = work_dir(spark, purpose)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        for part in parts:
            part.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    table = spark.read.schema(parts[0].schema).parquet(path)
    table._folder = path
    return table


def discard(materialised: DataFrame) -> None:
    """Removes a table of materialise() that nothing reads any more."""
    session = materialised.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path(materialised._folder)
    path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bucket_of_id(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % modulus


def packed_rows(docs: DataFrame) -> DataFrame:
    """(_in, _id, _text): each row whole, whatever its columns are called, with its id and
    text, so that a task can decide on the row itself."""
    return docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_in"),
        docs["doc_id"].cast("long").alias("_id"), docs["text"].cast("string").alias("_text"))


def unpacked_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of packed_rows() in their own columns again."""
    return rows.select(*[F.col("_in")[f"c{i}"].alias(c) for i, c in enumerate(columns)])


def open_fs(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder in the shared store (local, hdfs, s3, gs)."""
    if "://" not in uri and not uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks: Sequence[bytes]) -> None:
    """Writes one file under a name of its own; the reader learns the name from the
    task that succeeded, so what a lost task left behind is never read."""
    system, path = open_fs(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)


def attempt_name(prefix: str, partition: int) -> str:
    return f"{prefix}-{partition:06d}-{uuid.uuid4().hex}"


def connected_components(edges: DataFrame, a: str, b: str, purpose: str) -> DataFrame:
    """(vertex, root): the smallest vertex of the component, for every vertex that an
    edge touches but the roots themselves, which have no row. Alternating large-star and small-star steps; each state is a table
    in the shared folder. Edges of one vertex are only joined and aggregated, never
    gathered."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    state = materialise(edges, purpose)
    before = None
    while True:
        after = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after[0] == 0 or after == before:
            break
        before = after
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, purpose)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
        state = materialise(small, purpose)
    return state.select(F.col("u").alias("vertex"), F.col("v").alias("root"))


class Candidates(NamedTuple):
    """How candidates are told from links. right keeps the right ones of pairs (a, b). If
    marks, rows (vertex, ...), are given, pairs of p and q that do not pass near are none,
    and the right ones of those that pass are kept by passed."""

    right: Callable[[DataFrame], DataFrame]
    marks: DataFrame | None = None
    near: Callable[[str, str], Column] | None = None
    passed: Callable[[DataFrame], DataFrame] | None = None


def linked(keyed: DataFrame | Sequence[DataFrame], near: Callable[[Column, Column], Column],
           prepare: Callable[[DataFrame], Candidates], purpose: str) -> DataFrame:
    """(vertex, root) of the vertices that are linked to another. keyed: (vertex, mark,
    bucket), or parts of it that share no bucket, which are shuffled one after the other;
    vertices that share a bucket and whose marks are near are candidates. prepare gets the
    (vertex) rows that share a bucket.

    First each vertex is compared with two pivots of each of its buckets (smallest
    and largest), so a crowd costs as many comparisons as it has members. Only pairs
    that are not connected by then are compared one by one: no link that matters is
    lost, and none inside a group is formed twice. Pairs with a pivot are settled by then,
    so these are pairs of the other members of a bucket.
    """
    bucket = Window.partitionBy("bucket")
    me = F.struct("vertex", "mark")

    def pivots(part: DataFrame) -> DataFrame:
        found = part.withColumn("low", F.min(me).over(bucket)).withColumn("high", F.max(me).over(bucket)).withColumn(
            "members", F.count("*").over(bucket)).where("low.vertex <> high.vertex")
        inner = (F.col("members") > 3) & (F.col("vertex") != F.col("low.vertex")) & (F.col("vertex") != F.col("high.vertex"))
        return found.select("vertex", "mark", "bucket", inner.alias("inner"), *[
            F.when(near(F.col("mark"), F.col(f"{p}.mark")) & (F.col("vertex") != F.col(f"{p}.vertex")),
                   F.col(f"{p}.vertex")).alias(p) for p in ("low", "high")])

    parts = [keyed] if isinstance(keyed, DataFrame) else keyed
    crowded = materialise_parts([pivots(part) for part in parts], f"{purpose}-crowded")
    candidates = prepare(crowded.select("vertex").distinct())
    stars = [
        crowded.where(F.col(p).isNotNull()).select(
            F.least("vertex", p).alias("a"), F.greatest("vertex", p).alias("b"))
        for p in ("low", "high")]
    tried = stars[0].union(stars[1]).distinct()
    first = materialise(candidates.right(tried), f"{purpose}-stars")
    roots = connected_components(first, "a", "b", f"{purpose}-edges")
    named = crowded.where("inner").select("vertex", "mark", "bucket").join(roots, "vertex", "left").withColumn(
        "root", F.coalesce("root", "vertex"))
    if candidates.marks is not None:
        named = named.join(candidates.marks, "vertex")
    p, q = named.alias("p"), named.alias("q")
    met = ((F.col("p.bucket") == F.col("q.bucket")) & (F.col("p.vertex") < F.col("q.vertex"))
           & (F.col("p.root") != F.col("q.root")) & near(F.col("p.mark"), F.col("q.mark")))
    if candidates.near is not None:
        met = met & candidates.near("p", "q")
    rest = p.join(q, met).select(F.col("p.vertex").alias("a"), F.col("q.vertex").alias("b")).distinct()
    # pairs already refused as stars need no second comparison
    passed = candidates.passed or candidates.right
    rest = materialise(passed(rest.join(tried, ["a", "b"], "left_anti")), f"{purpose}-rest")
    return connected_components(first.union(rest), "a", "b", f"{purpose}-edges")
