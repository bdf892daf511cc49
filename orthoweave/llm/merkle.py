"""Merkle manifest of a document table, with proofs by a recursive query.

A tree per source: leaves ascend by doc_id, every FAN consecutive nodes become their
parent until one is left, the subroot; the subroots form a tree of the same kind, its top
is the root. Built levels are stored as node rows that hold their children's hashes and a
link to their parent. A recursive SQL query climbs those links: each step appends the
siblings met and folds the hash that is carried, so a changed leaf shows at the root.

The leaves of one run climb in one row, since they share everything above it. All rows
below a node need that node's row: they find it under the number of their block of
BLOCK_LEVELS levels of leaves, and upper nodes are stored once per block below them. So no
key of the climb has more rows than a block, however large the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orthoweave.llm.common import bucket_of_id, materialise

FAN = 16
#: A block: the leaves under one node of this level.
BLOCK_LEVELS = 3
#: Where this divides crc32 of the id, the climb starts from a changed text.
TAMPER_EVERY = 5
#: Number of the tree of subroots; the sources' trees count from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(*parts: Column) -> Column:
    """sha256 of the parts one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def text_of(hashes: Column) -> Column:
    """Lower-case hexadecimal text of one or more hashes."""
    return F.lower(F.hex(hashes))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(docs: DataFrame, text: Column) -> Column:
    return digest(*[_field(text if name == "text" else docs[name]) for name in FIELDS])


def numbered(rows: DataFrame, order: Sequence[str], number: str, group: str | None = None) -> DataFrame:
    """Adds the position (from 0) in the order, nulls first, among all rows or in a group
    that leads the order, and n_<number>, how many there are. The table is range-sorted
    and written; positions are the row's place in its part plus the rows of the parts
    before, so no task sees a whole group."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("_at", 33)
    key = F.col(group) if group else F.lit(0)
    parts = stored.groupBy(part.alias("_p"), key.alias("_g")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    parts = parts.withColumn("_total", F.sum("_n").over(Window.partitionBy("_g")))
    same = (part == F.col("_p")) & (F.col(group).eqNullSafe(F.col("_g")) if group else F.lit(True))
    return stored.join(parts, same).select(
        *rows.columns, (F.col("_at") + F.col("_base")).alias(number), F.col("_total").alias(f"n_{number}"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, start, tree, idx, n_idx, n_tree): the leaf of every row, the hash from
    which its climb starts, its tree and its place in it."""
    changed = F.translate(docs["text"].cast("string"), UPPER, LOWER)
    hashed = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        leaf_hash(docs, docs["text"]).alias("leaf"),
        F.when(bucket_of_id(TAMPER_EVERY) == 0, leaf_hash(docs, changed)).alias("tampered"))
    hashed = materialise(hashed, "merkle-leaves")
    placed = materialise(numbered(hashed, ["source", "doc_id", "leaf"], "idx", "source"), "merkle-placed")
    trees = numbered(placed.select("source").distinct(), ["source"], "tree").select(
        F.col("source").alias("_s"), "tree", "n_tree")
    return placed.join(trees, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "leaf", F.coalesce("tampered", "leaf").alias("start"), "tree", "idx", "n_idx", "n_tree")


def _levels(nodes: DataFrame, below: int) -> list[DataFrame]:
    """The levels above the nodes (tree, idx, n, hash), where `below` is the largest n: rows
    (tree, level, idx, n, hash, run). Trees of one node are done and left out."""
    out, level = [], 0
    while below > 1:
        level += 1
        runs = nodes.where("n > 1").groupBy("tree", F.expr(f"idx div {FAN}").alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("children"),
            F.expr(f"(first(n) + {FAN - 1}) div {FAN}").alias("n"))
        # runs of up to FAN hashes: their number is fixed, whatever the table
        run = F.aggregate("children", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["hash"]))
        nodes = runs.select("tree", F.lit(level).alias("level"), F.col("parent").alias("idx"), "n", run.alias("run"))
        nodes = materialise(nodes.withColumn("hash", digest(text_of(F.col("run")))), "merkle-level")
        out.append(nodes)
        below = -(-below // FAN)
    return out


def build(placed: DataFrame) -> DataFrame:
    """All node rows: tree, level, idx, hash, run (the children's hashes in order, null for a
    lone leaf), is_subroot, and the parent: up_tree, up_level, up_idx (null at the root) and
    position, the node's place among the parent's children."""
    sizes = placed.agg(F.max("n_idx"), F.max("n_tree")).first()
    most, n_trees = sizes[0] or 0, sizes[1] or 0
    first = placed.select("tree", F.lit(0).alias("level"), "idx", F.col("n_idx").alias("n"), F.col("leaf").alias("hash"))
    lone = first.where("n = 1").withColumn("run", F.lit(None).cast("binary"))
    inner = lone
    for nodes in _levels(first, most):
        inner = inner.unionByName(nodes)
    subroots = inner.where("n = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_trees).cast("long").alias("n"), "hash")
    top = _levels(subroots, n_trees)
    up = inner.withColumn("is_subroot", F.col("n") == 1)
    for nodes in top:
        up = up.unionByName(nodes.withColumn("is_subroot", F.lit(False)))
    ends = F.col("n") == 1
    root = ends & (F.lit(n_trees == 1) | (F.col("tree") == TOP))
    place = F.when(ends, F.col("tree")).otherwise(F.col("idx"))
    linked = up.select(
        "tree", "level", "idx", "hash", "run", "is_subroot",
        F.when(~root, F.when(ends, F.lit(TOP)).otherwise(F.col("tree"))).cast("long").alias("up_tree"),
        F.when(~root, F.when(ends, F.lit(1)).otherwise(F.col("level") + 1)).alias("up_level"),
        F.when(~root, F.expr(f"(CASE WHEN n = 1 THEN tree ELSE idx END) div {FAN}")).alias("up_idx"),
        (place % FAN).cast("int").alias("position"))
    return materialise(linked, "merkle-nodes")


def _reachable(nodes: DataFrame) -> DataFrame:
    """The node rows with (home, block), the tree and block of the leaves that climb through
    them: upper nodes once for each block below."""
    low = nodes.where((F.col("tree") != TOP) & (F.col("level") <= BLOCK_LEVELS))
    low = low.withColumn("home", F.col("tree")).withColumn(
        "block", F.expr(f"idx div cast(power({FAN}, {BLOCK_LEVELS} - level) as long)"))
    heights = nodes.where("is_subroot").select(F.col("tree").alias("home"), F.col("level").alias("height"))
    above = nodes.where(F.col("tree") == TOP).agg(F.max("level")).first()[0] or 0
    blocks = low.select("home", "block").distinct().join(heights, "home")
    own = blocks.where(F.col("height") > BLOCK_LEVELS).select("home", "block", F.explode(
        F.sequence(F.lit(BLOCK_LEVELS + 1), F.col("height"))).alias("_level")).select(
        "home", "block", F.col("home").alias("_tree"), "_level",
        F.expr(f"block div cast(power({FAN}, _level - {BLOCK_LEVELS}) as long)").alias("_idx"))
    tops = blocks.select("home", "block", F.explode(F.sequence(F.lit(1), F.lit(above))).alias("_level")).select(
        "home", "block", F.lit(TOP).cast("long").alias("_tree"), "_level",
        F.expr(f"home div cast(power({FAN}, _level) as long)").alias("_idx")) if above else own.where("false")
    chain = own.unionByName(tops)
    high = nodes.join(chain, (nodes["tree"] == chain["_tree"]) & (nodes["level"] == chain["_level"])
                      & (nodes["idx"] == chain["_idx"])).drop("_tree", "_level", "_idx")
    return low.unionByName(high)


#: left and right are the hexadecimal texts of the siblings before and after a child.
_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT home, block, tree, level, idx, members, run, folded, above, subroot, up_tree, up_level, up_idx, position
  FROM {first}
  UNION ALL
  SELECT c.home, c.block, c.up_tree, c.up_level, c.up_idx, c.members, c.run,
    transform(c.folded, x -> unhex(sha2(concat(
      lower(hex(substring(p.run, 1, 32 * c.position))), lower(hex(x)), lower(hex(substring(p.run, 32 * c.position + 33)))), 256))),
    concat(c.above, substring(p.run, 1, 32 * c.position), substring(p.run, 32 * c.position + 33)),
    CASE WHEN p.is_subroot THEN p.hash ELSE c.subroot END,
    p.up_tree, p.up_level, p.up_idx, p.position
  FROM climb c JOIN {nodes} p
    ON c.home = p.home AND c.block = p.block AND c.up_tree = p.tree AND c.up_level = p.level AND c.up_idx = p.idx
)
SELECT members, run, folded, above, subroot FROM climb WHERE up_tree IS NULL
"""


def climb(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every leaf's way to the root by the recursive query: a row per run of leaves with
    members (doc_id, leaf), run (the run's leaves), folded (a hash per member), above (the
    siblings from the second level on) and subroot."""
    spark = placed.sparkSession
    member = F.struct("idx", "doc_id", "leaf", "start")
    # the run of a lone leaf has no level of its own
    runs = placed.withColumn("level", F.when(F.col("n_idx") > 1, 1).otherwise(0)).groupBy(
        "tree", "level", F.expr(f"idx div {FAN}").alias("idx")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    run = F.aggregate("members", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["leaf"]))
    runs = runs.withColumn("run", run)
    left = lambda i: text_of(F.substring(F.col("run"), F.lit(1), 32 * i))
    right = lambda i: text_of(F.substring(F.col("run"), 32 * i + 33, F.length("run")))
    folded = F.transform("members", lambda x, i: digest(left(i), text_of(x["start"]), right(i)))
    alone = F.transform("members", lambda x: x["start"])
    # leaves climb from their parent's row; a lone leaf is its own subroot
    own = nodes.select("tree", "level", "idx", "hash", "is_subroot", "up_tree", "up_level", "up_idx", "position")
    first = runs.join(own, ["tree", "level", "idx"]).select(
        F.col("tree").alias("home"),
        F.expr(f"idx div {FAN ** (BLOCK_LEVELS - 1)}").alias("block"),
        "tree", "level", "idx", F.transform("members", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"))).alias("members"),
        "run", F.when(F.col("level") == 0, alone).otherwise(folded).alias("folded"), F.lit("").cast("binary").alias("above"),
        F.when(F.col("is_subroot"), F.col("hash")).alias("subroot"), "up_tree", "up_level", "up_idx", "position")
    first, reachable = materialise(first, "merkle-first"), materialise(_reachable(nodes), "merkle-reachable")
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # the rows grow with the table
    try:
        return materialise(spark.sql(_CLIMB, first=first, nodes=reachable), "merkle-climb")
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The placed leaves and all node rows of the table's Merkle trees."""
    placed = materialise(leaves(docs), "merkle-trees")
    return placed, build(placed)


def prove(docs: DataFrame) -> DataFrame:
    """A row per input row: doc_id, leaf, subroot, root, siblings (the proof: the hashes
    met on the way up, level by level), folded_root (from the changed leaf where the id is
    marked, else from the leaf) and verified.

    Needs the columns doc_id, source, lang, n_chars and text; others are not read. Any of
    them may be null; a null source is a source and comes first, a null id is an id, comes
    first and counts as marked, rows with equal id are leaves of their own in order of their
    hashes. A table of one row has an empty proof; an empty table gives no rows.
    """
    placed, nodes = manifest(docs)
    top = nodes.where("up_tree IS NULL").select(text_of(F.col("hash"))).first()
    done = climb(placed, nodes).withColumn("above", text_of(F.col("above")))
    each = done.select(
        F.posexplode("members").alias("_i", "_m"), "folded", "above", "subroot", "run")
    own = F.concat(F.substring(F.col("run"), F.lit(1), 32 * F.col("_i")),
                   F.substring(F.col("run"), 32 * F.col("_i") + 33, F.length("run")))
    folded = text_of(F.col("folded")[F.col("_i")])
    root = F.lit(top[0] if top else None).cast("string")
    return each.select(
        F.col("_m.doc_id").alias("doc_id"), text_of(F.col("_m.leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.concat(text_of(own), "above").alias("siblings"),
        folded.alias("folded_root"), (folded == root).alias("verified"))


def proof_digest(docs: DataFrame) -> DataFrame:
    """The rows of prove() with proof_sha256 in place of the siblings."""
    rows = prove(docs)
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")
