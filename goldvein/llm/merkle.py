"""Merkle manifest of a table: a tree of digests for each group and one over the groups.

A row's leaf is a digest of its columns.  The leaves of a group lie in a given order;
every `fan` consecutive nodes of a level have the digest of their digests as parent,
until one node is left, the group's subroot.  The subroots, ordered by group, are the
leaves of one more tree, whose last node is the root of the manifest.

1. Leaves are numbered within their group without a window over it: they are spread by
   range and sorted, each range's rows of a group are counted, and the sums of the counts
   of earlier ranges say where a range begins.
2. On each level a node knows its slot in its run, so it knows the indices of its
   siblings: those of 1 to fan - 1 slots on, around the run.  One equijoin on
   (group, index) gives each node the digests at those indices, in order.  The rows of slot
   zero then emit the parents, an eighth of the rows.
3. From the top down each node's proof is its parent's proof with its own siblings in
   front, joined by the parent's index.  A parent has at most `fan` children, so no join
   has a key with more rows than that, however large a group is.

Each level is a table in the session's shared folder, read by both passes.  The driver
learns the number of levels, from the size of the largest group, and the root.

Edge cases: a null group comes first.  Nulls in the order come first; rows with the
same place in the order are ordered by their digest, and equal rows are
interchangeable.  A group of one row has its leaf as subroot; an empty table has no rows
and no root.  Extra columns pass through; columns called subroot, root or path are
replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.session import remove_folder, scratch_path

FAN = 8
_ADDED = ("subroot", "root", "path")


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def record_digest(*columns: Column | str) -> Column:
    """Digest of some columns: each one's bytes behind their count and a colon, or `-` for null."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return _digest(F.concat(*parts))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(
        path, leaf, lambda own, step: _digest(F.concat(hex_of(step["before"]), hex_of(own), hex_of(step["after"])))
    )


def proof_digest(path: Column) -> Column:
    """Digest of the siblings of a path, level by level, left to right."""
    return _digest(F.array_join(F.transform(path, lambda s: hex_of(F.concat(s["before"], s["after"]))), ""))


def _kept(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `at`, their index in their tree, and `n`, the size of the tree's lowest level."""
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    lying, _ = _kept(spread.withColumn("pos", F.monotonically_increasing_id()).drop(*order), "leaves")
    lying = lying.withColumn("part", F.shiftright("pos", 33))
    counts = lying.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first"))
    # a row for each range and tree in it: as many as there are ranges and trees together
    sums = counts.selectExpr(
        "tree",
        "part",
        "first - (sum(rows) OVER (PARTITION BY tree ORDER BY part) - rows) AS shift",
        "sum(rows) OVER (PARTITION BY tree) AS n",
    )
    sums, _ = _kept(sums, "ranges")
    return lying.join(sums, ["tree", "part"]).withColumn("at", F.col("pos") - F.col("shift")).drop("pos", "part", "shift")


def _with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes with the digests that stand before and after theirs in their run."""
    slot = F.col("at") % fan
    offered = (
        nodes.select("tree", "at", "n", "digest", F.explode(F.sequence(F.lit(1), F.lit(fan - 1))).alias("on"))
        .withColumn("at", F.col("at") - slot + F.pmod(slot - F.col("on"), F.lit(fan)))
        .where("at < n")
    )
    ahead = [F.max(F.when(F.col("on") == k, F.col("digest"))).alias(f"s{k}") for k in range(1, fan)]
    joined = nodes.join(offered.groupBy("tree", "at").agg(*ahead), ["tree", "at"], "left")

    empty = F.expr("X''")

    def those(test) -> Column:
        return F.concat(*[F.when(test(slot + k), F.coalesce(f"s{k}", empty)).otherwise(empty) for k in range(1, fan)])

    return joined.select(
        *nodes.columns, those(lambda x: x >= fan).alias("before"), those(lambda x: x < fan).alias("after")
    )


def _parents(level: DataFrame, fan: int) -> DataFrame:
    digest = _digest(F.concat(hex_of(F.col("digest")), hex_of(F.col("after"))))
    return level.where(F.col("at") % fan == 0).select(
        "tree", F.floor(F.col("at") / fan).alias("at"), F.ceil(F.col("n") / fan).alias("n"), digest.alias("digest")
    )


def _grow(leaves: DataFrame, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, without their last nodes, and those last nodes with their level."""
    widest = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels, ends = leaves, [], []
    while True:
        ends.append(nodes.where("n = 1").select("tree", "digest", F.lit(len(levels)).alias("level")))
        if widest <= 1:
            return levels, reduce(DataFrame.unionByName, ends)
        level, _ = _kept(_with_siblings(nodes.where("n > 1"), fan), f"level{len(levels)}")
        levels.append(level)
        nodes, widest = _parents(level, fan), -(-widest // fan)


def _paths(levels: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """All nodes of the lowest level that have siblings, with their paths; tops: tree, level, path of last nodes."""
    above = None
    for k in reversed(range(len(levels))):
        ended = tops.where(F.col("level") == k + 1).select(F.col("tree").alias("t"), F.lit(0).cast("long").alias("up"), "path")
        if above is not None:
            ended = ended.unionByName(above.select(F.col("tree").alias("t"), F.col("at").alias("up"), "path"))
        own = F.array(F.struct("before", "after"))
        joined = levels[k].join(ended, (F.col("tree") == F.col("t")) & (F.floor(F.col("at") / fan) == F.col("up")))
        above = joined.withColumn("path", F.concat(own, "path")).drop("t", "up", "before", "after")
    return above


def manifest(rows: DataFrame, digest: str = "leaf", group: str = "lang", order: tuple[str, ...] = ("doc_id",), fan: int = FAN) -> DataFrame:
    """The rows with `subroot`, `root` (binary) and `path`: (before, after) for each level up to the root.

    ``digest`` names the column of the leaves, ``group`` the column that divides them
    into trees.  `fold` of a leaf and its path gives the root.
    """
    rows = rows.drop(*_ADDED)
    by = [f"k{i}" for i in range(len(order))]
    named = F.col(f"`{group}`").cast("string")
    plain = rows.select(
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("tree"),
        F.col(f"`{digest}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, by)],
    )
    # written first: spreading by range reads its input twice
    found, first = _kept(plain, "digests")
    leaves = _numbered(found.withColumns({"own": F.col("digest"), "id": F.monotonically_increasing_id()}), [*by, "own", "id"])
    remove_folder(rows.sparkSession, first)
    levels, ends = _grow(leaves, fan)
    ends, _ = _kept(ends, "subroots")

    groups = _numbered(
        ends.select(F.lit("").alias("tree"), "digest", F.struct("tree", "level", "digest").alias("row"), F.col("tree").alias("k")), ["k"]
    )
    upper, last = _grow(groups, fan)
    found = last.first()
    root = F.lit(found["digest"] if found else None).cast("binary")
    none = F.array().cast("array<struct<before:binary,after:binary>>")
    if upper:
        tops = _paths(upper, last.select("tree", "level", none.alias("path")), fan)
    else:
        tops = groups.withColumn("path", none)
    tops, _ = _kept(tops.select("row.tree", "row.level", F.col("row.digest").alias("subroot"), "path"), "tops")

    single = leaves.where("n = 1").select("tree", "row").join(tops.select("tree", "path"), "tree")
    out = single if not levels else single.unionByName(_paths(levels, tops.drop("subroot"), fan).select("tree", "row", "path"))
    # as many subroots as groups: the table is written, so Spark knows whether it is small
    out = out.join(tops.select("tree", "subroot"), "tree")
    return out.select("row.*", "subroot", root.alias("root"), "path")
