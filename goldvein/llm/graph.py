"""Connected components of an edge table, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.session import scratch_path


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) of all nodes that have an edge; component is the smallest node.

    The edge table of each round is written to the session's shared folder, so a
    round never depends on an earlier round's shuffles.  Both stars aggregate inside
    the map tasks first and join each node's rows with one row, which adaptive
    execution can split where a node has very many edges.  The number of rounds grows
    with the logarithm of the longest path.
    """
    start = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    now = _kept(start, "edges")
    before, state = None, _state(now)
    if not state[0]:
        before = state
    while state != before:
        now = _kept(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
