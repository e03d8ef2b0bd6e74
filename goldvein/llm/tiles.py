"""Near-duplicate embeddings by tiled comparison in the order of principal axes.

All vectors of one label are compared, but few products are computed to the end.

1. Equal vectors of a label are one class; the class counts its members.
2. The second moments of all unit vectors, summed by Spark, give the axes on which they
   differ most.  Turned to these axes, the leading dimensions hold most of a product.
3. Classes are sorted by label and first coordinate and packed into tiles, one row each,
   with the range of the leading coordinates and the longest rest.  Two tiles of a label meet
   only if these ranges leave room for a product of the threshold.
4. Two tiles are compared a few dimensions at a time.  After each step a pair's product is
   at most what is summed so far plus the product of the norms of what is left of both;
   pairs that cannot reach the threshold stop there.  Products closer to the threshold than
   rounding may move them are computed again from the given numbers.
5. A pair of tiles hands on one row for each vector with a link: its links there, counted with
   the members of classes, and one vector of its component within the two tiles.  So rows do not
   grow with the links of a large group.  Components are then joined as a graph.

What is compared grows with the square of a label that no range rules out; that is
the task.  Memory is bounded by two tiles of `TILE_BYTES` and their links.

Edge cases: vectors that are null, empty, all zero or hold null or non-finite components
and rows without a label link with nothing, nor do vectors of different lengths.
Rows with the same id are vectors of their own; a component's id is the smallest
in it, nulls left out.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.graph import components
from goldvein.session import scratch_path

TILE_BYTES = 1 << 20
TILE_ROWS = 4096
TILES_A_RANGE = 4
LEADING = 8  # coordinates by whose ranges tiles are ruled out
CHUNK = 256  # rows of a tile compared at once
STEPS = (0.25, 0.5, 1.0)  # of the dimensions, after which pairs may stop
SPARSE = 0.05  # share of pairs left below which they go on one by one
AT_ONCE = 1 << 16  # pairs that go on one by one
ROUNDING = 1e-9
SALT = 256  # tiles of a label that one task of the tile join holds against the rest


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square runs over or under."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _axes(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The commonest length, and for it the axes by falling second moment, as columns."""
    common = vectors.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common else 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = units(_matrix(batch.column(0), dims))
            total += x.T @ x
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"])

    sums = vectors.where(F.size("vector") == dims).select("vector").mapInArrow(task, "i int, j int, s double")
    found = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    moments = np.zeros((dims, dims))
    moments[found["i"], found["j"]] = moments[found["j"], found["i"]] = found["s"]
    return dims, np.linalg.eigh(moments)[1][:, ::-1] if dims else moments


def _turned(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return x @ axes if x.shape[1] == len(axes) else x


@dataclass
class Tile:
    node: np.ndarray
    times: np.ndarray
    given: np.ndarray
    turned: np.ndarray
    rest: np.ndarray  # norms of what is left after each step of STEPS

    @classmethod
    def of(cls, node: bytes, times: bytes, vectors: bytes, dims: int, axes: np.ndarray) -> Tile:
        given = np.frombuffer(vectors, np.float64).reshape(-1, dims)
        turned = _turned(units(given), axes)
        left = np.sqrt(np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1])
        left = np.concatenate([left, np.zeros((len(left), 1))], axis=1)
        return cls(np.frombuffer(node, np.int64), np.frombuffer(times, np.int64), given, turned, left[:, cuts(dims)])


def cuts(dims: int) -> list[int]:
    return sorted({max(1, int(dims * s)) for s in STEPS})


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows as they were given."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def linked(a: Tile, b: Tile, least: float) -> np.ndarray:
    """Whether the cosine of each row of a with each of b is `least` or more."""
    out = np.zeros((len(a.node), len(b.node)), bool)
    ends = cuts(a.turned.shape[1])
    for lo in range(0, len(a.node), CHUNK):
        x, rest = a.turned[lo : lo + CHUNK], a.rest[lo : lo + CHUNK]
        begin, i = 0, None
        dot = np.zeros((len(x), len(b.node)))
        for k, end in enumerate(ends):
            if i is None:
                dot += x[:, begin:end] @ b.turned[:, begin:end].T
                may = dot + rest[:, k : k + 1] * b.rest[:, k] >= least - ROUNDING
                if end == ends[-1] or np.count_nonzero(may) <= SPARSE * may.size:
                    i, j = np.nonzero(may)
                    dot = dot[i, j]
            elif len(i):
                for at in range(0, len(i), AT_ONCE):
                    s = slice(at, at + AT_ONCE)
                    dot[s] += np.einsum("nd,nd->n", x[i[s], begin:end], b.turned[j[s], begin:end])
                may = dot + rest[i, k] * b.rest[j, k] >= least - ROUNDING
                i, j, dot = i[may], j[may], dot[may]
            begin = end
        sure = dot >= least + ROUNDING
        out[lo + i[sure], j[sure]] = True
        i, j = lo + i[~sure], j[~sure]
        for at in range(0, len(i), AT_ONCE):
            p, q = i[at : at + AT_ONCE], j[at : at + AT_ONCE]
            out[p, q] = _exact(a.given[p], b.given[q]) >= least
    return out


def _gathered(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each column with a link, the number of a row of its component; -1 without links.

    Each row and column is followed once, so the work is that of reading the links.
    """
    rows, columns = np.full(links.shape[0], -1), np.full(links.shape[1], -1)
    for start in np.flatnonzero(links.any(axis=1)):
        if rows[start] >= 0:
            continue
        rows[start], now = start, np.array([start])
        while len(now):
            met = np.flatnonzero(links[now].any(axis=0) & (columns < 0))
            columns[met] = start
            now = met[rows[met] < 0] if same else np.flatnonzero(links[:, met].any(axis=1) & (rows < 0))
            rows[now] = start
    return rows, columns


def compared(a: Tile, b: Tile, same: bool, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, head) of all vectors with a link between two tiles, or within one."""
    found = linked(a, b, least)
    if same:
        np.fill_diagonal(found, False)
    rows, columns = _gathered(found, same)
    at = np.flatnonzero(rows >= 0)
    node, n, head = [a.node[at]], [found[at] @ b.times], [a.node[rows[at]]]
    if not same:
        at = np.flatnonzero(columns >= 0)
        node, n, head = node + [b.node[at]], n + [a.times @ found[:, at]], head + [a.node[columns[at]]]
    return np.concatenate(node), np.concatenate(n), np.concatenate(head)


def _packed(classes: DataFrame, dims: int, axes: np.ndarray) -> DataFrame:
    """Tiles: (label, dims, rows, low, high, rest) and their vectors, nodes and counts as bytes."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column(3)
            size = np.diff(vector.offsets.to_numpy())
            first = np.zeros(len(size))
            for d in np.unique(size):
                mine = np.flatnonzero(size == d)
                first[mine] = _turned(units(_matrix(vector.take(pa.array(mine)), int(d))), axes)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int32)), pa.array(first)], [*batch.schema.names, "dims", "lead"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, [], 0

        def tile() -> pa.RecordBatch:
            label, d = key
            given = np.concatenate([_matrix(b.column(3), d) for b in held])
            turned = _turned(units(given), axes)
            front, rest = turned[:, :LEADING], np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1)).max()
            node, times = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (0, 2))
            values = [[label], [d], [front.min(axis=0).tolist()], [front.max(axis=0).tolist()], [float(rest)], [given.tobytes()], [node.tobytes()], [times.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _TILE)], schema=_TILE)

        for batch in batches:
            label, size = batch.column(1).to_pylist(), batch.column(4).to_numpy()
            at = 0
            while at < len(label):
                if key != (label[at], size[at]):
                    if rows:
                        yield tile()
                    key, held, rows = (label[at], int(size[at])), [], 0
                room = max(1, min(TILE_ROWS, TILE_BYTES // (8 * key[1]))) - rows
                stop = at + 1
                while stop < len(label) and stop - at < room and (label[stop], size[stop]) == key:
                    stop += 1
                held.append(batch.slice(at, stop - at))
                rows += stop - at
                at = stop
                if stop - at == room or rows >= max(1, min(TILE_ROWS, TILE_BYTES // (8 * key[1]))):
                    yield tile()
                    held, rows = [], 0
        if rows:
            yield tile()

    a_tile = max(1, min(TILE_ROWS, TILE_BYTES // (8 * max(1, dims))))
    ranges = max(1, -(-classes.count() // (TILES_A_RANGE * a_tile)))
    led = classes.select("node", "label", "times", "vector").mapInArrow(lead, "node long, label string, times long, vector array<double>, dims int, lead double")
    lying = led.repartitionByRange(ranges, "label", "dims", "lead", "node").sortWithinPartitions("label", "dims", "lead", "node")
    columns = lying.select("node", "label", "times", "vector", "dims")
    return columns.mapInArrow(pack, "label string, dims int, low array<double>, high array<double>, rest double, vectors binary, nodes binary, counts binary")


_TILE = pa.schema(
    [("label", pa.string()), ("dims", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("rest", pa.float64()), ("vectors", pa.binary()), ("nodes", pa.binary()), ("counts", pa.binary())]
)


def _meeting(tiles: DataFrame, least: float) -> DataFrame:
    """(a, b): tiles of a label that may hold a pair, each two once, by their ranges."""
    box = tiles.select("tile", "label", "dims", "low", "high", "rest")
    many = tiles.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / SALT).alias("salts"))
    box = box.join(many, ["label", "dims"])
    one = box.withColumn("salt", F.pmod(F.xxhash64("tile"), F.col("salts"))).alias("x")
    other = box.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("y")
    # per coordinate the largest product of two numbers of the ranges is one of two of their ends
    most = """aggregate(zip_with(arrays_zip(x.low, x.high), arrays_zip(y.low, y.high), (p, q) -> greatest(
        p.low * q.low, p.low * q.high, p.high * q.low, p.high * q.high)), 0D, (s, v) -> s + v) + x.rest * y.rest"""
    same = (F.col("x.label") == F.col("y.label")) & (F.col("x.dims") == F.col("y.dims")) & (F.col("x.salt") == F.col("y.salt"))
    once = (F.col("x.tile") <= F.col("y.tile")) & (F.expr(most) >= least - ROUNDING)
    even = (F.col("x.tile") + F.col("y.tile")) % 2 == 0  # so that no tile is the second one of most pairs
    pairs = one.join(other, same & once)
    return pairs.select(
        F.when(even, F.col("x.tile")).otherwise(F.col("y.tile")).alias("a"),
        F.when(even, F.col("y.tile")).otherwise(F.col("x.tile")).alias("b"),
    )


def near_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93) -> DataFrame:
    """(id, n_links, component_id, kept) for each row.

    Vectors of one label are linked if their cosine in double precision is ``least``, above
    zero, or more.  Tables between the steps are in the session's shared folder.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    plain = rows.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), v.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    plain = plain.withColumn("sound", F.coalesce(sound & F.col("label").isNotNull(), F.lit(False)))
    # 128 bits stand for a vector, so rows meet their class without it
    plain = plain.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit("other"), "vector")})
    of = ["label", "h", "g"]
    classes = plain.where("sound").groupBy(*of).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"))
    classes = _kept(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    dims, axes = _axes(classes)
    tiles = _packed(classes, dims, axes).withColumn("tile", F.monotonically_increasing_id())
    tiles = _kept(tiles, "tiles")
    pairs = _kept(_meeting(tiles, least), "meeting")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                r = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                a = Tile.of(r["nodes_a"], r["counts_a"], r["vectors_a"], r["dims"], axes)
                same = r["a"] == r["b"]
                b = a if same else Tile.of(r["nodes_b"], r["counts_b"], r["vectors_b"], r["dims"], axes)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in compared(a, b, same, least)], ["node", "links", "head"])

    def side(end: str, *more: str) -> DataFrame:
        return tiles.select(F.col("tile").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("nodes", "counts", "vectors")], *more)

    met = pairs.join(side("a", "dims"), "a").join(side("b"), "b")
    found = _kept(met.mapInArrow(task, "node long, links long, head long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select("node", "head"), "node", "head")
    joined = classes.select("node", "least").join(joined, "node")
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = joined.join(smallest, "component").select("node", "component_id")
    known = classes.select(*of, "node", "least", "times").join(links, "node", "left").join(joined, "node", "left")
    known = known.select(
        *of, (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("sound")
    )
    out = plain.select("id", *of, "sound").join(known, [*of, "sound"], "left")
    own = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept")
    )
