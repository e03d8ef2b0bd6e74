"""Near-duplicate documents by HyperMinHash sketches.

A text's distinct word shingles are hashed to 64 bits.  The first bits of a hash name
one of `BUCKETS` buckets; of the smallest remainder in a bucket the sketch stores the
count of leading zeros and the ten bits after the first one, 16 bits in all.  Empty
buckets are marked; for banding they borrow from others by one fixed probing order, so a
register of two sets agrees about as often as their Jaccard index.

1. Texts with the same shingle set are one class; only its smallest id goes on.
2. Bands of registers (and, for very short texts, a prefix of their shingles in hash
   order, which finds every pair) are bucket keys.  Each member of a bucket is paired
   with the bucket's smallest class.
3. Pairs whose estimate, corrected for chance agreement of registers, is far too low
   are left; the rest are confirmed on the full sets.
4. Confirmed links give components.  Buckets that still hold several components are
   looked through again, in blocks: a block's most central member is paired with all
   that may link with it, and each member with its likeliest untested partner in another
   component.  In a last round, when few members are left apart, all pairs that are
   left are tested, so no link between components is lost, while a bucket whose members
   are already one component costs nothing more.  A pair that shares several bands
   counts in the first of them only.

Sizes alone rule out pairs whose larger set is more than 100 / percent times the
smaller one.  Two short texts are compared by their sets at once, not by an estimate.

Edge cases: texts that are null or have no words have no shingles and link with
nothing.  A text shorter than a shingle has one shingle, all its words.  Rows with a
null id link with nothing.  Rows with the same id are one document to the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.graph import components
from goldvein.llm.hashing import blocks, mix, shingles, words
from goldvein.session import scratch_path

BITS = 8
BUCKETS = 1 << BITS
MANTISSA = 10
ROWS, BANDS = 5, 25  # a pair at 0.8 shares no band with a chance below 1e-4
SHORT = 30  # up to so many shingles a text also has prefix keys
MARGIN = 3.5  # standard deviations below the threshold that an estimate may be
BLOCK = 1000  # members of a bucket compared at once
PARTNERS = (1, None)  # of a member in a block, by round; None: all
EMPTY = 0xFFFF
CROWD = 16  # members from which a block has a central one
MEMBERS = 2000  # texts compared with one copy of a leader's text

_EDGE = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BITS)
_OWN = np.arange(BUCKETS, dtype=np.uint64)
_PROBE = (mix(np.arange(64 * BUCKETS, dtype=np.uint64) + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64).reshape(64, -1)
# chance that unrelated registers agree: same zeros (1/4 + 1/16 + ...) and same mantissa
_CHANCE = 1 / 3 / (1 << MANTISSA)


def shingle_sets(column: pa.Array, n: int, lower: bool) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in blocks(column):
        h, at = shingles(words(data, offsets, lower), n)
        for i in range(len(at) - 1):
            s = np.sort(h[at[i] : at[i + 1]])
            yield s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def registers(least: np.ndarray, full: np.ndarray) -> np.ndarray:
    """16-bit registers of rows of bucket minima; full marks the buckets in use."""
    rest = (least << np.uint64(BITS)) | np.uint64(1 << (BITS - 1))
    zeros = (64 - np.frexp(rest.astype(np.float64))[1]).clip(0, 62).astype(np.uint64)
    bits = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.where(full, (zeros << np.uint64(MANTISSA)) | bits, np.uint64(EMPTY)).astype(np.uint16)


def densified(table: np.ndarray) -> np.ndarray:
    """Rows of registers whose empty ones hold what they borrow."""
    out, full = table.copy(), table != EMPTY
    got = full.copy()
    for probe in _PROBE:
        if got.all():
            return out
        take = ~got & full[:, probe]
        out[take] = table[:, probe][take]
        got |= take
    nearest = np.maximum.accumulate(np.where(full, np.arange(BUCKETS), -1), axis=1)
    nearest = np.where(nearest < 0, nearest[:, -1:], nearest)
    rows, cols = np.nonzero(~got & full.any(axis=1)[:, None])
    out[rows, cols] = table[rows, nearest[rows, cols]]
    return out


def band_keys(table: np.ndarray) -> np.ndarray:
    """A hash for each band of rows of registers."""
    part = densified(table)[:, : BANDS * ROWS].reshape(len(table), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32), part.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key + part[:, :, r])
    return key


def sketches(docs: DataFrame, n: int, lower: bool) -> DataFrame:
    """(id, n_shingles, set_a, set_b, registers, short) of rows (id, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            size, a, b = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            least, full = np.zeros((rows, BUCKETS), np.uint64), np.zeros((rows, BUCKETS), bool)
            keys: list[bytes | None] = [None] * rows
            for i, s in enumerate(shingle_sets(batch.column(1), n, lower)):
                if not len(s):
                    continue
                size[i] = len(s)
                a[i], b[i] = np.add.reduce(mix(s)), np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)))
                least[i] = s[np.minimum(np.searchsorted(s, _EDGE), len(s) - 1)]
                full[i] = (least[i] >> np.uint64(64 - BITS)) == _OWN
                if len(s) <= SHORT:
                    keys[i] = s.tobytes()
            packed = np.ascontiguousarray(registers(least, full))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.array([r.tobytes() for r in packed], pa.binary()),
                    pa.array(keys, pa.binary()),
                ],
                names=["id", "n_shingles", "set_a", "set_b", "registers", "short"],
            )

    return docs.mapInArrow(
        task, "id long, n_shingles long, set_a long, set_b long, registers binary, short binary"
    )


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def _short(raw: bytes | None) -> np.ndarray | None:
    return None if raw is None else np.frombuffer(raw, np.uint64)


def bands(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, band, id) for each band of a node's registers, and for a short text's first shingles (band -1).

    Two sets that reach the threshold share one of their first shingles in hash
    order, if each gives all but the share that may differ.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            key = band_keys(_unpacked(batch.column(1)))
            sets = [(i, _short(raw)) for i, raw in zip(ids, batch.column(2).to_pylist()) if raw]
            extra = [(k, i) for i, s in sets for k in mix(s[: len(s) - (percent * len(s) + 99) // 100 + 1]).view(np.int64)]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": np.concatenate([key.ravel().view(np.int64), np.array([k for k, _ in extra], np.int64)]),
                    "band": np.concatenate([np.tile(np.arange(BANDS, dtype=np.int32), len(ids)), np.full(len(extra), -1, np.int32)]),
                    "id": np.concatenate([np.repeat(ids, BANDS), np.array([i for _, i in extra], np.int64)]),
                }
            )

    return nodes.select("id", "registers", "short").mapInArrow(task, "key long, band int, id long")


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for chance agreement."""
    used = (x != EMPTY) | (y != EMPTY)
    agree = ((x == y) & used).sum(axis=-1) / np.maximum(1, used.sum(axis=-1))
    return (agree - _CHANCE) / (1 - _CHANCE)


def may_link(x: dict, y: dict, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a node x and many nodes y: which may reach the threshold, and the estimates.

    x and y have n_shingles, registers and short; those of y are arrays, short a list.
    """
    t, n = percent / 100, y["n_shingles"]
    small, large = np.minimum(n, x["n_shingles"]), np.maximum(n, x["n_shingles"])
    near = estimate(x["registers"], y["registers"])
    # registers sample the union of the sets, and of a small union they hold nearly all
    union = (small + large) / (1 + t)
    drawn = BUCKETS * (1 - np.exp(-union / BUCKETS))
    least = t - MARGIN * (t * (1 - t) / drawn * np.maximum(1 - drawn / union, 0.1)) ** 0.5
    may = 100 * small >= percent * large
    if x["short"] is None:
        return may & (near >= least), near
    for k in np.flatnonzero(may):
        if (other := y["short"][k]) is not None:
            shared = len(np.intersect1d(x["short"], other, assume_unique=True))
            near[k] = shared / (len(x["short"]) + len(other) - shared)
            may[k] = 100 * shared >= percent * (len(x["short"]) + len(other) - shared)
        else:
            may[k] = near[k] >= least[k]
    return may, near


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            short, other = (batch.column(i).to_pylist() for i in (6, 7))
            x, y = _unpacked(batch.column(2)), _unpacked(batch.column(3))
            may = np.zeros(len(batch), bool)
            for i in np.flatnonzero(100 * np.minimum(n, m) >= percent * np.maximum(n, m)):
                one = {"n_shingles": n[i], "registers": x[i], "short": _short(short[i])}
                may[i] = may_link(one, {"n_shingles": m[i : i + 1], "registers": y[i : i + 1], "short": [_short(other[i])]}, percent)[0][0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(may))

    sketch = nodes.select("id", F.col("registers").alias("r"), F.col("n_shingles").alias("n"), F.col("short").alias("s"))
    both = pairs.join(sketch.toDF("a", "x", "n", "s"), "a").join(sketch.toDF("b", "y", "m", "o"), "b")
    return both.select("a", "b", "x", "y", "n", "m", "s", "o").mapInArrow(task, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame, n: int, lower: bool, percent: int) -> DataFrame:
    """(a, b, linked) for pairs (a, b), decided on the full shingle sets.

    The texts paired with one leader `a` stream past its set, sorted so that the
    leader comes first; a leader with many partners is copied to several tasks.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    first = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("id"), F.lit(0).alias("role"))
    rest = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("id"), F.lit(1).alias("role"))
    rows = first.unionByName(rest).join(texts, "id").select("a", "part", "role", "id", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, role, ids = (batch.column(i).to_pylist() for i in (0, 2, 3))
            out = []
            for i, s in enumerate(shingle_sets(batch.column(4), n, lower)):
                if role[i] == 0:
                    leader, own = a[i], s
                elif a[i] == leader:
                    shared = len(own) + len(s) - len(np.union1d(own, s))
                    out.append((a[i], ids[i], 100 * shared >= percent * (len(own) + len(s) - shared)))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64()), "linked": pa.array([x[2] for x in out], pa.bool_())}
            )

    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "role").mapInArrow(task, "a long, b long, linked boolean")


def still_mixed(keys: DataFrame, label: DataFrame) -> DataFrame:
    """(key, band, id) of the buckets whose members are in several components."""
    named = keys.join(label, "id")
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return named.join(mixed.select("key"), "key").select("key", "band", "id")


def _central(table: np.ndarray) -> int:
    """The row that agrees most with the commonest value of each register."""
    common = np.empty(table.shape[1], table.dtype)
    for c in range(table.shape[1]):
        value, count = np.unique(table[:, c], return_counts=True)
        common[c] = value[count.argmax()]
    return int((table == common).sum(axis=1).argmax())


def untested(
    keys: DataFrame, nodes: DataFrame, label: DataFrame, tested: DataFrame, percent: int, partners: int | None
) -> DataFrame:
    """Likely pairs (a, b) of one bucket in different components that are not tested yet.

    Buckets are looked at in blocks of about `BLOCK` members, so no task holds a
    whole large bucket.
    """
    parts = keys.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    done = tested.select(F.col("a").alias("id"), F.col("b").alias("o")).unionByName(tested.select(F.col("b").alias("id"), F.col("a").alias("o")))
    done = done.groupBy("id").agg(F.collect_set("o").alias("done"))
    own = nodes.select("id", "registers", "n_shingles", "short").join(label, "id").join(done, "id", "left")
    rows = (
        keys.join(parts, "key")
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "band", "id")
        .join(own, "id")
        .select("key", "i", "j", "own", "band", "id", "component", "registers", "n_shingles", "short", "done")
    )

    def pairs(group: list[dict]) -> Iterator[tuple[int, int]]:
        left = right = group
        if group and group[0]["i"] < group[0]["j"]:
            left = [r for r in group if r["own"] == r["i"]]
            right = [r for r in group if r["own"] == r["j"]]
        if not left or not right:
            return
        table = {
            "registers": np.frombuffer(b"".join(r["registers"] for r in right), np.uint16).reshape(-1, BUCKETS),
            "n_shingles": np.array([r["n_shingles"] for r in right]),
        }
        short = [_short(r["short"]) for r in right]
        ids, comp = np.array([r["id"] for r in right]), np.array([r["component"] for r in right])
        band = right[0]["band"]
        keyed = band_keys(table["registers"])[:, : max(band, 0)]
        mine = keyed if left is right else band_keys(np.frombuffer(b"".join(r["registers"] for r in left), np.uint16).reshape(-1, BUCKETS))[:, : max(band, 0)]
        central = _central(table["registers"]) if left is right and len(right) >= CROWD else -1
        for n, r in enumerate(left):
            at = np.flatnonzero((comp != r["component"]) & ~np.isin(ids, r["done"] or []))
            if n != central and len(at):
                at = at[~(keyed[at] == mine[n]).any(axis=1)]  # no earlier band in common
            if not len(at):
                continue
            x = {"registers": np.frombuffer(r["registers"], np.uint16), "n_shingles": r["n_shingles"], "short": _short(r["short"])}
            may, near = may_link(x, {k: v[at] for k, v in table.items()} | {"short": [short[k] for k in at]}, percent)
            at, near = at[may], near[may]
            if n != central:
                at = at[np.argsort(-near, kind="stable")][:partners]
            for k in at.tolist():
                yield min(r["id"], int(ids[k])), max(r["id"], int(ids[k]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        out: set[tuple[int, int]] = set()

        def flush() -> pa.RecordBatch:
            got = sorted(out)
            out.clear()
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([y for _, y in got], pa.int64())})

        for batch in batches:
            for r in batch.to_pylist():
                if (now := (r["key"], r["i"], r["j"])) != key:
                    out.update(pairs(group))
                    key, group = now, []
                group.append(r)
            yield flush()
        out.update(pairs(group))
        yield flush()

    spread = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return spread.mapInArrow(task, "a long, b long").distinct()


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) after more links (a, b): components of components."""
    ends = links.join(label.toDF("a", "x"), "a").join(label.toDF("b", "y"), "b")
    joined = components(ends.select("x", "y"), "x", "y")
    moved = label.join(joined, label["component"] == joined["node"], "left")
    return moved.select("id", F.coalesce(joined["component"], label["component"]).alias("component"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, lower: bool = True, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, class_id, component_id, kept) for each row of docs.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their
    shingle sets.  class_id is the smallest id with the same set, component_id the
    smallest id that links reach.  Tables between the steps are written to the
    session's shared folder.
    """
    spark = docs.sparkSession

    def keep(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    plain = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketch = keep(sketches(plain, shingle, lower), "sketches")
    of = ["set_a", "set_b", "n_shingles"]
    live = sketch.where("n_shingles > 0 and id is not null")
    classes = live.groupBy(*of).agg(F.min("id").alias("class_id"))
    member = live.select("id", *of).join(classes, of).select("id", "class_id").distinct()
    member = keep(member, "members")
    nodes = sketch.drop("set_a", "set_b").join(member.where("id = class_id").select("id").distinct(), "id").dropDuplicates(["id"])
    nodes = keep(nodes, "nodes")

    keys = bands(nodes, percent)
    shared = keys.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    keys = keep(keys.join(shared, "key"), "buckets")
    texts = plain.join(keys.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    texts = keep(texts, "texts")
    more = likely(keys.where("a < id").select("a", F.col("id").alias("b")).distinct(), nodes, percent)
    label = nodes.select("id", F.col("id").alias("component"))
    tested, keys = None, keys.select("key", "band", "id")
    for partners in (*PARTNERS, 0):
        new = keep(confirm(more, texts, shingle, lower, percent), "tested")
        tested = new if tested is None else tested.unionByName(new)
        label = keep(_merged(label, new.where("linked")), "labels")
        if partners == 0:
            break
        keys = keep(still_mixed(keys, label), "mixed")
        more = keep(untested(keys, nodes, label, tested, percent, partners), "pairs")
    of_id = member.groupBy("id").agg(F.min("class_id").alias("class_id")).join(label.withColumnRenamed("id", "class_id"), "class_id")
    of_id = of_id.groupBy("id").agg(F.min("class_id").alias("class_id"), F.min("component").alias("component_id"))
    out = sketch.select("id", "n_shingles").join(of_id, "id", "left")
    own = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id),
        "n_shingles",
        F.coalesce("class_id", "id").alias("class_id"),
        own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )
