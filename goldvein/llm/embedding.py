"""Document fingerprints by randomised edit embedding.

A pointer walks over the characters of a text.  At step j it reads the character
below it and moves on by one or stays, as a random bit that all texts share for j and
that character says.  Where two texts agree the pointers move alike; after an edit
they part and, being random walks, soon meet again.  So few edits change few steps:
edit distance becomes Hamming distance of the walks.

A fingerprint samples `SLOTS` steps of the walk, eight bits each of the four
characters from the pointer on.  Texts have walks of different lengths, so each slot
samples like a reservoir: step j replaces what the slot holds with a chance of
1 / (j + 1), by draws that all texts share.  Each slot is then a step taken evenly
from the whole walk, and walks of nearly equal length sample mostly the same steps.

Near duplicates are found by banding: a band is eight bits at each of `BAND` slots.
All pairs of texts that share a band's bits are confirmed by the Hamming distance of
whole fingerprints, each in the first band that they share; links give components.
Buckets are looked at in blocks of about `BLOCK` members, and a block hands on one row
for each member, so rows do not grow with the number of pairs; comparisons do.

Edge cases: null texts are empty; empty texts have the fingerprint of no samples, all
zero, which is alike only to itself.  Rows with the same id and text count once in the
order of documents, and each of them gets the result; rows with the same id and
different texts are ordered by a hash of the text; null ids come after all others.
A single document is next to itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.graph import components
from goldvein.llm.hashing import mix
from goldvein.session import scratch_path

SLOTS = 128
BAND, BANDS = 4, 24  # a pair that is alike at 0.8 shares no band with a chance below 1e-5
SEED = 20240229
STEPS = 4096  # random bits made at once
CHARS = 12_000_000  # of texts that walk together
CLASSES = 64
BLOCK = 2000  # members of a bucket that one side of a comparison holds
BUCKETS_A_PARTITION = 4
_LAST = -(1 << 63)


@cache
def _records() -> dict[int, np.ndarray]:
    """The slots that each step replaces, for steps up to 2 ** 40."""
    random = np.random.default_rng(SEED)
    slots: dict[int, list[int]] = {}
    for s in range(SLOTS):
        step = 0
        while step < 1 << 40:
            slots.setdefault(step, []).append(s)
            step = int((step + 1) / max(random.random(), 2.0**-40))
    return {step: np.array(x) for step, x in slots.items()}


def _bits(first: int) -> np.ndarray:
    """Whether each class of characters moves the pointer at steps first, first + 1 and so on."""
    word = mix(np.arange(first, first + STEPS, dtype=np.uint64) + np.uint64(SEED))
    return ((word[:, None] >> np.arange(CLASSES, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)


def _walk(texts: list[str]) -> np.ndarray:
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.concatenate([code, np.zeros(STEPS + 4, np.uint32)])
    kind = (code * np.uint32(0x9E3779B1)) >> np.uint32(26)
    ends = np.cumsum(size)
    end = ends[order]
    at = end - size[order]
    n = len(code) - 3
    four = code[:n] * np.uint32(0x85EBCA6B)
    for k, odd in ((1, 0xC2B2AE35), (2, 0x27D4EB2F), (3, 0x165667B1)):
        four = (four ^ (four >> np.uint32(15))) + code[k : k + n] * np.uint32(odd)
    four = ((four * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    for k in (1, 2, 3):  # characters behind the end of a text do not count
        tail = ends[size >= k] - k
        h = np.zeros(len(tail), np.uint64)
        for i in range(k):
            h = mix(h + code[tail + i].astype(np.uint64) + np.uint64(k))
        four[tail] = (h >> np.uint64(56)).astype(np.uint8)
    four |= np.uint8(four == 0)
    out = np.zeros((len(texts), SLOTS), np.uint8)
    records, kind = _records(), kind.astype(np.uint8)
    live, step = int((size[order] > 0).sum()), 0
    at, end, row = at[:live], end[:live], order[:live]
    while len(at):
        bits = _bits(step)
        for i in range(STEPS):
            if (slots := records.get(step + i)) is not None:
                inside = np.flatnonzero(at < end)
                out[row[inside][:, None], slots] = four[at[inside]][:, None]
            at = at + bits[i][kind[at]]
            if i & 63 == 63:
                stay = at < end
                if not stay.all():
                    at, end, row = at[stay], end[stay], row[stay]
                    if not len(at):
                        break
        step += STEPS
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """Rows of `SLOTS` bytes, one for each text."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHARS or i == len(texts) - 1:
            out.append(_walk(texts[start : i + 1]))
            start, size = i + 1, 0
    return np.concatenate(out) if out else np.zeros((0, SLOTS), np.uint8)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of agreeing slots above what chance gives, 0 to 1."""
    chance = 1 / 255
    return np.clip(((x == y).mean(axis=1) - chance) / (1 - chance), 0, 1)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows (bucket, role, order, hash, id, text): ranges of ids with the row that follows each range.

    Ranges come from quantiles of the ids.  Each range's rows are followed, in role 1,
    by a copy of the first row of the next lower range (after the lowest: the highest).
    What reaches the driver is one row for each range.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(id).cast("long"), F.lit(_LAST))
    plain = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), order.alias("order"))
    ranges = max(2, BUCKETS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = plain.select("order").approxQuantile("order", [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    cuts = sorted({int(c) for c in cuts})
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("order"))) if cuts else F.lit(0)
    plain = plain.withColumn("hash", F.xxhash64("text")).withColumn("bucket", bucket)
    tops = plain.groupBy("bucket").agg(F.max(F.struct("order", "hash")).alias("top")).orderBy(F.desc("bucket")).collect()
    closing = {(t["top"]["order"], t["top"]["hash"]): tops[i - 1]["bucket"] for i, t in enumerate(tops)}
    heads = plain.where(F.col("order").isin([o for o, _ in closing])) if closing else plain.limit(0)
    to = F.create_map(*[F.lit(x) for (o, h), b in closing.items() for x in (f"{o} {h}", b)]) if closing else F.lit(None).cast("map<string,int>")
    heads = heads.withColumn("bucket", F.element_at(to, F.concat_ws(" ", F.col("order").cast("string"), F.col("hash").cast("string")))).where("bucket is not null")
    both = plain.withColumn("role", F.lit(0)).unionByName(heads.withColumn("role", F.lit(1)))
    return both.select("bucket", "role", "order", "hash", "id", "text")


def edit_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Texts are shuffled once, by ranges of ids; a task then streams over its ranges in
    descending order, holding the rows of one batch and the last row before it.
    """
    rows = with_next(docs, id, text).repartition("bucket").sortWithinPartitions("bucket", "role", F.desc("order"), F.desc("hash"))
    kind = dict(docs.dtypes)[id]

    def answer(held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        """Results of all held rows that have a following row."""
        key = [r[:2] for r in held]  # (bucket, order, hash) and role
        texts = [r[3] for r in held]
        last, following = -1, [-1] * len(held)
        for i in range(len(held) - 1, -1, -1):
            if i + 1 < len(held) and key[i + 1] != key[i]:
                last = i + 1
            following[i] = last if last >= 0 and held[last][0][0] == held[i][0][0] else -1
        own = [i for i, f in enumerate(following) if f >= 0 and held[i][1] == 0]
        new = [edited(texts[i], texts[following[i]]) for i in own]
        prints = fingerprints(texts + new)
        mine, after, changed = prints[own], prints[[following[i] for i in own]], prints[len(texts) :]
        return pa.RecordBatch.from_pydict(
            {
                "id": pa.array([held[i][2] for i in own], kind),
                "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
                "fingerprint": pa.array([r.tobytes().hex() for r in mine], pa.string()),
                "edited_fingerprint": pa.array([r.tobytes().hex() for r in changed], pa.string()),
                "near_edited": pa.array(likeness(mine, changed), pa.float64()),
                "near_next": pa.array(likeness(mine, after), pa.float64()),
            }
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            bucket, role, order, h, ids, texts = (c.to_pylist() for c in batch.columns)
            held += [((b, o, x), r, i, t) for b, r, o, x, i, t in zip(bucket, role, order, h, ids, texts)]
            # the rows that equal the last one wait for the row that follows
            cut = len(held) - 1
            while cut and held[cut - 1][:2] == held[-1][:2]:
                cut -= 1
            if cut:
                yield answer(held[: cut + 1], batch.column(4).type)
                held = held[cut:]

    out = rows.mapInArrow(
        task,
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
    return out.withColumnRenamed("id", id)


def block_links(own: np.ndarray, i: int, j: int, table: np.ndarray, band: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of members of blocks i and j of one bucket: the first member that links reach, and the number of links.

    Only pairs with one side in each block count, and only if `band` is the first band they share.
    """
    keys = np.ascontiguousarray(table[:, _BANDED[:band].ravel()]).view("<u4") if band else np.zeros((len(table), 0), np.uint32)
    root, count = np.arange(len(table)), np.zeros(len(table), np.int64)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    for n in left.tolist():
        at = right[right > n] if i == j else right
        at = at[~(keys[at] == keys[n]).any(axis=1)]
        at = at[likeness(table[at], table[n]) >= least]
        if len(at):
            count[n] += len(at)
            count[at] += 1
            joined = np.unique(np.append(root[at], root[n]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
    return root, count


def bucket_links(members: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """(node, other, n) of members (key, band, node): n links of a node in a block, other one that they reach."""
    parts = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    parts = parts.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
    rows = (
        members.join(parts, "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "band", "node")
        .join(prints, "node")
        .select("key", "i", "j", "own", "band", "node", "f")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def answer(t: pa.Table) -> pa.RecordBatch:
            key, i, j, own, band, node = (t.column(c).to_numpy() for c in range(6))
            table = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint8).reshape(-1, SLOTS)
            new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
            begin = np.flatnonzero(new)
            out = [(np.zeros(0, np.int64),) * 3]
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(key)]):
                root, count = block_links(own[a:b], i[a], j[a], table[a:b], int(band[a]), least)
                some = np.flatnonzero(count)
                out.append((node[a:b][some], node[a:b][root[some]], count[some]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["node", "other", "n"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if not len(held):
                continue
            last = np.ones(len(held), bool)
            for c in range(3):
                x = held.column(c).to_numpy()
                last &= x == x[-1]
            whole = int(np.argmax(last))
            if whole:
                yield answer(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield answer(held)

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(task, "node long, other long, n long")


def node_groups(prints: DataFrame, least: float) -> DataFrame:
    """(node, group_id, n_links) of rows (id, node, f); f are fingerprints in bytes, node their hash."""
    spark = prints.sparkSession
    some = prints.where(F.col("f") != F.lit(bytes(SLOTS)))
    bits = lambda b: F.concat(*[F.substring("f", s + 1, 1) for s in _band(b)])
    bands = F.posexplode(F.array(*[F.xxhash64(F.lit(b), bits(b)) for b in range(BANDS)])).alias("band", "key")
    members = some.select("node", bands).distinct()
    path = scratch_path(spark, "links")
    bucket_links(members, some.select("node", "f").dropDuplicates(["node"]), least).write.parquet(path)
    links = spark.read.parquet(path)
    group = components(links, "node", "other")
    count = links.groupBy("node").agg(F.sum("n").alias("n_links"))
    classes = prints.groupBy("node").agg(F.min("id").alias("least"))
    named = classes.join(group, "node", "left").join(count, "node", "left")
    named = named.select("node", "least", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    groups = named.groupBy("component").agg(F.min("least").alias("group_id"))
    return named.join(groups, "component").select("node", "group_id", "n_links")


def near_groups(prints: DataFrame, id: str = "doc_id", fingerprint: str = "fingerprint", least: float = 0.8) -> DataFrame:
    """(id, group_id, n_links): texts with alike fingerprints, of rows with a hex fingerprint.

    Rows with equal fingerprints are one class, named by a 64-bit hash.  Classes that
    share a band and are alike are linked; n_links counts a class's links, group_id is
    the smallest id that links reach, null if all are.  Fingerprints of empty texts
    link with none but their like.
    """
    own = prints.select(F.col(id).cast("long").alias("id"), F.unhex(fingerprint).alias("f")).withColumn("node", F.xxhash64("f"))
    return own.join(node_groups(own, least), "node").select(F.col("id").alias(id), "group_id", "n_links")


def with_groups(prints: DataFrame, id: str = "doc_id", least: float = 0.8) -> DataFrame:
    """The rows of edit_fingerprints with group_id and n_links of near_groups.

    The rows are written to the session's shared folder first, fingerprints in bytes,
    so that texts are read and walked once.
    """
    spark = prints.sparkSession
    path = scratch_path(spark, "prints")
    packed = prints.select(*[F.unhex(c).alias(c) if c in _HEX else F.col(f"`{c}`") for c in prints.columns])
    packed.withColumn("node", F.xxhash64("fingerprint")).write.parquet(path)
    packed = spark.read.parquet(path)
    groups = node_groups(packed.select(F.col(id).cast("long").alias("id"), F.col("fingerprint").alias("f"), "node"), least)
    plain = [F.lower(F.hex(c)).alias(c) if c in _HEX else F.col(f"`{c}`") for c in prints.columns]
    return packed.join(groups, "node").select(*plain, "group_id", "n_links")


def _band(b: int) -> list[int]:
    return sorted(np.random.default_rng([SEED, b]).choice(SLOTS, BAND, replace=False).tolist())


_BANDED = np.array([_band(b) for b in range(BANDS)])
_HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")
