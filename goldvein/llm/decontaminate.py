"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the number of their shingles; partition u holds sizes above
u / 2 up to u.  For each partition a document is cut in windows of 2 * u shingles that
overlap by u, so a stretch of u shingles lies in one window and a short item is a
large part of it, however long the document is.  Window and item have MinHash
signatures of `HASHES` values.  An item is a candidate for a document if any value
agrees with one of its windows: for an item four fifths of which lie in a window that
fails with a chance below 2e-6.  A window with no shingle of any item cannot agree
and gets no signature.  Candidates are confirmed by exact containment: the share of
the item's distinct shingles that the whole document has.

The search is one map over the documents, without a shuffle.  Items are the stated
query set: they reach the tasks in blocks of at most `ITEMS` items and `ITEM_WORDS`
words, and each block is one more pass over the documents, so what a task holds has a bound.

Edge cases: null texts, and items without words, match nothing.  An item of fewer
words than a shingle is one shingle, all its words, and is looked up as such.  A
document shorter than a shingle has no shingles.  Rows with equal ids are matched one
by one.  A-Z is lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.hashing import blocks, mix, run_starts, runs, shingles, words

HASHES = 64
ITEMS, ITEM_WORDS = 20_000, 2_000_000
LEAST = 8  # partitions are of sizes up to 8, 16, 32 and so on
WINDOWS = 2048  # given signatures at once
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


def signatures(rows: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """MinHash values of rows of shingle hashes; entries that are not valid do not count."""
    out = np.empty((len(rows), HASHES), np.uint64)
    for k, seed in enumerate(_SEEDS):
        out[:, k] = np.where(valid, mix(rows ^ seed), np.uint64(0xFFFFFFFFFFFFFFFF)).min(axis=1)
    return out


@dataclass
class Partition:
    upper: int
    item: list[np.ndarray]  # by hash: item numbers, sorted by the value
    value: list[np.ndarray]


@dataclass
class Index:
    ids: np.ndarray
    sets: list[np.ndarray]  # distinct shingles of each item
    partitions: list[Partition]
    known: np.ndarray  # all items' shingles, sorted
    maybe: np.ndarray  # bits by the first hash bits, to rule most shingles out
    shift: int
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: hashes, item numbers


def index(ids: list[int], texts: list[str | None], n: int) -> Index:
    column = pa.array(texts, pa.string())
    sets: list[np.ndarray] = []
    size, count, whole = [], [], []
    for _, data, offsets in blocks(column):
        w = words(data, offsets, lower=True)
        h, at = shingles(w, n)
        sets += [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
        size += np.diff(at).tolist()
        count += w.counts.tolist()
        own = w.hashes()
        whole += [runs(own[a:b], b - a)[0] if 0 < b - a < n else np.uint64(0) for a, b in zip(w.first[:-1], w.first[1:])]
    counts = np.array(count)
    partitions = []
    long = np.flatnonzero(counts >= n)
    # a repetitive item is looked for in windows of the size of its set and of its text
    upper, whole_upper = (
        np.maximum(LEAST, 1 << np.ceil(np.log2(np.maximum(s, 1))).astype(int)) for s in (np.array([len(x) for x in sets]), np.array(size))
    )
    for u in np.union1d(upper[long], whole_upper[long]):
        mine = long[(upper[long] == u) | (whole_upper[long] == u)]
        sig = np.vstack([signatures(sets[i][None, :], np.ones((1, len(sets[i])), bool)) for i in mine])
        order = np.argsort(sig, axis=0, kind="stable")
        partitions.append(Partition(int(u), [mine[order[:, k]] for k in range(HASHES)], [sig[order[:, k], k] for k in range(HASHES)]))
    known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in long)]))
    bits = max(16, int(len(known)).bit_length() + 6)
    maybe = np.zeros(1 << bits, bool)
    maybe[known >> np.uint64(64 - bits)] = True
    short = {}
    for k in range(1, n):
        mine = np.flatnonzero(counts == k)
        if len(mine):
            h = np.array([whole[i] for i in mine], np.uint64)
            short[k] = (h[np.argsort(h, kind="stable")], mine[np.argsort(h, kind="stable")])
    return Index(np.array(ids), sets, partitions, known, maybe, 64 - bits, short)


def _same(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) with values[i] == known[j]; known is sorted."""
    low, high = np.searchsorted(known, values, "left"), np.searchsorted(known, values, "right")
    n = high - low
    i = np.repeat(np.arange(len(values)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + low[i]


def matches(data: np.ndarray, offsets: np.ndarray, ix: Index, n: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(text row, item number, shared shingles, item's shingles) for a block of texts."""
    w = words(data, offsets, lower=True)
    h = w.hashes()
    start = run_starts(w.first, n)
    s = runs(h, n)[start]
    size = np.maximum(w.counts - n + 1, 0)
    at = np.concatenate([[0], np.cumsum(size)])
    out = []
    hit = np.flatnonzero(ix.maybe[s >> np.uint64(ix.shift)])
    if len(hit) and len(ix.known):
        hit = hit[ix.known[np.minimum(np.searchsorted(ix.known, s[hit]), len(ix.known) - 1)] == s[hit]]
    if len(hit):
        text = np.searchsorted(at, hit, side="right") - 1
        found: set[tuple[int, int]] = set()
        for p in ix.partitions:
            b = (hit - at[text]) // p.upper
            key = np.unique(np.concatenate([np.stack([text, b], 1), np.stack([text, b - 1], 1)[b > 0]]), axis=0)
            step = max(1, WINDOWS * LEAST // p.upper)
            for lo in range(0, len(key), step):
                t, c = key[lo : lo + step].T
                cells = (at[t] + c * p.upper)[:, None] + np.arange(2 * p.upper)
                valid = cells < at[t + 1][:, None]
                sig = signatures(s[np.minimum(cells, len(s) - 1)], valid)
                for k in range(HASHES):
                    i, j = _same(sig[:, k], p.value[k])
                    found.update(zip(t[i].tolist(), p.item[k][j].tolist()))
        own: dict[int, np.ndarray] = {}
        for d, item in sorted(found):
            if d not in own:
                own[d] = np.unique(s[hit[text == d]])
            want = ix.sets[item]
            shared = int(np.isin(want, own[d], assume_unique=True).sum())
            if 100 * shared >= percent * len(want):
                out.append((d, item, shared, len(want)))
    for k, (values, item) in ix.short.items():
        begin = run_starts(w.first, k)
        i, j = _same(runs(h, k)[begin], values)
        text = np.searchsorted(w.first, begin[i], side="right") - 1
        out += [(d, m, 1, 1) for d, m in sorted(set(zip(text.tolist(), item[j].tolist())))]
    return out


def _item_blocks(items: DataFrame, id: str, text: str) -> Iterator[tuple[list[int], list[str | None]]]:
    ids, texts, size = [], [], 0
    for row in items.select(id, text).orderBy(id, text).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += (row[1] or "").count(" ") + 1
        if len(ids) >= ITEMS or size >= ITEM_WORDS:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) for each item that a document holds."""
    spark = docs.sparkSession

    def one(ids: list[int], texts: list[str | None]) -> DataFrame:
        shared = spark.sparkContext.broadcast(index(ids, texts, shingle))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                own = batch.column(0).to_pylist()
                got = [
                    (own[row + d], ix.ids[i], n, m)
                    for row, data, offsets in blocks(batch.column(1))
                    for d, i, n, m in matches(data, offsets, ix, shingle, percent)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[c] for g in got], pa.int64()) for c in range(4)],
                    ["doc_id", "item_id", "shared", "item_shingles"],
                )

        return docs.select(F.col(id).cast("long"), text).mapInArrow(task, "doc_id long, item_id long, shared long, item_shingles long")

    found = reduce(DataFrame.unionByName, (one(*block) for block in _item_blocks(items, item_id, item_text)))
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))
