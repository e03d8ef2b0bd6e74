"""Removal of repeated byte strings, by a distributed merge sort of suffixes.

A byte goes if a string of `length` bytes that covers it also starts in a text with a
smaller id.  Sorting every suffix would move each byte many times, so suffixes start
at anchors only: of every `length` bytes in a row, the position whose next `gram` bytes
hash lowest.  Equal strings have equal anchors, so each repeat is seen at one.

1. Anchors' hashes meet by part; those found in one text only are done with.  A task
   sends each hash of a batch once, so a string that is everywhere is one entry a batch.
2. At the other anchors each task takes the suffix, up to `length` bytes, and the bytes
   before it.  Of equal ones in a batch only that of the smallest id goes on.  Suffixes
   are sorted and front-coded: each run stores the length of the prefix shared with the
   entry before it, and the bytes that follow.
3. Runs meet by part and are merged with a loser tree that keeps, for each run, the
   prefix shared with the last winner.  Two heads are told apart by these lengths
   alone, or, if they are equal, by the bytes behind them; known prefixes are never
   compared again.  The merge gives the order and the shared prefix of neighbours.
4. For each number of bytes before the anchor, entries that share those bytes and
   enough of the suffix are a group of equal strings; all but those of the group's
   smallest id are repeats.
5. Repeats are joined with the texts by id.  Both joins with the texts use the same
   exchange of the texts, so they are shuffled once.

Edge cases: null and empty texts, and texts shorter than `length`, keep all bytes.
Rows with a null id come after all others.  Rows with the same id are one text: they do
not repeat each other, and spans found in any are removed from each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.debruijn import LAST, _sliding_min, by_part, pack, unpack
from goldvein.llm.hashing import blocks, mix, run_starts

LENGTH = 50
GRAM = 16
PART_BYTES = 1 << 20  # of text for each part of anchors
_STEP = np.uint64(0x9E3779B97F4A7C15)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text row, place in the text, hash) of each anchor of a block."""
    start = run_starts(offsets, length)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none, none.view(np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))
    n = len(data) - gram + 1
    h = eight[:n].copy()
    for o in range(8, gram - 7, 8):
        h = mix(h) + eight[o : o + n] * _STEP
    if gram % 8:
        h = mix(h) + eight[gram - 8 : gram - 8 + n] * _STEP
    h = mix(h)
    place = np.uint64(max(1, int(n).bit_length()))
    ranked = (h >> place << place) | np.arange(n, dtype=np.uint64)
    least = _sliding_min(ranked, length - gram + 1)[start] & ((np.uint64(1) << place) - np.uint64(1))
    at = least[np.append(True, least[1:] != least[:-1])].astype(np.int64)
    text = np.searchsorted(offsets, at, side="right") - 1
    return text, at - offsets[text], h[at]


def _firsts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.append(True, sorted_keys[1:] != sorted_keys[:-1])[: len(sorted_keys)]


def anchor_parts(docs: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """Step 1, map side: (part, known, hash, doc, place); known rows are repeated inside a batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [(text + row, at, h) for row, data, offsets in blocks(batch.column(1)) for text, at, h in [anchors(data, offsets, length, gram)]]
            if not found:
                continue
            text, at, h = (np.concatenate(x) for x in zip(*found))
            doc = ids[text]
            order = np.lexsort((at, doc, h))
            doc, at, h = doc[order], at[order], h[order]
            new = _firsts(h)
            begin = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            last = np.append(begin[1:], len(h)) - 1
            many = (doc[begin] != doc[last])[group] if len(h) else new
            send = np.flatnonzero(new | ((doc == doc[begin][group]) & ~many)) if len(h) else begin
            out = []
            for known, rows in ((True, np.flatnonzero(many)), (False, send)):
                # what is known already meets nothing, so it goes to one part together
                part = np.full(len(rows), int(h[0]) % parts if len(h) else 0, np.uint64) if known else h[rows] % np.uint64(parts)
                order = np.lexsort((at[rows], doc[rows], part))
                rows, part = rows[order], part[order]
                edge = np.append(np.flatnonzero(_firsts(part)), len(part))
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    r = rows[a:b]
                    out.append((int(part[a]), known, None if known else pack(h[r]), pack(np.diff(doc[r], prepend=0)), pack(at[r].astype(np.int32))))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()))],
                    ["part", "known", "hash", "doc", "place"],
                )

    return docs.mapInArrow(task, "part long, known boolean, hash binary, doc binary, place binary")


def shared_anchors(found: DataFrame) -> DataFrame:
    """Step 1, after the exchange: (doc, place) of anchors whose hash is in several texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_part(batches):
            doc = [np.cumsum(unpack(r["doc"], np.int64)) for r in rows]
            place = [unpack(r["place"], np.int32) for r in rows]
            known = np.repeat([r["known"] for r in rows], [len(x) for x in doc])
            h = np.concatenate([np.zeros(len(d), np.uint64) if r["known"] else unpack(r["hash"], np.uint64) for r, d in zip(rows, doc)])
            doc, place = np.concatenate(doc), np.concatenate(place)
            ask = np.flatnonzero(~known)
            ask = ask[np.lexsort((doc[ask], h[ask]))]
            new = _firsts(h[ask])
            begin = np.flatnonzero(new)
            many = np.zeros(len(ask), bool)
            if len(ask):
                last = np.append(begin[1:], len(ask)) - 1
                many = (doc[ask[begin]] != doc[ask[last]])[np.cumsum(new) - 1]
            take = np.concatenate([np.flatnonzero(known), ask[many]])
            yield pa.RecordBatch.from_arrays([pa.array(doc[take]), pa.array(place[take])], ["doc", "place"])

    return found.repartition("part").sortWithinPartitions("part").mapInArrow(task, "doc long, place int")


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian numbers, for sorting."""
    wide = -rows.shape[1] % 8
    return np.ascontiguousarray(np.pad(rows, ((0, 0), (0, wide)))).view(">u8").astype(np.uint64)


def _shared(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before it."""
    out = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def suffix_runs(texts: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """Step 2, of rows (doc, id, text, places): front-coded sorted runs by part, and repeats known already."""
    left_most = length - gram

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            places = batch.column(3)
            right, left, doc, at, size, ahead = [], [], [], [], [], []
            for row, data, offsets in blocks(batch.column(2)):
                own = [places[row + i] for i in range(len(offsets) - 1)]
                n = [len(x) if x.is_valid else 0 for x in own]
                if not sum(n):
                    continue
                p = np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in own if x.is_valid and len(x)]).astype(np.int64)
                t = np.repeat(np.arange(len(own)), n)
                padded = np.concatenate([np.zeros(left_most, np.uint8), data, np.zeros(length, np.uint8)])
                view = np.lib.stride_tricks.sliding_window_view(padded, left_most + length)
                both = view[offsets[t] + p].copy()
                s, b = np.minimum(length, np.diff(offsets)[t] - p), np.minimum(left_most, p)
                both[:, left_most:][np.arange(length) >= s[:, None]] = 0
                both[:, :left_most][np.arange(left_most) < left_most - b[:, None]] = 0
                right.append(both[:, left_most:])
                left.append(both[:, :left_most])
                doc.append(ids[row + t])
                at.append(p)
                size.append(s)
                ahead.append(b)
            if not right:
                continue
            right, left = np.concatenate(right), np.concatenate(left)
            doc, at, size, ahead = (np.concatenate(x) for x in (doc, at, size, ahead))
            part = mix(_words(right[:, :gram])[:, 0] ^ mix(_words(right[:, :gram])[:, -1])) % np.uint64(parts)
            before = np.zeros(len(left), np.uint64)
            for word in _words(left).T:
                before = mix(before + word * _STEP)
            keys = [at, doc, size << 8 | ahead, before, *_words(right).T[::-1], part]
            order = np.lexsort(keys)
            right, left, doc, at, size, ahead, part = (x[order] for x in (right, left, doc, at, size, ahead, part))
            same = np.zeros(len(doc), bool)
            same[1:] = (part[1:] == part[:-1]) & (size[1:] == size[:-1]) & (ahead[1:] == ahead[:-1])
            same[1:] &= (right[1:] == right[:-1]).all(axis=1) & (left[1:] == left[:-1]).all(axis=1)
            origin = np.flatnonzero(~same)[np.cumsum(~same) - 1]
            later = doc > doc[origin]
            again = np.flatnonzero(later & (size + ahead >= length))
            # a repeat of the batch goes by its own text, an entry of its own by part
            send = np.flatnonzero(~same | ~later)
            out, small = [], zstandard.ZstdCompressor().compress
            edge = np.append(np.flatnonzero(_firsts(part[send])), len(send))
            shared = _shared(right[send])
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                r = send[a:b]
                lcp = shared[a:b].copy()
                lcp[0] = 0
                rest = right[r][np.arange(length) >= lcp[:, None]].tobytes()
                out.append((int(part[r[0]]), lcp.tobytes(), small(rest), small(left[r].tobytes()), pack(doc[r]), pack(at[r].astype(np.int32)), size[r].astype(np.uint8).tobytes(), ahead[r].astype(np.uint8).tobytes()))
            begin, end = _merged(doc[again], at[again] - ahead[again], at[again] + size[again])
            if len(begin):
                # they meet nothing in a part, so one row takes them all along
                out.append((int(part[0]), None, None, None, pack(begin[:, 0].copy()), pack(begin[:, 1].astype(np.int32)), pack(end.astype(np.int32)), None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), *[pa.binary()] * 7))],
                ["part", "lcp", "rest", "left", "doc", "place", "size", "ahead"],
            )

    schema = "part long, lcp binary, rest binary, left binary, doc binary, place binary, size binary, ahead binary"
    return texts.mapInArrow(task, schema)


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals within each text: rows (doc, start), and ends."""
    if not len(doc):
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    first = _firsts(doc)
    base = np.cumsum(first) << 32  # a later text is beyond all ends of an earlier one
    top = np.maximum.accumulate(base + end)
    new = first.copy()
    new[1:] |= base[1:] + start[1:] > top[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(doc)) - 1
    return np.stack([doc[begin], start[begin]], axis=1), top[last] - base[last]


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merges sorted runs of equally long strings: order as (run, place), and prefix shared with the one before.

    A run is its strings and the prefix each shares with the one before it.  Every node of the
    tree holds the run that lost there and the prefix it shares with the winner.
    """
    k = 1 << max(0, (len(runs) - 1).bit_length())
    wide = len(runs[0][0][0])
    head = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    at = [0] * k
    lcp = [0] * k  # with the last string put out
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one shared with the winner."""
        x, y = head[a], head[b]
        if x is None:
            return b, a
        if y is None or lcp[a] > lcp[b]:
            return a, b
        if lcp[b] > lcp[a]:
            return b, a
        known = lcp[a]
        x, y = x[known:], y[known:]
        if x == y:
            lcp[b] = wide
            return a, b
        bits = 8 * len(x)
        same = known + (bits - (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length()) // 8
        if x < y:
            lcp[b] = same
            return a, b
        lcp[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    order, shared = [], []
    while head[winner] is not None:
        order.append((winner, at[winner]))
        shared.append(lcp[winner])
        strings, prefixes = runs[winner]
        at[winner] += 1
        if at[winner] < len(strings):
            head[winner], lcp[winner] = strings[at[winner]], prefixes[at[winner]]
        else:
            head[winner] = None
        node = (winner + k) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1
    return order, shared


def repeats(found: DataFrame, length: int, gram: int) -> DataFrame:
    """Steps 3 and 4: (doc, start, end), the bytes of repeated strings."""
    left_most, large = length - gram, zstandard.decompress

    def strings(r: dict) -> tuple[list[bytes], list[int]]:
        lcp = list(r["lcp"])
        rest, out, before, p = large(r["rest"]), [], b"", 0
        for n in lcp:
            before = before[:n] + rest[p : p + length - n]
            p += length - n
            out.append(before)
        return out, lcp

    def of_part(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        runs = [strings(r) for r in rows]
        order, shared = merge_runs(runs)
        base = np.concatenate([[0], np.cumsum([len(r[0]) for r in runs])])
        o = np.array([base[r] + i for r, i in order])
        lcp = np.array(shared)
        lcp[0] = 0
        near = np.maximum(lcp, np.append(lcp[1:], 0)) >= gram
        left = np.frombuffer(b"".join(large(r["left"]) for r in rows), np.uint8).reshape(-1, left_most)[o]
        doc, place = (np.concatenate([unpack(r[c], t) for r in rows])[o] for c, t in (("doc", np.int64), ("place", np.int32)))
        size, ahead = (np.concatenate([np.frombuffer(r[c], np.uint8) for r in rows])[o].astype(np.int64) for c in ("size", "ahead"))
        before = np.zeros(len(o), np.uint64)
        least_b, most_b = np.full(len(o), length), np.full(len(o), -1)
        for b in range(left_most + 1):
            if b:
                before = mix(before + left[:, left_most - b].astype(np.uint64) + np.uint64(1))
            group = np.cumsum(lcp < length - b)
            may = np.flatnonzero(near & (size >= length - b) & (ahead >= b))
            if len(may) < 2:
                continue
            key = mix(before[may] + group[may].astype(np.uint64) * _STEP)
            order = np.argsort(key)
            may = may[order]
            new = _firsts(key[order])
            least = np.minimum.reduceat(doc[may], np.flatnonzero(new))[np.cumsum(new) - 1]
            hit = may[doc[may] > least]
            least_b[hit] = np.minimum(least_b[hit], b)
            most_b[hit] = b
        # strings around one anchor overlap, so they are one stretch
        hit = np.flatnonzero(most_b >= 0)
        return doc[hit], place[hit] - most_b[hit], place[hit] - least_b[hit] + length

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_part(batches):
            known = [r for r in rows if r["lcp"] is None]
            rows = [r for r in rows if r["lcp"] is not None]
            pieces = [(unpack(r["doc"], np.int64), unpack(r["place"], np.int32), unpack(r["size"], np.int32)) for r in known]
            if sum(len(r["lcp"]) for r in rows) > 1:
                pieces.append(of_part(rows))
            if not pieces:
                continue
            begin, end = _merged(*(np.concatenate(x).astype(np.int64) for x in zip(*pieces)))
            yield pa.RecordBatch.from_arrays([pa.array(begin[:, 0]), pa.array(begin[:, 1].astype(np.int32)), pa.array(end.astype(np.int32))], ["doc", "start", "end"])

    return found.repartition("part").sortWithinPartitions("part").mapInArrow(task, "doc long, start int, end int")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for each row; kept are the remaining bytes."""
    gram = min(gram, length - 1)
    if gram < 8:
        raise ValueError("length must be 9 or more, gram 8 or more")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    own = F.coalesce(F.col(id).cast("long"), F.lit(LAST))
    plain = docs.select(own.alias("doc"), F.col(id).alias("id"), F.col(text).alias("text"))
    shared = shared_anchors(anchor_parts(plain.select("doc", "text"), length, gram, parts))
    places = shared.groupBy("doc").agg(F.collect_list("place").alias("places"))
    # with the same columns and join as below, so that Spark shuffles the texts once
    at = plain.join(places, "doc", "left").select("doc", "id", "text", "places")
    found = repeats(suffix_runs(at, length, gram, parts), length, gram)
    spans = found.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = plain.join(spans, "doc", "left").select("doc", "id", "text", "spans")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, count, kept = [], [], [], []
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for raw, spans in zip(texts, batch.column(3).to_pylist()):
                raw, left, done, n, runs = raw or b"", [], 0, 0, 0
                for s in spans or ():
                    if s["start"] > done or not runs:
                        left.append(raw[done : s["start"]])
                        runs += 1
                        done = s["start"]
                    n += max(0, s["end"] - done)
                    done = max(done, s["end"])
                left.append(raw[done:])
                size.append(len(raw))
                gone.append(n)
                count.append(runs)
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = dict(docs.dtypes)[id]
    done = joined.mapInArrow(task, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.withColumnRenamed("id", id)
