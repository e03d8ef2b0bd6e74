"""Removal of repeated word spans, by a de Bruijn graph of word k-mers.

Every run of `window` words is a k-mer: an edge between its first and its last
window - 1 words.  Equal edges must meet, so each edge belongs to the smallest of the
shorter runs inside it (its minimizer), and the edges of one text that share a
minimizer in a row travel as one piece.  Pieces, not words, are shuffled.

1. A task finds the pieces of its texts.  Of equal pieces in a batch only the first
   (smallest id, then start) is sent on; the others are known to be repeats of it.
   A passage copied into very many texts is thus one row for each batch.
   What a batch has for a part of the minimizers is one row.
2. Pieces meet by minimizer, part by part.  Each edge's first occurrence is its source coordinate,
   and every other occurrence becomes a repeated edge with that source.
3. Repeated edges are compacted to nonbranching paths: a piece is joined with the
   piece that starts where it ends, as long as both continue one source path.  The
   join is on (text, coordinate), done as a sorted window over each text's pieces;
   a path ends where the source branches off to another text or coordinate.
4. Paths are joined with the texts by id, and the words they cover are removed.

An edge is compared by the 64-bit hash of all its words and 32 bits of its minimizer,
so edges of one minimizer, however common, are told apart by 64 bits: ten million
different ones have a false match with a chance of about 3e-6.

Edge cases: null or empty texts, and texts shorter than the window, keep all words.
Rows with a null id come after all others.  Rows with the same id are one text: spans
found in any of them are removed from each.  Results do not depend on row order.  Extra
columns pass through; a column with the name of one that is added is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.llm.hashing import blocks, mix, run_starts, runs, words

WINDOW = 20
MINIMIZER = 8
LAST = (1 << 63) - 1  # stands for a null id

# A row holds the pieces of a batch that go to one part: `head` has their minimizers, texts, starts
# and numbers of edges, `edges` the hashes of all their edges.  Without `edges` it holds repeats
# that are known already, and `head` has the columns of _REPEATS.
_PIECES = pa.schema([("part", pa.int32()), ("head", pa.binary()), ("edges", pa.binary())])
_HEAD = (np.int32, np.int64, np.int32, np.int32)
_KNOWN = (np.int64, np.int32, np.int32, np.int64, np.int32)
_SENT_EDGES = 1 << 18  # of pieces that are sent at a time
_KNOWN_ROWS = 4096  # of known repeats at most that travel as one
PART_BYTES = 1 << 20  # of text for each part of minimizers
_REPEATS = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("src", pa.int64()), ("src_start", pa.int32())])


def pack(x: np.ndarray) -> bytes:
    """Numbers by byte planes, which a shuffle's compression shrinks well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unpack(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each part; batches come sorted by it."""
    rows: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and rows[0]["part"] != r["part"]:
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


def _columns(raw: bytes, kinds: tuple[type, ...]) -> list[np.ndarray]:
    """Packed columns that lie one after the other."""
    raw = zstandard.decompress(raw)
    width = [np.dtype(k).itemsize for k in kinds]
    n, ends = len(raw) // sum(width), np.cumsum(width)
    return [unpack(raw[n * (end - w) : n * end], k) for k, w, end in zip(kinds, width, ends.tolist())]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def _pieces(data: np.ndarray, offsets: np.ndarray, window: int, small: int) -> dict[str, np.ndarray] | None:
    """Pieces of a block of texts: text row, start word, number of edges, minimizer, content, edge hashes."""
    w = words(data, offsets)
    at = run_starts(w.first, window)
    if not len(at):
        return None
    h = w.hashes()
    g = runs(h, small)
    place = np.uint64(max(1, int(len(g)).bit_length()))
    ranked = (g >> place << place) | np.arange(len(g), dtype=np.uint64)
    least = (_sliding_min(ranked, window - small + 1)[at] & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    edge = runs(h, window)[at]
    text = w.texts()[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(at)))
    content = mix(edge[begin] + mix(edge[begin + n - 1] + n.astype(np.uint64)))
    return {
        "text": text[begin], "start": at[begin] - w.first[text[begin]], "n": n,
        "key": (mix(g[least[begin]]) >> np.uint64(32)).astype(np.uint32).view(np.int32), "content": content, "edge": edge,
    }


def _joined_runs(doc, start, n, src, src_start, text) -> pa.RecordBatch:
    """Joins repeats that go on where the one before ended, in one text and from one source."""
    go_on = np.zeros(len(doc), bool)
    go_on[1:] = (text[1:] == text[:-1]) & (src[1:] == src[:-1]) & (start[1:] == start[:-1] + n[:-1]) & (src_start[1:] - start[1:] == src_start[:-1] - start[:-1])
    head = np.flatnonzero(~go_on)
    total = np.add.reduceat(n, head) if len(head) else n
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(t)) for x, t in ((doc[head], np.int64), (start[head], np.int32), (total, np.int32), (src[head], np.int64), (src_start[head], np.int32))],
        schema=_REPEATS,
    )


def pieces(docs: DataFrame, window: int, small: int, parts: int) -> DataFrame:
    """Step 1, of rows (doc, text): first pieces with their edges, later ones as repeats without."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = []
            for row, data, offsets in blocks(batch.column(1)):
                if got := _pieces(data, offsets, window, small):
                    got["text"] = got["text"] + row
                    found.append(got)
            if not found:
                continue
            p = {k: np.concatenate([x.pop(k) for x in found]) for k in list(found[0])}
            doc = ids[p["text"]]
            order = np.lexsort((p["start"], doc, p["content"]))
            c = p["content"][order]
            fresh = np.append(True, c[1:] != c[:-1])
            origin = np.empty(len(order), np.int64)
            origin[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            first = origin == np.arange(len(origin))
            keep = np.flatnonzero(first)
            ahead = np.cumsum(p["n"]) - p["n"]
            yield from _packed(p["key"][keep], doc[keep], p["start"][keep], p["n"][keep], ahead[keep], p["edge"], parts)
            same = (doc[origin] == doc) & (p["start"][origin] == p["start"])
            rest = np.flatnonzero(~first & ~same)
            far = origin[rest]
            r = _joined_runs(doc[rest], p["start"][rest], p["n"][rest], doc[far], p["start"][far], p["text"][rest])
            yield _packed_known([c.to_numpy() for c in r.columns], parts)

    return docs.mapInArrow(task, "part int, head binary, edges binary")


def _packed(key: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray, ahead: np.ndarray, edge: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """One row for each part; a piece's edges are the n after those ahead of it."""
    part = (key.view(np.uint32).astype(np.uint64) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    key, doc, start, n, ahead, part = (x[order] for x in (key, doc, start, n, ahead, part))
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    # some parts at a time, so that edges are copied and sent a little at a time
    turn = (np.cumsum(n) - n)[begin] // _SENT_EDGES
    small = zstandard.ZstdCompressor().compress
    for some in np.split(np.arange(len(begin)), np.flatnonzero(turn[1:] != turn[:-1]) + 1):
        at = [*begin[some].tolist(), int(begin[some[-1] + 1]) if some[-1] + 1 < len(begin) else len(part)]
        of = slice(at[0], at[-1])
        ends = np.cumsum(n[of])
        sent = edge[np.repeat(ahead[of] - (ends - n[of]), n[of]) + np.arange(ends[-1])]
        ends = np.append(0, ends)
        heads, edges = [], []
        for a, b in zip(at, at[1:]):
            heads.append(small(b"".join(pack(x[a:b].astype(k)) for x, k in zip((key, doc, start, n), _HEAD))))
            edges.append(sent[ends[a - at[0]] : ends[b - at[0]]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(part[at[:-1]]), pa.array(heads, pa.binary()), pa.array(edges, pa.binary())], schema=_PIECES)


def _packed_known(columns: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """Repeats that meet nothing in a part, so each row of them goes to any."""
    small, rows = zstandard.ZstdCompressor().compress, []
    for a in range(0, len(columns[0]), _KNOWN_ROWS):
        doc, start = (c[a : a + 1].astype(np.uint64) for c in columns[:2])
        head = b"".join(pack(c[a : a + _KNOWN_ROWS].astype(k)) for c, k in zip(columns, _KNOWN))
        rows.append((int(mix(doc + start)[0] % np.uint64(parts)), small(head), None))
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else ([], [], []), _PIECES)], schema=_PIECES)


def _known_of(rows: list[dict]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*(_columns(r["head"], _KNOWN) for r in rows))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_REPEATS)


def _repeated(rows: list[dict]) -> pa.RecordBatch:
    """Repeated edges of the pieces of a part."""
    key, doc, start, n = (np.concatenate(x) for x in zip(*(_columns(r["head"], _HEAD) for r in rows)))
    edge = np.frombuffer(b"".join(r["edges"] for r in rows), np.uint64)
    _, same, often = np.unique(key, return_inverse=True, return_counts=True)
    use = often[same] > 1
    edge = edge[np.repeat(use, n)]
    key, doc, start, n = key[use], doc[use], start[use].astype(np.int64), n[use].astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    doc, start = doc[row], start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    order = np.lexsort((start, doc, edge, key[row]))
    e, k = edge[order], key[row][order]
    fresh = np.append(True, (e[1:] != e[:-1]) | (k[1:] != k[:-1])) if len(e) else np.zeros(0, bool)
    origin = np.empty(len(order), np.int64)
    origin[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(e) else order
    later = np.flatnonzero((doc[origin] != doc) | (start[origin] != start))
    far = origin[later]
    return _joined_runs(doc[later], start[later], np.ones(len(later), np.int64), doc[far], start[far], row[later])


def repeats(found: DataFrame) -> DataFrame:
    """Step 2: (doc, start, n, src, src_start), n repeated edges in a row from start on."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_part(batches):
            known = [r for r in rows if r["edges"] is None]
            if known:
                yield _known_of(known)
            if len(known) < len(rows):
                yield _repeated([r for r in rows if r["edges"] is not None])

    rows = found.repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(task, "doc long, start int, n int, src long, src_start int")


def paths(repeated: DataFrame) -> DataFrame:
    """Step 3: nonbranching paths, each (doc, start, n, src, src_start)."""
    by_place = Window.partitionBy("doc").orderBy("start", "n", "src", "src_start")
    goes_on = (
        (F.col("src") == F.lag("src").over(by_place))
        & (F.col("src_start") - F.col("start") == F.lag(F.col("src_start") - F.col("start")).over(by_place))
        & (F.col("start") <= F.lag(F.col("start") + F.col("n")).over(by_place))
    )
    marked = repeated.withColumn("head", F.when(goes_on, 0).otherwise(1))
    return (
        marked.withColumn("path", F.sum("head").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "path")
        .agg(F.min("start").alias("start"), (F.max(F.col("start") + F.col("n")) - F.min("start")).alias("n"), F.first("src").alias("src"), F.min("src_start").alias("src_start"))
        .drop("path")
    )


@F.arrow_udf(T.BinaryType())
def _small_texts(column: pa.Array) -> pa.Array:
    """Texts as they travel: prose takes some two thirds of what a shuffle's compression makes of it."""
    small = zstandard.ZstdCompressor().compress
    return pa.array([None if raw is None else small(raw) for raw in column.cast(pa.binary()).to_pylist()], pa.binary())


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, small: int = MINIMIZER
) -> DataFrame:
    """Adds kept_text, n_words and n_removed, and `spans` of removed words with their source.

    A word goes if a window that covers it also starts earlier: in a row with a
    smaller id, or before in the same text.
    """
    docs = docs.drop("spans", "kept_text", "n_words", "n_removed", "_doc")
    own = F.coalesce(F.col(id).cast("long"), F.lit(LAST))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    found = pieces(docs.select(own.alias("doc"), F.col(text).alias("text")), window, min(small, window), parts)
    spans = (
        paths(repeats(found))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("start"), (F.col("start") + F.col("n") + window - 1).alias("end"), "src", "src_start"))).alias("spans"))
    )
    fields, at = docs.columns, docs.columns.index(text)
    kind = docs.schema[text].dataType.simpleString()
    sent = docs.withColumns({"_doc": own, text: _small_texts(F.col(text))})
    joined = sent.join(spans.withColumnRenamed("doc", "_doc"), "_doc", "left").select(*[F.col(f"`{c}`") for c in fields], "spans")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [raw and zstandard.decompress(raw) for raw in batch.column(at).to_pylist()]
            whole = pa.array(texts, pa.binary())
            columns = batch.columns[:at] + [whole if kind == "binary" else whole.cast(pa.string())] + batch.columns[at + 1 :]
            kept, count, gone = [], [], []
            for raw, found in zip(texts, batch.column(len(fields)).to_pylist()):
                w = (raw or b"").split()
                count.append(len(w))
                done, left = 0, []
                for s in found or ():
                    left += w[done : s["start"]] if s["start"] > done else []
                    done = max(done, s["end"])
                left += w[done:]
                gone.append(len(w) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.string()), pa.array(count, pa.int64()), pa.array(gone, pa.int64())],
                [*fields, "spans", "kept_text", "n_words", "n_removed"],
            )

    schema = ", ".join(f"`{f.name}` {kind if f.name == text else f.dataType.simpleString()}" for f in joined.schema)
    return joined.mapInArrow(task, schema + ", kept_text string, n_words long, n_removed long")
