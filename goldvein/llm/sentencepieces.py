"""SentencePiece encoding and decoding: Viterbi over a double-array trie of pieces.

The pieces of a vocabulary lie in a double-array trie over their UTF-8 bytes.  A text
is marked (a dummy space in front, every space as U+2581) and cut where no piece can
cross: before a run of markers, and around line breaks if no piece has one.  For each
part the sequence of pieces with the highest sum of log scores is found; a character
that no piece covers costs ten below the lowest score and becomes its bytes' pieces.
Parts are remembered within a task, up to `REMEMBERED` of them, so a common word is
searched once.  New parts of up to `NARROW` bytes are searched together, step by step
in numpy; longer ones one at a time.

A vocabulary made by merging has ranks instead of log scores.  These become Zipf's
law: log p = -log(rank + 2) less a constant.

Decoding joins the pieces' bytes, turns markers to spaces and drops the first one.
Bytes that are no UTF-8 become U+FFFD.  A text with a literal U+2581 decodes to one
with a space there; any other text comes back unchanged.

Edge cases: null texts have null ids and decode to null; empty texts have no ids.
Repeated rows are encoded alike.  Extra columns pass through; a column with the name of
one that is added is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_COST = 10.0
REMEMBERED = 300_000
NARROW = 64
TOGETHER = 20_000
SLICE = 1 << 20  # bytes of texts encoded at once


@dataclass
class Vocabulary:
    pieces: list[bytes]  # what each id decodes to, markers as spaces
    base: np.ndarray  # double array: child of node s by byte c is base[s] + c, if check there is s
    check: np.ndarray
    value: np.ndarray  # id of the piece that ends at a node, or -1
    score: np.ndarray  # by id
    byte_ids: list[int]  # id of each byte's piece, or the unknown piece's
    unknown: int
    longest: int
    parts: str  # pattern of the parts of a marked text


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie of sorted distinct keys; value is the key's place."""
    step = 1 << 14  # bases tried at once
    base, check, value = (np.full(8 * step, x, np.int32) for x in (0, -1, -1))
    check[0] = 0
    empty = check == -1
    free = 257  # so that a base of 1 or more reaches it by any byte
    todo = [(0, 0, len(keys), 0)]
    while todo:
        node, low, high, depth = todo.pop()
        if low < high and len(keys[low]) == depth:
            value[node] = low
            low += 1
        if low == high:
            continue
        codes, starts = [], []
        at = low
        while at < high:
            c = keys[at][depth]
            codes.append(c)
            starts.append(at)
            while at < high and keys[at][depth] == c:
                at += 1
        starts.append(high)
        while not empty[free]:
            free += 1
        b = free - codes[0]
        while True:
            if b + step + 512 > len(check):
                base, check, value = (np.concatenate([x, np.full(len(x), f, np.int32)]) for x, f in ((base, 0), (check, -1), (value, -1)))
                empty = check == -1
            wide = 1 if len(codes) == 1 else step
            fits = empty[b + codes[0] : b + codes[0] + wide].copy()
            for c in codes[1:]:
                fits &= empty[b + c : b + c + wide]
            if fits.any():
                b += int(fits.argmax())
                break
            b += wide
        base[node] = b
        for i, c in enumerate(codes):
            check[b + c] = node
            empty[b + c] = False
            todo.append((b + c, starts[i], starts[i + 1], depth + 1))
    return base, check, value


def vocabulary(pieces: Iterable[tuple[str, float, str]]) -> Vocabulary:
    """From (piece, score, kind) in order of ids; kind: normal, byte, control or unknown."""
    rows = list(pieces)
    kinds = [k for _, _, k in rows]
    normal = [i for i, k in enumerate(kinds) if k == "normal"]
    score = np.array([s for _, s, _ in rows], np.float64)
    ranks = [-score[i] for i in normal if score[i] > -1e6]
    if ranks and all(r >= 0 and r == int(r) for r in ranks):  # of merges, not log scores
        rank = np.clip(-score, 0, max(ranks) + 1)
        score = -np.log(rank + 2) - np.log(np.log(max(ranks) + 2) + 1)
    order = sorted(normal, key=lambda i: rows[i][0].encode())
    keys = [rows[i][0].encode() for i in order]
    base, check, value = double_array(keys)
    value[value >= 0] = np.array(order, np.int32)[value[value >= 0]]
    unknown = kinds.index("unknown") if "unknown" in kinds else -1
    byte_ids = [unknown] * 256
    decoded = []
    for i, (piece, _, kind) in enumerate(rows):
        if kind == "byte":
            byte_ids[int(piece[3:5], 16)] = i
        decoded.append(bytes([int(piece[3:5], 16)]) if kind == "byte" else piece.replace(MARK, " ").encode() if kind == "normal" else b"" if kind == "control" else " ⁇ ".encode())
    text = [rows[i][0] for i in normal]
    if any(re.search(f"[^{MARK}]{MARK}", t) for t in text):
        parts = "(?s).+"
    elif any("\n" in t for t in text):
        parts = f"(?s){MARK}*[^{MARK}]+|{MARK}+"
    else:
        parts = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n"
    low = score[normal].min() if normal else 0.0
    score = np.append(score, low - UNKNOWN_COST).astype(np.float32)  # last: of an uncovered character
    return Vocabulary(decoded, base, check, value, score, byte_ids, unknown, max(map(len, keys), default=1), parts)


def read_vocabulary(path: str) -> Vocabulary:
    """Reads the pieces of a model file; the library is used for nothing else."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if m.is_byte(i) else "control" if m.is_control(i) or m.is_unused(i) else "unknown" if m.is_unknown(i) else "normal"
    return vocabulary((m.id_to_piece(i), m.get_score(i), kind(i)) for i in range(m.get_piece_size()))


def _width(lead: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts with each byte."""
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


def best_of_many(parts: list[bytes], v: Vocabulary) -> list[list[int]]:
    """Best pieces of short parts, all searched in step."""
    rows = len(parts)
    size = np.fromiter(map(len, parts), np.int64, rows)
    wide = int(size.max())
    text = np.zeros((rows, wide + 4), np.uint8)
    text[np.arange(wide + 4) < size[:, None]] = np.frombuffer(b"".join(parts), np.uint8)
    best = np.full((rows, wide + 5), -np.inf, np.float32)
    best[:, 0] = 0
    came = np.full((rows, wide + 5), -1, np.int32)
    piece = np.full((rows, wide + 5), -1, np.int32)
    lost = len(v.score) - 1
    for p in range(wide):
        row = np.flatnonzero((size > p) & (best[:, p] > -np.inf))
        if not len(row):
            continue
        here = best[row, p]
        single = np.zeros(len(row), bool)
        char = _width(text[row, p])
        live, node = np.arange(len(row)), np.zeros(len(row), np.int64)
        for k in range(min(v.longest, wide - p)):
            to = v.base[node] + text[row[live], p + k].astype(np.int64)
            ok = (p + k < size[row[live]]) & (v.check[to] == node)
            live, node = live[ok], to[ok]
            if not len(live):
                break
            got = v.value[node]
            ends = got >= 0
            if ends.any():
                who, ids = live[ends], got[ends]
                single[who[char[who] == k + 1]] = True
                total = here[who] + v.score[ids]
                better = total > best[row[who], p + k + 1]
                r = row[who[better]]
                best[r, p + k + 1], came[r, p + k + 1], piece[r, p + k + 1] = total[better], p, ids[better]
        bare = np.flatnonzero(~single)
        if len(bare):
            total, to = here[bare] + v.score[lost], p + char[bare]
            better = total > best[row[bare], to]
            r, to = row[bare[better]], to[better]
            best[r, to], came[r, to], piece[r, to] = total[better], p, lost
    out: list[list[int]] = []
    came_rows, piece_rows = came.tolist(), piece.tolist()
    for part, n, c, g in zip(parts, size.tolist(), came_rows, piece_rows):
        ids: list[int] = []
        while n:
            if g[n] == lost:
                ids += [v.byte_ids[b] for b in reversed(part[c[n] : n])]
            else:
                ids.append(g[n])
            n = c[n]
        out.append(ids[::-1])
    return out


def best_of_one(part: bytes, v: Vocabulary) -> list[int]:
    """Best pieces of one part of any length."""
    base, check, value = v.base, v.check, v.value
    n, lost = len(part), len(v.score) - 1
    best: list[np.float32 | None] = [None] * (n + 5)
    came, piece = [0] * (n + 5), [0] * (n + 5)
    best[0] = np.float32(0)
    for p in range(n):
        here = best[p]
        if here is None:
            continue
        c = part[p]
        char = 1 + (c >= 0xC0) + (c >= 0xE0) + (c >= 0xF0)
        node, single = 0, False
        for k in range(p, min(n, p + v.longest)):
            to = int(base[node]) + part[k]
            if check[to] != node:
                break
            node = to
            if (got := int(value[node])) >= 0:
                single |= k + 1 - p == char
                total = here + v.score[got]
                if best[k + 1] is None or total > best[k + 1]:
                    best[k + 1], came[k + 1], piece[k + 1] = total, p, got
        if not single:
            total, to = here + v.score[lost], p + char
            if best[to] is None or total > best[to]:
                best[to], came[to], piece[to] = total, p, lost
    ids: list[int] = []
    while n:
        ids += [v.byte_ids[b] for b in reversed(part[came[n] : n])] if piece[n] == lost else [piece[n]]
        n = came[n]
    return ids[::-1]


class Encoder:
    """Encodes texts; keeps the ids of parts seen before."""

    def __init__(self, v: Vocabulary):
        self.v, self.seen, self.find = v, {}, re.compile(v.parts).findall

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        parts = [self.find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.seen) > REMEMBERED:
            for p in list(islice(self.seen, len(self.seen) // 2)):  # the older half
                del self.seen[p]
        new = list({p for own in parts for p in own}.difference(self.seen))
        narrow = [p for p in new if len(p) <= NARROW and len(p.encode()) <= NARROW]
        for lo in range(0, len(narrow), TOGETHER):
            some = narrow[lo : lo + TOGETHER]
            for p, ids in zip(some, best_of_many([p.encode() for p in some], self.v)):
                self.seen[p] = np.array(ids, np.int32).tobytes()
        for p in set(new).difference(narrow):
            self.seen[p] = np.array(best_of_one(p.encode(), self.v), np.int32).tobytes()
        get = self.seen.__getitem__
        return [None if t is None else np.frombuffer(b"".join(map(get, own)), np.int32) for t, own in zip(texts, parts)]


def decode_ids(ids: Iterable[int], v: Vocabulary) -> str:
    return b"".join(map(v.pieces.__getitem__, ids)).decode(errors="replace").removeprefix(" ")


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows of about `SLICE` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
        yield start, stop - start
        start, done = stop, int(ends[stop - 1])


_ENCODED = ("piece_ids", "n_byte_pieces")


def _with_pieces(docs: DataFrame, v: Vocabulary, text: str, back: bool) -> DataFrame:
    """Piece ids and, if asked for, the text they decode to, slice by slice in one pass."""
    added = (*_ENCODED, "decoded") if back else _ENCODED
    docs = docs.drop(*added)
    names, shared = docs.columns, docs.sparkSession.sparkContext.broadcast(v)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        encoder = Encoder(v)
        is_byte = np.zeros(len(v.pieces) + 1, bool)
        is_byte[[i for i in v.byte_ids if i >= 0]] = True
        for batch in batches:
            column = batch.column(names.index(text))
            for start, size in _slices(column):
                ids = encoder.encode(column.slice(start, size).to_pylist())
                sizes = np.array([0 if x is None else len(x) for x in ids])
                flat = np.concatenate([np.zeros(0, np.int32), *(x for x in ids if x is not None)])
                at = np.concatenate([[0], np.cumsum(sizes)])
                none = pa.array([x is None for x in ids], pa.bool_())
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat), mask=none)
                fallen = np.concatenate([[0], np.cumsum(is_byte[flat])])
                new = [lists, pa.array(fallen[at[1:]] - fallen[at[:-1]])]
                if back:
                    texts = _decoded(flat, at, v)
                    new.append(pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, size).columns, *new], [*names, *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(task, schema + ", piece_ids array<int>, n_byte_pieces long" + (", decoded string" if back else ""))


def _decoded(flat: np.ndarray, at: np.ndarray, v: Vocabulary) -> list[str]:
    ids = flat.tolist()
    return [decode_ids(ids[a:b], v) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def encode(docs: DataFrame, v: Vocabulary, text: str = "text") -> DataFrame:
    """Adds piece_ids and n_byte_pieces; no shuffle."""
    return _with_pieces(docs, v, text, back=False)


def decode(docs: DataFrame, v: Vocabulary, ids: str = "piece_ids") -> DataFrame:
    """Adds decoded; no shuffle."""
    docs = docs.drop("decoded")
    names, shared = docs.columns, docs.sparkSession.sparkContext.broadcast(v)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(ids))
            at = column.offsets.to_numpy()
            texts = _decoded(column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], at - at[0], shared.value)
            got = [t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(task, schema + ", decoded string")


def round_trip(docs: DataFrame, v: Vocabulary, text: str = "text") -> DataFrame:
    """Encodes and decodes: adds piece_ids, n_byte_pieces and decoded."""
    return _with_pieces(docs, v, text, back=True)


def piece_count(ids: str = "piece_ids"):
    return F.coalesce(F.size(F.col(ids)), F.lit(0))
