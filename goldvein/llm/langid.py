"""Language labels by word: script ranges, then Viterbi with a switching penalty.

Training counts, for each language, hashed runs of four code points inside words
(word edges included), and how many letters of each script its texts hold.  A word's
score for a language is the sum of the log shares of its runs.  The script of a word
narrows the languages that may label it to those trained with that script.  Viterbi
over the words of a text then finds the labels of highest total score, where each
change of language costs `penalty`; equal labels in a row are a span.

Edge cases: a text that is null or has no letter is `und` with score 0.  A word
without letters scores 0 for every language and so takes its neighbours' label.
Words in a script that no language was trained with are scored over all of them, so
every text with a letter gets a learned label.  With no training rows every text is `und`.  Ties go to the language first in sort order.
Extra columns pass through; a column with the name of one that is added is replaced.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
BUCKETS = 1 << 15  # hashed runs kept in a model, for each language
PENALTY = 12.0  # cost of a change of language, in nats
LEAST_SHARE = 0.01  # of a language's letters, for it to be a candidate for a script
TEXT_BYTES = 1 << 20  # of texts whose letters are looked at together
LABEL_BYTES = 8 << 20  # of texts whose words go through the search together

# letters' scripts by code point range.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F), ("thai", 0x0E00, 0x0E7F),
    ("lao", 0x0E80, 0x0EFF), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("han", 0x20000, 0x2FA1F),
)
NAMES = ("none", "other", *dict.fromkeys(name for name, _, _ in SCRIPTS))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script number (0: no letter) and lower case of each code point."""
    size = sys.maxunicode + 1
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(size)), bool, size)
    script = letter.astype(np.uint8)
    for name, low, high in SCRIPTS:
        script[low : high + 1] *= np.uint8(NAMES.index(name))
    lower = np.arange(size, dtype=np.uint32)
    for c in range(0x530):
        if len(small := chr(c).lower()) == 1:
            lower[c] = ord(small)
    return script, lower


@dataclass
class Letters:
    """Words of some texts: runs of letters' code points as hashed buckets, word by word."""

    bucket: np.ndarray  # of the run that starts at each code point of a word
    word: np.ndarray  # start of each word in bucket
    script: np.ndarray  # of each word, 0 if it has no letter
    letters: np.ndarray  # of each word
    first: np.ndarray  # index of each text's first word, number of words last


def letters_of(texts: list[str | None]) -> Letters:
    script_of, lower = _tables()
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    joined = "".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(joined, dtype="<u4")
    low, script = lower[code], script_of[code]
    space = (code == 32) | ((code >= 9) & (code <= 13))
    edge = np.concatenate([[0], np.cumsum(sizes)])
    solid = ~space
    new = np.ones(len(code), bool)
    new[1:] = ~solid[:-1]
    new[edge[edge < len(code)]] = True
    at = np.flatnonzero(solid)
    word = np.flatnonzero(new[at])
    first = np.searchsorted(at[word], edge)
    kind = script[at]
    plain = np.where(kind > 0, low[at], np.uint32(1)).astype(np.uint64)
    if not len(word):
        none = np.zeros(0, np.int64)
        return Letters(none, none, none, none, first)
    # the run at a code point: the one before it, itself and the two after, 0 beyond the word
    n, begins = len(at), np.zeros(len(at) + 3, bool)
    begins[word] = True
    begins[n:] = True
    pad = np.concatenate([plain, np.zeros(3, np.uint64)])
    back = np.concatenate([[np.uint64(0)], plain[:-1]])
    back[word] = 0
    one = np.where(begins[1 : n + 1], np.uint64(0), pad[1 : n + 1])
    two = np.where(begins[1 : n + 1] | begins[2 : n + 2], np.uint64(0), pad[2 : n + 2])
    mixed = ((back * np.uint64(0x9E3779B1) + plain) * np.uint64(0x85EBCA6B) + one) * np.uint64(0xC2B2AE3D) + two
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(49)).astype(np.int64)
    bucket[kind == 0] = -1
    has = np.add.reduceat((kind > 0).astype(np.int64), word)
    return Letters(bucket, word, np.maximum.reduceat(kind, word).astype(np.int64), has, first)


def _slices(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows of about ``size`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield start, stop - start
        start, done = stop, int(ends[stop - 1])


def count_runs(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts by (lang, kind, bucket): runs as kind 0, letters of each script as kind 1.

    Each task sums its rows in arrays of fixed size first; the rows that are
    shuffled are at most `BUCKETS` for each language and task.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for start, size in _slices(batch.column(0), TEXT_BYTES):
                part, own = batch.column(0).slice(start, size).to_pylist(), langs[start : start + size]
                found = letters_of(part)
                of_word = np.repeat(np.arange(len(part)), np.diff(found.first))
                of_run = np.repeat(of_word, np.diff(np.append(found.word, len(found.bucket))))
                for name in set(own):
                    mine = own == name
                    took = found.bucket[mine[of_run] & (found.bucket >= 0)]
                    run.setdefault(name, np.zeros(BUCKETS, np.int64))
                    run[name] += np.bincount(took, minlength=BUCKETS)
                    pick = mine[of_word]
                    scripts.setdefault(name, np.zeros(len(NAMES), np.int64))
                    scripts[name] += np.bincount(
                        found.script[pick], weights=found.letters[pick], minlength=len(NAMES)
                    ).astype(np.int64)
        for kind, counts in ((0, run), (1, scripts)):
            for name, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [name] * len(at), "kind": np.full(len(at), kind, np.int32), "bucket": at.astype(np.int32), "n": c[at]}
                )

    some = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    counted = some.mapInArrow(task, "lang string, kind int, bucket int, n long")
    return counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    score: np.ndarray  # log share of a bucket, by language
    allowed: np.ndarray  # script by language


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fits on every labelled row.

    What reaches the driver is the summed table: at most `BUCKETS` + scripts rows
    for each language.
    """
    rows = count_runs(labelled, text, lang).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(NAMES), len(langs)))
    number = {name: i for i, name in enumerate(langs)}
    rows["l"] = rows["lang"].map(number)
    for kind, table in ((0, counts), (1, scripts)):
        part: pd.DataFrame = rows[rows["kind"] == kind]
        table[part["bucket"].to_numpy(int), part["l"].to_numpy(int)] = part["n"]
    share = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)
    allowed = scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, np.log(share).astype(np.float32), allowed)


def word_scores(found: Letters, model: Model) -> np.ndarray:
    """Score of each word for each language, and for `und` last.

    A word in a script that no language was trained with may be of any of them.
    """
    n, never = len(model.langs), np.float32(-np.inf)
    out = np.zeros((len(found.word), n + 1), np.float32)
    if not len(found.word):
        return out
    table = np.vstack([model.score, np.zeros((1, n), np.float32)])  # bucket -1: no letter
    out[:, :n] = np.add.reduceat(table[found.bucket], found.word, axis=0)
    may = model.allowed[found.script]
    may[~may.any(axis=1)] = True
    lettered = found.letters > 0
    out[:, :n][lettered[:, None] & ~may] = never
    out[:, n] = np.where(lettered & (n > 0), never, 0)
    out[~lettered] = 0
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; texts go in step with each other, the longest first."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    size, start = size[order], first[:-1][order]
    longest, states = int(size[0]) if len(size) else 0, scores.shape[1]
    label = np.zeros(len(scores), np.int16)
    if not longest:
        return label
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t words
    back = np.empty((len(scores), states), np.int8 if states < 128 else np.int16)
    own = np.arange(states)
    value = scores[start[: active[0]]].copy()
    final = np.empty(len(size), np.int64)
    rows = np.arange(len(size))
    for t in range(1, longest + 1):
        now = active[t] if t < longest else 0
        if now < len(value):
            final[now : len(value)] = value[now:].argmax(axis=1)
        if not now:
            break
        value = value[:now]
        top = value.argmax(axis=1)
        switch = value[rows[:now], top][:, None] - np.float32(penalty)
        stay = value >= switch
        at = start[:now] + t
        back[at] = np.where(stay, own, top[:, None])
        value = np.where(stay, value, switch) + scores[at]
    now = 0
    state = np.empty(len(size), np.int64)
    for t in range(longest - 1, -1, -1):
        if active[t] > now:
            state[now : active[t]] = final[now : active[t]]
            now = active[t]
        at = start[:now] + t
        label[at] = state[:now]
        if t:
            state[:now] = back[at, state[:now]]
    return label


_OUT = "struct<lang_pred:string,score:double,spans:array<struct<from_word:int,to_word:int,lang:string>>>"
_SPAN = pa.struct([("from_word", pa.int32()), ("to_word", pa.int32()), ("lang", pa.string())])
_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def label_texts(texts: pa.Array, model: Model, penalty: float) -> pa.StructArray:
    """lang_pred, score and spans of each text, as one column."""
    names = np.array([*model.langs, UNKNOWN], dtype=object)
    n, scores, letters, sizes = len(texts), [], [], [np.zeros(1, np.int64)]
    for start, size in _slices(texts, TEXT_BYTES):
        found = letters_of(texts.slice(start, size).to_pylist())
        scores.append(word_scores(found, model))
        letters.append(found.letters)
        sizes.append(np.diff(found.first))
    first, letters = np.cumsum(np.concatenate(sizes)), np.concatenate([np.zeros(0, np.int64), *letters])
    label = viterbi(np.concatenate([np.zeros((0, len(names)), np.float32), *scores]), first, penalty)
    text_of = np.repeat(np.arange(n), np.diff(first))
    weight = np.bincount(text_of * len(names) + label, weights=letters, minlength=n * len(names)).reshape(n, -1)
    total = weight.sum(axis=1)
    best = np.where(total > 0, weight.argmax(axis=1), len(names) - 1)
    score = np.where(total > 0, weight[np.arange(n), best] / np.maximum(total, 1), 0.0)
    new = np.ones(len(label), bool)
    new[1:] = (label[1:] != label[:-1]) | (text_of[1:] != text_of[:-1])
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(label))
    some = total[text_of[begin]] > 0
    begin, stop = begin[some], stop[some]
    base = first[text_of[begin]]
    parts = [(begin - base).astype(np.int32), (stop - base).astype(np.int32), names[label[begin]]]
    span = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(parts, _SPAN)], fields=list(_SPAN))
    at = np.searchsorted(text_of[begin], np.arange(n + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(at), span)
    return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score), spans], fields=list(_TYPE))


def label(docs: DataFrame, model: Model, text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """Adds lang_pred, score (share of letters in its spans) and spans; no shuffle.

    A task holds one slice of texts and its scores at a time and hands it on at once.
    """
    docs = docs.drop(*(f.name for f in _TYPE))
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # a name that no column has
    added = max([*names, ""], key=len) + "_"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(text))
            for start, size in _slices(column, LABEL_BYTES):
                got = label_texts(column.slice(start, size), shared.value, penalty)
                yield pa.RecordBatch.from_arrays([*batch.slice(start, size).columns, got], [*names, added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{added}` {_OUT}"
    return docs.mapInArrow(task, schema).select(*[F.col(f"`{c}`") for c in names], F.col(f"`{added}`.*"))
