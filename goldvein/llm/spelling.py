"""Spelling variants: words that differ by one inserted, deleted or replaced character.

Candidates come from pivotal grams.  The bigrams of all words are ranked by how many
words have them, the rarest first.  A word's prefix is its three rarest bigrams and all
others of the rank of the third; one edit touches at most two neighbouring bigrams, so
of any three two are disjoint, and of two disjoint ones at least one outlives the edit.
A word's two pivots are the pair of disjoint bigrams of its three rarest that dynamic
programming finds cheapest, by the words that may share them.  Of two near words take
the one whose prefix ends at the rarer rank: a pivot of it that outlives the edit is in the
prefix of the other word.

Position limits: an edit behind the left pivot leaves all up to that pivot as it is, and
an edit before the right pivot all from that pivot on; one of the two holds whatever is
edited.  So the left pivot is a key together with the characters before it, the right
pivot with those after it, and every bigram of a prefix is a key both ways.  A key holds
its pivot's distance from the start or from the end, so a pivot moves with the length
and by one at most.  Unless `ENOUGH` characters are known that way, a key takes in one half of
the rest: the edit spares its first or its last half (of the shorter of two rests,
which may be one shorter than this one).  Candidates are the rows of one equijoin on
keys whose words differ in the parity of two letters at most; they are confirmed by the
edit distance itself.  Keys are hashes: a collision costs one comparison and changes
nothing.

Ranks are of 65,536 hashed bigrams, so what each task gets is bounded whatever the
alphabet; equal bigrams have equal ranks, which is all that the argument needs.  Words
go through numpy batch by batch; a key with many words is split by Spark's skew join.

Edge cases: null texts have no words.  A word in several spellings of upper and lower
case is one only if the caller lowers it.  `near_words` takes distinct words of at least
four characters; shorter ones have fewer than three bigrams and are near nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.llm.hashing import mix
from goldvein.session import remove_folder, scratch_path

LEAST = 7  # code points of a word
GRAM_BITS = 16
RARE = 3  # bigrams of which two are disjoint
SHORTEST = RARE + 1
LETTERS = 3.0  # how much rarer each further known character makes a key, for the choice of pivots
ENOUGH = 7  # characters known beside a pivot that make a key rare
RATIO = 10  # times as frequent a word's form must be
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_counts(texts: DataFrame, word: Column, pattern: str, text: str = "text") -> DataFrame:
    """(word, n): how often each word occurs.  ``pattern`` matches runs of letters; ``word``
    is an expression on `run` and the columns of texts, null for none."""
    runs = texts.withColumn("run", F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
    return runs.select(word.alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


class Grams:
    """The bigrams of a batch of words of `SHORTEST` code points and more."""

    def __init__(self, words: pa.Array):
        self.length = np.asarray(pc.utf8_length(words)).astype(np.int64)
        self.code = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.start = np.cumsum(self.length) - self.length
        pos = np.arange(len(self.code)) - np.repeat(self.start, self.length)
        self.at = np.flatnonzero(pos < np.repeat(self.length - 1, self.length))
        self.pos = pos[self.at]
        self.word = np.repeat(np.arange(len(self.length)), self.length - 1)
        self.first = np.cumsum(self.length - 1) - (self.length - 1)
        pair = mix(self.code[self.at] * _BASE + self.code[self.at + 1])
        self.bucket = (pair >> np.uint64(64 - GRAM_BITS)).astype(np.int64)

    def trio(self, rank: np.ndarray) -> np.ndarray:
        """The three rarest bigrams of each word, the earlier of equally rare ones first."""
        order = np.lexsort((self.pos, rank[self.bucket], self.word))
        return order[self.first[:, None] + np.arange(RARE)]

    def letters(self) -> np.ndarray:
        """A bit for each of 64 kinds of characters, set if the word has an odd number of them: an edit turns two at most."""
        bit = np.uint64(1) << (mix(self.code + np.uint64(7)) >> np.uint64(58))
        return np.bitwise_xor.reduceat(bit, self.start) if len(bit) else bit

    def _sums(self, right: bool) -> np.ndarray:
        pos = np.arange(len(self.code)) - np.repeat(self.start, self.length)
        power = np.multiply.accumulate(np.full(int(self.length.max(initial=1)), _BASE, np.uint64))
        place = np.repeat(self.length, self.length) - 1 - pos if right else pos
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.code + np.uint64(1)) * power[place])])

    def keys(self, g: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(words, keys) of bigrams: the word from its start to the bigram, or from the bigram to
        its end (right), together with one half of what is left."""
        own = self.word[g]
        begin, end = self.start[own], self.start[own] + self.length[own]
        front, back = self._sums(False), self._sums(True)

        def first(size: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
            return front[begin[at] + size] - front[begin[at]]

        def last(size: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
            return back[end[at]] - back[end[at] - size]

        this, that = (last, first) if right else (first, last)
        known = self.length[own] - self.pos[g] if right else self.pos[g] + 2
        rest = self.length[own] - known

        def tagged(value: np.ndarray, size: np.ndarray, half: np.ndarray, kind: int) -> np.ndarray:
            tag = size * 4096 + half * 8 + kind * 2 + right
            return mix(value + mix(tag.astype(np.uint64)))

        at = np.flatnonzero((known >= ENOUGH) | (rest <= 2))
        which, key = [own[at]], [tagged(this(known[at], at), known[at], 0 * at, 0)]
        # the halves of the shorter of two words: this one's, or of a rest that is one shorter
        for half, some in ((rest // 2, rest > 1), ((rest - 1) // 2, (rest % 2 == 0) & (rest > 2))):
            at = np.flatnonzero(some & (known < ENOUGH))
            m, k = half[at], known[at]
            which += [own[at], own[at]]
            key += [tagged(this(k + m, at), k, m, 1), tagged(mix(this(k, at)) + that(m, at), k, m, 2)]
        return np.concatenate(which), np.concatenate(key)


def pivots(grams: Grams, trio: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The left and the right of the two disjoint bigrams with the least cost, for each word."""
    trio = np.sort(trio, axis=1)  # by position
    pos, often = grams.pos[trio], count[grams.bucket[trio]].astype(float)
    behind = grams.length[:, None] - 2 - pos
    as_left, as_right = often * LETTERS ** -np.minimum(pos, 40.0), often * LETTERS ** -np.minimum(behind, 40.0)
    rows = np.arange(len(trio))
    least, left, right = np.full(len(trio), np.inf), trio[:, 0].copy(), trio[:, 2].copy()
    for j in range(1, RARE):
        before = np.where(pos[:, :j] <= pos[:, j : j + 1] - 2, as_left[:, :j], np.inf)
        i = before.argmin(axis=1)  # the cheapest left one that ends before j begins
        cost = before[rows, i] + as_right[:, j]
        better = cost < least
        least[better], left[better], right[better] = cost[better], trio[better, i[better]], trio[better, j]
    return left, right


_KEYS = "key long, word string, last int, letters long"


def _rows(batch: pa.RecordBatch, g: Grams, keys: tuple[np.ndarray, np.ndarray], last: np.ndarray) -> pa.RecordBatch:
    word, key = keys
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), batch.column(0).take(pa.array(word)), pa.array(last[word].astype(np.int32)), pa.array(g.letters()[word].view(np.int64))],
        ["key", "word", "last", "letters"],
    )


def _gram_counts(words: DataFrame) -> np.ndarray:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << GRAM_BITS, np.int64)
        for batch in batches:
            total += np.bincount(Grams(batch.column(0)).bucket, minlength=1 << GRAM_BITS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    found = words.select("word").mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).toArrow()
    total = np.zeros(1 << GRAM_BITS, np.int64)
    total[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return total


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n), both ways, for all pairs of words one edit apart.

    words: (word, n), each word once.  It is read several times, so pass a table.
    """
    long = words.select("word").where(F.char_length("word") >= SHORTEST)
    count = _gram_counts(long)
    rank = np.empty(1 << GRAM_BITS, np.int32)
    rank[np.lexsort((np.arange(len(count)), count))] = np.arange(len(count))
    shared = words.sparkSession.sparkContext.broadcast((count, rank))

    def pivot_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rank = shared.value
        for batch in batches:
            g = Grams(batch.column(0))
            trio = g.trio(rank)
            last = rank[g.bucket[trio[:, -1]]]
            for pivot, right in zip(pivots(g, trio, count), (False, True)):
                yield _rows(batch, g, g.keys(pivot, right), last)

    def prefix_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, rank = shared.value
        for batch in batches:
            g = Grams(batch.column(0))
            last = rank[g.bucket[g.trio(rank)[:, -1]]]
            in_prefix = np.flatnonzero(rank[g.bucket] <= last[g.word])
            for right in (False, True):
                yield _rows(batch, g, g.keys(in_prefix, right), last)

    a = long.mapInArrow(pivot_task, _KEYS).alias("a")
    b = long.mapInArrow(prefix_task, _KEYS).alias("b")
    meet = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.last") <= F.col("b.last"))
        & (F.bit_count(F.col("a.letters").bitwiseXOR(F.col("b.letters"))) <= 2)
        & (F.col("a.word") != F.col("b.word"))
    )
    one_edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    x, y = F.col("a.word"), F.col("b.word")
    pair = a.join(b, meet).where(one_edit).select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct()
    both = F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    both = pair.select(both.alias("p")).select(F.col("p.x").alias("word"), F.col("p.y").alias("other"))
    return both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "other", "other_n")


def _roots(links: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of all words with a form: each round doubles how far a word has followed."""
    spark, at = links.sparkSession, None
    now = links.select("word", F.col("form").alias("root"))
    for k in range(rounds + 1):
        path = scratch_path(spark, "roots")
        now.write.parquet(path)
        if at:
            remove_folder(spark, at)
        at = path
        own = spark.read.parquet(at)
        if k < rounds:
            ahead = own.select(F.col("word").alias("root"), F.col("root").alias("next"))
            now = own.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return own


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of distinct words (word, n).

    ``form`` is the near word of largest n, the smallest of equals, if it is ``ratio`` times as
    frequent or more; ``root`` the last one that forms lead to, the word itself without one.
    """
    spark = words.sparkSession
    path = scratch_path(spark, "words")
    words.select("word", "n").write.parquet(path)
    words = spark.read.parquet(path)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best).join(words, "word")
    often = -F.col("best.less")
    enough = often >= ratio * F.col("n")
    near = near.select(
        "word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, often).alias("form_n")
    )
    path = scratch_path(spark, "near")
    near.write.parquet(path)
    near = spark.read.parquet(path)
    links = near.where("form IS NOT NULL")
    # along forms n grows by the ratio each time, so the largest n bounds the steps
    top, steps = links.agg(F.max("form_n")).first()[0] or 0, 0
    while ratio ** (steps + 1) <= top:
        steps += 1
    root = _roots(links, max(0, steps - 1).bit_length())
    out = words.join(near, "word", "left").join(root, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
