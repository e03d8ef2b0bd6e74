"""Spelling variants against a comparison of all words."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from goldvein.llm import spelling
from goldvein.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n, ratio=10):
    out = {}
    for w in n:
        near = [o for o in n if o != w and one_edit(w, o)]
        best = min(near, key=lambda o: (-n[o], o), default=None)
        out[w] = (best if best is not None and n[best] >= ratio * n[w] else None, n[w], len(near))
    rows = []
    for w, (form, count, near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, count, near, n[form] if form else None))
    return sorted(rows)


def got_variants(spark, n, **options):
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    return sorted(tuple(r) for r in spelling.variants(words, **options).collect())


def edited(random, word, letters):
    at = random.randrange(len(word) + 1)
    kind = random.randrange(3)
    if kind == 0:
        return word[:at] + random.choice(letters) + word[at:]
    return word[: at - 1 if at else 0] + (random.choice(letters) if kind == 1 else "") + word[at:]


@pytest.mark.parametrize("letters, size", [("ab", 120), ("abcdefgh", 200), ("añß×日x", 150)])
def test_variants_against_all_pairs(spark, letters, size):
    r = random.Random(size)
    n = {}
    for _ in range(size // 6):
        word = "".join(r.choice(letters) for _ in range(r.randrange(7, 14)))
        n[word] = 10 ** r.randrange(1, 6)
        for _ in range(5):
            word = edited(r, word, letters)
            if len(word) >= 4:
                n.setdefault(word, 10 ** r.randrange(0, 5) * r.randrange(1, 4))
    n |= {"a" * k: 10**k % 97 + 1 for k in range(4, 30)}  # one bigram over and over
    n |= {"long" * 5000: 3, "long" * 5000 + "x": 40, "x" + "long" * 5000: 3}
    assert got_variants(spark, n) == plain_variants(n)


def test_chains_ties_and_short_words(spark):
    n = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20_000, "xbcdefg": 20, "abcdefgy": 20}
    assert got_variants(spark, n) == plain_variants(n)
    short = got_variants(spark, {"abc": 1, "abd": 50, "": 3})
    assert short == [("", None, "", 3, 0, None), ("abc", None, "abc", 1, 0, None), ("abd", None, "abd", 50, 0, None)]
    assert got_variants(spark, {}) == []


@given(st.lists(st.text("abc", min_size=4, max_size=9), min_size=2, max_size=40, unique=True))
@settings(max_examples=150, deadline=None)
def test_pivots_meet_prefixes_of_all_near_words(words):
    """Of two near words the one whose prefix ends at the rarer rank has a key of the other one."""
    g = spelling.Grams(pa.array(words))
    count = np.bincount(g.bucket, minlength=1 << spelling.GRAM_BITS)
    rank = np.empty(len(count), np.int64)
    rank[np.lexsort((np.arange(len(count)), count))] = np.arange(len(count))
    trio = g.trio(rank)
    last = rank[g.bucket[trio[:, -1]]]
    left, right = spelling.pivots(g, trio, count)
    assert (np.abs(g.pos[left] - g.pos[right]) >= 2).all() and (g.pos[left] < g.pos[right]).all()
    held = np.flatnonzero(rank[g.bucket] <= last[g.word])
    keys = [set() for _ in words]
    for side in (False, True):
        for w, k in zip(*g.keys(held, side)):
            keys[w].add((side, int(k)))
    mine = [set() for _ in words]
    for side, pivot in ((False, left), (True, right)):
        for w, k in zip(*g.keys(pivot, side)):
            mine[w].add((side, int(k)))
    letters = g.letters()
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if a != b and last[i] <= last[j] and one_edit(a, b):
                assert mine[i] & keys[j], (a, b)
                assert int(letters[i] ^ letters[j]).bit_count() <= 2


def test_query_over_odd_texts(spark, tmp_path):
    r = random.Random(4)
    texts = [(1, None), (2, ""), (3, "123 _ short"), (None, "Wonderful wonderful WONDERFUL wonderfol"), (5, "Straße×mit÷Ünd-Straße×mit÷Ünd")]
    base = ["wonderful", "celebration", "Ünbelievable", "mountain", "mountains", "a" * 12]
    for i in range(10, 400):
        texts.append((i, " ".join(edited(r, r.choice(base), "abcxyzé") if r.random() < 0.2 else r.choice(base) for _ in range(12))))
    texts += [(400, "mountain " * 40_000), (400, "mountain " * 3)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' AS word", "'y' AS run")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    n = Counter()
    for i, text in texts:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    got = sorted(tuple(r) for r in QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect())
    assert got == plain_variants(n)


def test_no_plan_pairs_words_without_a_key(spark):
    words = spark.range(100).selectExpr("concat('wording', id) AS word", "id AS n")
    plan = spelling.near_words(words)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
