"""Near-duplicate, substring and component operators against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldvein.llm import debruijn, hyperminhash, suffixes
from goldvein.llm.graph import components

from .conftest import shingles_of, words_of


def groups(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(7, 7), (300, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups([(a, b) for a, b in edges if a is not None and a != b])


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_near(rows, n, percent=80):
    sets = [(i, shingles_of(t, n)) for i, t in rows]
    edges = []
    for k, (i, s) in enumerate(sets):
        for j, o in sets[:k]:
            if i is not None and j is not None and s and o and 100 * len(s & o) >= percent * len(s | o):
                edges.append((i, j))
    of = groups(edges)
    return sorted(((i, len(s), of.get(i, i)) for i, s in sets), key=repr)


def near(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in hyperminhash.near_duplicates(df, **options).collect()), key=repr)


def test_near_duplicates_of_odd_texts(docs_of, odd_texts):
    got = hyperminhash.near_duplicates(docs_of(odd_texts), shingle=4)
    assert got.where("doc_id is null").first().kept
    assert near(docs_of(odd_texts), shingle=4) == brute_near(odd_texts, 4)


def test_near_duplicates_of_chains_and_large_groups(docs_of, some_words):
    """A chain whose ends are not alike, a group of copies, and short texts around the threshold."""
    random.seed(3)
    chain = some_words(1, 120)
    rows = []
    for i in range(12):
        rows.append((100 - i, " ".join(chain)))
        for k in range(3):
            chain[(11 * i + 37 * k) % 120] = f"new{i}x{k}"
    base = some_words(2, 90)
    for i in range(60):
        copy = list(base)
        for _ in range(random.randrange(4)):
            copy[random.randrange(90)] = f"edit{random.randrange(50)}"
        rows.append((200 + i, " ".join(copy)))
    for i in range(40):
        rows.append((400 + i, " ".join(some_words(5, 8 + i % 7)[: 8 + i % 7] + [f"z{i % 5}"])))
    assert near(docs_of(rows), shingle=4) == brute_near(rows, 4)


def test_no_documents(docs_of):
    assert near(docs_of([])) == []
    assert debruijn.remove_repeats(docs_of([])).count() == 0
    assert suffixes.remove_repeats(docs_of([])).count() == 0


def test_estimates_follow_jaccard():
    random.seed(5)
    for shared in (0.2, 0.5, 0.8, 0.95):
        n = 3000
        both = np.array([random.getrandbits(64) for _ in range(int(n * shared))], np.uint64)
        rows = [np.unique(np.append(both, np.array([random.getrandbits(64) for _ in range(n - len(both))], np.uint64))) for _ in (0, 1)]
        least = np.zeros((2, hyperminhash.BUCKETS), np.uint64)
        for i, s in enumerate(rows):
            least[i] = s[np.minimum(np.searchsorted(s, hyperminhash._EDGE), len(s) - 1)]
        r = hyperminhash.registers(least, (least >> np.uint64(64 - hyperminhash.BITS)) == hyperminhash._OWN)
        true = len(both) / (2 * n - len(both))
        assert abs(float(hyperminhash.estimate(r[0], r[1])) - true) < 0.12


def brute_windows(rows, window):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for i, t in ordered:
        w = words_of(t)
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), (i, p))
    for i, t in ordered:
        w, gone = words_of(t), set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] != (i, p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def removed(df, **options):
    done = debruijn.remove_repeats(df, **options)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in done.collect()), key=repr)


def test_repeated_windows_of_odd_texts(docs_of, odd_texts):
    df = docs_of(odd_texts)
    assert removed(df) == brute_windows(odd_texts, 20)
    kept = debruijn.remove_repeats(df)
    assert {"source", "score", "node", "kept_text"} <= set(kept.columns) and kept.columns.count("spans") == 1


@pytest.mark.parametrize("window", [3, 5])
def test_repeated_windows_of_few_words(docs_of, window):
    """Few different words, so that windows repeat, overlap and branch everywhere."""
    random.seed(window)
    rows = [(i, " ".join(random.choice("abc") for _ in range(random.randrange(25)))) for i in range(40)]
    assert removed(docs_of(rows), window=window, small=2) == brute_windows(rows, window)


def test_paths_name_their_source(docs_of, some_words):
    text = some_words(11, 100)
    rows = [(1, " ".join(text)), (2, "x y " + " ".join(text[30:80]) + " z")]
    spans = {r.doc_id: r.spans for r in debruijn.remove_repeats(docs_of(rows)).collect()}
    assert spans[1] is None
    assert [tuple(s) for s in spans[2]] == [(2, 52, 1, 30)]


def test_edges_of_one_minimizer_that_agree_in_32_bits(docs_of):
    """Two windows around a common line; the upper halves of their hashes are equal, their words are not."""
    line = [f"l33490x{j}" for j in range(8)]
    rows = [(k, " ".join([f"a{first + j}" for j in range(12)] + line)) for k, first in ((1, 51432), (2, 292296))]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    found = debruijn._pieces(data, np.array([0, len(rows[0][1]), len(data)]), 20, 8)
    assert found["key"][0] == found["key"][1]
    assert removed(docs_of(rows)) == brute_windows(rows, 20)


def test_pieces_and_texts_take_little_more_than_their_hashes(spark, some_words):
    """What is shuffled of a piece beside its edges' hashes: once 24 bytes and a header of 12, now its part of a row."""
    rows = [(10_000 + i, " ".join(some_words(i, 300))) for i in range(300)]
    found = debruijn.pieces(spark.createDataFrame(rows, "doc long, text string").coalesce(1), 20, 8, 4).collect()
    edges = sum(len(r.edges) for r in found)
    n = np.concatenate([debruijn._columns(bytes(r.head), debruijn._HEAD)[3] for r in found])
    assert edges == 300 * 281 * 8 == 8 * n.sum()
    assert sum(len(r.head) for r in found) < 14 * len(n)
    texts = spark.createDataFrame([(t,) for _, t in rows] + [(None,), ("",)], "text string")
    sent = [r[0] for r in texts.select(debruijn._small_texts("text")).collect()]
    assert sent[-2] is None and sum(map(len, sent[:-2])) < 0.75 * sum(len(t) for _, t in rows)


def test_many_parts_and_many_known_repeats(spark, some_words, monkeypatch):
    """Parts sent a few at a time, and repeats known in a batch in several rows, give the same windows."""
    rows = [(i, " ".join(some_words(i % 7, 200 + i % 3) + some_words(i, 30))) for i in range(60)]
    text = spark.createDataFrame(rows, "doc long, text string").coalesce(1)
    whole = sorted(map(tuple, debruijn.paths(debruijn.repeats(debruijn.pieces(text, 20, 8, 1))).collect()))
    batch = pa.RecordBatch.from_pylist([{"doc": i, "text": t} for i, t in rows])
    monkeypatch.setattr(debruijn, "_SENT_EDGES", 50)
    monkeypatch.setattr(debruijn, "_KNOWN_ROWS", 3)
    sent = []

    class Frame:
        def mapInArrow(self, task, schema):
            sent.extend(task(iter([batch])))

    debruijn.pieces(Frame(), 20, 8, 100)
    assert len(sent) > 20
    many = spark.createDataFrame(pa.Table.from_batches(sent))
    assert sorted(map(tuple, debruijn.paths(debruijn.repeats(many)).collect())) == whole != []


def brute_bytes(rows, length):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    last = 1 << 63
    first, out = {}, []
    for i, t in ordered:
        raw = (t or "").encode()
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p : p + length], last if i is None else i)
    for i, t in ordered:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < (last if i is None else i):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cut(df, **options):
    done = suffixes.remove_repeats(df, **options)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in done.collect()), key=repr)


def test_repeated_bytes_of_odd_texts(docs_of, odd_texts):
    assert cut(docs_of(odd_texts)) == brute_bytes(odd_texts, 50)


def test_repeated_bytes_of_few_letters(docs_of):
    random.seed(1)
    rows = [(i, "".join(random.choice("ab\x00é") for _ in range(random.randrange(60)))) for i in range(50)]
    assert cut(docs_of(rows), length=9, gram=9) == brute_bytes(rows, 9)
    assert cut(docs_of(rows), length=12, gram=9) == brute_bytes(rows, 12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=6, max_size=6).map(lambda b: bytes(c % 3 for c in b)), max_size=12), min_size=1, max_size=9))
def test_loser_tree_merges_and_knows_prefixes(runs):
    runs = [sorted(r) for r in runs if r]
    if not runs:
        return

    def prefix(x, y):
        return next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))

    coded = [(r, [0] + [prefix(x, y) for x, y in zip(r, r[1:])]) for r in runs]
    order, shared = suffixes.merge_runs(coded)
    merged = [runs[r][i] for r, i in order]
    assert merged == sorted(x for r in runs for x in r)
    assert shared[1:] == [prefix(x, y) for x, y in zip(merged, merged[1:])]
