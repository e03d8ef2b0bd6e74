"""Tiled comparison of embeddings against all pairs."""

import numpy as np
import pytest

from goldvein.llm import tiles
from goldvein.llm.queries import QUERIES

from .test_dedup_ops import groups


def plain_near(rows, least=0.93):
    """(id, n_links, component_id) by comparing all vectors with all."""
    edges, n = [], [0] * len(rows)
    ok = [lab is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    for p, (_, v, lab) in enumerate(rows):
        for q in range(p):
            o, other = rows[q][1:]
            if ok[p] and ok[q] and lab == other and len(v) == len(o):
                a, b = np.array(v, float), np.array(o, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    edges.append((p, q))
                    n[p] += 1
                    n[q] += 1
    of, smallest = groups(edges), {}
    for p, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[of.get(p, p)] = min(i, smallest.get(of.get(p, p), i))
    return sorted(((i, n[p], smallest.get(of.get(p, p))) for p, (i, _, _) in enumerate(rows)), key=repr)


def got_near(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' AS node", "1 AS least", "map('a', 1) AS tile")
    found = tiles.near_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr)


def clouds(seed, dims, sizes, spread):
    """Groups of vectors near a common one, copies among them, some of them scaled."""
    r = np.random.default_rng(seed)
    out = []
    for label, size in enumerate(sizes):
        centre = r.normal(size=dims)
        for k in range(size):
            v = centre + spread * r.normal(size=dims) * (1 + k % 3)
            out.append((r.integers(1, 5) * v if k % 4 else v, label % 3))
            if k % 5 == 0:
                out.append((v, label % 3))
    order = r.permutation(len(out))
    return [(int(100 + i), [float(x) for x in out[p][0]], out[p][1]) for i, p in enumerate(order)]


@pytest.mark.parametrize("rows_a_tile", [3, 4096])
def test_against_all_pairs(spark, monkeypatch, rows_a_tile):
    monkeypatch.setattr(tiles, "TILE_ROWS", rows_a_tile)
    monkeypatch.setattr(tiles, "CHUNK", 5)
    rows = clouds(1, 16, [40, 30, 20, 1, 1], 0.12)
    bad = [[0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [], None]
    rows += [(i, v, 1) for i, v in enumerate(bad)] + [(6, rows[0][1], None), (None, rows[0][1], rows[0][2]), (None, [1.0] * 16, 2)]
    rows += [(7, rows[1][1], rows[1][2])] * 3 + [(7, rows[2][1], rows[2][2]), (8, [1e200] * 16, 2), (9, [1e-200] * 16, 2), (10, [1.0, 0.0], 0), (11, [2.0, 0.1], 0), (12, [-0.0, 0.0, 3.0], 0), (13, [0.0, -0.0, 4.0], 0)]
    assert got_near(spark, rows) == plain_near(rows)


def test_chain_across_tiles(spark, monkeypatch):
    """Neighbours on an arc are linked, its ends are not."""
    monkeypatch.setattr(tiles, "TILE_ROWS", 4)
    step = np.arccos(0.931)
    rows = [(90 - i, [float(np.cos(i * step)), float(np.sin(i * step))], 1) for i in range(12)]
    got = got_near(spark, rows)
    assert got == plain_near(rows) and {c for _, _, c in got} == {79} and {n for _, n, _ in got} == {1, 2}


def test_threshold_is_met_exactly(spark):
    """3-4-5 triangles: a cosine of exactly 0.6 and 0.8, turned and scaled."""
    rows = [(1, [5.0, 0.0], 1), (2, [3.0, 4.0], 1), (3, [4.0, 3.0], 1), (4, [-5.0, 0.0], 1), (5, [0.0, -7.0], 1)]
    assert got_near(spark, rows, least=0.6) == plain_near(rows, 0.6)
    assert got_near(spark, rows, least=0.8) == plain_near(rows, 0.8)


def test_pairs_stop_only_where_they_cannot_reach():
    r = np.random.default_rng(5)
    for dims in (1, 2, 7, 64):
        x = r.normal(size=(90, dims)) * np.linspace(3, 0.1, dims)
        x[40:] = x[:50] + 0.05 * r.normal(size=(50, dims))
        axes = np.linalg.qr(r.normal(size=(dims, dims)))[0]
        make = lambda v: tiles.Tile.of(np.arange(len(v)).tobytes(), np.ones(len(v), int).tobytes(), v.tobytes(), dims, axes)
        u = tiles.units(x)
        assert (tiles.linked(make(x[:45]), make(x[45:]), 0.9) == (u[:45] @ u[45:].T >= 0.9)).all()


def test_empty_table_and_given_table(spark):
    assert got_near(spark, []) == []
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in given.collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in QUERIES["op13_tiled_embeddings"](spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == plain_near(rows)
