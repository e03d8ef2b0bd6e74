"""Merkle manifests against a plain computation, level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from goldvein.llm import merkle
from goldvein.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text=None):
    values = [row[c] for c in FIELDS[:4]] + [row["text"] if text is None else text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves, fan):
    """The last node and, for each leaf, its (before, after) on each level."""
    proofs, of = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, at in enumerate(of):
            run = at - at % fan
            proofs[i].append(("".join(leaves[run:at]), "".join(leaves[at + 1 : run + fan])))
        leaves = [sha("".join(leaves[k : k + fan])) for k in range(0, len(leaves), fan)]
        of = [at // fan for at in of]
    return leaves[0], proofs


def plain_manifest(rows, fan=8):
    """(row, leaf, subroot, root, proof) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))
    trees = [climb([leaf_of(r) for r in sorted(groups[k], key=first)], fan) for k in keys]
    root, tops = climb([t[0] for t in trees], fan)
    return [
        (r, leaf_of(r), sub, root, proofs[i] + tops[g])
        for g, (k, (sub, proofs)) in enumerate(zip(keys, trees))
        for i, r in enumerate(sorted(groups[k], key=first))
    ]


def rows_of(sizes):
    out, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            n += 1
            out.append({"doc_id": n * 37 % 1009 if n % 11 else -n, "source": "é|" if n % 5 else None, "lang": lang, "n_chars": n if n % 3 else None, "text": f"Text {n} ß" if n % 7 else None})
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
SHAPES = [
    {"en": 1}, {"en": 8}, {None: 9, "en": 64}, {"en": 65, "": 1, "é": 7, "z": 2, None: 3},
    {f"l{i}": 1 + i % 3 for i in range(70)} | {"big": 520},
]


@pytest.mark.parametrize("shape", SHAPES)
def test_query_against_plain_computation(spark, tmp_path, shape):
    rows = rows_of(shape)
    folder = str(tmp_path)
    spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in rows], SCHEMA).selectExpr("*", "1 AS at", "'x' AS path").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_merkle_manifest"](spark, folder).collect()}
    for r, leaf, subroot, root, proof in plain_manifest(rows):
        g = got[r["doc_id"]]
        assert (g.leaf, g.subroot, g.root) == (leaf, subroot, root)
        assert g.proof_sha256 == sha("".join(b + a for b, a in proof))
        low = r["text"] and r["text"].replace("T", "t")
        own = leaf_of(r, low) if low and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 else leaf
        for before, after in proof:
            own = sha(before + own + after)
        assert g.folded_root == own and g.verified == (own == root)


@pytest.mark.parametrize("fan", [2, 3])
def test_other_fans_nulls_and_repeated_rows(spark, fan):
    rows = rows_of({"en": 30, None: 5}) + rows_of({"en": 4}) + [dict.fromkeys(FIELDS)] * 2
    rows += [{"doc_id": 5, "source": str(k), "lang": "en", "n_chars": None, "text": "long " * 50_000} for k in range(3)]
    df = spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in rows], SCHEMA)
    df = df.withColumns({"leaf": merkle.record_digest(*FIELDS), "tree": F.lit("t"), "subroot": F.lit(1), "more": F.create_map(F.lit("a"), "doc_id")})
    got = merkle.manifest(df, fan=fan).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path")))
    assert got.where("NOT folded <=> root").count() == 0 and got.columns.count("subroot") == 1 and "more" in got.columns
    hexed = lambda b: bytes(b).hex()
    steps = lambda path: [(hexed(s["before"]), hexed(s["after"])) for s in path]
    have = sorted((hexed(r.leaf), hexed(r.subroot), hexed(r.root), steps(r.path)) for r in got.collect())
    assert have == sorted((leaf, sub, root, proof) for _, leaf, sub, root, proof in plain_manifest(rows, fan))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA).withColumn("leaf", merkle.record_digest(*FIELDS))
    assert merkle.manifest(empty).count() == 0


def test_plan_joins_on_index_only(spark):
    rows = spark.range(600).selectExpr("id AS doc_id", "'en' AS lang", "unhex(sha2(string(id), 256)) AS leaf")
    plan = merkle.manifest(rows)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
