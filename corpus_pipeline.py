"""Prepares the documents for training, stage by stage.

Each stage works on all that the stage before it kept, and all but the last return
the columns of `documents`.  Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.llm import debruijn, decontaminate, hyperminhash, langid, sentencepieces
from goldvein.llm.queries import PIECES, in_training
from goldvein.session import scratch_path

KEEP_WORDS = 1  # a text with fewer words left is dropped


def _columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in names])


def _numbered(docs: DataFrame) -> DataFrame:
    """The columns as c0, c1 and so on, so that none has the name of one that a step adds."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no language: null, empty, or without letters.  Texts in several languages stay."""
    model = langid.train(docs.where(in_training()))
    plain = _numbered(docs)
    seen = langid.label(plain, model, text=plain.columns[docs.columns.index("text")])
    kept = seen.where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.select(*plain.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group, and equal rows once.

    Rows without an id belong to no group and stay.
    """
    judged = hyperminhash.near_duplicates(docs.select("doc_id", "text"), shingle=5)
    kept = judged.where("kept and doc_id is not null").select("doc_id").distinct()
    plain = _numbered(docs)
    id = plain.columns[docs.columns.index("doc_id")]
    first = plain.join(kept.toDF("kept_id"), F.col(id) == F.col("kept_id"), "left_semi")
    stay = first.unionByName(plain.where(F.col(id).isNull()))
    # maps cannot be compared, their text can
    texts = {f"t{f.name}": F.to_json(F.struct(f.name)) for f in plain.schema if "map<" in f.dataType.simpleString()}
    alike = [c for c in plain.columns if f"t{c}" not in texts] + list(texts)
    return stay.withColumns(texts).dropDuplicates(alike).select(*plain.columns).toDF(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated 20-word windows out of the texts; drops texts with nothing left.

    Texts without a repeat stay as they are, white space included.
    """
    plain = _numbered(docs)
    at = {name: plain.columns[i] for i, name in enumerate(docs.columns)}
    done = debruijn.remove_repeats(plain, id=at["doc_id"], text=at["text"])
    done = done.where(F.col("n_words") - F.col("n_removed") >= KEEP_WORDS)
    text = F.when(F.col("n_removed") == 0, F.col(at["text"])).otherwise(F.col("kept_text"))
    out = done.select(*plain.columns, text.alias("text")).withColumn(at["text"], F.col("text"))
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.length("text").cast("long"))
    return out.select(*plain.columns).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold four fifths or more of a benchmark item's shingles."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contained_items(docs.select("doc_id", "text"), items).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds piece ids and the text that they decode to."""
    done = sentencepieces.round_trip(docs, sentencepieces.read_vocabulary(PIECES))
    return done.withColumn("n_pieces", sentencepieces.piece_count())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]
ORACLE_SQL = None  # SQL cannot express language identification or piece encoding


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
