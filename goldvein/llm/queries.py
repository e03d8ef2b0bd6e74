"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.llm import (
    debruijn,
    decontaminate,
    embedding,
    hyperminhash,
    langid,
    licenses,
    merkle,
    oracle,
    sentencepieces,
    spelling,
    suffixes,
    tiles,
    urlfilter,
    warc,
)

PIECES = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_training(doc_id: str = "doc_id"):
    """Documents that a language model may learn from; a null id is one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(True))


@query
def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(in_training()))
    seen = langid.label(docs.select("doc_id", "text"), model)
    return seen.select(
        "doc_id", (~in_training()).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query
def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4).drop("class_id")


@query
def op6_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = debruijn.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op8_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs.select("doc_id", "text"), items)


@query
def op1_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = sentencepieces.round_trip(docs, sentencepieces.read_vocabulary(PIECES))
    same = F.col("decoded").eqNullSafe(F.col("text"))
    return done.select(
        "doc_id", sentencepieces.piece_count().alias("n_pieces"), "n_byte_pieces", "piece_ids", same.alias("round_trip")
    )


@query
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return done.withColumnRenamed("source", "page_id")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    best = F.get("matches", F.lit(0))
    return found.select(
        "doc_id",
        best["license"].alias("license"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        best["from_word"].alias("from_word"),
        best["to_word"].alias("to_word"),
        F.size("matches").alias("n_matches"),
    )


# The rules of the contract.
URL_RULES = [
    urlfilter.parse_rule("allow", "com/"),
    urlfilter.parse_rule("block", "example.com/en/"),
    urlfilter.parse_rule("allow", "www.example.com/en/"),
    urlfilter.parse_rule("block", "net/es/"),
    urlfilter.parse_rule("block", "net/fr/"),
]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.with_groups(embedding.edit_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = merkle.record_digest(*fields, F.translate("text", UPPER, LOWER))
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", merkle.record_digest(*fields, "text").alias("leaf"), F.when(changed, tampered).alias("tampered")
    )
    done = merkle.manifest(leaves, digest="leaf", group="lang", order=("doc_id",))
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    digests = {
        "leaf": F.col("leaf"), "subroot": F.col("subroot"), "root": F.col("root"),
        "proof_sha256": merkle.proof_digest(F.col("path")), "folded_root": folded,
    }
    hexed = done.select("doc_id", *[merkle.hex_of(c).alias(n) for n, c in digests.items()])
    return hexed.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    run = F.translate("run", UPPER, LOWER)
    drawn = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
    cut = (drawn % F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), cut), F.substring(run, cut + 2, F.char_length(run)))
    word = F.when(drawn % 31 == 0, without).otherwise(run)
    # a run of fewer code points gives no word, with or without one of them
    pattern = f"[A-Za-z\u00C0-\u00FF]{{{spelling.LEAST},}}"
    counted = spelling.word_counts(docs, F.when(F.char_length(word) >= spelling.LEAST, word), pattern)
    return spelling.variants(counted.where("n >= 2"))


@query
def op13_tiled_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


ORACLE_SQL |= {
    "op2_warc_derivatives": oracle.warc_sql(warc.HIDDEN, warc.LINE_TAGS, warc.TAGS, [(a, b) for a, b in warc.ENTITIES if a != "&#39;"]),
    "op4_hyperminhash": oracle.OP4,
    "op6_debruijn_dedup": oracle.OP6,
    "op7_suffix_dedup": oracle.OP7,
    "op8_containment_search": oracle.OP8,
    "op9_url_filter": oracle.OP9,
    "op11_merkle_manifest": oracle.OP11,
    "op12_spelling_variants": oracle.OP12,
    "op13_tiled_embeddings": oracle.OP13,
}
