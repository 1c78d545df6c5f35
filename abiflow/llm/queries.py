"""The registered queries of this subpackage: each applies one operator to
its whole table and derives its result columns from the operator's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, langid, licenses, minhash, packing, pii, quality, ranked_search, rules, sharding, token_files, whitening
from .common import scratch, table
from .token_ids import public_path

Query = Callable[[SparkSession, str], DataFrame]


def _remainder(n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return placed.select(
        "doc_id", "_place.size", "_place.text_crc32", F.lit(sharding.LAW).alias("law"), "_place.shard", "_place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.train(quality.sample(docs, labels, _remainder(5) != 0))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, public_path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, out).drop("file")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.train(langid.sample(docs, _remainder(3) != 1))
    found = langid.predict(docs, trees)
    return found.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, benchmark).drop("_doc")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=85)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_hilbert_shards, op2_quality_classifier, op3_token_files, op4_jaccard_join, op5_language_id,
        op6_license_scan, op7_quality_rules, op8_packing, op9_decontaminate, op10_pii,
        op11_ranked_search, op12_whitening, op13_minhash,
    )
}
