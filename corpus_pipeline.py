"""A corpus from documents to packed windows, stage by stage.

Each stage gets what the one before kept (written as Parquet and read
again), works on all of it and returns the columns of ``documents``; the
last returns the pieces of the packed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abiflow.llm import decontaminate, jaccard, langid, packing, pii
from abiflow.llm.common import checkpointed, fresh, numbered, scratch, small_batches, table
from abiflow.llm.token_ids import public_path

#: Texts whose best language needs more bits a byte than this, or has no
#: letter, are in none of the known languages; prose needs two to three.
MOST_BITS = 6.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language; ``lang`` becomes the language
    found.  Trees are counted on labelled texts of this stage's input."""
    small_batches(spark)
    trees = langid.train(langid.sample(docs, F.lit(True)))
    name = fresh(docs, "_language")
    found = langid.with_language(docs, trees, name)
    kept = found.where((F.col(f"{name}.lang_pred") != langid.UNKNOWN) & (F.col(f"{name}.bits_per_byte") <= MOST_BITS))
    return kept.withColumn("lang", F.col(f"{name}.lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts that share 80 % of their five-word n-grams the
    row with the smallest doc_id stays (null last; of equal ids the first
    row).  Rows are told apart by a number of their own."""
    small_batches(spark)
    row = fresh(docs, "_row")
    rows = numbered(docs, row)
    of = rows.select(F.col(row).alias("row"), "doc_id")
    classes = jaccard.jaccard_classes(rows.select(F.col(row).alias("doc_id"), "text"), n=5, percent=80)
    linked = classes.where("n_links > 0").select(F.col("doc_id").alias("row"), F.col("component_id").alias("class"))
    linked = checkpointed(of.join(linked, "row"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    stay = linked.groupBy("class").agg(least.alias("least")).select(F.col("least.row").alias("row"))
    gone = linked.select("row").join(stay, "row", "left_anti").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, reworded or not."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces identifiers in the texts by their kind."""
    small_batches(spark)
    clean = pii.redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 2048 ids."""
    small_batches(spark)
    return packing.pack_documents(docs, public_path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_texts", benchmark_texts),
    ("personal_data", personal_data),
    ("windows", windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}-{name}")
        docs = spark.read.parquet(f"{out}/{k}-{name}")
    return docs


#: No stage is expressible in SQL as a whole: trained models, tokenizers.
ORACLE_SQL = None
