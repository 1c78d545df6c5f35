"""Tables of a data folder and the scratch folder of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it if ``df`` has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = "_" + name
    return name


def numbered(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a number of its own for each row, written to the scratch
    folder, so that every later read has the same numbers."""
    path = scratch(df.sparkSession, "rows")
    df.withColumn(column, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Texts that a Python worker gets at a time: whole texts can be long.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, on both sides of a Python worker,
    where they aren't smaller already."""
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    shared_dir(df.sparkSession)  # names the folder to the context
    return df.checkpoint()
