"""Run records as Parquet tables (K1-K5, A6).

One run (a batch, or one micro-batch of a stream) writes four tables under a
root folder, each to its own folder ``batch_id=<k>``:

* ``events``: every match with its ``status`` -- ``decoded``
  rows carry the decoded values (K1), ``failed`` rows the error and the raw
  payload (K2); the match notices (K3) are this table's key columns;
* ``receipt_errors`` (K4), ``block_errors`` (A6), ``progress`` (K5).

Every run writes every table, also one without rows, and each write replaces
the whole folder of its ``batch_id``: a replayed batch leaves nothing of its
earlier run.  The subscribed-transaction rows shared by the events and the
receipt errors are persisted by the run (``RunOutput.release`` drops them), so
the transaction and receipt scans run once per run.

``compact`` merges the folders of older batches into files of Spark's advisory
size, clustered by announcement, without changing what a batch is: rows keep
their ``batch_id``, and a table's manifest says which sets of merged batches
are live.  A manifest entry is one row in one file, so it is there or not:
readers see the state before it or after it.  A batch that is replayed after
it was merged writes its folder again, and an entry then puts the folder in
place of its merged rows.  ``vacuum`` deletes the folders that no entry needs.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import RunOutput

EVENTS = "events"
RECEIPT_ERRORS = "receipt_errors"
BLOCK_ERRORS = "block_errors"
PROGRESS = "progress"
TABLES = (EVENTS, RECEIPT_ERRORS, BLOCK_ERRORS, PROGRESS)
DECODED = "decoded"
FAILED = "failed"


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))


def event_records(out: RunOutput) -> DataFrame:
    """Every match with its status; the raw payload kept only on failures."""
    ev = out.events
    failed = F.col("error").isNotNull()
    return ev.withColumn("status", F.when(failed, F.lit(FAILED)).otherwise(F.lit(DECODED))).withColumn(
        "data", F.when(failed, F.col("data"))
    )


def write_run(out: RunOutput, root: str, batch_id: int = 0) -> int:
    """Write the run's tables; returns the number of block errors (0 or 1),
    which the caller uses to stop a stream."""
    _write(event_records(out), os.path.join(root, EVENTS), batch_id)
    _write(out.receipt_errors, os.path.join(root, RECEIPT_ERRORS), batch_id)
    _write(out.progress, os.path.join(root, PROGRESS), batch_id)
    # one row at most: the announcement lookup, no transaction data
    _write(out.block_error, os.path.join(root, BLOCK_ERRORS), batch_id)
    spark = out.progress.sparkSession
    for name in TABLES:  # all folders are there: now they take the place of merged rows
        if manifest(spark, root, name).merged(batch_id):
            _enter(spark, root, name, "", batch_id, batch_id)
    return int(out.stopped)


@dataclass
class Manifest:
    """The live sets of merged batches (path, first and last batch) of a table
    and the batches among them whose folder is to be read instead."""

    sets: list[tuple[str, int, int]] = field(default_factory=list)
    replaced: set[int] = field(default_factory=set)

    def merged(self, batch_id: int) -> bool:
        return any(lo <= batch_id <= hi for _, lo, hi in self.sets)


def _manifest_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}_manifest")


def manifest(spark: SparkSession, root: str, name: str) -> Manifest:
    try:
        rows = spark.read.schema("path string, lo bigint, hi bigint").parquet(_manifest_path(root, name)).collect()
    except AnalysisException:  # nothing was ever merged
        return Manifest()
    sets = sorted((r.path, r.lo, r.hi) for r in rows if r.path)
    return Manifest(sets, {r.lo for r in rows if not r.path})


def _enter(spark: SparkSession, root: str, name: str, path: str, lo: int, hi: int) -> None:
    entry = spark.createDataFrame([(path, lo, hi)], "path string, lo bigint, hi bigint")
    entry.coalesce(1).write.mode("append").parquet(_manifest_path(root, name))


def _folders(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, name)).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A run table: the folders of batches that aren't merged, and the merged
    sets (a filter on ``batch_id`` reads no merged folder)."""
    state = manifest(spark, root, name)
    table = _folders(spark, root, name)
    if not state.sets:
        return table
    for _, lo, hi in state.sets:
        again = [k for k in state.replaced if lo <= k <= hi]
        table = table.where(~F.col("batch_id").between(lo, hi) | F.col("batch_id").isin(again))
    for path, _, _ in state.sets:
        merged = spark.read.parquet(os.path.join(root, path))
        table = table.unionByName(merged.where(~F.col("batch_id").isin(sorted(state.replaced))))
    return table


def compact(spark: SparkSession, root: str, upto: int | None = None) -> tuple[int, int] | None:
    """Merge the batches that aren't merged yet, up to ``upto`` (default: all
    but the newest, which a stream may still replay), table by table; returns
    their first and last number.  A failure leaves a set without an entry,
    which nobody reads."""
    # the numbers are read from the folders' names
    newest = spark.read.parquet(os.path.join(root, PROGRESS)).agg(F.max("batch_id").alias("k")).first()["k"]
    last = upto if upto is not None else (newest - 1 if newest is not None else -1)
    done = None
    for name in TABLES:
        # (tables differ where an earlier call failed between them)
        first = max((hi + 1 for _, _, hi in manifest(spark, root, name).sets), default=0)
        if last < first:
            continue
        path = os.path.join(f"{name}_merged", f"{first}-{last}-{uuid.uuid4().hex}")
        rows = _folders(spark, root, name).where(F.col("batch_id").between(first, last))
        # no number of partitions: adaptive execution sizes the files
        rows.repartitionByRange("arrival_seq", "arrival_pos").sortWithinPartitions("arrival_seq", "arrival_pos").write.parquet(os.path.join(root, path))
        _enter(spark, root, name, path, first, last)
        done = min(first, done[0]) if done else first, last
    return done


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders of merged batches that no replay put back; to be
    called when no reader still works on an earlier state."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = 0
    for name in TABLES:
        state = manifest(spark, root, name)
        for _, lo, hi in state.sets:
            for k in set(range(lo, hi + 1)) - state.replaced:
                folder = fs_path(os.path.join(root, name, f"batch_id={k}"))
                fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                gone += bool(fs.delete(folder, True))
    return gone


def decoded_events(spark: SparkSession, root: str) -> DataFrame:
    """K1 as stored: decoded rows of all batches."""
    return read_table(spark, root, EVENTS).where(F.col("status") == DECODED).drop("data", "error", "status")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """K2 as stored."""
    return read_table(spark, root, EVENTS).where(F.col("status") == FAILED).drop("status")
