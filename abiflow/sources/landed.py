"""Landed chain tables: the layouts the engine reads in production.

``land`` writes the chain tables as Parquet under a folder (a shared one on
a cluster), or appends newly arrived rows to them.

* Default, for a subscriber that reads a few new blocks at a time: each table
  is clustered by range of its ``block_number`` (without one, ``tx_hash``), and
  sorted by it, in files of Spark's advisory partition size, so a run's block
  range skips files and row groups by their statistics.  ``tx_hash`` carries a
  bloom filter.  The joins on ``tx_hash`` shuffle the announced blocks' rows.
* ``buckets``, for runs over the whole history: transactions, receipts and
  logs are bucketed and sorted by ``tx_hash`` with the same count, so the
  receipt lookup and the log join read co-located buckets without an exchange.
  A write makes at most ``buckets`` files per table; append rarely, or land
  anew, since every append adds as many.

The number of files follows the data's size (or ``buckets``), never the
number of blocks.  ``Landed.table`` needs no table of an earlier session: a
bucketed table's layout is declared to the session's catalog over its folder
where it isn't known yet.  Its name there is made of the folder and the bucket
count, so two roots never share one; a known table over another folder is an
error.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TX_KEYED = ("transactions", "receipts", "logs")
PLAIN = ("blocks", "subscriptions")
#: Found by transaction hash, so kept in the index.
INDEXED = ("receipts", "logs")
#: Folders that the index of a table is cut into by hash; a lookup of a few
#: hashes reads as many of them at most.
INDEX_BUCKETS = 64


@dataclass
class Landed:
    root: str
    buckets: int | None
    prefix: str  # table-name prefix in the session catalog (bucketed layout)

    def known(self, name: str) -> str:
        """The catalog name of a bucketed table."""
        place = f"{self.root.rstrip('/')}|{self.buckets}"
        return f"{self.prefix}_{hashlib.sha256(place.encode()).hexdigest()[:16]}_{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        path = os.path.join(self.root, name)
        if not (self.buckets and name in TX_KEYED):
            return spark.read.parquet(path)
        known = self.known(name)
        if spark.catalog.tableExists(known):
            _check_location(spark, known, path)
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
            spark.sql(f"CREATE TABLE {known} ({columns}) USING parquet CLUSTERED BY (tx_hash) SORTED BY (tx_hash) "
                      f"INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return spark.table(known)

    def forget(self, spark: SparkSession) -> None:
        """Take the bucketed tables out of the session's catalog; the files stay."""
        for name in TX_KEYED:
            spark.sql(f"DROP TABLE IF EXISTS {self.known(name)}")

    def of(self, spark: SparkSession, name: str, keys: DataFrame) -> DataFrame:
        """The rows of the files that hold any of the ``tx_hash`` values of
        ``keys``, which must be few: the index folders of their hashes are
        read, then the files found.  Files that aren't indexed yet are always
        among them; a table without an index is read whole."""
        whole = self.table(spark, name)
        index, listed = _index_paths(self.root, name)
        if self.buckets or name not in INDEXED or not _exists(spark, listed):
            return whole
        wanted = keys.select(_mark(F.col("tx_hash")).alias("mark")).distinct()
        buckets = [r["b"] for r in wanted.select(_bucket().alias("b")).distinct().collect()]
        found = spark.read.parquet(index).where(F.col("bucket").isin(buckets)).join(F.broadcast(wanted), "mark", "left_semi")
        files = {r["file"] for r in found.select("file").distinct().collect()}
        known = {r["file"] for r in spark.read.parquet(listed).collect()}
        there = {os.path.basename(f) for f in whole.inputFiles()}
        files = sorted(there & files | there - known)
        if not files:
            return whole.where(F.lit(False))
        return spark.read.schema(whole.schema).parquet(*(os.path.join(self.root, name, f) for f in files))


def _index_paths(root: str, name: str) -> tuple[str, str]:
    return os.path.join(root, "index", name), os.path.join(root, "index", f"{name}_files")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(1).collect()
    except AnalysisException:  # no such folder
        return False
    return True


def _mark(tx_hash) -> Column:
    return F.xxhash64(tx_hash)


def _bucket() -> Column:
    return F.pmod("mark", F.lit(INDEX_BUCKETS)).cast("int")


def index_files(spark: SparkSession, root: str, name: str, mode: str = "append") -> None:
    """Bring the index of a landed table up to its files: a row for each file
    and hash in it.  A file is listed once its rows are written, so a landing
    that failed in between is made up for by the next."""
    index, listed = _index_paths(root, name)
    table = spark.read.parquet(os.path.join(root, name))
    files = {os.path.basename(f): f for f in table.inputFiles()}
    if mode == "append" and _exists(spark, listed):
        for r in spark.read.parquet(listed).collect():
            files.pop(r["file"], None)
    if not files:
        return
    rows = spark.read.schema(table.schema).parquet(*files.values())
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    marks = rows.select(_mark(F.col("tx_hash")).alias("mark"), file.alias("file")).distinct().withColumn("bucket", _bucket())
    marks.repartition("bucket").sortWithinPartitions("bucket", "mark").write.mode(mode).partitionBy("bucket").parquet(index)
    spark.createDataFrame([(f,) for f in sorted(files)], "file string").coalesce(1).write.mode(mode).parquet(listed)


def _bare(path: str) -> str:
    """A path without the local scheme and trailing slashes."""
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def _check_location(spark: SparkSession, known: str, path: str) -> None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {known}").where("col_name = 'Location'").collect()
    found = rows[0]["data_type"] if rows else ""
    if not _bare(found).endswith(_bare(path)):
        raise RuntimeError(f"table {known} lies in {found}, not in {path}")


def _write_bucketed(df: DataFrame, path: str, table: str, buckets: int, mode: str, dealt: bool = False) -> None:
    rows = df if dealt else df.repartition(buckets, "tx_hash")
    writer = rows.write.mode(mode).bucketBy(buckets, "tx_hash").sortBy("tx_hash")
    # (payloads are mostly zeros)
    writer.option("path", path).option("compression", "zstd").saveAsTable(table)


def _write_clustered(df: DataFrame, path: str, mode: str, transactions: DataFrame | None) -> None:
    columns = df.columns
    keys = [c for c in ("block_number", "tx_hash") if c in columns][:1]
    if keys == ["tx_hash"] and transactions is not None:
        at = transactions.groupBy("tx_hash").agg(F.min("block_number").alias("_block"))
        df = df.join(at, "tx_hash", "left")
        keys = ["_block", "tx_hash"]
    if keys:
        # no number of partitions: adaptive execution sizes them
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*columns)
    writer = df.write.mode(mode).option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in ("tx_hash", "block_hash"):  # looked up by value
        if c in columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def land(tables: dict[str, DataFrame], root: str, buckets: int | None = None,
         prefix: str = "chain", mode: str = "overwrite", dealt: tuple[str, ...] = ()) -> Landed:
    """Write ``tables`` (names as in ``TX_KEYED`` + ``PLAIN``) under ``root``;
    ``mode`` "append" adds rows that arrived since.  ``dealt``: bucketed tables
    whose rows a shuffle by ``tx_hash`` into as many partitions as buckets has
    just dealt out, so that none is moved again to have few files."""
    landed = Landed(root, buckets, prefix)
    for name, df in tables.items():
        path = os.path.join(root, name)
        if not (buckets and name in TX_KEYED):
            _write_clustered(df, path, mode, tables.get("transactions") if name in INDEXED else None)
            if name in INDEXED:
                index_files(df.sparkSession, root, name, mode)
            continue
        if mode == "append":
            landed.table(df.sparkSession, name)  # declared, also in a new session
        _write_bucketed(df, path, landed.known(name), buckets, mode, name in dealt)
    return landed
