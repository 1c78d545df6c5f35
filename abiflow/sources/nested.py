"""Nested chain tables, as a node returns them -> the flat tables of a run
(A9, A11).

* ``blocks (block_number, block_hash, transactions ARRAY<STRUCT<tx_hash, to,
  ..>> [, version])``: one row per block landed;
* ``receipts (tx_hash, logs ARRAY<STRUCT<address, topics, data, ..>>)``: one
  row per receipt landed.

A transaction's and a log's index is its position in its array.  Hex text may
carry ``0x`` and capitals; it is made bare lower case here, once, and ``data``
may be BINARY or hex text.  A NULL or empty array has no items; a NULL item
keeps its position but gives no row.  Rows landed twice may stay: the run
counts each (announcement, transaction, log, filter) once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import blocks as B
from ..plans.pipeline import ChainInput


def _digits(text) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    marked = text.startswith("0x") | text.startswith("0X")
    return F.when(marked, F.substr(text, F.lit(3))).otherwise(text)


def bare_hex(text) -> Column:
    """Lower-case hex digits without ``0x``."""
    return F.lower(_digits(text))


def _bytes(data: Column, kind: T.DataType) -> Column:
    return data if isinstance(kind, T.BinaryType) else F.unhex(_digits(data))


def flat_blocks(blocks: DataFrame) -> DataFrame:
    keep = [c for c in ("version",) if c in blocks.columns]
    return blocks.select("block_number", bare_hex("block_hash").alias("block_hash"), *keep)


def block_transactions(blocks: DataFrame) -> DataFrame:
    """A9: the transactions of each block, in order."""
    items = blocks.select("block_number", "block_hash", F.posexplode("transactions").alias("tx_index", "t"))
    return items.where("t IS NOT NULL").select(
        "block_number",
        bare_hex("block_hash").alias("block_hash"),
        F.col("tx_index").cast("bigint").alias("tx_index"),
        bare_hex("t.tx_hash").alias("tx_hash"),
        bare_hex("t.to").alias("to"),
    )


def flat_receipts(receipts: DataFrame) -> DataFrame:
    return receipts.select(bare_hex("tx_hash").alias("tx_hash"))


def receipt_logs(receipts: DataFrame) -> DataFrame:
    """A11: the logs of each receipt, in order."""
    data_type = receipts.schema["logs"].dataType.elementType["data"].dataType
    items = receipts.select("tx_hash", F.posexplode("logs").alias("log_index", "g"))
    return items.where("g IS NOT NULL").select(
        bare_hex("tx_hash").alias("tx_hash"),
        "log_index",
        bare_hex("g.address").alias("address"),
        F.transform("g.topics", bare_hex).alias("topics"),
        _bytes(F.col("g.data"), data_type).alias("data"),
    )


def bare_notices(notices: DataFrame, mode: str) -> DataFrame:
    if mode == B.NUMBER:
        return notices
    return notices.withColumn("hashes", F.transform("hashes", bare_hex))


def nested_input(notices: DataFrame, blocks: DataFrame, receipts: DataFrame, subscriptions: DataFrame,
                 mode: str = B.NUMBER) -> ChainInput:
    """The input of ``run_batch`` from nested blocks and receipts."""
    return ChainInput(
        bare_notices(notices, mode), flat_blocks(blocks), block_transactions(blocks),
        flat_receipts(receipts), receipt_logs(receipts), subscriptions, mode,
    )
