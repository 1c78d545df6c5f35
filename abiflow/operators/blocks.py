"""Block notices -> block lookup (A4, A5, A7), missing-block fail-stop (A6,
J6) and block-received progress rows (K5).

Notices are one row per announcement.  By number: ``(arrival_seq,
block_number)``; by hash: ``(arrival_seq, hashes ARRAY<STRING>)``, a poll
batch that is flattened in order (``arrival_pos``).  ``(arrival_seq,
arrival_pos)`` orders announcements; a block announced twice is processed
twice.

A missing block ends the run: everything announced before it is processed,
nothing after it.  The cut is the first missing announcement, evaluated once
and compared as a literal -- no cross join, no global sort.

The lookup is sized by the announcements: they are counted first and, within
the bound, broadcast to the block table, whose rows are met where they are
read; only the announced blocks' rows move on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .broadcast import DEFAULT_MAX_ROWS, broadcast_if

ARRIVAL = ["arrival_seq", "arrival_pos"]
#: Transactions of a block that are given to a consumer in one row.
PART_TRANSACTIONS = 10_000
NUMBER = "number"
HASH = "hash"


@dataclass
class BlockLookup:
    found: DataFrame  # (arrival_seq, arrival_pos, block_number, block_hash), before the cut
    progress: DataFrame  # K5: (arrival_seq, arrival_pos, block_number)
    missing: DataFrame  # A6 error row: (arrival_seq, arrival_pos, block_number, block_hash, error)
    announcements: DataFrame  # one row per announced block (flattened notices)
    n_announcements: int
    stopped: bool  # whether an announced block is missing
    # (lowest, highest) number of the blocks found; None when none was found
    block_range: tuple[int, int] | None


def flatten_hash_notices(notices: DataFrame) -> DataFrame:
    """A7: one row per announced hash, order kept in ``arrival_pos``."""
    return notices.select(
        "arrival_seq", F.posexplode("hashes").alias("arrival_pos", "block_hash")
    )


def number_notices(notices: DataFrame) -> DataFrame:
    return notices.select("arrival_seq", F.lit(0).alias("arrival_pos"), "block_number")


def _one_block(n: DataFrame, heads: DataFrame, key: str, value: str, few: bool) -> DataFrame:
    """Each announcement with at most one block: of several rows found for it
    (a landing that was retried, a number that was reorganised) the one with
    the highest ``version``, where the block table has that column, then the
    highest value.  Only rows of announced blocks are grouped."""
    found = heads.join(broadcast_if(n, few), key)
    best = found.groupBy(*ARRIVAL, key).agg(F.max(F.struct("version", value))[value].alias(value))
    looked = n.join(broadcast_if(best, few), [*ARRIVAL, key], "left")
    return looked.select(*ARRIVAL, "block_number", "block_hash")


def lookup_blocks(notices: DataFrame, blocks: DataFrame, mode: str = NUMBER, max_rows: int = DEFAULT_MAX_ROWS) -> BlockLookup:
    """Look the announced blocks up and apply the fail-stop.

    Two small jobs run here: a count of the announcements (with the range of
    announced numbers, a filter that reaches the block scan), and one
    aggregate that returns the first missing announcement and the range of
    the blocks found.  Their results are literals of the plans, so writing
    several run tables repeats neither."""
    version = F.col("version") if "version" in blocks.columns else F.lit(None).cast("bigint")
    heads = blocks.select("block_number", "block_hash", version.alias("version"))
    if mode == NUMBER:
        n, key, value = number_notices(notices), "block_number", "block_hash"
        message = F.concat(F.lit("BlockNotFoundForNumber: "), F.coalesce(F.col("block_number").cast("string"), F.lit("null")))
    elif mode == HASH:
        n, key, value = flatten_hash_notices(notices), "block_hash", "block_number"
        message = F.concat(F.lit("BlockNotFound: "), F.coalesce(F.col("block_hash"), F.lit("null")))
    else:
        raise ValueError(f"unknown notice mode {mode!r}")
    n = n.distinct()
    size = n.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if mode == NUMBER and size["lo"] is not None:
        heads = heads.where(F.col("block_number").between(F.lit(size["lo"]), F.lit(size["hi"])))
    looked = _one_block(n, heads, key, value, size["n"] <= max_rows)
    missing_flag = F.col(value).isNull()

    at = F.struct(*ARRIVAL)
    missing_all = looked.where(missing_flag)
    found_number = F.when(~missing_flag, F.col("block_number"))
    r = looked.agg(
        F.min(F.when(missing_flag, at)).alias("first"), F.min(found_number).alias("lo"), F.max(found_number).alias("hi")
    ).first()
    stopped = r["first"] is not None
    if stopped:
        first_missing = F.struct(F.lit(r["first"]["arrival_seq"]).cast("bigint").alias("arrival_seq"),
                                 F.lit(r["first"]["arrival_pos"]).cast("int").alias("arrival_pos"))
        before, at_or_before, no_missing = at < first_missing, at <= first_missing, at == first_missing
    else:
        before = at_or_before = F.lit(True)
        no_missing = F.lit(False)

    found = looked.where(~missing_flag & before)
    missing = missing_all.where(no_missing).withColumn("error", message)
    if mode == NUMBER:
        # the notice is logged before the lookup, so the missing one shows too
        progress = looked.where(at_or_before).select(*ARRIVAL, "block_number")
    else:
        progress = found.select(*ARRIVAL, "block_number")
    block_range = (r["lo"], r["hi"]) if r["lo"] is not None else None
    return BlockLookup(found, progress, missing, n, size["n"], stopped, block_range)


def whole_blocks(found: DataFrame, transactions: DataFrame, small: bool = False,
                 part_transactions: int = PART_TRANSACTIONS) -> DataFrame:
    """U1: every found block with its transactions in order, as a node
    returns it: (arrival_seq, arrival_pos, block_number, block_hash, part,
    transactions ARRAY<STRUCT<tx_index, tx_hash, to>>).  A block of very many
    transactions is several rows (``part`` from 0), none of more than
    ``part_transactions`` positions; a block without any has one, empty."""
    keys = [*ARRIVAL, "block_number", "block_hash"]
    t = transactions.join(broadcast_if(found, small), ["block_number", "block_hash"])
    one = F.struct("tx_index", "tx_hash", "to")
    # (a set: a transaction that was landed twice counts once)
    parts = t.groupBy(*keys, F.floor(F.col("tx_index") / part_transactions).alias("slice")).agg(F.sort_array(F.collect_set(one)).alias("transactions"))
    kind = parts.schema["transactions"].dataType.simpleString()
    # parts are numbered without gaps, over the few rows of one block
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("slice")) - 1
    every = found.select(*keys).join(parts, keys, "left")
    return every.select(*keys, place.alias("part"), F.coalesce("transactions", F.array().cast(kind)).alias("transactions"))


def prune_to_blocks(df: DataFrame, lookup: BlockLookup) -> DataFrame:
    """Keep only rows of the looked-up blocks' number range, when ``df`` has
    a ``block_number`` column.  For transactions only: they are joined to the blocks by that number, while receipts and
    logs are found by ``tx_hash`` alone, wherever they are filed.  The range filter
    reaches the Parquet scan, where files clustered by block number
    (``sources.landed``) are skipped by their statistics, so a micro-batch of
    a few blocks reads those blocks' rows, not the whole history."""
    if "block_number" not in df.columns:
        return df
    if lookup.block_range is None:
        return df.where(F.lit(False))
    lo, hi = lookup.block_range
    return df.where(F.col("block_number").between(F.lit(lo), F.lit(hi)))
