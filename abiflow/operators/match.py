"""Transactions -> subscribed transactions -> receipts -> logs -> matches.

F1-F5, J2-J6, A10, A11.  Tables (flat, one row per item):

* ``transactions (block_number, block_hash, tx_index, tx_hash, to)``
* ``receipts (tx_hash, ..)`` -- one row per receipt that exists
* ``logs (tx_hash, log_index, address, topics ARRAY<STRING>, data BINARY)``

Shuffle plan: the subscription side is config-sized and broadcast after a
bounded count.  Where the announced transactions are counted and few (``few``),
as in a micro-batch, they are broadcast to the receipts and the logs, which are
met where they are read: neither table is shuffled, only what belongs to the
announced transactions moves on.  Otherwise these joins are on ``tx_hash``
(uniformly hashed, no hot key), where AQE splits skewed partitions, and logs
are cut to those carrying a subscribed hash before they are shuffled.  Within
``FEW_HASHES`` a log is tested where it is read and moves once, with the
hashes it carries, whatever their number, and a filter is its address and the
place of its hash among the few: ``CODED_FILTERS`` times as many are broadcast,
so that no match is moved by its address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .broadcast import broadcast_if, broadcast_if_bounded

ARRIVAL = ["arrival_seq", "arrival_pos"]
RECEIPT_NOT_FOUND = "ReceiptNotFound: "
EXPLODE = "explode"
JOIN = "join"
#: Different subscribed hashes up to which they are literals of the plan.
FEW_HASHES = 64
#: Filters that take as many bytes as one with its texts (about 450 in a
#: broadcast), where the texts are found by the place of the hash (about 140).
CODED_FILTERS = 3


def _bcast(df: DataFrame, small: bool | None) -> DataFrame:
    """Broadcast under a bound the caller proved, else count it here."""
    return broadcast_if_bounded(df) if small is None else broadcast_if(df, small)


def subscribed_transactions(transactions: DataFrame, addresses: DataFrame, small: bool | None = None) -> DataFrame:
    """F1 + F2 + J2: drop contract creations, keep txs sent to a subscribed
    address (first subscription per address, see J1)."""
    subs = _bcast(addresses.withColumnRenamed("contract_address", "to"), small)
    return transactions.where(F.col("to").isNotNull()).join(subs, "to")


def announced(sub_txs: DataFrame, found_blocks: DataFrame, small: bool = False) -> DataFrame:
    """Attach the announcement(s) that brought each block in.  ``small``:
    the announcements are proven few, so the found blocks are broadcast and
    the transaction side keeps its partitioning."""
    return sub_txs.join(broadcast_if(found_blocks, small), ["block_number", "block_hash"])


def with_receipts(rows: DataFrame, receipts: DataFrame, few: bool = False) -> DataFrame:
    """A10 + J3: left lookup of the receipt, ``has_receipt`` false when
    absent.  A receipt that was landed twice counts once.  ``few``: the rows
    are proven few, so only their receipts are made distinct."""
    r = receipts.select("tx_hash")
    if few:
        r = r.join(F.broadcast(rows.select("tx_hash")), "tx_hash", "left_semi")
    r = broadcast_if(r.distinct().withColumn("has_receipt", F.lit(True)), few)
    return rows.join(r, "tx_hash", "left").withColumn(
        "has_receipt", F.coalesce(F.col("has_receipt"), F.lit(False))
    )


def receipt_gap_cut(rows: DataFrame, small: bool = False) -> tuple[DataFrame, DataFrame]:
    """J5 + J6 + K4: per announced block, subscribed txs after the first
    missing receipt are dropped; one error row per such block.

    The gap is a grouped ``min`` (partial aggregation, one row per block with
    a gap) joined back on the announcement key -- no window, so a block with
    very many subscribed txs is never gathered into one task.  The gap table
    has at most one row per announcement; with ``small`` (few announcements,
    proven by the caller) it is broadcast, so the transaction rows are not
    shuffled on the announcement key and keep their ``tx_hash``
    partitioning for the log join.  Otherwise AQE chooses."""
    gaps = (
        rows.where(~F.col("has_receipt"))
        .groupBy(*ARRIVAL)
        .agg(F.min(F.struct("tx_index", "tx_hash", "block_number")).alias("gap"))
    )
    kept = (
        rows.join(broadcast_if(gaps, small), ARRIVAL, "left")
        .where(F.col("gap").isNull() | (F.col("tx_index") < F.col("gap.tx_index")))
        .drop("gap", "has_receipt")
    )
    errors = gaps.select(
        *ARRIVAL,
        F.col("gap.block_number").alias("block_number"),
        F.col("gap.tx_index").alias("tx_index"),
        F.col("gap.tx_hash").alias("tx_hash"),
        F.concat(F.lit(RECEIPT_NOT_FOUND), F.col("gap.tx_hash")).alias("error"),
    )
    return kept, errors


def candidate_topics(logs: DataFrame, filters: DataFrame, small: bool | None) -> DataFrame:
    """One row per log and subscribed hash among its distinct topics.  Logs
    without one match no filter and are gone before any shuffle: the hashes
    are config-sized and broadcast under the filters' bound."""
    hashes = _bcast(filters.select("hash").distinct(), small)
    topics = logs.select("tx_hash", "log_index", "data", F.explode(F.array_distinct("topics")).alias("hash"))
    return topics.join(hashes, "hash")


def match_logs(kept: DataFrame, logs: DataFrame, filters: DataFrame,
               strategy: str = JOIN, small_filters: bool | None = None, few: bool = False,
               hashes: list[str] | None = None) -> DataFrame:
    """A11 + F3 + J4 + F5: one row per (log, event filter) where the filter's
    hash is in the log's topics (any position, counted once per filter), one
    row also where a log was landed twice (of differing payloads the greatest).

    ``join``: explode the distinct topics and equi-join (address, hash) to
    the broadcast filters; ``explode``: explode each tx's filters and test
    ``array_contains``.  Same rows either way.  ``few``: the transactions are
    proven few, so they meet the logs before anything of these is exploded or
    moved.  ``hashes``: every hash of the filters, where they are few; with
    ``join``, ``small_filters`` then bounds their coded rows."""
    f = filters.withColumnRenamed("contract_address", "to").drop("subscription_ord")
    if few:
        mine = logs.select("tx_hash", "log_index", "topics", "data").join(F.broadcast(kept.select("tx_hash")), "tx_hash", "left_semi")
        kept, logs = F.broadcast(kept), mine
    if strategy == JOIN:
        if hashes:
            every = F.array(*[F.lit(h) for h in hashes])
            place = F.array_position(every, F.col("hash")).cast("int").alias("place")
            carried = F.array_intersect("topics", every)
            mine = logs.select("tx_hash", "log_index", "data", carried.alias("carried")).where(F.size("carried") > 0)
            topics = mine.join(kept, "tx_hash").withColumn("hash", F.explode("carried")).drop("carried")
            # a hash is its signature's, so the texts are a row per hash
            texts = f.select(place, "signature", "event_name", "type_key").distinct()
            coded = _bcast(f.select("to", place, "event_ord"), small_filters)
            out = topics.withColumn("place", place).join(coded, ["to", "place"]).join(F.broadcast(texts), "place")
        else:
            topics = kept.join(candidate_topics(logs, filters, small_filters), "tx_hash")
            out = topics.join(_bcast(f, small_filters), ["to", "hash"])
    elif strategy == EXPLODE:
        per_tx = f.groupBy("to").agg(
            F.collect_list(F.struct("event_ord", "signature", "event_name", "hash", "type_key")).alias("fs")
        )
        out = (
            kept.join(logs.select("tx_hash", "log_index", "topics", "data"), "tx_hash").join(_bcast(per_tx, small_filters), "to")
            .withColumn("f", F.explode("fs"))
            .where(F.array_contains("topics", F.col("f.hash")))
            .select("*", "f.event_ord", "f.signature", "f.event_name", "f.hash", "f.type_key")
            .drop("f", "fs")
        )
    else:
        raise ValueError(f"unknown match strategy {strategy!r}")
    # A transaction or log that was landed twice counts once.  The rows are
    # already partitioned by tx_hash, so this moves nothing; everything but
    # the payload is a grouping key, so filters pass below it.
    keys = [*ARRIVAL, "block_number", "tx_index", "tx_hash", "log_index", "to",
            "subscription_ord", "event_ord", "event_name", "signature", "type_key"]
    return out.groupBy(*keys).agg(F.max("data").alias("data"))

