"""Structured Streaming run of the plan (O2, A1-A3, U1).

Block announcements land as Parquet files in a folder, in arrival order,
each row carrying its ``arrival_seq``.  The stream reads them with a file
source and runs the batch plan on every micro-batch inside
``foreachBatch``: the block, transaction, receipt and log tables are read as
tables when the micro-batch runs (the reference likewise looks blocks and
receipts up at processing time; no stream-stream join waits for late
receipts).  The plan needs several aggregates and a whole-batch cut, which a
streaming DataFrame refuses but a micro-batch DataFrame allows.

A missing block stops the stream: the micro-batch writes everything
announced before it, then raises.  The batch is then not committed, so a
restart replays it and its sink partitions are rewritten (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import blocks as B
from ..operators import match as M
from ..operators.decode_events import Decoder
from ..plans.pipeline import ChainInput, PreparedSubscriptions, RunOutput, prepare_subscriptions, run_batch
from ..sources.landed import Landed
from ..sources.sinks import write_run

NUMBER_NOTICE_SCHEMA = T.StructType(
    [T.StructField("arrival_seq", T.LongType()), T.StructField("block_number", T.LongType())]
)
HASH_NOTICE_SCHEMA = T.StructType(
    [T.StructField("arrival_seq", T.LongType()), T.StructField("hashes", T.ArrayType(T.StringType()))]
)


#: A consumer of a micro-batch's rows: called with them and the batch number,
#: again with the same number when the micro-batch is replayed.
Consumer = Callable[[DataFrame, int], None]


class BlockNotFound(RuntimeError):
    """An announced block is not in the block table: the run stops."""


@dataclass
class StaticTables:
    """Lookup tables, re-read by every micro-batch."""

    blocks: Callable[[], DataFrame]
    transactions: Callable[[], DataFrame]
    receipts: Callable[[], DataFrame]
    logs: Callable[[], DataFrame]
    # those of a few transactions only, see ``ChainInput``
    receipts_of: Callable[[DataFrame], DataFrame] | None = None
    logs_of: Callable[[DataFrame], DataFrame] | None = None


def landed_tables(spark: SparkSession, landed: Landed) -> StaticTables:
    """The landed tables, receipts and logs by the files' index."""
    table = lambda name: lambda: landed.table(spark, name)
    of = lambda name: lambda keys: landed.of(spark, name, keys)
    return StaticTables(table("blocks"), table("transactions"), table("receipts"), table("logs"), of("receipts"), of("logs"))


def notice_schema(mode: str) -> T.StructType:
    return NUMBER_NOTICE_SCHEMA if mode == B.NUMBER else HASH_NOTICE_SCHEMA


def readable(spark: SparkSession, folder: str, mode: str) -> bool:
    """Whether announcements can be read from ``folder``: not if it is
    missing, not reachable or holds anything else."""
    try:
        spark.read.schema(notice_schema(mode)).parquet(folder).limit(1).collect()
    except Exception:  # noqa: BLE001 - any error means the other mode, as with a node without push
        return False
    return True


def choose_mode(spark: SparkSession, number_folder: str | None, hash_folder: str | None) -> tuple[str, str]:
    """A3: announcements by number (push) when they can be read, on any error
    by hash (poll).  Returns ``(mode, folder)``."""
    if number_folder and readable(spark, number_folder, B.NUMBER):
        return B.NUMBER, number_folder
    if hash_folder and readable(spark, hash_folder, B.HASH):
        return B.HASH, hash_folder
    raise FileNotFoundError(f"no announcement folder: {number_folder!r} or {hash_folder!r}")


def read_notices(spark: SparkSession, folder: str, mode: str = B.NUMBER,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A1/A2: the announcement stream over a landing folder."""
    reader = spark.readStream.schema(notice_schema(mode))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def batch_runner(tables: StaticTables, prepared: PreparedSubscriptions, sink_root: str,
                 mode: str = B.NUMBER, strategy: str = M.JOIN, decoder: Decoder | None = None,
                 on_blocks: Consumer | None = None, on_matches: Consumer | None = None):
    """The per-micro-batch function given to ``foreachBatch``: writes the run
    tables, then hands the blocks found, with their transactions, to
    ``on_blocks`` (U1) and every (log, event filter) match with its raw
    ``data`` to ``on_matches`` (U2), whose rows are those that were written.
    An exception of a consumer fails the micro-batch, which is replayed."""

    def consume(out: RunOutput, batch_id: int) -> None:
        if on_blocks is not None:
            on_blocks(out.blocks, batch_id)
        if on_matches is not None:
            on_matches(out.matches, batch_id)

    def run(notices: DataFrame, batch_id: int) -> None:
        # several tables are written from one micro-batch: read it once
        notices = notices.persist(StorageLevel.MEMORY_AND_DISK)
        out = None
        try:
            inp = ChainInput(notices, tables.blocks(), tables.transactions(), tables.receipts(), tables.logs(),
                             prepared.subs.validated, mode, tables.receipts_of, tables.logs_of)
            out = run_batch(inp, strategy=strategy, decoder=decoder, prepared=prepared)
            if on_matches is not None:  # decoded and consumed from one evaluation
                out.held.append(out.matches.persist(StorageLevel.MEMORY_AND_DISK))
            stopped = write_run(out, sink_root, batch_id)
            consume(out, batch_id)
        finally:
            if out is not None:
                out.release()
            notices.unpersist()
        if stopped:
            raise BlockNotFound(f"micro-batch {batch_id}: an announced block is missing; run stopped")

    return run


def run_stream(spark: SparkSession, notice_folder: str, tables: StaticTables, subscriptions: DataFrame,
               sink_root: str, checkpoint: str, mode: str = B.NUMBER, strategy: str = M.JOIN,
               decoder: Decoder | None = None, max_files_per_trigger: int | None = None,
               available_now: bool = True, strict: bool = True, every: str = "5 seconds",
               on_blocks: Consumer | None = None, on_matches: Consumer | None = None):
    """O2: start the stream; with ``available_now`` it processes what has
    landed and returns when done, otherwise it looks for new announcements
    ``every`` so often."""
    prepared = prepare_subscriptions(subscriptions, strict=strict)  # persisted for the query's life
    writer = (
        read_notices(spark, notice_folder, mode, max_files_per_trigger)
        .writeStream.foreachBatch(batch_runner(tables, prepared, sink_root, mode, strategy, decoder, on_blocks, on_matches))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    query = writer.start()
    if available_now:
        try:
            query.awaitTermination()
        finally:
            prepared.unpersist()
    return query


def run_subscriber(spark: SparkSession, number_folder: str | None, hash_folder: str | None,
                   tables: StaticTables, subscriptions: DataFrame, sink_root: str, checkpoint: str, **kw):
    """A3 + O2: pick the announcement mode from the landing folders, then
    run the stream.  Returns ``(mode, query)``."""
    mode, folder = choose_mode(spark, number_folder, hash_folder)
    return mode, run_stream(spark, folder, tables, subscriptions, sink_root, checkpoint, mode=mode, **kw)


def land_notices(notices: DataFrame, folder: str, chunks: int) -> None:
    """Land announcements in arrival order as ``chunks`` files, one write
    each, so the file source sees them in order (test and bench helper)."""
    bounds = notices.selectExpr("min(arrival_seq) AS lo", "max(arrival_seq) AS hi").first()
    if bounds.lo is None:
        return
    lo, hi = bounds.lo, bounds.hi
    step = (hi - lo) // chunks + 1
    for i in range(chunks):
        a, b = lo + i * step, lo + (i + 1) * step
        notices.where((notices.arrival_seq >= a) & (notices.arrival_seq < b)).coalesce(1).write.mode(
            "append"
        ).parquet(folder)
