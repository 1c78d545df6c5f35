"""The whole plan: announcements -> blocks -> subscribed txs -> receipts ->
logs -> matches -> decoded events (O1, O3, U1-U3).

``run_batch`` builds DataFrames; while it does, it evaluates the announcement
lookup, the size checks of the broadcast sides and the distinct type lists
that the decoder is compiled for, and nothing else.  The same function
runs on a static table of announcements (batch) and on each micro-batch of
a stream (``streaming.stream``).

Input tables (flat, one row per item):

* ``notices``: ``(arrival_seq, block_number)`` by number, or
  ``(arrival_seq, hashes ARRAY<STRING>)`` by hash;
* ``blocks (block_number, block_hash)``;
* ``transactions (block_number, block_hash, tx_index, tx_hash, to)``;
* ``receipts (tx_hash, ..)``: one row per receipt that exists;
* ``logs (tx_hash, log_index, address, topics ARRAY<STRING>, data BINARY)``;
* ``subscriptions (subscription_ord, contract_address, events ARRAY<STRING>)``.

Order of the output (O1) is the key ``(arrival_seq, arrival_pos, tx_index,
log_index, event_ord)``; it is kept as columns and applied only by a reader
that needs it, never as a global sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import match as M
from ..operators.broadcast import DEFAULT_MAX_ROWS
from ..operators.decode_events import Decoder, decode_mixed
from ..operators.subscriptions import Subscriptions, prepare

ORDER_KEY = ["arrival_seq", "arrival_pos", "tx_index", "log_index", "event_ord"]
#: Announcements up to which a run is taken for a micro-batch, whose
#: transactions are counted, and those up to which they are broadcast to the
#: receipts and logs (about 300 bytes each).
MICRO_BATCH = 10_000
FEW_TRANSACTIONS = 200_000
MATCH_COLUMNS = [
    "arrival_seq", "arrival_pos", "block_number", "tx_index", "tx_hash", "log_index",
    "event_ord", "event_name", "signature", "type_key",
]


@dataclass
class ChainInput:
    notices: DataFrame
    blocks: DataFrame
    transactions: DataFrame
    receipts: DataFrame
    logs: DataFrame
    subscriptions: DataFrame
    mode: str = B.NUMBER
    # receipts and logs of a few transactions (a DataFrame with ``tx_hash``),
    # where the tables' layout can tell their files apart (``Landed.of``)
    receipts_of: Callable[[DataFrame], DataFrame] | None = None
    logs_of: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class PreparedSubscriptions:
    """The subscription catalogue plus the config-sized facts the plan is
    built from: the distinct type lists, and the row counts that bound the
    broadcast sides.  The catalogue is persisted (it
    is small and every run reads it, so the keccak UDF runs once); call
    ``unpersist`` when done."""

    subs: Subscriptions
    type_keys: list[str]
    n_addresses: int
    n_filters: int
    hashes: list[str] | None = None  # the filters' different hashes, if few

    def small_addresses(self, max_rows: int = DEFAULT_MAX_ROWS) -> bool:
        return self.n_addresses <= max_rows

    def small_filters(self, strategy: str = M.JOIN, max_rows: int = DEFAULT_MAX_ROWS) -> bool:
        coded = strategy == M.JOIN and self.hashes
        return self.n_filters <= max_rows * (M.CODED_FILTERS if coded else 1)

    def unpersist(self) -> None:
        self.subs.addresses.unpersist()
        self.subs.filters.unpersist()


def prepare_subscriptions(subscriptions: DataFrame, strict: bool = True) -> PreparedSubscriptions:
    subs = prepare(subscriptions, strict=strict)
    subs.addresses.persist(StorageLevel.MEMORY_AND_DISK)
    subs.filters.persist(StorageLevel.MEMORY_AND_DISK)
    # one pass over the (persisted) filters; only valid subscriptions reach
    # them, so every type list is set
    rows = subs.filters.groupBy("type_key").count().collect()
    hashes = [r.hash for r in subs.filters.select("hash").distinct().limit(M.FEW_HASHES + 1).collect()]
    return PreparedSubscriptions(subs, sorted(r.type_key for r in rows), subs.addresses.count(), sum(r["count"] for r in rows),
                                 sorted(hashes) if len(hashes) <= M.FEW_HASHES else None)


@dataclass
class RunOutput:
    subscriptions: Subscriptions
    type_keys: list[str]
    progress: DataFrame  # K5
    block_error: DataFrame  # A6: the announcement that stopped the run, if any
    receipt_errors: DataFrame  # K4
    matches: DataFrame  # K3 (+ data, to decode)
    events: DataFrame  # every match + params + error
    blocks: DataFrame  # U1: every announced block that was found, before the stop, with its transactions
    stopped: bool  # an announced block is missing
    prepared: PreparedSubscriptions | None = None
    # subscribed, announced txs (with their receipt flag), shared by K1-K4
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Drop what the run persisted, once its tables have been read or
        written."""
        for df in self.held:
            df.unpersist()
        if self.prepared is not None:
            self.prepared.unpersist()

    def decoded(self) -> DataFrame:
        """K1: rows that decoded."""
        return self.events.where(F.col("error").isNull()).drop("data", "error")

    def dead_letters(self) -> DataFrame:
        """K2: rows that failed to decode, with the raw payload."""
        return self.events.where(F.col("error").isNotNull()).drop("params")

    def consume(self, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """U2: a per-match consumer, as a DataFrame -> DataFrame function over
        every (log, event filter) match with its raw ``data``."""
        return self.matches.transform(fn)

    def match_notices(self) -> DataFrame:
        """K3: event name + tx hash per match, before decode."""
        return self.matches.select(*MATCH_COLUMNS)


def run_batch(inp: ChainInput, strict: bool = True, strategy: str = M.JOIN,
              decoder: Decoder | None = None, prepared: PreparedSubscriptions | None = None,
              max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> RunOutput:
    """The whole plan over ``inp``.  ``max_broadcast_rows`` bounds every
    broadcast side (addresses, filters, found blocks, receipt gaps), each on
    its own; beyond it the joins are shuffle joins planned by Spark and AQE.
    Filters that are coded by their hash's place count a third."""
    p = prepared if prepared is not None else prepare_subscriptions(inp.subscriptions, strict=strict)
    looked = B.lookup_blocks(inp.notices, inp.blocks, inp.mode, max_broadcast_rows)

    # F1 + F2 + J2 before anything is joined to the big tables: only txs sent
    # to a subscribed address go on to the receipt lookup.
    small_addresses = p.small_addresses(max_broadcast_rows)
    # only the announced blocks' transactions are read; receipts and logs are
    # found by tx_hash, whatever block they are filed under
    transactions = B.prune_to_blocks(inp.transactions, looked)
    sub_txs = M.subscribed_transactions(transactions, p.subs.addresses, small_addresses)
    # The found blocks and the per-block receipt gaps each hold at most one
    # row per announcement, so their count proves both broadcastable.
    small = looked.n_announcements <= max_broadcast_rows
    rows = M.announced(sub_txs, looked.found, small)
    held = []
    few = False
    if looked.n_announcements <= MICRO_BATCH:
        held.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        few = rows.count() <= min(FEW_TRANSACTIONS, max_broadcast_rows)
    receipts, logs = inp.receipts, inp.logs
    if few:  # read from the files that hold their transactions
        receipts = inp.receipts_of(rows.select("tx_hash")) if inp.receipts_of else receipts
        logs = inp.logs_of(rows.select("tx_hash")) if inp.logs_of else logs
    # one evaluation for the gaps and for the rows they leave
    rows = M.with_receipts(rows, receipts, few).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(rows)
    kept, receipt_errors = M.receipt_gap_cut(rows, small)

    small_filters = p.small_filters(strategy, max_broadcast_rows)
    matches = M.match_logs(kept, logs, p.subs.filters, strategy=strategy, small_filters=small_filters, few=few, hashes=p.hashes)

    events = (decoder or decode_mixed)(matches.select(*MATCH_COLUMNS, "data"), p.type_keys)
    blocks = B.whole_blocks(looked.found, transactions, small)
    return RunOutput(p.subs, p.type_keys, looked.progress, looked.missing, receipt_errors, matches, events, blocks,
                     looked.stopped, prepared=p if prepared is None else None, held=held)
