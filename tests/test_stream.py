import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from abiflow.plans.pipeline import run_batch
from abiflow.sources import sinks
from abiflow.streaming.stream import StaticTables, land_notices, run_stream
from test_behaviours import A1, A2, H_T, H_U, SIG_T, SIG_U, chain, payload


def fixture(spark, notices):
    txs = [(b, f"h{b}", i, f"t{b}_{i}", A1 if i % 2 == 0 else A2) for b in range(1, 9) for i in range(3)]
    logs = [(t[3], j, A1, [H_T] if j == 0 else [H_U, H_T], payload(t[0] * 10 + j)) for t in txs for j in range(2)]
    receipts = [t[3] for t in txs if t[3] != "t5_2"]
    return chain(spark, txs, logs, [(0, A1, [SIG_T, SIG_U])], receipts=receipts, notices=notices)


def tables(inp):
    return StaticTables(lambda: inp.blocks, lambda: inp.transactions, lambda: inp.receipts, lambda: inp.logs)


def event_keys(df):
    return sorted((r.arrival_seq, r.tx_hash, r.log_index, r.event_ord, r.error) for r in df.collect())


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="abiflow-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    notices = [(i, b) for i, b in enumerate(range(1, 9))]
    inp = fixture(spark, notices)
    land_notices(inp.notices, os.path.join(root, "in"), 4)
    args = (spark, os.path.join(root, "in"), tables(inp), inp.subscriptions, os.path.join(root, "out"),
            os.path.join(root, "ckpt"))
    run_stream(*args, max_files_per_trigger=1)
    stored = sinks.read_table(spark, os.path.join(root, "out"), sinks.EVENTS)
    assert stored.select("batch_id").distinct().count() == 4
    batch = run_batch(inp)
    assert event_keys(stored) == event_keys(batch.events)
    errs = sinks.read_table(spark, os.path.join(root, "out"), sinks.RECEIPT_ERRORS)
    assert [r.tx_hash for r in errs.collect()] == ["t5_2"]
    # restart from the checkpoint: nothing new landed, nothing added
    run_stream(*args, max_files_per_trigger=1)
    assert sinks.read_table(spark, os.path.join(root, "out"), sinks.EVENTS).count() == stored.count()


def test_missing_block_stops_the_stream_after_the_prefix(spark):
    root = tempfile.mkdtemp(prefix="abiflow-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    notices = [(0, 1), (1, 2), (2, 99), (3, 3)]
    inp = fixture(spark, notices)
    land_notices(inp.notices, os.path.join(root, "in"), 1)
    with pytest.raises(StreamingQueryException, match="BlockNotFound|announced block is missing"):
        run_stream(spark, os.path.join(root, "in"), tables(inp), inp.subscriptions, os.path.join(root, "out"),
                   os.path.join(root, "ckpt"))
    stored = sinks.read_table(spark, os.path.join(root, "out"), sinks.EVENTS)
    assert {r.block_number for r in stored.collect()} == {1, 2}
    [err] = sinks.read_table(spark, os.path.join(root, "out"), sinks.BLOCK_ERRORS).collect()
    assert err.error == "BlockNotFoundForNumber: 99"


def test_mode_choice_prefers_number_then_falls_back_to_hash(spark):
    from abiflow.operators import blocks as B
    from abiflow.streaming.stream import choose_mode

    root = tempfile.mkdtemp(prefix="abiflow-mode-", dir=os.environ.get("TMPDIR", "/tmp"))
    by_number, by_hash = os.path.join(root, "n"), os.path.join(root, "h")
    with pytest.raises(FileNotFoundError):
        choose_mode(spark, by_number, by_hash)
    os.makedirs(by_hash)
    assert choose_mode(spark, by_number, by_hash) == (B.HASH, by_hash)
    os.makedirs(by_number)
    assert choose_mode(spark, by_number, by_hash) == (B.NUMBER, by_number)


def test_consumer_sees_every_match_with_its_payload(spark):
    from pyspark.sql import functions as F

    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    out = run_batch(inp)
    sized = out.consume(lambda m: m.select("tx_hash", "log_index", "event_name", F.length("data").alias("n")))
    assert sized.count() == out.matches.count() == out.events.count()
    assert sized.where("n IS NULL").count() == 0


def test_run_reads_only_the_announced_blocks(spark):
    from abiflow.operators import blocks as B

    inp = fixture(spark, [(0, 3), (1, 4)])
    look = B.lookup_blocks(inp.notices, inp.blocks)
    assert look.block_range == (3, 4) and look.n_announcements == 2 and not look.stopped
    pruned = B.prune_to_blocks(inp.transactions, look)
    assert {r.block_number for r in pruned.collect()} == {3, 4}
    # no block found: nothing is read
    none = B.lookup_blocks(spark.createDataFrame([(0, 99)], "arrival_seq bigint, block_number bigint"), inp.blocks)
    assert none.stopped and B.prune_to_blocks(inp.transactions, none).count() == 0
    # same rows as the whole-table run restricted to those blocks
    out = run_batch(inp)
    assert {r.block_number for r in out.events.collect()} <= {3, 4}


def landed_input(spark, ld, notices):
    from abiflow.plans.pipeline import ChainInput

    g = lambda n: ld.table(spark, n)
    return ChainInput(notices, g("blocks"), g("transactions"), g("receipts"), g("logs"), g("subscriptions"))


def parts_of(inp):
    logs = inp.logs.join(inp.transactions.select("tx_hash", "block_number"), "tx_hash")
    return {"blocks": inp.blocks, "subscriptions": inp.subscriptions, "transactions": inp.transactions,
            "receipts": inp.receipts, "logs": logs}


def files(root, name):
    return [f for f in os.listdir(os.path.join(root, name)) if f.endswith(".parquet")]


@pytest.mark.parametrize("buckets", [None, 4])
def test_landed_tables_give_the_same_run_also_after_an_append(spark, buckets):
    import uuid

    from abiflow.sources import landed as L

    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    root = tempfile.mkdtemp(prefix="abiflow-landed-", dir=os.environ.get("TMPDIR", "/tmp"))
    prefix = "t" + uuid.uuid4().hex[:8]
    parts = parts_of(inp)
    old = {n: df.where("block_number <= 5") if "block_number" in df.columns else df for n, df in parts.items()}
    L.land(old, root, buckets, prefix)
    assert all(len(files(root, n)) <= (buckets or 8) for n in parts)
    # a later session knows nothing of the tables; it finds them by their folder
    for n in L.TX_KEYED:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{n}")
    new = {n: parts[n].where("block_number > 5") for n in ("blocks", "transactions", "logs")}
    ld = L.land(new, root, buckets, prefix, mode="append")
    landed = run_batch(landed_input(spark, ld, inp.notices))
    assert event_keys(landed.events) == event_keys(run_batch(inp).events)
    plan = landed.events._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block_number,1)" in plan  # the block range reaches the scan
    assert ("Bucketed: true" in plan) == bool(buckets)


def test_files_do_not_grow_with_the_number_of_blocks(spark):
    from abiflow.sources import landed as L

    root = tempfile.mkdtemp(prefix="abiflow-landed-", dir=os.environ.get("TMPDIR", "/tmp"))
    many = spark.range(20_000).selectExpr("id AS block_number", "sha2(string(id), 256) AS tx_hash")
    L.land({"transactions": many}, root)
    assert len(files(root, "transactions")) <= 8


def test_stream_hands_blocks_and_matches_to_consumers(spark):
    root = tempfile.mkdtemp(prefix="abiflow-consumers-", dir=os.environ.get("TMPDIR", "/tmp"))
    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    land_notices(inp.notices, os.path.join(root, "in"), 2)
    blocks, matches = {}, {}
    run_stream(spark, os.path.join(root, "in"), tables(inp), inp.subscriptions, os.path.join(root, "out"),
               os.path.join(root, "ckpt"), max_files_per_trigger=1,
               on_blocks=lambda df, k: blocks.update({k: sorted(r.block_number for r in df.collect())}),
               on_matches=lambda df, k: matches.update({k: df.count()}))
    assert blocks == {0: [1, 2, 3, 4], 1: [5, 6, 7, 8]}
    assert sum(matches.values()) == run_batch(inp).matches.count()


def test_block_that_lands_after_the_stop_leaves_no_error(spark):
    root = tempfile.mkdtemp(prefix="abiflow-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    land_notices(inp.notices, os.path.join(root, "in"), 1)
    early = tables(inp)
    early.blocks = lambda: inp.blocks.where("block_number <> 4")
    rest = (inp.subscriptions, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    with pytest.raises(StreamingQueryException):
        run_stream(spark, os.path.join(root, "in"), early, *rest)
    run_stream(spark, os.path.join(root, "in"), tables(inp), *rest)
    assert sinks.read_table(spark, os.path.join(root, "out"), sinks.BLOCK_ERRORS).count() == 0
    stored = sinks.read_table(spark, os.path.join(root, "out"), sinks.EVENTS)
    assert event_keys(stored) == event_keys(run_batch(inp).events)


def test_nested_input_equals_flat_input(spark):
    """Nulls, empty arrays, ``0x`` and capitals, rows landed twice."""
    from pyspark.sql import functions as F

    from abiflow.sources.nested import nested_input

    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    typed = lambda c: F.concat(F.lit("0X"), F.upper(c))
    item = F.struct("tx_index", typed(F.col("tx_hash")).alias("tx_hash"), typed(F.col("to")).alias("to"))
    blocks = inp.transactions.groupBy("block_number", "block_hash").agg(
        F.concat(F.array_sort(F.collect_list(item)), F.array(F.lit(None))).alias("transactions")
    )
    empty = spark.createDataFrame([(50, "h50")], "block_number bigint, block_hash string")
    blocks = blocks.union(blocks).unionByName(empty, allowMissingColumns=True)
    log = F.struct("log_index", "address", F.transform("topics", typed).alias("topics"), typed(F.hex("data")).alias("data"))
    logs = inp.logs.groupBy("tx_hash").agg(F.array_sort(F.collect_list(log)).alias("logs"))
    receipts = inp.receipts.join(logs, "tx_hash", "left").withColumn("tx_hash", typed(F.col("tx_hash")))
    got = run_batch(nested_input(inp.notices, blocks, receipts.union(receipts), inp.subscriptions))
    assert event_keys(got.events) == event_keys(run_batch(inp).events)
    assert [r.tx_hash for r in got.receipt_errors.collect()] == ["t5_2"]
