"""Landings that are retried, late or replayed; configuration positions."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from abiflow.operators import blocks as B
from abiflow.operators.subscriptions import ConfigurationError, prepare, validate
from abiflow.plans.pipeline import run_batch
from abiflow.sources import sinks
from abiflow.streaming.stream import StaticTables, land_notices, run_stream
from test_behaviours import A1, SIG_T
from test_stream import event_keys, fixture, tables

SUBS = "subscription_ord bigint, contract_address string, events array<string>"


def test_a_number_with_two_blocks_is_processed_once(spark):
    blocks = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (2, "c", 1)], "block_number bigint, block_hash string, version int")
    notices = spark.createDataFrame([(0, 1), (1, 2), (2, None)], "arrival_seq bigint, block_number bigint")
    got = B.lookup_blocks(notices, blocks)
    assert sorted((r.block_number, r.block_hash) for r in got.found.collect()) == [(1, "b"), (2, "c")]
    assert [r.error for r in got.missing.collect()] == ["BlockNotFoundForNumber: null"]


def test_a_receipt_landed_twice_and_one_filed_elsewhere(spark):
    from pyspark.sql import functions as F

    inp = fixture(spark, [(i, b) for i, b in enumerate(range(1, 9))])
    want = event_keys(run_batch(inp).events)
    filed = inp.receipts.withColumn("block_number", F.when(F.col("tx_hash") == "t1_0", F.lit(99)))
    inp.receipts = filed.union(filed.where("tx_hash like 't2%'"))
    inp.logs = inp.logs.withColumn("block_number", F.lit(None).cast("bigint"))
    assert event_keys(run_batch(inp).events) == want


def test_a_stopped_stream_goes_on_when_the_block_lands(spark):
    root = tempfile.mkdtemp(prefix="abiflow-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    inp = fixture(spark, [(0, 1), (1, 2), (2, 3)])
    land_notices(inp.notices, os.path.join(root, "in"), 1)
    late = StaticTables(lambda: inp.blocks.where("block_number <> 2"), *list(vars(tables(inp)).values())[1:])
    args = lambda t: (spark, os.path.join(root, "in"), t, inp.subscriptions, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    with pytest.raises(StreamingQueryException):
        run_stream(*args(late))
    assert sinks.read_table(spark, os.path.join(root, "out"), sinks.BLOCK_ERRORS).count() == 1
    run_stream(*args(tables(inp)))
    assert sinks.read_table(spark, os.path.join(root, "out"), sinks.BLOCK_ERRORS).count() == 0
    assert event_keys(sinks.read_table(spark, os.path.join(root, "out"), sinks.EVENTS)) == event_keys(run_batch(inp).events)


def test_positions_that_are_missing_or_repeated(spark):
    subs = spark.createDataFrame(
        [(None, A1, ["T(uint24)"]), (1, A1, [SIG_T]), (1, A1, ["T(uint24)"]), (2, A1, ["T(uint24)"]), (3, A1, [SIG_T])], SUBS
    )
    got = sorted(((r.subscription_ord or 0, r.error or "") for r in validate(subs).collect()))
    assert got == [
        (0, "MissingField: subscription_ord"), (1, "RepeatedField: subscription_ord 1"), (1, "RepeatedField: subscription_ord 1"),
        (2, "InvalidEvent: T(uint24): UnsupportedDataType: uint24"), (3, ""),
    ]
    with pytest.raises(ConfigurationError, match="of 4"):
        prepare(subs)


def test_a_filter_on_a_key_passes_the_decode(spark):
    inp = fixture(spark, [(0, 1)])
    out = run_batch(inp)
    plan = out.decoded().where("tx_hash = 't1_0'")._jdf.queryExecution().optimizedPlan().toString()
    decode = plan.find("Generate inline")
    assert decode >= 0 and plan.count("Generate inline") == 1
    assert "= t1_0" not in plan[:decode] and "= t1_0" in plan[decode:]
    assert {r.tx_hash for r in out.decoded().where("tx_hash = 't1_0'").collect()} == {"t1_0"}
