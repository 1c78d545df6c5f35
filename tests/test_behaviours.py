"""The eight easy-to-get-wrong behaviours on small
hand-built chains."""

import pytest

import abi_model as model
from abiflow.functions.abi_types import parse_type_list
from abiflow.functions.keccak import keccak256
from abiflow.operators import blocks as B
from abiflow.operators import match as M
from abiflow.plans.pipeline import ChainInput, run_batch
from abiflow.streaming.stream import HASH_NOTICE_SCHEMA, NUMBER_NOTICE_SCHEMA

A1 = "a1" * 20
A2 = "b2" * 20
A3 = "c3" * 20
SIG_T = "T(uint256)"
SIG_U = "U(uint256)"
SIG_V = "V(uint256)"
H_T, H_U, H_V = (keccak256([s.encode()])[0].hex() for s in (SIG_T, SIG_U, SIG_V))

TX = "block_number bigint, block_hash string, tx_index bigint, tx_hash string, to string"
LOG = "tx_hash string, log_index int, address string, topics array<string>, data binary"
SUB = "subscription_ord bigint, contract_address string, events array<string>"


def payload(x):
    return bytearray(model.encode(parse_type_list(["uint256"]), [x]))


def chain(spark, txs, logs, subs, receipts=None, notices=None, blocks=None, mode=B.NUMBER):
    blocks = blocks if blocks is not None else sorted({(t[0], t[1]) for t in txs})
    receipts = receipts if receipts is not None else sorted({t[3] for t in txs})
    if notices is None:
        notices = [(i, b[0]) for i, b in enumerate(blocks)]
    schema = NUMBER_NOTICE_SCHEMA if mode == B.NUMBER else HASH_NOTICE_SCHEMA
    return ChainInput(
        spark.createDataFrame(notices, schema),
        spark.createDataFrame(blocks, "block_number bigint, block_hash string"),
        spark.createDataFrame(txs, TX),
        spark.createDataFrame([(r,) for r in receipts], "tx_hash string"),
        spark.createDataFrame(logs, LOG),
        spark.createDataFrame(subs, SUB),
        mode,
    )


def keys(out, strategy_rows=None):
    df = out.events if strategy_rows is None else strategy_rows
    return sorted((r.block_number, r.tx_hash, r.log_index, r.event_name) for r in df.collect())


@pytest.mark.parametrize("strategy", [M.JOIN, M.EXPLODE])
def test_first_subscription_wins(spark, strategy):
    txs = [(1, "h1", 0, "t0", A1)]
    logs = [("t0", 0, A1, [H_T], payload(1)), ("t0", 1, A1, [H_U], payload(2))]
    subs = [(0, "0x" + A1.upper(), [SIG_T]), (1, A1, [SIG_U])]
    out = run_batch(chain(spark, txs, logs, subs), strategy=strategy)
    assert keys(out) == [(1, "t0", 0, "T")]


def test_address_test_is_on_tx_to_not_log_emitter(spark):
    txs = [(1, "h1", 0, "t0", A1), (1, "h1", 1, "t1", A2)]
    logs = [
        ("t0", 0, A3, [H_T], payload(1)),  # other emitter inside a subscribed tx: kept
        ("t1", 0, A1, [H_T], payload(2)),  # subscribed emitter reached through A2: missed
    ]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])]))
    assert keys(out) == [(1, "t0", 0, "T")]


def test_contract_creation_is_dropped(spark):
    txs = [(1, "h1", 0, "t0", None), (1, "h1", 1, "t1", A1)]
    logs = [("t0", 0, A1, [H_T], payload(1)), ("t1", 0, A1, [H_T], payload(2))]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])]))
    assert keys(out) == [(1, "t1", 0, "T")]


@pytest.mark.parametrize("strategy", [M.JOIN, M.EXPLODE])
def test_topic_any_position_and_one_row_per_filter(spark, strategy):
    txs = [(1, "h1", 0, "t0", A1)]
    logs = [
        ("t0", 0, A1, ["00" * 32, H_U], payload(1)),  # hash in second position
        ("t0", 1, A1, [H_T, H_T, H_U], payload(2)),  # repeated topic counts once; two filters -> two rows
        ("t0", 2, A1, [H_V], payload(3)),  # not subscribed
    ]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T, SIG_U])]), strategy=strategy)
    assert keys(out) == [(1, "t0", 0, "U"), (1, "t0", 1, "T"), (1, "t0", 1, "U")]


def test_missing_receipt_cuts_the_block(spark):
    txs = [(1, "h1", 0, "t0", A1), (1, "h1", 1, "t1", A1), (1, "h1", 2, "t2", A1),
           (1, "h1", 3, "u3", A2),  # unsubscribed, no receipt: never looked up
           (2, "h2", 0, "t4", A1)]
    logs = [(t, 0, A1, [H_T], payload(i)) for i, t in enumerate(["t0", "t2", "t4"])]
    receipts = ["t0", "t2", "t4"]  # t1 missing
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])], receipts=receipts))
    assert keys(out) == [(1, "t0", 0, "T"), (2, "t4", 0, "T")]
    errs = [(r.block_number, r.tx_index, r.tx_hash, r.error) for r in out.receipt_errors.collect()]
    assert errs == [(1, 1, "t1", "ReceiptNotFound: t1")]


def test_subscription_without_events_still_cuts(spark):
    txs = [(1, "h1", 0, "t0", A2), (1, "h1", 1, "t1", A1)]
    logs = [("t1", 0, A1, [H_T], payload(1))]
    subs = [(0, A1, [SIG_T]), (1, A2, [])]
    out = run_batch(chain(spark, txs, logs, subs, receipts=["t1"]))
    assert keys(out) == []
    assert out.receipt_errors.count() == 1


def test_missing_block_ends_the_run(spark):
    txs = [(1, "h1", 0, "t0", A1), (3, "h3", 0, "t3", A1)]
    logs = [("t0", 0, A1, [H_T], payload(1)), ("t3", 0, A1, [H_T], payload(3))]
    notices = [(0, 1), (1, 2), (2, 3)]  # block 2 does not exist
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])], notices=notices))
    assert keys(out) == [(1, "t0", 0, "T")]
    [err] = out.block_error.collect()
    assert (err.arrival_seq, err.error) == (1, "BlockNotFoundForNumber: 2")
    # by number, the notice is logged before the lookup: the missing one shows
    assert sorted(r.block_number for r in out.progress.collect()) == [1, 2]


def test_missing_block_by_hash_and_order_in_batches(spark):
    txs = [(1, "h1", 0, "t0", A1), (3, "h3", 0, "t3", A1), (4, "h4", 0, "t4", A1)]
    logs = [(t, 0, A1, [H_T], payload(1)) for t in ("t0", "t3", "t4")]
    notices = [(0, ["h1", "h3"]), (1, ["hx", "h4"])]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])], notices=notices, mode=B.HASH))
    assert keys(out) == [(1, "t0", 0, "T"), (3, "t3", 0, "T")]
    [err] = out.block_error.collect()
    assert (err.arrival_seq, err.arrival_pos, err.error) == (1, 0, "BlockNotFound: hx")
    assert sorted(r.block_number for r in out.progress.collect()) == [1, 3]


def test_block_announced_twice_is_processed_twice(spark):
    txs = [(1, "h1", 0, "t0", A1)]
    logs = [("t0", 0, A1, [H_T], payload(1))]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [SIG_T])], notices=[(0, 1), (1, 1)]))
    assert sorted(r.arrival_seq for r in out.events.collect()) == [0, 1]


def test_all_parameters_decoded_from_data(spark):
    # an event with an indexed parameter in its source: the signature lists it,
    # the data lacks it, so decoding misaligns and runs out of bounds
    sig = "Moved(address,uint256)"
    h = keccak256([sig.encode()])[0].hex()
    txs = [(1, "h1", 0, "t0", A1)]
    logs = [("t0", 0, A1, [h, "00" * 12 + A3], payload(5))]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [sig])]))
    [r] = out.events.collect()
    assert r.error == "OutOfBounds"


def test_hash_is_of_the_raw_signature_text(spark):
    spaced = "T(uint256 )"  # valid after trimming, but its hash is of the raw text
    txs = [(1, "h1", 0, "t0", A1)]
    logs = [("t0", 0, A1, [H_T], payload(1))]
    out = run_batch(chain(spark, txs, logs, [(0, A1, [spaced])]))
    assert out.events.count() == 0


def test_invalid_configuration_fails_the_load(spark):
    from abiflow.operators.subscriptions import ConfigurationError

    txs = [(1, "h1", 0, "t0", A1)]
    with pytest.raises(ConfigurationError):
        run_batch(chain(spark, txs, [], [(0, A1, ["T(uint24)"])]))
    out = run_batch(chain(spark, txs, [], [(0, A1, ["T(uint24)"]), (1, A2, [SIG_T])]), strict=False)
    bad = [(r.subscription_ord, r.error) for r in out.subscriptions.validated.where("not is_valid").collect()]
    assert bad == [(0, "InvalidEvent: T(uint24): UnsupportedDataType: uint24")]


@pytest.mark.parametrize("strategy", [M.JOIN, M.EXPLODE])
def test_shuffle_path_beyond_broadcast_bounds_gives_the_same_rows(spark, strategy):
    """One hot block holds most transactions (and a missing receipt); with
    every broadcast bound at zero and Spark's own broadcasts off, the plan
    uses shuffle joins (AQE may split the hot partition) and must give the
    same rows as the broadcast plan."""
    txs = [(1, "h1", i, f"a{i}", A1 if i % 3 else A2) for i in range(60)]
    txs += [(b, f"h{b}", i, f"b{b}_{i}", A1) for b in range(2, 6) for i in range(2)]
    logs = [(t[3], j, A1, [H_T] if j % 2 else [H_U, H_T], payload(t[2] * 10 + j)) for t in txs for j in range(3)]
    receipts = [t[3] for t in txs if t[3] != "a40"]
    inp = chain(spark, txs, logs, [(0, A1, [SIG_T, SIG_U]), (1, A2, [SIG_U])], receipts=receipts)
    want = run_batch(inp, strategy=strategy)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = run_batch(inp, strategy=strategy, max_broadcast_rows=0)
        assert "SortMergeJoin" in got.events._jdf.queryExecution().executedPlan().toString()
        assert keys(got) == keys(want)
        assert sorted(got.receipt_errors.collect()) == sorted(want.receipt_errors.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r.tx_hash for r in want.receipt_errors.collect()] == ["a40"]
    assert {r.tx_hash for r in want.events.collect()} >= {"a39"} and "a41" not in {r.tx_hash for r in want.events.collect()}


def test_null_or_bad_signature_makes_the_subscription_invalid(spark):
    from abiflow.operators.subscriptions import ConfigurationError, prepare, validate

    subs = spark.createDataFrame(
        [(0, A1, [SIG_T, None]), (1, A2, [SIG_T, "Bad(uint24)"]), (2, A3, [SIG_T, SIG_T]), (3, A3, None)], SUB)
    got = {r.subscription_ord: (r.is_valid, r.error) for r in validate(subs).collect()}
    assert got[0] == (False, "InvalidEvent: InvalidSignatureFormat")
    assert got[1] == (False, "InvalidEvent: Bad(uint24): UnsupportedDataType: uint24")
    assert got[2] == (True, None)
    assert got[3] == (False, "MissingField: events")
    with pytest.raises(ConfigurationError):
        prepare(subs)
    lenient = prepare(subs, strict=False)
    assert [(r.contract_address, r.signature) for r in lenient.filters.orderBy("event_ord").collect()] == [
        (A3, SIG_T), (A3, SIG_T)]


def test_hash_lookup_stops_at_the_first_missing_hash(spark):
    from pyspark.sql import functions as F

    blocks = spark.createDataFrame([(b, f"h{b}") for b in range(1, 40)], "block_number bigint, block_hash string")
    notices = spark.createDataFrame([(0, ["h3", "h4"]), (1, ["h5", None, "h99", "h6"])], HASH_NOTICE_SCHEMA)
    got = B.lookup_blocks(notices, blocks, B.HASH)
    assert [r.block_hash for r in got.found.orderBy("arrival_seq", "arrival_pos").collect()] == ["h3", "h4", "h5"]
    assert "h6" not in {r.block_hash for r in got.found.collect()}  # after the missing block
    assert got.found.where(F.col("block_hash") == "h5").count() == 1
    assert [r.error for r in got.missing.collect()] == ["BlockNotFound: null"]
