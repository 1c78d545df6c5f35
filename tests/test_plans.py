"""Where rows move: a run of a few blocks shuffles neither the block, receipt
nor log table; landed tables are told apart by their folder."""

import contextlib
import os
import re
import tempfile

import pytest

from abiflow.functions.decode import decode_frame
from abiflow.operators import blocks as B
from abiflow.plans.pipeline import ChainInput, run_batch
from abiflow.sources.landed import Landed, land
from test_behaviours import A1, A2, H_T, H_U, SIG_T, SIG_U, chain, payload


def history(spark, n=40):
    """``n`` blocks of six transactions, all of whose logs carry a common event."""
    txs = [(b, f"h{b}", i, f"t{b}_{i}", A1 if i % 2 == 0 else A2) for b in range(n) for i in range(6)]
    logs = [(t[3], j, A1, [H_T] if j == 0 else [H_U, H_T], payload(t[0])) for t in txs for j in range(2)]
    return chain(spark, txs, logs, [(0, A1, [SIG_T, SIG_U])], receipts=[t[3] for t in txs], notices=[(0, 7)])


def on_files(spark, inp, root):
    """The input read from files, so that scans can be told apart in a plan."""
    names = ("blocks", "transactions", "receipts", "logs")
    for name in names:
        getattr(inp, name).write.parquet(os.path.join(root, name))
    read = {name: spark.read.parquet(os.path.join(root, name)) for name in names}
    return ChainInput(inp.notices, read["blocks"], read["transactions"], read["receipts"], read["logs"], inp.subscriptions, inp.mode)


@contextlib.contextmanager
def plain_plans(spark):
    """Plans as for tables beyond Spark's own broadcast threshold."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def above(plan, scan):
    """For each scan of a folder the operators above it up to the first exchange."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[\s:|+\-*()0-9]*", x)[0]) for x in lines]
    out = []
    for k, line in enumerate(lines):
        if "FileScan" in line and re.search(rf"/{scan}[\],/]", line):
            d, ops = depth[k], []
            for j in range(k - 1, -1, -1):
                if depth[j] < d:
                    d = depth[j]
                    ops.append(lines[j][d:].split(" ")[0].split("(")[0])
                    if "Exchange" in ops[-1]:
                        break
            out.append(ops)
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_micro_batch_meets_big_tables_where_they_are_read(spark):
    inp = on_files(spark, history(spark), tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    with plain_plans(spark):
        out = run_batch(inp)
        try:
            plans = plan_of(out.matches) + "\n" + plan_of(out.receipt_errors)
            for scan in ("receipts", "logs"):
                ops = above(plans, scan)
                assert ops
                for o in ops:
                    assert "BroadcastHashJoin" in o and "SortMergeJoin" not in o
                    assert "Exchange" not in o or o.index("BroadcastHashJoin") < o.index("Exchange")
            # logs are cut to the announced transactions before their topics are exploded
            for o in above(plans, "logs"):
                assert o.index("BroadcastHashJoin") < o.index("Generate")
            # the gap rows and the kept rows are one evaluation
            assert all("InMemoryRelation" in " ".join(o) or "BroadcastHashJoin" in o for o in above(plans, "receipts"))
            assert plan_of(out.matches).count("InMemoryTableScan") >= 2
            assert {r.block_number for r in out.matches.collect()} == {7} and out.matches.count() == 9
        finally:
            out.release()


@pytest.mark.parametrize("mode", [B.NUMBER, B.HASH])
def test_the_block_table_is_not_shuffled(spark, mode):
    inp = on_files(spark, history(spark), tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    notices = inp.notices if mode == B.NUMBER else spark.createDataFrame([(0, ["h7", "h9"])], "arrival_seq bigint, hashes array<string>")
    with plain_plans(spark):
        look = B.lookup_blocks(notices, inp.blocks, mode)
        for df in (look.found, look.progress):
            for o in above(plan_of(df), "blocks"):
                assert o.index("BroadcastHashJoin") < o.index("Exchange")
    assert sorted(r.block_number for r in look.found.collect()) == ([7] if mode == B.NUMBER else [7, 9])


def test_many_announcements_take_the_shuffle_joins_and_give_the_same(spark):
    inp = history(spark)
    inp.notices = spark.createDataFrame([(b, b) for b in range(30)], "arrival_seq bigint, block_number bigint")
    few, many = run_batch(inp), run_batch(inp, max_broadcast_rows=3)
    key = lambda df: sorted(map(str, df.drop("params").collect()))
    assert key(few.events) == key(many.events) and few.matches.count() == 270


def test_whole_blocks_in_parts(spark):
    inp = history(spark, 3)
    found = B.lookup_blocks(spark.createDataFrame([(0, 2), (1, 0)], "arrival_seq bigint, block_number bigint"), inp.blocks).found
    txs = inp.transactions.unionAll(inp.transactions).where("block_number <> 0")  # landed twice; block 0 has none
    got = {(r.block_number, r.part): [t.tx_hash for t in r.transactions] for r in B.whole_blocks(found, txs, part_transactions=4).collect()}
    assert got == {(0, 0): [], (2, 0): ["t2_0", "t2_1", "t2_2", "t2_3"], (2, 1): ["t2_4", "t2_5"]}


def test_landed_roots_do_not_share_a_table(spark):
    a, b = (tempfile.mkdtemp(prefix="run-", dir="/tmp") for _ in "ab")
    make = lambda name: {"receipts": spark.createDataFrame([(f"{name}{k}",) for k in range(5)], "tx_hash string")}
    first, second = land(make("a"), a, buckets=2), land(make("b"), b, buckets=2)
    read = lambda landed: sorted(r.tx_hash for r in landed.table(spark, "receipts").collect())
    assert read(first) == [f"a{k}" for k in range(5)] and read(second) == [f"b{k}" for k in range(5)]
    assert read(Landed(a + "/", 2, "chain")) == read(first)
    spark.sql(f"CREATE TABLE {Landed(a, 3, 'chain').known('receipts')} (tx_hash STRING) USING parquet LOCATION '{b}/receipts'")
    with pytest.raises(RuntimeError, match="not in"):
        Landed(a, 3, "chain").table(spark, "receipts")


def appended(spark, root, parts):
    """Blocks landed in several appends; returns the layout."""
    inp = history(spark, 12 * parts)
    inp.logs = inp.logs.withColumn("log_index", inp.logs.log_index)
    for k in range(parts):
        lo, hi = 12 * k, 12 * (k + 1)
        here = {n: getattr(inp, n).where(f"block_number >= {lo} and block_number < {hi}") for n in ("blocks", "transactions")}
        mine = here["transactions"].select("tx_hash")
        here |= {n: getattr(inp, n).join(mine, "tx_hash", "left_semi") for n in ("receipts", "logs")}
        landed = land(here, root, mode="append" if k else "overwrite")
    return inp, landed


def test_a_run_of_one_block_reads_as_much_of_any_history(spark):
    sizes = {}
    for parts in (2, 6):
        inp, landed = appended(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"), parts)
        keys = spark.createDataFrame([(f"t7_{i}",) for i in range(6)], "tx_hash string")
        files = [f for name in ("receipts", "logs") for f in landed.of(spark, name, keys).inputFiles()]
        sizes[parts] = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
        whole = [f for name in ("receipts", "logs") for f in landed.table(spark, name).inputFiles()]
        assert len(files) < len(whole)
        used = ChainInput(inp.notices, *(landed.table(spark, n) for n in ("blocks", "transactions", "receipts", "logs")), inp.subscriptions,
                          receipts_of=lambda k, l=landed: l.of(spark, "receipts", k), logs_of=lambda k, l=landed: l.of(spark, "logs", k))
        key = lambda df: sorted(map(str, df.drop("params").collect()))
        assert key(run_batch(used).events) == key(run_batch(inp).events) != []
        none = spark.createDataFrame([("nowhere",)], "tx_hash string")
        assert landed.of(spark, "logs", none).count() == 0
    assert sizes[6] <= 1.05 * sizes[2]


def test_files_that_are_not_indexed_are_read(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    inp, landed = appended(spark, root, 2)
    # filed late, by a writer that knows no index
    inp.receipts.where("tx_hash = 't7_0'").limit(1).selectExpr("'late' AS tx_hash").coalesce(1).write.mode("append").parquet(f"{root}/receipts")
    late = spark.createDataFrame([("late",)], "tx_hash string")
    assert landed.of(spark, "receipts", late).where("tx_hash = 'late'").count() == 1
    land({"receipts": late.selectExpr("'later' AS tx_hash")}, root, mode="append")  # lists both
    assert len(landed.of(spark, "receipts", late).inputFiles()) == 1
    land({"receipts": late}, root)  # anew: the old files are forgotten
    assert landed.of(spark, "receipts", late).count() == 1 and landed.of(spark, "receipts", inp.transactions.limit(3)).count() == 0


def test_a_payload_is_decoded_once_below_a_filter_on_the_result(spark, tmp_path):
    rows = [(k, payload(k)) for k in range(8)] + [(8, b"\x00" * 40)]
    spark.createDataFrame(rows, "k int, data binary").write.parquet(str(tmp_path / "payloads"))
    out = decode_frame(spark.read.parquet(str(tmp_path / "payloads")), ["uint256", "bytes"])
    whole = plan_of(out).count("conv(")
    for kept in (out.where("error IS NULL"), out.where("p0 > 2"), out.where("error IS NOT NULL AND k > 3")):
        # the filter's own scan conditions aside, nothing is decoded again
        assert plan_of(kept).count("conv(") <= whole
    assert "GreaterThan(k,3)" in plan_of(out.where("error IS NULL AND k > 3"))
    assert sorted(r["k"] for r in out.where("error IS NOT NULL").collect()) == sorted(
        r["k"] for r in out.collect() if r["error"] is not None)
    assert all(r["p0"] is None and r["p1"] is None for r in out.where("error IS NOT NULL").collect())
