"""Lines, payloads and landed rows are moved once, whatever is made of them."""

import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abiflow.functions import encode as E
from abiflow.operators import match as M
from abiflow.plans import pipeline as P
from abiflow.plans import queries as Q
from abiflow.session import scratch_path
from abiflow.sources import landed as L
from abiflow.sources import nested, sinks
from abiflow.sources import tpch_chain as C

DAY = datetime.datetime(1995, 1, 3)
LINE = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, "
        "l_linestatus string, l_extendedprice double, l_shipdate timestamp")


@pytest.fixture(scope="module")
def chain_dir(spark):
    """Orders 1 to 10, 97 (no receipt) and none; order 4 has no lines."""
    root = scratch_path(spark, "moved", uuid.uuid4().hex)
    keys = [*range(1, 11), 97, None]
    lines = [(k, 100 * k + n, n + 1, n + 1, "ARN"[n % 3], "FO"[n % 2], float(n), DAY) for k in keys if k not in (None, 4) for n in range(3)]
    lines.append((None, 1, 1, 1, "A", "F", 1.0, DAY))
    spark.createDataFrame(lines, LINE).repartition(3).write.parquet(f"{root}/lineitem.parquet")
    orders = [(k, 10, DAY) for k in keys]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(k,) for k in range(1, 21)], "c_custkey bigint").write.parquet(f"{root}/customer.parquet")
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def rows(df):
    return sorted(map(str, df.collect()))


def test_logs_are_joined_where_they_were_numbered(spark, chain_dir):
    logs = C.logs(spark, chain_dir)
    assert exchanges(logs.groupBy("tx_hash").count()) == 1
    assert logs.count() == 27
    per_tx = logs.groupBy("tx_hash").agg(F.array_sort(F.collect_list("log_index")).alias("at")).collect()
    assert all(r["at"] == [0, 1, 2] for r in per_tx) and len(per_tx) == 9


def test_nested_receipts_are_made_once_and_whole(spark, chain_dir):
    receipts = C.nested_receipts(spark, chain_dir)
    assert exchanges(receipts) <= 2  # the lines and the orders
    assert "Union" not in plan(receipts)
    assert receipts.count() == 12  # 5 and 10 twice
    none = receipts.where("logs IS NULL").select("tx_hash").collect()
    assert [r[0] for r in none] == ["0x" + spark.range(1).select(F.upper(F.sha2(F.lit("4"), 256))).first()[0]]
    flat = nested.receipt_logs(receipts)
    want = C.logs(spark, chain_dir).select(flat.columns)
    assert rows(flat.distinct()) == rows(want) and flat.count() == 33


def test_landed_lookups_move_nothing(spark, chain_dir):
    root = scratch_path(spark, "moved", uuid.uuid4().hex)
    t = C.chain_tables(spark, chain_dir)
    with Q._lookup_tables(spark, t, root) as tables:
        logs, receipts = tables.logs(), tables.receipts()
        assert exchanges(logs.groupBy("tx_hash").count()) == 0
        assert exchanges(receipts.select("tx_hash").distinct()) == 0
        assert rows(logs) == rows(t.logs) and rows(receipts) == rows(t.receipts)
        names = [x.name for x in spark.catalog.listTables() if x.name.startswith("stream_")]
        assert len(names) == 2
    assert not [x.name for x in spark.catalog.listTables() if x.name in names]


def test_dealt_rows_are_landed_as_others(spark, chain_dir):
    logs = C.logs(spark, chain_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for dealt in ((), ("logs",)):
        root = scratch_path(spark, "moved", uuid.uuid4().hex)
        ld = L.land({"logs": logs}, root, buckets=buckets, prefix="moved", dealt=dealt)
        assert rows(ld.table(spark, "logs")) == rows(logs)
        assert len([f for f in os.listdir(f"{root}/logs") if f.endswith(".parquet")]) <= buckets
        ld.forget(spark)


def test_few_hashes_match_as_many_do(spark):
    kept = spark.createDataFrame(
        [(0, 0, 1, 0, "t0", "a", 0), (0, 0, 1, 1, "t1", "b", 1)],
        "arrival_seq bigint, arrival_pos int, block_number bigint, tx_index bigint, tx_hash string, to string, subscription_ord bigint")
    logs = spark.createDataFrame(
        [("t0", 0, ["h1", "h2", "h1"], b"x"), ("t0", 1, None, b"x"), ("t0", 2, [None, "h2"], b"y"), ("t0", 2, [None, "h2"], b"z"),
         ("t1", 0, ["h2"], None), ("t1", 1, [], b"x"), ("t1", 2, ["h9", "h3"], b"w"), (None, 0, ["h1"], b"x")],
        "tx_hash string, log_index int, topics array<string>, data binary")
    filters = spark.createDataFrame(
        [("a", 0, 0, "s1", "e1", "h1", "k"), ("a", 0, 1, "s2", "e2", "h2", "k"), ("a", 0, 2, "s1", "e1", "h1", "k"), ("b", 1, 0, "s3", "e3", "h3", "k")],
        "contract_address string, subscription_ord bigint, event_ord int, signature string, event_name string, hash string, type_key string")
    many = M.match_logs(kept, logs, filters, small_filters=True)
    few = M.match_logs(kept, logs, filters, small_filters=True, hashes=["h1", "h2", "h3"])
    assert rows(few.select(many.columns)) == rows(many) and many.count() == 5
    # a log is one row until it has met its transaction
    assert plan(many).index("Generate") > plan(few).index("Generate")
    assert rows(M.match_logs(kept, logs, filters.where("false"), small_filters=True, hashes=[])) == []


def test_hashes_are_made_where_rows_arrive(spark, chain_dir):
    made = "Exchange hashpartitioning(sha2("
    t = C.chain_tables(spark, chain_dir)
    for df, moves in ((t.logs.groupBy("tx_hash").count(), 1), (t.receipts.select("tx_hash").distinct(), 1),
                      (C.nested_receipts(spark, chain_dir), 2)):
        assert plan(df).count(made) == exchanges(df) == moves  # the key moves, not its 64 digits
    assert t.receipts.count() == 10
    both = t.receipts.hint("merge").join(t.logs.hint("merge"), "tx_hash", "left")
    assert exchanges(both) == 2 and both.where("log_index IS NULL").count() == 1


def test_bare_hex_takes_one_mark(spark):
    texts = ["0xAB", "0Xab", "AB", "0x", "", "0x0xAB", "x0AB", "00xA", None, "0", "\n0xAB"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(F.coalesce(nested.bare_hex("t").eqNullSafe(F.lower(F.regexp_replace("t", r"\A0[xX]", ""))), F.lit(False))).collect()
    assert all(r[0] for r in got)
    for data, want in (("0xAbC0", b"\xab\xc0"), ("0X", b""), ("abc0", b"\xab\xc0"), ("zz", None), (None, None)):
        one = spark.createDataFrame([(data,)], "t string").select(nested._bytes(F.col("t"), T.StringType())).first()[0]
        assert one == want


def test_words_are_padded_as_before(spark):
    values = [0, 1, -1, 15, 255, -255, 2**31, 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    word = F.when(F.col("x") < 0, F.lpad(F.hex("x"), 64, "f")).otherwise(F.lpad(F.hex("x"), 64, "0"))
    for r in df.select("x", E.word_int(F.col("x")), word, E.word_uint(F.col("x")), F.lpad(F.hex("x"), 64, "0")).collect():
        assert r[1] == r[2] and r[3] == r[4] and (r[0] is None or len(r[1]) == 64)


def test_payload_text_is_the_payload(spark, chain_dir):
    lines = C.read(spark, chain_dir, "lineitem")
    texts = lines.select(C.event_payload(F.col), F.unhex(C.event_payload_hex(F.col)), "l_partkey").collect()
    assert all(r[0] == r[1] and len(r[0]) == (C.SHORT_DATA_LEN if r[2] % C.SHORT_DATA_MOD == 0 else 288) for r in texts)
    assert {len(r[0]) for r in texts} == {C.SHORT_DATA_LEN, 288}


def test_many_filters_of_few_hashes_move_no_match_by_address(spark, chain_dir):
    """Two addresses with four filters: beyond the bound with their texts,
    within it by the place of their hash."""
    whole = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got, moved = {}, {}
    try:
        for bound in (1, 2, P.DEFAULT_MAX_ROWS):
            out = P.run_batch(Q.chain_input(spark, chain_dir), max_broadcast_rows=bound)
            moved[bound] = plan(out.matches).count("SortMergeJoin [to#")
            got[bound] = rows(out.matches.drop("data"))
            out.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", whole)
    assert got[1] == got[2] == got[P.DEFAULT_MAX_ROWS] and len(got[2]) > 10
    assert moved[2] == moved[P.DEFAULT_MAX_ROWS] == 0 < moved[1]


def test_a_written_run_moves_a_line_once(spark, chain_dir, monkeypatch):
    """o3_batch_run_tables beyond a few transactions: lines are moved by the
    key their hash is made of, for the events alone, and nothing made of them
    is moved on the way to its file."""
    plans, write = {}, sinks._write

    def seen(df, path, batch_id):
        plans[os.path.basename(path)] = plan(df)
        write(df, path, batch_id)

    few = rows(Q.o3_batch_run_tables(spark, chain_dir))
    monkeypatch.setattr(sinks, "_write", seen)
    monkeypatch.setattr(P, "FEW_TRANSACTIONS", 0)
    whole = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(Q.o3_batch_run_tables(spark, chain_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", whole)
    assert got == few and len(got) > 10 and set(plans) == set(sinks.TABLES)
    events = plans.pop(sinks.EVENTS)
    assert events.count("Exchange hashpartitioning(sha2(cast(cast(l_orderkey") == events.count("FileScan parquet [l_orderkey") == 1
    assert "Exchange" not in events[: events.index("Window [row_number")]
    assert not any("l_orderkey" in other for other in plans.values())
