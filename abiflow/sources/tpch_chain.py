"""Chain-shaped tables derived from the driver's TPC-H-style tables.

Every column is a deterministic formula over ``orders``, ``lineitem``,
``customer`` (and ``part`` / ``documents`` for the decoder jobs), written so
the same formula exists in DuckDB (see ``plans/oracle.py``).  Work grows
with the source tables; nothing is sampled or capped.

* a block per order date: ``block_number`` = days since 1995-01-01;
* a transaction per order: ``tx_index`` = ``o_orderkey`` (orders a block's
  txs), ``tx_hash`` = sha256 of the key, ``to`` = the customer's address,
  none (contract creation) when ``o_orderkey % 11 = 0``;
* a receipt per order unless ``o_orderkey % 97 = 0``;
* a log per line item of an order with a receipt: topics from the return
  flag and line status, data = the ABI encoding of seven line-item fields,
  cut to 100 bytes when ``l_partkey % 13 = 0``;
* subscriptions: every tenth customer to [Created, Updated]; a later
  duplicate for every twentieth customer to [Transfer] (never effective).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import encode as E

# The shipped configuration's event signatures and the
# keccak-256 of each (the hashes a chain would carry in topics).
CREATED_SIG = "DummyStructCreated(uint256,uint256,int256,bool,address,string,bytes32)"
UPDATED_SIG = "DummyStructUpdated(uint256,uint256,int256,bool,address,string,bytes32)"
TRANSFER_SIG = "Transfer(address,address,uint256)"
CREATED_HASH = "3c74b9cf316663d283a8274522fc12e846930fde65cabdcba55b9e9197b81d70"
UPDATED_HASH = "e722729b38da8cb0b28c916b84a2e0c62348f785db300c1ce7af1fdf4d70d570"
TRANSFER_HASH = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
EVENT_TYPES = ["uint256", "uint256", "int256", "bool", "address", "string", "bytes32"]

EPOCH = "1995-01-01"
NO_TO_MOD = 11
NO_RECEIPT_MOD = 97
SUBSCRIBED_MOD = 10
DUPLICATE_MOD = 20
SHORT_DATA_MOD = 13
SHORT_DATA_LEN = 100
DUPLICATE_ORD_OFFSET = 1 << 40
HASH_NOTICE_BATCH = 4


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def address_of(key) -> F.Column:
    """40 lowercase hex digits of an integer key."""
    return F.lpad(F.lower(F.hex(key)), 40, "0")


def block_number_of(ts) -> F.Column:
    return F.datediff(ts.cast("date"), F.lit(EPOCH).cast("date")).cast("bigint")


def block_hash_of(n) -> F.Column:
    return F.sha2(F.concat(F.lit("block:"), n.cast("string")), 256)


def tx_hash_of(orderkey) -> F.Column:
    return F.sha2(orderkey.cast("string"), 256)


@dataclass
class ChainTables:
    blocks: DataFrame
    transactions: DataFrame
    receipts: DataFrame
    logs: DataFrame
    subscriptions: DataFrame

    def notices_by_number(self) -> DataFrame:
        """One announcement per block, in block order."""
        return self.blocks.select(F.col("block_number").alias("arrival_seq"), "block_number")

    def notices_by_hash(self) -> DataFrame:
        """Poll batches of up to four hashes, ordered by block number."""
        return hash_notices(self.blocks.select("block_number"))


def number_notices(numbers: DataFrame) -> DataFrame:
    """One announcement per block number, in number order."""
    return numbers.select(F.col("block_number").alias("arrival_seq"), "block_number")


def hash_notices(numbers: DataFrame) -> DataFrame:
    """Poll batches: the hashes of four consecutive block numbers per
    announcement, in number order.  A group holds at most four rows."""
    return (
        numbers.groupBy(F.floor(F.col("block_number") / HASH_NOTICE_BATCH).cast("bigint").alias("arrival_seq"))
        .agg(F.array_sort(F.collect_list(F.struct("block_number", block_hash_of(F.col("block_number")).alias("h")))).alias("b"))
        .select("arrival_seq", F.transform("b", lambda x: x["h"]).alias("hashes"))
    )


def shipdate_block_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block numbers announced by ship date: they run past the last order
    date, so some announced blocks do not exist (missing-block stop)."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(block_number_of(F.col("l_shipdate")).alias("block_number")).distinct()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    bn = block_number_of(F.col("o_orderdate"))
    return o.select(
        bn.alias("block_number"),
        block_hash_of(bn).alias("block_hash"),
        F.col("o_orderkey").alias("tx_index"),
        tx_hash_of(F.col("o_orderkey")).alias("tx_hash"),
        F.when(F.col("o_orderkey") % NO_TO_MOD != 0, address_of(F.col("o_custkey"))).alias("to"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    bn = block_number_of(F.col("o_orderdate"))
    return (
        o.select(bn.alias("block_number"))
        .distinct()
        .select("block_number", block_hash_of(F.col("block_number")).alias("block_hash"))
    )


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt out by the ``tx_hash`` of their order, by the key it is
    made of: the 64 digits are made where the rows arrive, none is moved.  A
    grouping or join on ``tx_hash`` finds them there.  In as many partitions as
    a shuffle has, so that what is made of these few bytes is spread."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, tx_hash_of(F.col(key)))


def _receipt_orders(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where(F.col("o_orderkey") % NO_RECEIPT_MOD != 0)
    return dealt(o.select("o_orderkey", *columns), "o_orderkey")


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _receipt_orders(spark, sf_dir, "o_orderdate").select(
        tx_hash_of(F.col("o_orderkey")).alias("tx_hash"),
        block_number_of(F.col("o_orderdate")).alias("block_number"),
    )


def event_payload_hex(c) -> F.Column:
    """ABI encoding, as hex digits, of (l_partkey, l_suppkey, l_linenumber - 4, l_linestatus
    = 'F', address(l_suppkey), l_returnflag, sha256(l_partkey)) for the
    seven-parameter event; the string's pointer is 7 * 32 = 0xe0.  ``c`` gives
    a line item's column by its name."""
    full = E.payload_hex(
        E.word_uint(c("l_partkey")),
        E.word_uint(c("l_suppkey")),
        E.word_int(c("l_linenumber") - 4),
        E.word_bool(c("l_linestatus") == "F"),
        E.word_address(address_of(c("l_suppkey"))),
        E.word_uint(F.lit(len(EVENT_TYPES) * 32)),
        F.sha2(c("l_partkey").cast("string"), 256),
        E.tail_string(c("l_returnflag")),
    )
    return F.when(c("l_partkey") % SHORT_DATA_MOD == 0, F.substring(full, 1, 2 * SHORT_DATA_LEN)).otherwise(full)


def event_payload(c) -> F.Column:
    return F.unhex(event_payload_hex(c))


def event_topics(c) -> F.Column:
    first = (
        F.when(c("l_returnflag") == "A", F.lit(CREATED_HASH))
        .when(c("l_returnflag") == "R", F.lit(UPDATED_HASH))
        .otherwise(F.lit(TRANSFER_HASH))
    )
    return F.when(c("l_linestatus") == "F", F.array(first, F.lit(UPDATED_HASH))).otherwise(F.array(first))


# what a log is made of
LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag"]


def _receipt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items of orders with a receipt, numbered within their order
    (bounded, like a tx's logs).  An order's lines are brought together by its
    ``tx_hash``, and before payloads are made of them: a join or a grouping on
    ``tx_hash`` moves neither again."""
    li = read(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % NO_RECEIPT_MOD != 0)
    li = dealt(li.select("l_orderkey", *LINE_COLUMNS, "l_extendedprice", "l_shipdate"), "l_orderkey")
    place = Window.partitionBy("tx_hash").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    lines = li.select(tx_hash_of(F.col("l_orderkey")).alias("tx_hash"), *LINE_COLUMNS, "l_extendedprice", "l_shipdate")
    return lines.select("tx_hash", (F.row_number().over(place) - 1).cast("int").alias("log_index"), *LINE_COLUMNS)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _receipt_lines(spark, sf_dir).select(
        "tx_hash",
        "log_index",
        address_of(F.col("l_suppkey")).alias("address"),
        event_topics(F.col).alias("topics"),
        event_payload(F.col).alias("data"),
    )


def _typed(hex_text) -> F.Column:
    """Hex as a node writes it: ``0x``, here with capitals."""
    return F.concat(F.lit("0x"), F.upper(hex_text))


def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per block with its transactions in key order, every fifth
    block (by number) landed twice.  A group is one order date."""
    items = F.struct("tx_index", _typed(F.col("tx_hash")).alias("tx_hash"), _typed(F.col("to")).alias("to"))
    b = transactions(spark, sf_dir).groupBy("block_number", _typed(F.col("block_hash")).alias("block_hash")).agg(
        F.array_sort(F.collect_list(items)).alias("transactions")
    )
    return b.union(b.where(F.col("block_number") % 5 == 0))


def nested_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per receipt with its logs in order, ``data`` as hex text,
    every receipt of a key divisible by 5 landed twice; a group is one
    order's lines, gathered before hex text is made of them."""
    lines = F.array_sort(F.collect_list(F.struct("log_index", *LINE_COLUMNS)))
    g = _receipt_lines(spark, sf_dir).groupBy("tx_hash").agg(lines.alias("lines"))

    def item(line) -> F.Column:
        c = line.getField
        return F.struct(
            c("log_index").alias("log_index"), _typed(address_of(c("l_suppkey"))).alias("address"),
            F.transform(event_topics(c), _typed).alias("topics"), _typed(event_payload_hex(c)).alias("data"),
        )

    g = g.select("tx_hash", F.transform("lines", item).alias("logs"))
    o = _receipt_orders(spark, sf_dir)
    landed = F.explode(F.array_repeat(F.lit(0), F.when(F.col("o_orderkey") % 5 == 0, 2).otherwise(1)))
    o = o.select(tx_hash_of(F.col("o_orderkey")).alias("tx_hash"), landed.alias("landing")).drop("landing")
    return o.join(g, "tx_hash", "left").withColumn("tx_hash", _typed(F.col("tx_hash")))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    # address text as a user would type it: 0x prefix, upper-case hex
    text = F.concat(F.lit("0x"), F.lpad(F.hex(F.col("c_custkey")), 40, "0"))
    primary = c.where(F.col("c_custkey") % SUBSCRIBED_MOD == 0).select(
        F.col("c_custkey").cast("bigint").alias("subscription_ord"),
        text.alias("contract_address"),
        F.array(F.lit(CREATED_SIG), F.lit(UPDATED_SIG)).alias("events"),
    )
    duplicate = c.where(F.col("c_custkey") % DUPLICATE_MOD == 0).select(
        (F.col("c_custkey").cast("bigint") + DUPLICATE_ORD_OFFSET).alias("subscription_ord"),
        text.alias("contract_address"),
        F.array(F.lit(TRANSFER_SIG)).alias("events"),
    )
    return primary.unionByName(duplicate)


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a configuration entry, with a fixed rotation of
    defects so each validation branch is exercised (by ``c_custkey % 7``):
    0 valid, 1 bad hex, 2 short address, 3 missing events, 4 missing
    address, 5 one unsupported signature, 6 valid without 0x."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    hex40 = F.lpad(F.hex(k), 40, "0")
    r = k % 7
    addr = (
        F.when(r == 1, F.concat(F.lit("0xzz"), F.substring(hex40, 3, 38)))
        .when(r == 2, F.concat(F.lit("0x"), F.substring(hex40, 2, 39)))
        .when(r == 4, F.lit(None).cast("string"))
        .when(r == 6, hex40)
        .otherwise(F.concat(F.lit("0x"), hex40))
    )
    events = (
        F.when(r == 3, F.lit(None).cast("array<string>"))
        .when(r == 5, F.array(F.lit(CREATED_SIG), F.lit("Broken(uint24)")))
        .otherwise(F.array(F.lit(CREATED_SIG), F.lit(UPDATED_SIG)))
    )
    return c.select(k.cast("bigint").alias("subscription_ord"), addr.alias("contract_address"), events.alias("events"))


def chain_tables(spark: SparkSession, sf_dir: str) -> ChainTables:
    return ChainTables(
        blocks=blocks(spark, sf_dir),
        transactions=transactions(spark, sf_dir),
        receipts=receipts(spark, sf_dir),
        logs=logs(spark, sf_dir),
        subscriptions=subscriptions(spark, sf_dir),
    )
