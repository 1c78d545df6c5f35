"""Payload tables for the decoder jobs, encoded from the driver's tables.

Each builder returns the source key columns plus ``data BINARY`` holding the
ABI encoding of known source columns, and names the type list to decode it
with.  The oracle of each job selects the source columns directly, so it
never decodes and checks the decoder independently.  Work grows with the
source table; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import encode as E
from .tpch_chain import address_of, read

SCALAR_TYPES = ["uint64", "uint8", "int256", "int64", "bool", "address", "bytes4", "bytes16", "uint256"]
STRING_TYPES = ["string", "bytes", "uint256"]
ARRAY_TYPES = ["uint256[]", "string[]"]
STRUCT_TYPES = ["(uint256,bool,address)", "int64"]
DEFECT_TYPES = ["uint256", "string", "bool"]
DEFECT_MOD = 6
PRICE_FACTOR = 1000003


def scalar_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine scalar parameters per line item (D1-D4, D7); the uint8 holds
    values above 255 (the width is ignored) and the ints are negative."""
    li = read(spark, sf_dir, "lineitem")
    c = F.col
    data = E.payload(
        E.word_uint(c("l_orderkey")),
        E.word_uint(c("l_linenumber") + 250),
        E.word_int(-c("l_partkey")),
        E.word_int(c("l_suppkey") - 50),
        E.word_bool(c("l_returnflag") == "R"),
        E.word_address(address_of(c("l_partkey"))),
        E.word_fixed(F.substring(F.sha2(c("l_partkey").cast("string"), 256), 1, 8)),
        E.word_fixed(F.substring(F.sha2(c("l_suppkey").cast("string"), 256), 1, 32)),
        E.word_uint(c("l_orderkey") * PRICE_FACTOR),
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", data.alias("data"))


def string_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(string, bytes, uint256) per document: the whole text twice, as text
    and as its UTF-8 bytes, then the id (D5, D6).  Texts reach tens of
    thousands of characters and are not ASCII."""
    d = read(spark, sf_dir, "documents")
    b = F.encode(F.col("text"), "UTF-8")
    padded = F.ceil(F.length(b) / 32).cast("bigint") * 32
    head = 3 * 32
    data = E.payload(
        E.word_uint(F.lit(head)),
        E.word_uint(F.lit(head + 32) + padded),
        E.word_uint(F.col("doc_id")),
        E.tail_bytes(b),
        E.tail_bytes(b),
    )
    return d.select("doc_id", data.alias("data"))


def _line_order():
    return ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def array_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uint256[], string[]) per order: the part keys and the two-letter
    flags of its lines in line order (D8; string elements are pointers
    relative to the element frame).  One group per order, a handful of
    lines each."""
    li = read(spark, sf_dir, "lineitem")
    lines = F.array_sort(
        F.collect_list(F.struct(*_line_order(), F.concat("l_returnflag", "l_linestatus").alias("flag")))
    )
    per_order = li.groupBy("l_orderkey").agg(lines.alias("lines"))
    n = F.size("lines").cast("bigint")
    uint_tail = F.concat(
        E.word_uint(n), F.array_join(F.transform("lines", lambda x: E.word_uint(x["l_partkey"])), "")
    )
    str_heads = F.array_join(F.transform("lines", lambda x, i: E.word_uint(n * 32 + i * 64)), "")
    str_tails = F.array_join(F.transform("lines", lambda x: E.tail_string(x["flag"])), "")
    data = E.payload(
        E.word_uint(F.lit(64)),
        E.word_uint(F.lit(64 + 32) + n * 32),
        uint_tail,
        E.word_uint(n),
        str_heads,
        str_tails,
    )
    return per_order.select("l_orderkey", data.alias("data"))


def struct_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inline struct (uint256, bool, address) then an int64 (D9)."""
    li = read(spark, sf_dir, "lineitem")
    c = F.col
    data = E.payload(
        E.word_uint(c("l_partkey")),
        E.word_bool(c("l_returnflag") == "R"),
        E.word_address(address_of(c("l_suppkey"))),
        E.word_int(c("l_linenumber") - 4),
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", data.alias("data"))


def defect_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uint256, string, bool) per line item with one defect by
    ``l_partkey % 6`` (D12-D15): 0 none, 1 cut to 40 bytes, 2 pointer with a
    nonzero high byte, 3 invalid UTF-8, 4 uint above 2^64, 5 length word
    past the end."""
    li = read(spark, sf_dir, "lineitem")
    c = F.col
    r = c("l_partkey") % DEFECT_MOD
    uint_word = F.when(
        r == 4, F.lpad(F.concat(F.lit("1"), F.lpad(F.hex(c("l_partkey")), 16, "0")), E.HEX_WORD, "0")
    ).otherwise(E.word_uint(c("l_partkey")))
    ptr_word = F.when(r == 2, F.concat(F.lit("01"), F.lpad(F.lit("60"), E.HEX_WORD - 2, "0"))).otherwise(
        E.word_uint(F.lit(96))
    )
    tail = (
        F.when(r == 3, F.concat(E.word_uint(F.lit(1)), F.rpad(F.lit("ff"), E.HEX_WORD, "0")))
        .when(r == 5, F.concat(E.word_uint(F.lit(1000)), F.rpad(F.hex(F.encode("l_returnflag", "UTF-8")), E.HEX_WORD, "0")))
        .otherwise(E.tail_string(c("l_returnflag")))
    )
    full = E.payload(uint_word, ptr_word, E.word_bool(c("l_linestatus") == "F"), tail)
    data = F.when(r == 1, F.substring(full, 1, 40)).otherwise(full)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", data.alias("data"))


# The kinds of parameter that the mixed payloads pair up.
MIXED_KINDS = ["uint256", "bool", "int256", "string", "uint256[]", "uint256[][]", "bytes[]", "(uint256,string[])"]
MIXED_TYPE_KEYS = [f"{a},{b}" for a in MIXED_KINDS for b in MIXED_KINDS]


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parameters per line item, each of one of eight kinds, by
    ``l_partkey`` and ``l_suppkey``: 64 type lists in one table (D16)."""
    li = read(spark, sf_dir, "lineitem")
    c, word, none = F.col, lambda n: E.word_uint(F.lit(n)), F.lit("")
    part, supp, line = (E.word_uint(c(x)) for x in ("l_partkey", "l_suppkey", "l_linenumber"))
    flag, status = E.tail_string(c("l_returnflag")), E.tail_string(c("l_linestatus"))
    # (words in the head before a pointer, tail the pointer leads to)
    kinds = [
        (part, none),
        (E.word_bool(c("l_returnflag") == "R"), none),
        (E.word_int(c("l_linenumber") - 4), none),
        (none, E.tail_string(F.concat("l_returnflag", "l_linestatus"))),
        (none, F.concat(word(2), part, supp)),
        (none, F.concat(word(2), word(64), word(128), word(1), part, word(2), supp, line)),
        (none, F.concat(word(2), word(64), word(128), flag, status)),
        (supp, F.concat(word(1), word(32), flag)),
    ]
    heads, tails = (F.array(*[k[i] for k in kinds]) for i in (0, 1))
    n = len(kinds)
    first, second = (c("l_partkey") % n).cast("int"), (c("l_suppkey") % n).cast("int")
    d = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.get(F.array(*[F.lit(t) for t in MIXED_KINDS]), first).alias("t0"),
        F.get(F.array(*[F.lit(t) for t in MIXED_KINDS]), second).alias("t1"),
        F.get(heads, first).alias("h0"), F.get(heads, second).alias("h1"),
        F.get(tails, first).alias("d0"), F.get(tails, second).alias("d1"),
    )
    words = lambda h, t: F.length(h) + F.when(F.length(t) > 0, F.lit(64)).otherwise(F.lit(0))
    head = ((words("h0", "d0") + words("h1", "d1")) / 2).cast("bigint")
    pointer = lambda t, at: F.when(F.length(t) > 0, E.word_uint(at)).otherwise(none)
    data = E.payload(
        c("h0"), pointer("d0", head), c("h1"), pointer("d1", head + (F.length("d0") / 2).cast("bigint")), c("d0"), c("d1")
    )
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.concat_ws(",", "t0", "t1").alias("type_key"), data.alias("data"))
