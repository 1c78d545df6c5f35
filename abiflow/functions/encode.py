"""ABI word builders as Spark Column expressions (hex text, joined and
``unhex``-ed into a BINARY payload).  Used to land chain-shaped test tables
from the driver's data; every builder has a one-line DuckDB equivalent in
the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_WORD = 64  # hex digits per 32-byte word


def _padded(digit: str, x: Column) -> Column:
    # (a bigint has 16 hex digits at most: only these are padded one by one)
    return F.concat(F.lit(digit * (HEX_WORD - 16)), F.lpad(F.hex(x), 16, digit))


def word_uint(x: Column) -> Column:
    """Non-negative integer as one word."""
    return _padded("0", x.cast("bigint"))


def word_int(x: Column) -> Column:
    """Signed 64-bit integer as one two's-complement word."""
    x = x.cast("bigint")
    return F.when(x < 0, _padded("f", x)).otherwise(_padded("0", x))


def word_bool(b: Column) -> Column:
    return word_uint(b.cast("int"))


def word_address(hex40: Column) -> Column:
    return F.lpad(hex40, HEX_WORD, "0")


def word_fixed(hex_bytes: Column) -> Column:
    """``bytesN`` given as hex text, right-padded to a word."""
    return F.rpad(hex_bytes, HEX_WORD, "0")


def tail_bytes(b: Column) -> Column:
    """Length word then the bytes right-padded to whole words (the tail of a
    ``string``/``bytes`` parameter)."""
    n = F.length(b)
    padded = F.ceil(n / 32).cast("int") * HEX_WORD
    return F.concat(word_uint(n), F.rpad(F.hex(b), padded, "0"))


def tail_string(s: Column) -> Column:
    return tail_bytes(F.encode(s, "UTF-8"))


def payload_hex(*hex_parts: Column) -> Column:
    return F.concat(*hex_parts)


def payload(*hex_parts: Column) -> Column:
    return F.unhex(payload_hex(*hex_parts))
