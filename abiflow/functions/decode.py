"""ABI payload decoding compiled to native Spark Column expressions.

A type tree (``abi_types.AbiType``) is turned, once on the driver, into a
pair ``(value Column, error Column)`` over a BINARY ``data`` column.  All
executor work is built-in expressions (substring, hex, conv, comparisons,
and ``transform`` for arrays), so scalar-only events stay inside whole-stage
codegen and no Python runs per row.

Layout rules reproduced:

* every type advances the running offset by a static head: one 32-byte
  word, or the sum of the fields for an inline struct, so element ``i`` of
  an array starts at ``base + i * head`` and a sequential loop becomes a
  ``transform`` over ``sequence``;
* ``string`` / ``bytes`` / ``T[]`` hold a pointer word relative to the
  current frame base; an array's elements live in a new frame whose base is
  just after its length word;
* structs are inline in the same frame (no pointer);
* bit widths are ignored; values are read as 64-bit host integers;
* every read is bounds-checked against the whole payload, errors come out
  in the order the sequential decoder meets them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .abi_types import WORD, AbiType, parse_type_list, tuple_type

# Decode error classes.
OUT_OF_BOUNDS = "OutOfBounds"
INVALID_UNSIGNED = "InvalidUnsignedInteger"
UTF8_ERROR = "Utf8Error"
INTEGER_OVERFLOW = "IntegerOverflow"  # value outside the 64-bit result type

# Byte constants compared against slices of a word (built per call: a
# Column needs an active session).
ZERO24 = bytes(24)
ZERO28 = bytes(28)
FF24 = b"\xff" * 24
ONE = b"\x01"
HIGH_BIT = b"\x80"


_COMPILED: dict = {}
_COMPILED_MAX = 256


def compiled(key, build):
    """``build()`` memoised per SparkContext and ``key``.  Column expressions
    are unresolved trees, reusable by any DataFrame; a stream compiles its
    decoders once instead of once per micro-batch (thousands of JVM calls)."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    k = (id(sc), key)
    if k not in _COMPILED:
        if len(_COMPILED) >= _COMPILED_MAX:
            _COMPILED.clear()
        # the entry holds the context, so its id cannot be reused by a new one
        _COMPILED[k] = (sc, build())
    return _COMPILED[k][1]


def once(df: DataFrame, fields: list[Column]) -> DataFrame:
    """``df`` plus the named fields, evaluated once per row by a generator
    of one row.  A filter on a field stays above it, so the fields are not
    copied below the joins, and a filter on the columns of ``df`` passes
    through it to the scans."""
    return df.select("*", F.inline(F.array(F.struct(*fields)))) if fields else df


def _no_error() -> Column:
    return F.lit(None).cast("string")


@dataclass(frozen=True)
class _Frame:
    """The payload and its length.  Positions are 0-based byte offsets, a
    Python int where the layout makes them static (every top-level
    parameter and struct field), else a bigint Column."""

    data: Column
    length: Column  # bigint byte length of data

    def read(self, pos, n) -> Column:
        """``n`` bytes at ``pos``.  A dynamic position is clamped into the
        payload so the int cast never overflows; callers only use the value
        where the bounds test passed."""
        if isinstance(pos, int):
            start = F.lit(pos + 1)
        else:
            start = (F.least(F.greatest(pos, F.lit(0)), self.length) + 1).cast("int")
        if isinstance(n, int):
            size = F.lit(n)
        else:
            size = F.least(F.greatest(n, F.lit(0)), self.length).cast("int")
        return self.data.substr(start, size)

    def fits(self, pos, n) -> Column:
        if isinstance(pos, int) and isinstance(n, int):
            return self.length >= F.lit(pos + n)
        return self.length >= pos + n

    def size_word(self, pos):
        """A 32-byte size/pointer word: (error, value).  The first 28 bytes
        must be zero; the value is the last 4 bytes."""
        err = F.when(~self.fits(pos, WORD), F.lit(OUT_OF_BOUNDS)).when(
            self.read(pos, 28) != F.lit(ZERO28), F.lit(INVALID_UNSIGNED)
        )
        val = F.conv(F.hex(self.read(pos + 28, 4)), 16, 10).cast("bigint")
        return err, val


def _dynamic(t: AbiType) -> bool:
    """Whether decoding ``t`` needs per-element lambdas (an array inside)."""
    if t.kind == "array":
        return True
    return t.kind == "struct" and any(_dynamic(f) for f in t.fields)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: bound to a lambda
    variable through a one-element ``transform``.  Higher-order functions
    are evaluated without subexpression elimination, so a shared subtree
    used twice would be computed twice (and 2^depth times when nested)."""
    return F.get(F.transform(F.array(value), body), 0)


def _first_error(items: Column) -> Column:
    return F.try_element_at(
        F.transform(F.filter(items, lambda x: x["e"].isNotNull()), lambda x: x["e"]), F.lit(1)
    )


def _array_items(t: AbiType, fr: _Frame, at: Column, n: Column, head_err: Column) -> Column:
    """Elements of an array whose length word is at ``at``: each decoded in
    the frame that starts after the length word."""
    inner_base = at + WORD
    # Every element moves at least one word and needs at least two bytes,
    # so an array longer than this must fail within the range.
    cap = F.least(n, F.floor((fr.length - inner_base) / WORD) + 2)
    count = F.when(head_err.isNull(), cap).otherwise(F.lit(0)).cast("int")
    idx = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    h = t.elem.head
    items = F.transform(idx, lambda i: _compile_packed(t.elem, fr, inner_base + i.cast("bigint") * h, inner_base))
    return _let(items, lambda y: F.struct(
        F.transform(y, lambda x: x["v"]).alias("v"), F.coalesce(head_err, _first_error(y)).alias("e")
    ))


def _compile_packed(t: AbiType, fr: _Frame, pos, base) -> Column:
    """``struct<v, e>`` for type ``t``: value and error from one evaluation
    of the element decoders."""
    k = t.kind
    if k == "array":
        # head words bound once per array: every element position derives
        # from the array's base, and lambdas get no subexpression elimination
        ptr_err, ptr = fr.size_word(pos)

        def with_len(a_):
            len_err, n = fr.size_word(a_["at"])
            return _let(F.struct(n.alias("n"), F.coalesce(a_["pe"], len_err).alias("he")),
                        lambda b_: _array_items(t, fr, a_["at"], b_["n"], b_["he"]))

        return _let(F.struct((base + ptr).alias("at"), ptr_err.alias("pe")), with_len)
    if k in ("string", "bytes") and not isinstance(pos, int):
        # an element inside an array: bind its pointer and length once
        ptr_err, ptr = fr.size_word(pos)

        def with_len(a_):
            at = a_["at"]
            len_err, n = fr.size_word(at)

            def body(b_):
                raw = fr.read(at + WORD, b_["n"])
                err = F.coalesce(a_["pe"], b_["le"], F.when(~fr.fits(at + WORD, b_["n"]), F.lit(OUT_OF_BOUNDS)))
                if k == "bytes":
                    return F.struct(raw.alias("v"), err.alias("e"))
                text = raw.cast("string")
                return F.struct(text.alias("v"),
                                F.coalesce(err, F.when(~F.is_valid_utf8(text), F.lit(UTF8_ERROR))).alias("e"))

            return _let(F.struct(n.alias("n"), len_err.alias("le")), body)

        return _let(F.struct((base + ptr).alias("at"), ptr_err.alias("pe")), with_len)
    if k == "struct" and _dynamic(t):
        packs, off = [], pos
        for i, f in enumerate(t.fields):
            packs.append(_compile_packed(f, fr, off, base).alias(f"f{i}"))
            off = off + f.head
        names = [f"f{i}" for i in range(len(t.fields))]
        return _let(F.struct(*packs), lambda s_: F.struct(
            F.struct(*[s_[n]["v"].alias(n) for n in names]).alias("v"),
            F.coalesce(*[s_[n]["e"] for n in names], _no_error()).alias("e"),
        ))
    v, e = _compile(t, fr, pos, base)
    return F.struct(v.alias("v"), e.alias("e"))


def _compile(t: AbiType, fr: _Frame, pos: Column, base: Column):
    """(value, error) for type ``t`` at absolute offset ``pos`` in a frame
    starting at ``base``."""
    k = t.kind
    if k == "address":
        err = F.when(~fr.fits(pos, WORD), F.lit(OUT_OF_BOUNDS))
        return F.lower(F.hex(fr.read(pos + 12, 20))), err
    if k == "uint":
        err = F.when(~fr.fits(pos, WORD), F.lit(OUT_OF_BOUNDS)).when(
            fr.read(pos, 24) != F.lit(ZERO24), F.lit(INTEGER_OVERFLOW)
        )
        val = F.conv(F.hex(fr.read(pos + 24, 8)), 16, 10).cast("decimal(20,0)")
        return val, err
    if k == "int":
        hi, top = fr.read(pos, 24), fr.read(pos + 24, 1)
        in_range = ((hi == F.lit(ZERO24)) & (top < F.lit(HIGH_BIT))) | ((hi == F.lit(FF24)) & (top >= F.lit(HIGH_BIT)))
        err = F.when(~fr.fits(pos, WORD), F.lit(OUT_OF_BOUNDS)).when(
            ~in_range, F.lit(INTEGER_OVERFLOW)
        )
        val = F.conv(F.hex(fr.read(pos + 24, 8)), 16, -10).cast("bigint")
        return val, err
    if k == "bool":
        err = F.when(~fr.fits(pos, WORD), F.lit(OUT_OF_BOUNDS))
        return fr.read(pos + 31, 1) == F.lit(ONE), err
    if k == "fixed_bytes":
        err = F.when(~fr.fits(pos, t.size), F.lit(OUT_OF_BOUNDS))
        return fr.read(pos, t.size), err
    if k in ("string", "bytes"):
        ptr_err, ptr = fr.size_word(pos)
        at = base + ptr
        len_err, n = fr.size_word(at)
        body = fr.read(at + WORD, n)
        err = F.coalesce(
            ptr_err, len_err, F.when(~fr.fits(at + WORD, n), F.lit(OUT_OF_BOUNDS))
        )
        if k == "string":
            text = body.cast("string")
            err = F.coalesce(err, F.when(~F.is_valid_utf8(text), F.lit(UTF8_ERROR)))
            return text, err
        return body, err
    if k == "array" or _dynamic(t):
        packed = _compile_packed(t, fr, pos, base)
        return packed["v"], packed["e"]
    if k == "struct":
        vals, errs, off = [], [], pos
        for i, f in enumerate(t.fields):
            v, e = _compile(f, fr, off, base)
            vals.append(v.alias(f"f{i}"))
            errs.append(e)
            off = off + f.head
        return F.struct(*vals), F.coalesce(*errs, _no_error())
    raise ValueError(f"unknown ABI kind {k}")


def decode_columns(data: Column, types) -> tuple[list[Column], Column]:
    """Decode a parameter list laid out from offset 0.

    Returns one value Column per parameter (``p0``, ``p1``, ..) and the
    first error in parameter order (NULL when the whole row decoded).  The
    values are not masked: where ``error`` is set they are meaningless.  Use
    ``decode_frame`` to get NULLs there without repeating the error
    expression inside every value."""
    if types and isinstance(types[0], str):
        types = parse_type_list(types)
    fr = _Frame(data, F.length(data).cast("bigint"))
    values, errors, off = [], [], 0
    for t in types:
        v, e = _compile(t, fr, off, 0)
        values.append(v)
        errors.append(e)
        off += t.head
    error = F.coalesce(*errors, _no_error()) if errors else _no_error()
    return [v.alias(f"p{i}") for i, v in enumerate(values)], error.alias("error")


def decode_frame(df: DataFrame, types, data_col: str = "data") -> DataFrame:
    """``df`` plus ``p0 .. pn`` (NULL where the row failed) and ``error``.

    Parameters holding arrays are decoded first into one ``struct<v, e>``
    column each, so their element decoders run once per row; then the error
    is computed once as a column, and each value only where it is NULL: in
    plain projections, which share common parts and leave out the values of
    rows that failed.  The result then passes a generator of one row, so that
    a filter on it isn't copied below it (see ``once``)."""
    if types and isinstance(types[0], str):
        types = parse_type_list(types)
    packs, values, error, masked = compiled(("frame", tuple(t.name for t in types), data_col),
                                            lambda: _frame_columns(types, data_col))
    read = df.select("*", *packs).select("*", *values, error)
    decoded = read.select(*df.columns, F.struct(*masked, "error").alias("_decoded"))
    return decoded.select(*df.columns, F.inline(F.array("_decoded")))


def _frame_columns(types, data_col: str):
    names = [f"p{i}" for i in range(len(types))]
    fr = _Frame(F.col(data_col), F.length(data_col).cast("bigint"))
    packs, values, errors, off = [], [], [], 0
    for n, t in zip(names, types):
        if _dynamic(t):
            packs.append(_compile_packed(t, fr, off, 0).alias(f"_pk_{n}"))
            v, e = F.col(f"_pk_{n}")["v"], F.col(f"_pk_{n}")["e"]
        else:
            v, e = _compile(t, fr, off, 0)
        values.append(v.alias(f"_raw_{n}"))
        errors.append(e)
        off += t.head
    error = (F.coalesce(*errors, _no_error()) if errors else _no_error()).alias("error")
    ok = F.col("error").isNull()
    masked = [F.when(ok, F.col(f"_raw_{n}")).alias(n) for n in names]
    return packs, values, error, masked


def decode_struct(data: Column, types) -> tuple[Column, Column]:
    """Decoded parameters as one struct ``<p0, p1, ..>`` plus the error
    (values not masked, as ``decode_columns``)."""
    values, error = decode_columns(data, types)
    if not values:
        return F.struct().cast(tuple_type(())), error
    return F.struct(*values), error


def param_variant(data: Column, t, offset: int) -> Column:
    """``struct<v VARIANT, e STRING>`` of one parameter of type ``t`` whose head
    is at byte ``offset``."""
    fr = _Frame(data, F.length(data).cast("bigint"))
    wrap = F.to_variant_object if t.kind in ("array", "struct") else (lambda v: v.cast("variant"))
    if not _dynamic(t):
        v, e = _compile(t, fr, offset, 0)
        return F.struct(wrap(v).alias("v"), e.alias("e"))
    return _let(_compile_packed(t, fr, offset, 0), lambda p: F.struct(wrap(p["v"]).alias("v"), p["e"].alias("e")))
