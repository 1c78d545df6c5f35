"""Decode matched logs (D10, D15, D16; U3).

The matched rows carry ``type_key``: the canonical type list of the filter
that matched.  The decoder is compiled once on the driver from the distinct
type lists (they come from the subscription catalogue, so they are
config-sized); each parameter's is selected per row with ``CASE type_key``.
Every branch is built-in expressions; nothing runs in Python per row.

Two output shapes:

* ``decode_mixed``: one table for all events; ``params`` is a VARIANT object
  ``{p0: .., p1: ..}`` -- the dynamic value list of the reference;
* ``decode_typed``: the rows of one type list with typed columns
  ``p0 .. pn`` (what a table per event looks like).

Both keep every matched row: ``error`` is NULL for decoded rows and holds
the first error in parameter order otherwise (dead letters, K2).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.abi_types import parse_type_list
from ..functions.decode import compiled, decode_frame, once, param_variant

# Spark's generated code for one projection is bounded: parameters are decoded
# in stages of at most this many decoders, one after another over the same rows.
MAX_BRANCHES = 48

Decoder = Callable[[DataFrame, list[str]], DataFrame]


def split_type_key(type_key: str) -> list[str]:
    """Canonical type names of a ``type_key`` (comma-joined, no spaces); a
    comma inside a struct's parentheses joins its fields."""
    return re.split(r",(?![^(]*\))", type_key) if type_key else []


def decode_mixed(matches: DataFrame, type_keys: list[str], data_col: str = "data") -> DataFrame:
    """All matched rows with ``params VARIANT`` and ``error``.

    Each parameter's branch yields one ``struct<v VARIANT, e STRING>``; it
    is materialised as a column first, so the error and the value are taken
    from one decode of the row."""
    keys = sorted(set(type_keys))
    if not keys:
        return matches.select("*", F.lit(None).cast("variant").alias("params"),
                              F.lit(None).cast("string").alias("error"))
    stages, v, error = compiled(("mixed", tuple(keys), data_col, MAX_BRANCHES), lambda: _mixed_params(keys, data_col))
    out = matches
    for columns in stages:
        out = once(out, columns)
    out = out.select(*matches.columns, error.alias("error"), v.alias("_v"))
    return out.select(*matches.columns, "error", F.when(F.col("error").isNull(), F.col("_v")).alias("params"))


def _mixed_params(keys: list[str], data_col: str) -> tuple[list[list[Column]], Column, Column]:
    """Columns to evaluate one stage after the other, and over them the
    VARIANT object of all parameters and the first error.

    A parameter's decoder depends on its place, type and head offset only, so
    lists that agree there share it: the number of decoders grows with the
    different parameters, not with the lists."""
    shared: dict[tuple[int, int, str], list[str]] = {}
    arity: dict[int, list[str]] = {}
    for key in keys:
        offset, types = 0, parse_type_list(split_type_key(key))
        arity.setdefault(len(types), []).append(key)
        for place, t in enumerate(types):
            shared.setdefault((place, offset, t.name), []).append(key)
            offset += t.head
    key_col, data = F.col("type_key"), F.col(data_col)
    stages, packs, room = [], {}, 0
    branches = sorted(shared)
    while branches:
        if room == 0:
            stages.append([])
            room = MAX_BRANCHES
        place = branches[0][0]
        part = [b for b in branches[:room] if b[0] == place]
        branches, room = branches[len(part) :], room - len(part)
        packed = None
        for b in part:
            decoded = param_variant(data, parse_type_list([b[2]])[0], b[1])
            hit = key_col.isin(shared[b])
            packed = F.when(hit, decoded) if packed is None else packed.when(hit, decoded)
        name = f"_pk{place}_{len(packs.setdefault(place, []))}"
        packs[place].append(name)
        stages[-1].append(packed.alias(name))
    # a row's list has one decoder for each of its places: NULL in all others
    field = lambda place, f: F.coalesce(*[F.col(name)[f] for name in packs[place]])
    params = None
    for n, of in sorted(arity.items()):
        values = [field(k, "v").alias(f"p{k}") for k in range(n)]
        whole = F.to_variant_object(F.struct(*values)) if values else F.parse_json(F.lit("{}"))
        hit = key_col.isin(of)
        params = F.when(hit, whole) if params is None else params.when(hit, whole)
    errors = [field(k, "e") for k in sorted(packs)]
    return stages, params, F.coalesce(*errors, F.lit(None).cast("string"))


def decode_typed(matches: DataFrame, type_key: str, data_col: str = "data") -> DataFrame:
    """Rows of one type list with typed parameter columns ``p0 .. pn``."""
    rows = matches.where(F.col("type_key") == type_key)
    return decode_frame(rows, parse_type_list(split_type_key(type_key)), data_col)
