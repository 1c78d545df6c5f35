"""Signature catalogue: a table of event signatures -> one filter row each.

Input: any DataFrame with a ``signature`` string column.  Output adds
``is_valid, error, event_name, data_types ARRAY<STRING>`` (canonical type
names), ``type_key`` (the canonical names joined by ``,``, the key the
decoder compiles one expression per) and ``hash`` (keccak-256 hex of the raw
signature text).

Everything but the hash is built-in expressions; the hash is one vectorised
pandas UDF over the signature column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.abi_types import SCALAR_TYPES
from ..functions.keccak import keccak256_hex

# Shape of an event signature: a word, then a non-empty parameter list with
# no ')' inside.  \A .. \z anchor the whole text (Java's '$' would also
# accept a trailing newline); (?U) gives Unicode \w and \s.
SIGNATURE_PATTERN = r"(?U)\A(\w+)\(([^)]+)\)\z"
_TRIM_PATTERN = r"(?U)\A\s+|\s+\z"
_ARRAY_SUFFIX = r"((?:\[\])*)\z"

INVALID_SIGNATURE = "InvalidSignatureFormat"
UNSUPPORTED_TYPE = "UnsupportedDataType: "


def _canonical_map() -> Column:
    pairs = []
    for text, (_, _, canonical) in SCALAR_TYPES.items():
        pairs += [F.lit(text), F.lit(canonical)]
    return F.create_map(*pairs)


def type_base(t: Column) -> Column:
    """Type text with all trailing ``[]`` removed."""
    return F.regexp_replace(t, r"(\[\])+\z", "")


def is_supported_type(t: Column) -> Column:
    """Whether one trimmed type text parses.  Event parameter lists cannot
    hold ')', so the struct form never applies here and a type is a scalar
    name followed by any number of ``[]``."""
    return type_base(t).isin(list(SCALAR_TYPES))


def canonical_type(t: Column) -> Column:
    return F.concat(F.element_at(_canonical_map(), type_base(t)), F.regexp_extract(t, _ARRAY_SUFFIX, 1))


def catalogue(signatures: DataFrame, signature_col: str = "signature") -> DataFrame:
    """G1-G11: validate and analyse every signature of the table."""
    sig = F.col(signature_col)
    shape_ok = sig.rlike(SIGNATURE_PATTERN)
    types = F.transform(
        F.split(F.regexp_extract(sig, SIGNATURE_PATTERN, 2), ","),
        lambda t: F.regexp_replace(t, _TRIM_PATTERN, ""),
    )
    first_bad = F.try_element_at(F.filter(types, lambda t: ~is_supported_type(t)), F.lit(1))
    error = (
        F.when(sig.isNull() | ~shape_ok, F.lit(INVALID_SIGNATURE))
        .when(first_bad.isNotNull(), F.concat(F.lit(UNSUPPORTED_TYPE), first_bad))
    )
    out = signatures.withColumn("_types", types).withColumn("error", error)
    ok = F.col("error").isNull()
    canonical = F.transform(F.col("_types"), canonical_type)
    return (
        out.withColumn("is_valid", ok)
        .withColumn("event_name", F.when(ok, F.regexp_extract(sig, SIGNATURE_PATTERN, 1)))
        .withColumn("data_types", F.when(ok, canonical))
        .withColumn("type_key", F.when(ok, F.array_join(canonical, ",")))
        .withColumn("hash", F.when(ok, keccak256_hex(sig)))
        .drop("_types")
    )


def catalogue_distinct(df: DataFrame, signature_col: str = "signature") -> DataFrame:
    """``catalogue(df)`` computed once per distinct signature and joined
    back (null-safe, so a missing signature is still reported).  Many
    subscriptions share a few signatures; the parse and the hash then run
    once per signature, and the tiny catalogue side is broadcast at run
    time by AQE."""
    cat = catalogue(df.select(F.col(signature_col).alias("_sig")).distinct(), "_sig")
    joined = df.join(cat, df[signature_col].eqNullSafe(cat["_sig"]), "left")
    return joined.drop("_sig")
