"""Subscription table: validation (A8, G10), first-match lookup (J1) and the
event filters attached to each subscribed address (G11 per event).

Input schema: ``(subscription_ord BIGINT, contract_address STRING,
events ARRAY<STRING>)``; ``subscription_ord`` is the position of the entry
in the configuration, lower first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalogue import catalogue_distinct

ADDRESS_PATTERN = r"\A(0x)?[0-9a-fA-F]{40}\z"


class ConfigurationError(ValueError):
    """The subscription table does not load (strict mode)."""


@dataclass
class Subscriptions:
    validated: DataFrame  # every input row + is_valid, error, normalised address
    addresses: DataFrame  # first subscription per address: (contract_address, subscription_ord)
    filters: DataFrame  # its events: (contract_address, subscription_ord, event_ord, signature, event_name, hash, type_key)


def normalise_address(text) -> F.Column:
    """Lowercase 40 hex digits without ``0x``; NULL when not an address."""
    return F.when(text.rlike(ADDRESS_PATTERN), F.lower(F.regexp_replace(text, r"\A0x", "")))


def validate(subs: DataFrame) -> DataFrame:
    """Per subscription: normalised address, catalogue of each event, and the
    first error (missing or repeated position, missing field, bad address,
    first bad signature).  An event's error finds its row by the row's
    content, so rows without a position or with the same one don't mix."""
    subs = subs.select("*", F.sha2(F.to_json(F.struct("subscription_ord", "contract_address", "events"), {"ignoreNullFields": "false"}), 256).alias("_row"))
    events = (
        subs.select("_row", F.posexplode_outer("events").alias("event_ord", "signature"))
        .where(F.col("signature").isNotNull() | F.col("event_ord").isNotNull())
    )
    cat = catalogue_distinct(events)
    bad_event = cat.where(~F.col("is_valid")).groupBy("_row").agg(
        F.min_by(F.concat_ws(": ", F.col("signature"), F.col("error")), F.col("event_ord")).alias("event_error")
    )
    repeated = (
        subs.where(F.col("subscription_ord").isNotNull()).groupBy("subscription_ord").count().where("count > 1")
        .select("subscription_ord", F.lit(True).alias("_repeated"))
    )
    addr = F.col("contract_address")
    error = (
        F.when(F.col("subscription_ord").isNull(), F.lit("MissingField: subscription_ord"))
        .when(F.col("_repeated"), F.concat(F.lit("RepeatedField: subscription_ord "), F.col("subscription_ord").cast("string")))
        .when(addr.isNull(), F.lit("MissingField: contract_address"))
        .when(F.col("events").isNull(), F.lit("MissingField: events"))
        .when(normalise_address(addr).isNull(), F.concat(F.lit("InvalidAddress: "), addr))
        .when(F.col("event_error").isNotNull(), F.concat(F.lit("InvalidEvent: "), F.col("event_error")))
    )
    return (
        subs.join(bad_event, "_row", "left").join(repeated, "subscription_ord", "left")
        .select(
            "subscription_ord",
            normalise_address(addr).alias("contract_address"),
            error.alias("error"),
            error.isNull().alias("is_valid"),
            "events",
        )
    )


def prepare(subs: DataFrame, strict: bool = True) -> Subscriptions:
    """Validate, then keep the first subscription per address.

    ``strict`` (the default, as a configuration load): any invalid row makes
    the whole load fail.  Otherwise invalid rows are left out and remain
    visible in ``validated``."""
    validated = validate(subs)
    if strict:
        wrong = validated.where(~F.col("is_valid")).select("subscription_ord", "error")
        bad = wrong.limit(5).collect()
        if bad:
            named = "; ".join(f"#{r.subscription_ord}: {r.error}" for r in bad)
            raise ConfigurationError(f"first {len(bad)} of {wrong.count()}: {named}")
    good = validated.where(F.col("is_valid"))
    # J1: one subscription per address, the lowest position wins.  An
    # aggregate with map-side combine, no window sort.
    first = good.groupBy("contract_address").agg(
        F.min_by(F.struct("subscription_ord", "events"), F.col("subscription_ord")).alias("s")
    ).select("contract_address", "s.subscription_ord", "s.events")
    addresses = first.select("contract_address", "subscription_ord")
    filters = catalogue_distinct(
        first.select(
            "contract_address",
            "subscription_ord",
            F.posexplode("events").alias("event_ord", "signature"),
        )
    ).select("contract_address", "subscription_ord", "event_ord", "signature", "event_name", "hash", "type_key")
    return Subscriptions(validated, addresses, filters)
