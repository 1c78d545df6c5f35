"""Shards along a Hilbert curve through several metadata dimensions.

Each document gets a cell: language, source and size, each quantised to
``2**BITS`` steps in its own order (names by their place among the distinct
names, up to that many told apart, more in quantiles; the size by its binary
logarithm), and the cell its place on the Hilbert curve, so that neighbours
on the curve are neighbours in every dimension.  Documents sorted by that index (then by text
and doc_id) are cut into runs of equal length, one for each shard: shard
``k`` of ``K`` holds the ranks from ceil(k * N / K) on, so counts differ by
one at most.  A reader that wants one language, source or size range skips
the shards whose smallest and largest values (``manifest``) exclude it.

Equal texts get the cell of one of them (the least language, then source),
so copies lie next to each other and only a cut parts them.

Ranks come from counts, level by level (curve index, text bucket, text,
copy bucket), each level's running sum inside the one above it; no sort or
window ever sees all rows, and a text that a third of all rows share is
ranked in ``2**COPY_BITS`` parts.

Null or empty text: 0 bytes; a null name counts as the empty one.  Repeated
rows get places of their own.  No rows: no rows.
"""

from __future__ import annotations

import os.path
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BITS = 4
DIMENSIONS = 3
TEXT_BUCKETS = 1024
COPY_BITS = 8
#: Bytes of a name, behind those that all names begin with, by which names
#: are told apart: as many as a double holds exactly.
NAME_BYTES = 6
LAW = "rows"


def curve_index(cell: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve: the axes' bits are brought into
    Gray-code order from the highest bit down, turning and mirroring the
    lower bits by the quadrant, then interleaved."""
    x = list(cell)
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low  # mirror
            else:
                swap = (x[0] ^ x[i]) & low  # turn
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    q = 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    out = 0
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | ((x[i] ^ flip) >> bit & 1)
    return out


def curve_table() -> list[tuple[int, int]]:
    """(cell number, curve index) of the whole grid, 2**(BITS * DIMENSIONS) rows."""
    side = 1 << BITS
    return [((a * side + b) * side + c, curve_index((a, b, c), BITS)) for a in range(side) for b in range(side) for c in range(side)]


def _number(name: Column, skip: int) -> Column:
    """The ``NAME_BYTES`` bytes of a name behind its first ``skip`` as a number
    in the order of the names; -1 for the empty name."""
    head = F.substring(name.cast("binary"), skip + 1, NAME_BYTES)
    number = F.conv(F.rpad(F.hex(head), 2 * NAME_BYTES, "0"), 16, 10).cast("double")
    return F.when(name == "", F.lit(-1.0)).otherwise(number)


def name_cuts(docs: DataFrame) -> list[tuple[int, list[float]]]:
    """For language and source the bytes that all names begin with, and the
    numbers that part the distinct names into ``2**BITS`` steps.  The driver
    gets four names and 2 * (2**BITS - 1) numbers."""
    sides = [F.nullif(F.col(c), F.lit("")) for c in ("lang", "source")]
    ends = docs.agg(*(f(c).alias(f"{n}{k}") for k, c in enumerate(sides) for n, f in (("least", F.min), ("most", F.max)))).first()
    skips = [len(os.path.commonprefix([(ends[f"least{k}"] or "").encode(), (ends[f"most{k}"] or "").encode()])) for k in (0, 1)]
    each = F.array(*(F.struct(F.lit(k).alias("side"), F.coalesce(c, F.lit("")).alias("name")) for k, c in enumerate(sides)))
    names = docs.select(F.explode(each).alias("n")).select("n.*").distinct()
    number = F.when(F.col("side") == 0, _number(F.col("name"), skips[0])).otherwise(_number(F.col("name"), skips[1]))
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    rows = names.groupBy("side").agg(F.percentile_approx(number, shares, 10_000).alias("cuts")).collect()
    cuts = {r["side"]: r["cuts"] for r in rows}
    return [(skips[k], cuts.get(k, [])) for k in (0, 1)]


def _step(number: Column, cuts: list[float]) -> Column:
    return reduce(lambda a, b: a + b, [(number > F.lit(c)).cast("bigint") for c in cuts], F.lit(0).cast("bigint"))


def _size_step(size: Column) -> Column:
    """0 up to 15 bytes, then one step for each doubling."""
    step = F.length(F.bin(size)) - 4
    return F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), step))


def _before(*order: str, within: tuple[str, ...] = ()) -> Column:
    window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def hilbert_shards(docs: DataFrame, shards: int = 24, keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all of ``docs``; what isn't kept isn't shuffled)
    with struct column ``_place``: size, text_crc32, curve, shard, slot."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    (lang_skip, lang_cuts), (source_skip, source_cuts) = name_cuts(docs)
    keyed = docs.select(
        F.struct(*(docs.columns if keep is None else keep)).alias("_row"),
        "doc_id",
        F.struct(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).alias("names"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.md5(text.cast("binary")).alias("text_id"),
    )
    # copies take one cell; their names combine before the shuffle
    named = keyed.groupBy("text_id").agg(F.min("names").alias("cell_names"))
    # a key of its own: both sides are then plain shuffles, of which the
    # adaptive join can split the part that a much copied text fills
    named = named.select(F.reverse("text_id").alias("copy_key"), "cell_names")
    keyed = keyed.withColumn("copy_key", F.reverse("text_id")).join(named, "copy_key")
    keyed = keyed.withColumn("lang_number", _number(F.col("cell_names.lang"), lang_skip))
    keyed = keyed.withColumn("source_number", _number(F.col("cell_names.source"), source_skip)).drop("cell_names", "names")
    cell = (_step(F.col("lang_number"), lang_cuts) * (1 << BITS) + _step(F.col("source_number"), source_cuts)) * (1 << BITS) + _size_step(F.col("size"))
    curve = spark.createDataFrame(curve_table(), "cell bigint, curve int")
    keyed = (
        keyed.withColumn("cell", cell.cast("bigint")).join(F.broadcast(curve), "cell")
        .withColumn("bucket", F.pmod("crc", F.lit(TEXT_BUCKETS)).cast("int"))
        .withColumn("part", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(1 << COPY_BITS)).cast("int"))
        .drop("lang_number", "source_number")
    )
    levels = ["curve", "bucket", "text_id", "part"]
    # dealt anew by all levels, so that the join above can split a text that
    # many rows share
    keyed = keyed.repartition(*levels)
    parts = keyed.groupBy(*levels).agg(F.count(F.lit(1)).alias("n"))
    sums = {k: parts.groupBy(*levels[:k]).agg(F.sum("n").alias("n")) for k in (1, 2, 3)} | {4: parts}
    at = sums[1].select("curve", _before("curve").alias("b1"), F.sum("n").over(Window.partitionBy()).alias("total"))
    for k in (2, 3, 4):
        level = sums[k].select(*levels[:k], _before(levels[k - 1], within=tuple(levels[: k - 1])).alias(f"b{k}"))
        at = level.join(at, levels[: k - 1])
    at = at.select(*levels, (F.col("b1") + F.col("b2") + F.col("b3") + F.col("b4")).alias("base"), "total")
    own = F.row_number().over(Window.partitionBy(*levels).orderBy("doc_id")) - 1
    ranked = keyed.withColumn("own", own).join(at, levels).withColumn("rank", F.col("base") + F.col("own"))
    ranked = ranked.withColumn("shard", F.expr(f"(rank * {shards}) div total").cast("int"))
    slot = F.expr(f"rank - (shard * total + {shards - 1}) div {shards}")
    place = F.struct("size", F.col("crc").alias("text_crc32"), "curve", "shard", slot.cast("long").alias("slot"))
    return ranked.select("_row.*", place.alias("_place"))


def manifest(sharded: DataFrame) -> DataFrame:
    """Of each shard: rows, and the smallest and largest value of each
    dimension, by which a reader skips it."""
    ends = [f(c).alias(f"{n}_{c.rpartition('.')[2]}") for c in ("lang", "source", "_place.size", "_place.curve") for n, f in (("least", F.min), ("most", F.max))]
    return sharded.groupBy(F.col("_place.shard").alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"), *ends)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in curve order."""
    rows = sharded.withColumn("shard", F.col("_place.shard"))
    rows.repartitionByRange("shard", F.col("_place.slot")).sortWithinPartitions("shard", "_place.slot").write.partitionBy("shard").parquet(path)
