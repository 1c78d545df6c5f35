"""Quality rules, and a likelihood ratio of hashed n-grams.

Multinomials over ``BUCKETS`` hashed word n-grams (of one and two words) are
counted: one on all texts, and two on trusted texts (labelled good), each of
those on one half of the doc_ids; all with one added to every bucket.
Trusted texts are weighted so that each language has the share of the
trusted characters that it has of all.  A text's score is the mean over its
n-grams of log(trusted / all), by the trusted texts of the other half: no
text is scored by its own counts, so a label doesn't raise its own score.

The cut is taken from the labelled texts' scores: of the cuts that keep
``LEAST_GOOD`` of the good ones that pass the plain rules those that drop most
bad ones, and of these the middle.  Every document below it is dropped; none
is where no cut drops a bad text (no labels), or where a text's language has
no trusted text in the other half.

The plain rules look at words, symbols, repeated lines and repeated
three-word windows of the whole text.

Null or empty text: no words, so the rules fail it.  Repeated rows: each
counts and gets a result.  A doc_id labelled both ways, or null, counts as
not labelled; without a ``lang`` column, or with more than ``LANGUAGES``
values of it, all texts are of one language.  No rows: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch

BUCKETS = 1 << 13
LEAST_GOOD = 0.99
LANGUAGES = 10_000
#: Scores are told apart by so many steps a unit to find the cut.
STEPS = 1000
#: A weight of one: weights are whole, so that sums don't depend on order.
UNIT = 1 << 10
SPACE = r"[\x20\x09-\x0D]+"
#: Labels up to which they are broadcast (16 bytes each); beyond: a shuffle.
BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def _joined(column: str) -> Column:
    """Hashes of an array column's neighbours."""
    n = F.greatest(F.size(column) - 1, F.lit(0))
    return F.zip_with(F.slice(column, 1, n), F.slice(column, 2, n), lambda a, b: F.xxhash64(a, b))


def _hashed(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, w (words) and h1, h2 (hashes of one and two)."""
    d = docs.select(*keep, _words(F.coalesce("text", F.lit(""))).alias("w"))
    d = d.select(*keep, "w", F.transform("w", lambda w: F.xxhash64(w)).alias("h1"))
    return d.select(*keep, "w", "h1", _joined("h1").alias("h2"))


def _buckets() -> Column:
    return F.transform(F.concat("h1", "h2"), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, half, good (1, 0 or null) of every row."""
    ids = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("a"), F.max("quality").alias("b"))
    ids = ids.where("a = b").select("doc_id", F.col("a").cast("int").alias("good"))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    rows = docs.select("doc_id", "text", lang.alias("lang"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"))
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(ids), "doc_id", "left")
    # rows without an id are many of one key: they go round the shuffle
    none = rows.where("doc_id IS NULL").withColumn("good", F.lit(None).cast("int"))
    return rows.where("doc_id IS NOT NULL").join(ids, "doc_id", "left").unionByName(none)


def _weights(rows: DataFrame) -> DataFrame:
    """lang, w0, w1: the weight of a trusted text of each half; null where
    the half has none of the language."""
    size = F.length(F.coalesce("text", F.lit("")))
    trusted = lambda half: F.coalesce(F.sum(F.when((F.col("good") == 1) & (F.col("half") == half), size)), F.lit(0))
    by_lang = rows.groupBy("lang").agg(F.sum(size).alias("n"), trusted(0).alias("t0"), trusted(1).alias("t1"))
    every = Window.partitionBy()  # over LANGUAGES rows at most
    w = lambda t: F.when(F.col(t) > 0, F.greatest(F.lit(1), F.round(UNIT * (F.col("n") / F.sum("n").over(every)) / (F.col(t) / F.sum(t).over(every)))).cast("long"))
    return by_lang.select("lang", w("t0").alias("w0"), w("t1").alias("w1"))


def log_ratios(rows: DataFrame) -> DataFrame:
    """bucket, r0, r1 of every bucket: log(trusted / all) by the trusted texts
    of each half.  rows: text, half, good, w0, w1."""
    mine = lambda half: F.when((F.col("good") == 1) & (F.col("half") == half), F.col(f"w{half}"))
    flagged = rows.select("text", mine(0).alias("m0"), mine(1).alias("m1"))
    grams = _hashed(flagged, "m0", "m1").select("m0", "m1", F.explode(_buckets()).alias("bucket"))
    total = lambda m: F.coalesce(F.sum(m), F.lit(0)) / UNIT
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), total("m0").alias("t0"), total("m1").alias("t1"))
    # every bucket, also those that no text has
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(counts, "bucket", "left").fillna(0, ["n", "t0", "t1"])
    whole = Window.partitionBy()  # over BUCKETS rows
    p = lambda n: (F.col(n) + 1) / (F.sum(n).over(whole) + BUCKETS)
    return counts.select("bucket", F.log(p("t0") / p("n")).alias("r0"), F.log(p("t1") / p("n")).alias("r1"))


def cut_between(scored: DataFrame) -> float | None:
    """The cut from labelled texts: good (1 or 0) and ratio of each; None
    where no cut drops a bad text."""
    bins = scored.groupBy(F.floor(F.col("ratio") * STEPS).alias("bin")).agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    # as many rows as there are steps between the least and the largest score
    order = Window.orderBy("bin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    below = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    cuts = bins.select("bin", F.lag("bin").over(order).alias("last"), below("good").alias("good"), below("bad").alias("bad"), F.sum("good").over(Window.partitionBy()).alias("all"))
    cuts = cuts.where(F.col("good") <= (1 - LEAST_GOOD) * F.col("all")).groupBy("bad").agg(F.min("last").alias("low"), F.max("bin").alias("high"))
    best = cuts.where("bad > 0").orderBy(F.desc("bad")).first()
    return None if best is None else (best["low"] + 1 + best["high"]) / 2 / STEPS


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, judged (by the ratio), ratio, kept.  labels: doc_id and
    quality (1 good, 0 bad).  The rows are counted once and written."""
    spark = docs.sparkSession
    rows = _labelled(docs, labels)
    if "lang" in docs.columns and rows.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        rows = rows.withColumn("lang", F.lit(""))
    rows = rows.join(F.broadcast(_weights(rows)), "lang")
    ratios = log_ratios(rows)
    of = lambda r: F.transform(F.sort_array(F.collect_list(F.struct("bucket", r))), lambda x: x[r])
    # 2 * BUCKETS numbers, in every task
    by_bucket = ratios.agg(F.struct(of("r0").alias("r0"), of("r1").alias("r1")).alias("r")).select("r").scalar()
    counted = _counted(rows, by_bucket)
    path = scratch(spark, "rules")
    counted.write.parquet(path)
    counted = spark.read.parquet(path)
    cut = cut_between(counted.where("good IS NOT NULL AND judged AND NOT base_failed").select("good", "ratio"))
    good_enough = F.lit(True) if cut is None else ~F.col("judged") | (F.col("ratio") >= cut)
    return counted.drop("good").withColumn("kept", ~F.col("base_failed") & good_enough)


def _counted(rows: DataFrame, by_bucket: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    # by the trusted texts of the other half
    judged = F.when(F.col("half") == 0, F.col("w1")).otherwise(F.col("w0")).isNotNull()
    rows = rows.select("doc_id", "text", "half", "good", judged.alias("judged"))
    d = _hashed(rows, "doc_id", "text", "half", "good", "judged")
    d = d.select("*", _joined("h2").alias("h3"), _buckets().alias("b"))
    # a window's first words in order of the window, where any repeats
    again = F.size("h3") > F.size(F.array_distinct("h3"))
    placed = F.when(again, F.sort_array(F.transform("h3", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.withColumn("placed", placed)
    same = lambda j, x: F.coalesce(F.get("placed", j)["h"] == x["h"], F.lit(False))
    twice = F.filter("placed", lambda x, j: same(j - 1, x) | same(j + 1, x))
    d = d.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # each such window adds the words up to the next one, three at most
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines).withColumn("r", by_bucket).withColumn("r", F.when(F.col("half") == 0, F.col("r.r1")).otherwise(F.col("r.r0")))
    d = d.select(
        "doc_id", "good", "judged",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.aggregate("b", F.lit(0.0), lambda acc, k: acc + F.get("r", k)) / F.greatest(F.size("b"), F.lit(1))).alias("ratio"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed)
