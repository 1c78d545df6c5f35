"""Licence notices by diagonal voting.

Every run of ``k`` neighbouring words of a text is hashed and joined to the
places where it stands in a template.  A hit votes for the diagonal ``place in
the text - place in the template``: a notice copied word for word puts all its
votes on one diagonal, inserted or dropped words move the rest to another.
Votes are counted by diagonal, and diagonals no more than ``GAP`` or a share
``GAP_SHARE`` of the template apart are merged.  A merged span is verified in
order: the longest chain of hits whose places rise in the text and in the
template must cover enough of the template, and the span must not be much
longer than it.  Of notices over the same words (half of the shorter) only the
one whose template is covered best stays (equal: the longer, then the first),
so a notice doesn't carry the labels of its relatives.

The phrases are templates that must be whole: all their word pairs on one
diagonal; they stand beside any notice.  Runs are compared by 64-bit hashes.

Words: runs of digits, letters and characters beyond ASCII, lower case
(lower-casing letters beyond ASCII changes no phrase and no boundary).
Null or empty text: no words, no labels, score 0.  Repeated rows: a result
for each.  No rows: no rows.  A null or shorter template has no runs and is
never found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = 3
GAP_SHARE = 0.5
LEAST_COVER = 0.6
MOST_LENGTH = 1.5
#: Runs of the templates up to which they are broadcast (about 100 bytes
#: each); beyond: a shuffle.
BROADCAST_ROWS = 200_000

# Phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening lines of well-known notices and their labels (fixed values); a
# table of other templates, also whole licence texts, can be given instead.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights": "cc0",
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR, -1), lambda w: w != "")


def runs(column: str, k: int) -> Column:
    """Hashes of an array column's runs of ``k`` neighbouring words, by first word."""
    n = F.greatest(F.size(column) - k + 1, F.lit(0))
    out = F.slice(column, 1, n)
    if k == 1:
        return F.transform(out, lambda a: F.xxhash64(a))
    for j in range(1, k):
        out = F.zip_with(out, F.slice(column, j + 1, n), lambda a, b: F.xxhash64(a, b))
    return out


def notices(spark: SparkSession) -> DataFrame:
    """label, text of the notices known here."""
    return spark.createDataFrame([(label, t) for t, label in NOTICES.items()], "label string, text string")


def template_runs(spark: SparkSession, templates: DataFrame, k: int) -> DataFrame:
    """run, template, at, label, whole, n_runs, n_words of phrases (pairs of
    words) and templates (``k`` words)."""
    rows = spark.createDataFrame([(-j - 1, label, t) for j, (t, label) in enumerate(PHRASES.items())], "template bigint, label string, text string")
    every = rows.withColumn("whole", F.lit(True)).unionByName(templates.select(F.monotonically_increasing_id().alias("template"), "label", "text", F.lit(False).alias("whole")))
    t = every.select("template", "label", "whole", words(F.col("text")).alias("w"))
    cut = lambda size, whole: t.where(F.col("whole") == whole).select("template", "label", "whole", F.size("w").alias("template_words"), runs("w", size).alias("p"))
    t = cut(2, True).unionByName(cut(k, False))
    return t.select(F.posexplode("p").alias("at", "run"), "template", "label", "whole", F.size("p").alias("n_runs"), "template_words")


def license_spans(docs: DataFrame, templates: DataFrame | None = None, k: int = 2) -> DataFrame:
    """One row per document and span, and one with a null template for every
    document: _doc (row number), doc_id, n_words, template, label, whole,
    first_word, last_word (inclusive), cover.  templates: label, text."""
    spark = docs.sparkSession
    each = docs.select(F.monotonically_increasing_id().alias("_doc"), "doc_id", words(F.col("text")).alias("w"))
    pairs = runs("w", 2)
    each = each.select("_doc", "doc_id", F.size("w").alias("n_words"), pairs.alias("p"), *([runs("w", k).alias("q")] if k != 2 else []))
    # place 0 holds a value that every document votes with, so that all of
    # them come through the one pass over the texts; runs of another size
    # than the pairs stand behind these
    always = F.array(F.lit(0).cast("bigint"))
    every = F.concat(always, "p", "q") if k != 2 else F.concat(always, "p")
    votes = each.select("_doc", "doc_id", "n_words", F.size("p").alias("n_pairs"), F.posexplode(every).alias("place", "run"))
    known = template_runs(spark, notices(spark) if templates is None else templates, k)
    none = spark.createDataFrame([(0, 0, None, None, None, None, None)], "at int, run bigint, template bigint, label string, whole boolean, n_runs int, template_words int")
    known = known.unionByName(none)
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    word = F.when(F.col("place") <= F.col("n_pairs"), F.col("place") - 1).otherwise(F.col("place") - 1 - F.col("n_pairs"))
    hits = votes.join(known, "run").withColumn("word", word)
    # a false match of a run with the value 0 stands on place 0 only
    hits = hits.where(F.col("template").isNotNull() | (F.col("place") == 0)).where(F.col("template").isNull() | (F.col("place") > 0))
    if k != 2:  # each sort of template by its own runs
        hits = hits.where(F.col("template").isNull() | (F.col("whole") == (F.col("place") <= F.col("n_pairs"))))
    # every step below groups by document and more: one shuffle serves all
    hits = hits.repartition("_doc")
    by_document = ["_doc", "doc_id", "n_words", "template", "label", "whole", "n_runs", "template_words"]
    diagonals = hits.withColumn("diagonal", F.col("word") - F.col("at")).groupBy(*by_document, "diagonal").agg(
        F.min("word").alias("low"), F.max("word").alias("high"), F.collect_set(F.struct("word", "at")).alias("hits")
    )
    order = Window.partitionBy("_doc", "template").orderBy("diagonal")
    # a notice that stands twice has diagonals its whole length apart, a
    # phrase is never merged
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    begins = (step.isNull() | F.col("whole") | (step > F.greatest(F.lit(GAP), F.floor(F.col("n_runs") * GAP_SHARE)))).cast("int")
    merged = diagonals.withColumn("begins", begins).withColumn("span", F.sum("begins").over(order))
    spans = merged.groupBy(*by_document, "span").agg(F.min("low").alias("first_word"), F.max("high").alias("high"), F.flatten(F.collect_list("hits")).alias("hits"))
    spans = spans.withColumn("last_word", F.col("high") + F.when(F.col("whole"), 2).otherwise(k) - 1)
    # unordered first: most spans have far too few places
    places = F.size(F.array_distinct(F.transform("hits", lambda x: x["at"])))
    length = F.col("last_word") - F.col("first_word") + 1
    enough = F.when(F.col("whole"), places == F.col("n_runs")).otherwise(
        (places >= LEAST_COVER * F.col("n_runs")) & (length <= F.col("template_words") * MOST_LENGTH)
    )
    spans = spans.where(F.col("template").isNull() | enough)
    # (same word: the later place first, so that one word is one step)
    ordered = F.transform(F.sort_array(F.transform("hits", lambda x: F.struct(x["word"].alias("word"), (-x["at"]).alias("at")))), lambda x: -x["at"])
    spans = spans.select(*by_document, "first_word", "last_word", (_longest_chain(ordered, F.col("n_runs")) / F.col("n_runs")).alias("cover"))
    spans = spans.where(F.col("template").isNull() | F.col("whole") | (F.col("cover") >= LEAST_COVER))
    return _best(spans).drop("n_runs", "template_words")


def _longest_chain(places: Column, n: Column) -> Column:
    """The length of the longest rising subsequence of places 0 to n - 1:
    for each place, the longest chain that ends there."""
    zero = F.array_repeat(F.lit(0), F.coalesce(n, F.lit(0)))

    def longer(ends: Column, at: Column) -> Column:
        best = F.when(at > 0, F.array_max(F.slice(ends, 1, F.greatest(at, F.lit(1))))).otherwise(0) + 1
        return F.transform(ends, lambda x, j: F.when(j == at, F.greatest(x, best)).otherwise(x))

    return F.aggregate(places, zero, longer, lambda ends: F.coalesce(F.array_max(ends), F.lit(0)))


def _best(spans: DataFrame) -> DataFrame:
    """Notices without those that another one covers better over the same
    words; notices that overlap, in a chain, are compared with each other."""
    notice = F.col("template").isNotNull() & ~F.col("whole")
    rank = F.struct("cover", "n_runs", (-F.col("template")).alias("template"))
    rest = spans.where("template IS NULL OR whole")
    order = Window.partitionBy("_doc").orderBy("first_word", "last_word", "template")
    reach = F.max("last_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    some = spans.where(notice).withColumn("begins", (reach.isNull() | (F.col("first_word") > reach)).cast("int"))
    some = some.withColumn("island", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    members = F.collect_list(F.struct("first_word", "last_word", rank.alias("rank"))).over(Window.partitionBy("_doc", "island"))
    some = some.withColumn("members", members).withColumn("mine", rank)

    def better(x: Column) -> Column:
        common = F.least(x["last_word"], F.col("last_word")) - F.greatest(x["first_word"], F.col("first_word")) + 1
        shorter = F.least(x["last_word"] - x["first_word"], F.col("last_word") - F.col("first_word")) + 1
        return (x["rank"] > F.col("mine")) & (2 * common >= shorter)

    some = some.where(~F.exists("members", better))
    return rest.unionByName(some.select(*rest.columns))


def license_scan(docs: DataFrame, templates: DataFrame | None = None, k: int = 2) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of phrases),
    first_word, last_word (of them), base_labels, labels, score (the best
    cover of a verified span)."""
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    whole = F.col("whole")
    return (
        license_spans(docs, templates, k).groupBy("_doc", "doc_id", "n_words").agg(
            F.count(F.when(whole, 1)).alias("n_base"),
            F.min(F.when(whole, F.col("first_word"))).cast("long").alias("first_word"),
            F.max(F.when(whole, F.col("first_word"))).cast("long").alias("last_word"),
            names(F.when(whole, F.col("label"))).alias("base_labels"),
            names(F.col("label")).alias("labels"),
            F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("cover"))), F.lit(0.0)).alias("score"),
        ).withColumn("n_words", F.col("n_words").cast("long")).drop("_doc")
    )
