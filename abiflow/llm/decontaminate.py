"""Benchmark decontamination by canonical templates.

Texts and benchmark items are brought into a canonical form: numbers (with
sign, thousands and decimals), names (capitalised words inside a sentence)
and units (abbreviations behind a number, unit words of three letters or
more wherever they stand) become typed placeholders, all else is lower case.
A capitalised word elsewhere, as at a sentence's start, is read both ways, as
a word and as a name.  Windows of ``WINDOW`` canonical words are hash-joined,
so a question whose numbers, units or names were changed still meets its
template.  A window's hash is that of its two halves' hashes, down to single
words, so all windows of a text take three passes over its words.  Hits are
gathered by item and diagonal (place in the text - place in the item), and
there the slots are checked: one value of the item must stand for one value
of the text throughout.  Where it doesn't, only windows without slots count.

A text is contaminated by an item if the windows that count hold at least
``LEAST_SHARE`` of the item's, or ``LEAST_WORDS`` of its words in one run.
Windows of mostly placeholders say nothing as templates: they are joined by
their literal words, and the share is over all windows, of either sort (or,
for an item whose templates are found reworded, over the templates alone).

Items shorter than a window are looked up as a whole: from ``ANYWHERE`` words
on by windows of their own length, those of ``IN_SENTENCE`` words or more as a
whole line or sentence, and still shorter ones as a whole line only, since a
word or two stand in any text.

Null or empty texts and items match nothing.  Repeated rows: a result for
each.  No rows on either side: no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh, numbered

WINDOW = 8
ANYWHERE = 5
IN_SENTENCE = 3
LEAST_SHARE = 0.5
LEAST_WORDS = 13
#: Benchmark windows up to which they are broadcast (about 200 bytes each);
#: beyond: a shuffle.
BROADCAST_ROWS = 200_000

# Unit words (fixed values).
UNITS = "mm cm km m mg kg g lb lbs oz ml l s sec min h hr hours hour minutes minute seconds second days day weeks week months month years year km/h mph kmh hz khz mhz ghz kb mb gb tb w kw kwh v ma usd eur gbp dollars dollar euros euro cents cent percent miles mile meters metres meter metre feet foot inches inch degrees".split()
WORD_UNITS = [u for u in UNITS if len(u) > 2]
_MARKS = "\x01\x02\x03\x04\x05\x06"
_NAME, _UNIT, _MINUS, _DOT, _COMMA, _CAPITAL = _MARKS
# A capitalised word: a name or the start of a sentence; behind a word and a
# blank, or a comma and the like, it is a name.
_CAPITAL_AT = r"(\p{Lu})(?<![\p{L}\p{N}\x01].)(?=\p{L})"
_NAME_AT = r"\x06(?<=[\p{Ll}\p{N},;:][\x20]\x06)"
_UNIT_AT = r"(?<=[0-9])[\x20]?(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
_SEPARATOR = r"[^\p{L}\p{N}\x01-\x06]+"
# Marks inside a number.  Thousands go; a point or comma in a chain that is
# no number (12.05.2020, 1,2,3) or in a pair like (3,4) still separates.
_THOUSANDS_AT = r"[,'’  ](?=[0-9]{3}(?:[,'’  ][0-9]{3})*+(?![0-9]|,[0-9]))(?<=(?<![0-9.,'’  ])[0-9]{1,3}(?:[,'’  ][0-9]{3}){0,6}.)"
_POINT_AT = r"\.(?=[0-9]++(?!\.[0-9]))(?<=(?<![0-9.])[0-9]{1,18}\.)"
_COMMA_AT = r",(?=[0-9]++(?!,[0-9]))(?<=(?<![0-9,(\[{])[0-9]{1,18},)"
_MINUS_AT = r"(?<![\p{L}\p{N}.,)\]])[-−](?=[0-9])"
_SENTENCE_END = r"(?<=[.!?])[\x20\t]+"


def _without_marks(text: Column) -> Column:
    return F.regexp_replace(text, "[\x01-\x06]", " ")


def _numbers(text: Column) -> Column:
    for pattern, mark in ((_THOUSANDS_AT, ""), (_POINT_AT, _DOT), (_COMMA_AT, _COMMA), (_MINUS_AT, _MINUS)):
        text = F.regexp_replace(text, pattern, mark)
    return text


def _capitals(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _CAPITAL_AT, _CAPITAL + "$1"), _NAME_AT, _NAME)


def _units(text: Column) -> Column:
    return F.regexp_replace(text, _UNIT_AT, " " + _UNIT + "$1")


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SEPARATOR, -1), "")


def _marked_words(text: Column) -> Column:
    """Words in lower case; names, units and other capitalised words have a
    mark before them, a number with its sign and parts is one word."""
    return _split(_units(_capitals(_numbers(_without_marks(F.coalesce(text, F.lit("")))))))


def _with_words(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, and w: the marked words of ``text``.  Numbers and
    units are looked for in texts with digits only, marks where there are any."""
    d = rows.select(*keep, F.coalesce("text", F.lit("")).alias("t"))
    d = d.select(*keep, F.when(F.col("t").rlike("[\x01-\x06]"), _without_marks(F.col("t"))).otherwise(F.col("t")).alias("t"))
    d = d.select(*keep, "t", F.col("t").rlike("[0-9]").alias("digits"))
    d = d.select(*keep, "digits", _capitals(F.when(F.col("digits"), _numbers(F.col("t"))).otherwise(F.col("t"))).alias("t"))
    return d.select(*keep, _split(F.when(F.col("digits"), _units(F.col("t"))).otherwise(F.col("t"))).alias("w"))


def _plain(word: Column) -> Column:
    return F.translate(word, _NAME + _UNIT + _CAPITAL, "")


def _kind(word: Column, capitals: bool) -> Column:
    """The placeholder's letter for a name, unit or number, else null.
    ``capitals``: any capitalised word is a name."""
    c = F.ascii(word)
    name = c.isin(1, 6) if capitals else c == 1
    unit = (c == 2) | word.isin(WORD_UNITS + [_CAPITAL + u for u in WORD_UNITS])
    return F.when(name, F.lit("N")).when(unit, F.lit("U")).when(c.between(48, 57) | (c == 3), F.lit("#"))


def _hash(word: Column) -> Column:
    """Of the canonical word; plain words, most of all, are tested first."""
    literal = (F.ascii(word) > 57) & ~word.isin(WORD_UNITS)
    return F.xxhash64(F.when(literal, word).otherwise(F.coalesce(_kind(word, False), _plain(word))))


def _canonical(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, w (marked words), h (hashes of canonical ones)
    and g (the same with all capitalised words as names, where any is)."""
    return _hashed(_with_words(rows, *keep), *keep)


def _hashed(d: DataFrame, *keep: str) -> DataFrame:
    d = d.select(*keep, "w", F.transform("w", _hash).alias("h"))
    name = F.xxhash64(F.lit("N"))
    capital = lambda w: F.ascii(w) == 6
    return d.select(*keep, "w", "h", F.when(F.exists("w", capital), F.zip_with("h", "w", lambda h, w: F.when(capital(w), name).otherwise(h))).alias("g"))


def _places(first: Column, last: Column) -> Column:
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _joined(a: str, b: str, step: int) -> Column:
    """Hashes of a's and b's hashes that stand ``step`` apart; the last ones,
    which have nothing ``step`` behind them, are left to ``_runs`` to cut."""
    return F.zip_with(a, F.slice(b, step + 1, F.greatest(F.size(b) - step, F.lit(0))), lambda x, y: F.xxhash64(x, y))


def _runs(d: DataFrame, column: str, sizes: list[int]) -> DataFrame:
    """``d`` with the hashes of all windows of each size as column_size, from
    those of half the size."""
    old = d.columns
    d = d.withColumn(f"{column}_1", F.col(column))
    power = 1
    while power * 2 <= max(sizes):
        d = d.withColumn(f"{column}_{power * 2}", _joined(f"{column}_{power}", f"{column}_{power}", power))
        power *= 2
    for k in sizes:
        have = 1 << (k.bit_length() - 1)
        for bit in (4, 2, 1):
            if have != k and k & bit and have & bit == 0:
                d = d.withColumn(f"{column}_{have + bit}", _joined(f"{column}_{have}", f"{column}_{bit}", have))
                have += bit
    whole = lambda k: F.slice(f"{column}_{k}", 1, F.greatest(F.size(column) - k + 1, F.lit(0)))
    return d.select(*old, *(whole(k).alias(f"{column}_{k}") for k in sizes))


def _with_dense(d: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """The columns to keep, w, h, g, and many_size: the places of the windows
    that are mostly placeholders in any reading."""
    kinds = [F.xxhash64(F.lit(x)) for x in "NU#"]
    index = F.transform(F.coalesce("g", "h"), lambda x, i: F.when(x.isin(kinds), i))
    d = d.select(*keep, "w", "h", "g", F.filter(index, lambda i: i.isNotNull()).alias("q"))
    none = F.array().cast("array<int>")
    many = []
    for k in sizes:
        # more than half of a window are placeholders where so many lie within it
        half, last = k // 2, F.size("w") - k
        dense = F.transform("q", lambda i, j: F.when(j + half < F.size("q"), _places(F.greatest(F.get("q", j + half) - k + 1, F.lit(0)), F.least(i, last))))  # noqa: B023
        dense = F.filter(dense, lambda x: x.isNotNull() & (F.size(x) > 0))
        many.append(F.when(F.size("q") > half, F.array_distinct(F.flatten(dense))).otherwise(none).alias(f"many_{k}"))
    return d.select(*keep, "w", "h", "g", *many)


def _windows(d: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """The columns to keep, place and window (hash) of every window of so
    many words: one if both readings of its capitalised words agree, else one
    for each; and one of its literal words if most of them are placeholders
    in any reading.  Where a hash stands says what it is of (``_placed``)."""
    many = [f"many_{k}" for k in sizes]
    dense = reduce(lambda a, b: a | b, (F.size(m) > 0 for m in many))
    plain = F.when(dense, F.transform("w", lambda x: F.xxhash64(_plain(x))))
    # the words go here: every row below would be copied with them
    d = _with_dense(d, sizes, *keep).select(*keep, "h", "g", *many, plain.alias("plain"))
    d = _runs(_runs(d, "h", sizes), "g", sizes)
    parts = []
    for k in sizes:
        other = F.zip_with(f"h_{k}", f"g_{k}", lambda x, y: F.when(x != y, y))
        parts += [F.col(f"h_{k}"), F.when(F.col(f"g_{k}").isNotNull(), other).otherwise(F.array().cast("array<bigint>"))]
        parts.append(F.transform(f"many_{k}", lambda i: F.xxhash64(F.lit("literal"), F.slice("plain", i + 1, k))))  # noqa: B023
    # (outer: else Spark filters by the array's size and computes it twice;
    # the join drops the nulls)
    return d.select(*keep, F.posexplode_outer(F.concat(*parts)).alias("place", "window"))


def _placed(place: Column, sizes: list[int], size: Column | None = None) -> Column:
    """k, at (the window's first word) and reading of a place: 0 if both
    readings agree, else 1 (capitalised words are words) or 2 (names); 3:
    literal words.  Of the row's w, g and many_size; ``size``: k, if known."""
    k, at, reading, begin = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    cut = []
    for s in sizes:
        n = F.greatest(F.size("w") - s + 1, F.lit(0))
        second = begin + n
        third = F.when(F.col("g").isNotNull(), second + n).otherwise(second)
        end = third + F.size(f"many_{s}")
        cut.append((s, begin, second, third, end))
        begin = end
    for s, begin, second, third, end in cut:
        mine = size == s if size is not None else (place >= begin) & (place < end)
        here = F.when(place < second, place - begin).when(place < third, place - second).otherwise(F.get(f"many_{s}", place - third))
        both = F.exists(F.slice("w", here + 1, s), lambda x: F.ascii(x) == 6)
        read = F.when(place >= third, F.lit(3)).when(place >= second, F.lit(2)).when(both, F.lit(1)).otherwise(F.lit(0))
        k, at, reading = F.when(mine, F.lit(s)).otherwise(k), F.when(mine, here).otherwise(at), F.when(mine, read).otherwise(reading)
    return F.struct(k.alias("k"), at.alias("at"), reading.alias("reading"))


def _whole(d: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, w, reading and window of whole short texts (h, g):
    as ``_with_windows``, but one window of all words."""
    dense = F.size(F.filter("w", lambda x: _kind(x, True).isNotNull())) * 2 > F.size("w")
    literal = F.when(dense, F.xxhash64(F.lit("literal"), F.transform("w", _plain)))
    both = F.when(F.col("g").isNotNull(), 1).otherwise(0)
    windows = F.array(F.struct(both.alias("reading"), F.xxhash64("h").alias("window")), F.struct(F.lit(2).alias("reading"), F.when(F.col("g").isNotNull(), F.xxhash64("g")).alias("window")), F.struct(F.lit(3).alias("reading"), literal.alias("window")))
    return d.select(*keep, "w", F.explode(windows).alias("x")).select(*keep, "w", "x.*").where("window IS NOT NULL")


def _described(w: DataFrame) -> DataFrame:
    """Benchmark windows (window, item_id, at, of_item, k, w) with
    n_windows, n_templates, words, slots; templates of mostly placeholders go."""
    w = w.withColumn("words", F.slice("w", F.col("at") + 1, F.col("k")))
    kinds = lambda capitals: F.transform("words", lambda x: _kind(x, capitals))
    none = F.transform("words", lambda x: F.lit(None).cast("string"))
    w = w.withColumn("slots", F.when(F.col("of_item") == 3, none).when(F.col("of_item") == 2, kinds(True)).otherwise(kinds(False)))
    literal = F.size(F.filter("slots", lambda s: s.isNull()))
    w = w.where(literal * 2 >= F.col("k"))
    template = F.when(F.col("of_item") < 2, F.col("at"))
    n = w.groupBy("item_id").agg(F.count_distinct("at").alias("n_windows"), F.count_distinct(template).alias("n_templates"))
    return w.join(n, "item_id").select("window", "item_id", "at", "of_item", "k", "n_windows", "n_templates", "words", "slots")


def benchmark_windows(items: DataFrame, sizes: list[int]) -> DataFrame:
    """window, item_id, at, of_item, k, n_windows, n_templates, words, slots
    of the canonical ``items``: of ``WINDOW`` words, or of all of an item's
    where it has one of the smaller sizes."""
    keep = ["item_id", "w", "g", *(f"many_{k}" for k in sizes)]
    # an item's words are few; they stay with its windows
    w = _windows(_with_dense(items, sizes, "item_id").select("item_id", "w", "h", "g", *keep[3:], F.struct(*keep[1:]).alias("item")), sizes, "item_id", "item")
    w = w.select("item_id", "window", "place", "item.*")
    w = w.select("item_id", "w", "window", _placed(F.col("place"), sizes).alias("p")).select("item_id", "w", "window", "p.k", "p.at", F.col("p.reading").alias("of_item"))
    return _described(w.where(F.col("window").isNotNull() & (F.col("k") == F.least(F.size("w"), F.lit(WINDOW)))))


def _known(windows: DataFrame) -> DataFrame:
    return F.broadcast(windows) if windows.count() <= BROADCAST_ROWS else windows


_HIT = ["item_id", "at", "of_item", "k", "n_windows", "n_templates", "words", "slots"]


def _long_hits(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Hits of windows; the words are looked at again in texts with hits."""
    windows = _windows(_canonical(rows, "_doc"), sizes, "_doc")
    # (windows of different sizes have different hashes)
    hits = windows.join(_known(benchmark_windows(items, sizes)), "window")
    hits = hits.groupBy("_doc").agg(F.collect_list(F.struct("place", *_HIT)).alias("hits"))
    hits = checkpointed(hits)
    found = hits.select("_doc")
    texts = rows.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "_doc", "left_semi")
    d = _with_dense(_canonical(texts, "_doc", "doc_id"), sizes, "_doc", "doc_id").join(hits, "_doc")

    def told(x: Column) -> Column:
        p = _placed(x["place"], sizes, x["k"])
        return F.struct(*(x[c].alias(c) for c in _HIT), p["at"].alias("word"), p["reading"].alias("of_text"), F.slice("w", p["at"] + 1, x["k"]).alias("here"))

    d = d.select("_doc", "doc_id", F.transform("hits", told).alias("hits"))
    return d.select("_doc", "doc_id", F.explode("hits").alias("x")).select("_doc", "doc_id", "x.*")


def _line_hits(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Hits of items that must be a whole line or sentence."""
    short = _whole(items.where(F.size("w") < ANYWHERE), "item_id").withColumnRenamed("reading", "of_item")
    known = _described(short.select("*", F.lit(0).alias("at"), F.size("w").alias("k")))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n")
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.split(x, _SENTENCE_END, -1))
    d = rows.select("_doc", "doc_id", F.transform(lines, lambda line: F.transform(line, _marked_words)).alias("lines"))
    d = d.select("_doc", "doc_id", "lines", F.posexplode(F.transform("lines", F.flatten)).alias("line", "all"))
    # a line, and its sentences where there are several
    parts = F.when(F.size(F.get("lines", F.col("line"))) > 1, F.get("lines", F.col("line"))).otherwise(F.array().cast("array<array<string>>"))
    d = d.select("_doc", "doc_id", "lines", "line", F.posexplode(F.concat(F.array("all"), parts)).alias("part", "w"))
    d = d.where((F.size("w") > 0) & (F.size("w") < ANYWHERE) & ((F.col("part") == 0) | (F.size("w") >= IN_SENTENCE)))
    hits = _whole(_hashed(d, "_doc", "doc_id", "lines", "line", "part"), "_doc", "doc_id", "lines", "line", "part").join(_known(known), "window")
    words = lambda parts: F.aggregate(parts, F.lit(0), lambda n, x: n + F.size(x))
    before = words(F.flatten(F.slice("lines", 1, F.col("line")))) + F.when(F.col("part") > 0, words(F.slice(F.get("lines", F.col("line")), 1, F.col("part") - 1))).otherwise(0)
    return hits.select("_doc", "doc_id", "item_id", "at", "of_item", "k", "n_windows", "n_templates", "words", "slots", before.alias("word"), F.col("reading").alias("of_text"), F.col("w").alias("here"))


def contaminated(docs: DataFrame, benchmark: DataFrame, row: str | None = None) -> DataFrame:
    """One row per contaminated document and item: _doc (row number; the
    values of the column ``row`` if one is named),
    doc_id, item_id, n_windows (found), share (of the item's), n_words (of
    the longest run), first_word, last_word (inclusive), n_slots,
    reworded (a slot's value was changed)."""
    items = _canonical(benchmark, "item_id").where(F.size("w") > 0)
    n = F.size("w")
    lengths = {r["n"] for r in items.select(F.when(n < ANYWHERE, 0).otherwise(F.least(n, F.lit(WINDOW))).alias("n")).distinct().collect()}
    sizes = sorted({WINDOW} | lengths - {0}, reverse=True)
    rows = docs.select(F.col(row).alias("_doc"), "doc_id", "text") if row else numbered(docs.select("doc_id", "text"), "_doc")
    found = _long_hits(rows, items, sizes)
    if 0 in lengths:
        found = found.unionByName(_line_hits(rows, items))
    # slots of a window as (item's value, text's value)
    pairs = F.filter(F.arrays_zip(F.col("slots"), F.col("words"), F.col("here")), lambda x: x["slots"].isNotNull())
    found = found.withColumn("pairs", F.transform(pairs, lambda x: F.struct(_plain(x["words"]).alias("b"), _plain(x["here"]).alias("d"))))
    # slots are checked in each reading alone
    literal = (F.col("of_text") != 2) & (F.col("of_item") != 2)
    names = ~literal | (F.col("of_text").isin(0, 3) & F.col("of_item").isin(0, 3))
    readings = F.filter(F.array(F.when(literal, 1), F.when(names, 2)), lambda x: x.isNotNull())
    found = found.select("_doc", "doc_id", "item_id", "k", "n_windows", "n_templates", "at", "word", "pairs", (F.col("of_item") < 2).alias("template"), F.explode(readings).alias("reading"))
    # all steps below group by document and more: one shuffle serves them
    found = found.repartition("_doc")
    item = ["_doc", "doc_id", "item_id", "k", "n_windows", "n_templates"]
    diagonal = found.groupBy(*item, "reading", (F.col("word") - F.col("at")).alias("diagonal")).agg(
        F.collect_list(F.struct("word", "at", F.size("pairs").alias("n"), "template")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("values")
    )
    one_to_one = F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["b"])))
    diagonal = diagonal.withColumn("good", F.sort_array(F.when(one_to_one, F.col("hits")).otherwise(F.filter("hits", lambda x: x["n"] == 0))))
    diagonal = diagonal.where(F.size("good") > 0).withColumn("values", F.when(one_to_one, F.col("values")).otherwise(F.array().cast("array<struct<b:string,d:string>>")))
    # the longest run of windows that follow each other
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(-9).alias("last"))

    def longer(acc: Column, x: Column) -> Column:
        # a window can be found as a template and by its literal words
        run = F.when(x["word"] == acc["last"] + 1, acc["run"] + 1).when(x["word"] == acc["last"], acc["run"]).otherwise(1)
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"), x["word"].alias("last"))

    diagonal = diagonal.withColumn("run", F.aggregate("good", zero, longer, lambda acc: acc["best"]))
    out = diagonal.groupBy(*item).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.transform("good", lambda x: x["at"]))))).alias("found"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.transform(F.filter("good", lambda x: x["template"]), lambda x: x["at"]))))).alias("templates"),
        (F.max("run") + F.col("k") - 1).alias("n_words"),
        F.min(F.element_at("good", 1)["word"]).alias("first_word"),
        (F.max(F.element_at("good", -1)["word"]) + F.col("k") - 1).alias("last_word"),
        F.max(F.size("values")).alias("n_slots"),
        F.max(F.exists("values", lambda v: v["b"] != v["d"])).alias("reworded"),
    )
    out = out.withColumn("share", F.col("found") / F.col("n_windows"))
    reworded = (F.col("n_templates") > 0) & (F.col("templates") >= LEAST_SHARE * F.col("n_templates"))
    out = out.where((F.col("share") >= LEAST_SHARE) | reworded | (F.col("n_words") >= LEAST_WORDS))
    return out.select("_doc", "doc_id", "item_id", F.col("found").alias("n_windows"), "share", "n_words", "first_word", "last_word", "n_slots", "reworded")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, decided row by row
    whatever their doc_id."""
    row = fresh(docs, "_doc")
    rows = numbered(docs, row)
    bad = contaminated(rows, benchmark, row).select(F.col("_doc").alias(row)).distinct()
    return rows.join(bad, row, "left_anti").select(*docs.columns)
