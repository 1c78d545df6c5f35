"""Canonical windows and slots against a plain restatement in Python."""

from __future__ import annotations

from collections import defaultdict

import pytest
import regex

from abiflow.llm import decontaminate as D

UNITS = set(D.UNITS)


def number_end(t, k):
    """End of the number that begins at digit k, and its value without
    thousands marks: whole words only."""
    m = regex.compile(r"[0-9]+").match(t, k)
    return m.end(), m[0]


def words(text):
    """(kind, word) of a text: N name, C other capitalised word, U unit, # number, else ''."""
    t = regex.sub("[\x01-\x06]", " ", text or "")
    for pattern, mark in ((D._THOUSANDS_AT, ""), (D._POINT_AT, "."), (D._COMMA_AT, ","), (D._MINUS_AT, "-")):
        t = regex.sub(pattern, {"": "", ".": "\x04", ",": "\x05", "-": "\x03"}[mark], t)
    out = []
    for m in regex.finditer(r"[\p{L}\p{N}\x03-\x05]+", t):
        w, at = m[0], m.start()
        parts = []
        # capitals begin a word or stand behind a mark of a number
        for c in regex.finditer(r"(?<![\p{L}\p{N}])\p{Lu}(?=\p{L})", w):
            parts.append((c.start(), "C"))
        name = at >= 2 and t[at - 1] == " " and regex.match(r"[\p{Ll}\p{N},;:]", t[at - 2])
        kind = ("N" if name else "C") if parts and parts[0][0] == 0 else ""
        low = w.lower()
        unit = regex.fullmatch(r"([0-9\x03-\x05]*[0-9])(" + "|".join(sorted(D.UNITS, key=len, reverse=True)) + ")", w)
        if unit:
            out += [("#", unit[1]), ("U", unit[2])]
            continue
        if kind == "" and regex.match(r"[0-9\x03]", low):
            kind = "#"
        elif kind == "" and low in UNITS and at >= 2 and t[at - 1] == " " and t[at - 2] in "0123456789" and w == low:
            kind = "U"
        elif kind in ("", "C") and low in UNITS and len(low) > 2:
            kind = kind + "U"
        out.append((kind, low))
    return out


def canonical(w, names):
    kind, low = w
    if kind == "N" or (names and kind.startswith("C")):
        return "N"
    if kind.endswith("U"):
        return "U"
    return "#" if kind == "#" else low


def is_slot(w, names):
    return canonical(w, names) in ("N", "U", "#")


def windows(ws, k):
    """key -> [(at, reading)]"""
    out = defaultdict(list)
    for at in range(len(ws) - k + 1):
        part = ws[at : at + k]
        plain, names = (tuple(canonical(w, r) for w in part) for r in (False, True))
        two = any(w[0].startswith("C") for w in part)
        out[plain].append((at, 1 if two else 0))
        if two:
            out[names].append((at, 2))
        if 2 * sum(is_slot(w, True) for w in part) > k:
            out["literal", *(w[1] for w in part)].append((at, 3))
    return out


def contaminated(docs, items):
    out = {}
    for item, text in items:
        iw = words(text)
        if len(iw) < D.ANYWHERE:
            continue
        k = min(len(iw), D.WINDOW)
        known = defaultdict(list)
        for key, places in windows(iw, k).items():
            for at, reading in places:
                literal = k if reading == 3 else sum(not is_slot(w, reading == 2) for w in iw[at : at + k])
                if 2 * literal >= k:
                    known[key].append((at, reading))
        n_windows = len({at for v in known.values() for at, _ in v})
        n_templates = len({at for v in known.values() for at, r in v if r < 2})
        for row, (doc, body) in enumerate(docs):
            dw = words(body)
            hits = defaultdict(set)
            for key, places in windows(dw, k).items():
                for at, of_item in known.get(key, ()):
                    for word, of_text in places:
                        literal = of_text != 2 and of_item != 2
                        names = not literal or (of_text in (0, 3) and of_item in (0, 3))
                        for reading in [1] * literal + [2] * names:
                            slots = tuple((iw[at + j][1], dw[word + j][1]) for j in range(k) if of_item != 3 and is_slot(iw[at + j], of_item == 2))
                            hits[reading, word - at].add((word, at, slots, of_item < 2))
            found, templates, runs, places, slots, reworded = set(), set(), [], [], [], []
            for group in hits.values():
                values = {v for h in group for v in h[2]}
                if len({b for b, _ in values}) != len(values):
                    group, values = {h for h in group if not h[2]}, set()
                if not group:
                    continue
                at = sorted({h[0] for h in group})
                run = best = 1
                for a, b in zip(at, at[1:]):
                    run = run + 1 if b == a + 1 else 1
                    best = max(best, run)
                runs.append(best)
                places += at
                slots.append(len(values))
                reworded.append(any(b != d for b, d in values))
                found |= {h[1] for h in group}
                templates |= {h[1] for h in group if h[3]}
            if not found:
                continue
            n_words = max(runs) + k - 1
            if len(found) / n_windows >= 0.5 or (n_templates and len(templates) >= 0.5 * n_templates) or n_words >= D.LEAST_WORDS:
                out[row, item] = (doc, item, len(found), n_words, min(places), max(places) + k - 1, max(slots), any(reworded))
    return sorted(out.values(), key=str)


def check(docs, benchmark):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = D.contaminated(docs, benchmark).collect()
    names = ["doc_id", "item_id", "n_windows", "n_words", "first_word", "last_word", "n_slots", "reworded"]
    assert sorted((tuple(r[c] for c in names) for r in got), key=str) == contaminated(rows, items)
    return got


def test_whole_small_table(spark, small):
    assert check(small, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_changed_numbers_names_and_units(spark):
    items = [
        "If 3 pens cost 12 dollars then 5 pens cost how many dollars in all at the same shop today",
        "Anna drove 40 miles in two hours. Then Bob drove 15 miles more. How many miles did Anna and Bob drive?",
        "A pool of 2,500 l loses 3.5 l an hour. After 12 hours, how many l are left in the pool for Carl?",
        "Compute 3 * 4 + 17 / 2 - 9 * 6 exactly.", "What is 12 + 34 * 56 - 78?",
    ]
    texts = [
        "If 7 pens cost 21 euros then 9 pens cost how many euros in all at the same shop today",
        "If 7 pens cost 21 euros then 9 pens cost how many cents in all at the same shop today",
        "Well. Mary drove 41 km in two hours. Then Tom drove 16 km more. How many km did Mary and Tom drive? Ha",
        "mary drove 41 feet in two hours. then tom drove 16 feet more. how many feet did mary and tom drive?",
        "A pool of 900 l loses 0,5 l an hour. After 3 hours, how many l are left in the pool for Eva? 12kg 5km -4 m",
        "so compute 3 * 4 + 17 / 2 - 9 * 6 exactly. and 12 + 34 * 56 - 78 is what is 12 + 34 * 56 - 78? yes",
        "It took hours and hours, days and days, Miles said, and cents and dollars and euros and miles", *items, None, "",
    ]
    got = check(spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string"), spark.createDataFrame([*enumerate(items)], "item_id bigint, text string"))
    found = {(r["doc_id"], r["item_id"]): r["reworded"] for r in got}
    assert found[0, 0] and found[2, 1] and found[4, 2]  # pens and euros, km, other numbers
    assert not {d for d, _ in found} & {6, 12, 13}


@pytest.mark.parametrize(
    ("item", "text", "found"),
    [
        ("Yes", "He said yes and left for the shop.", False), ("Yes", "He nodded. Yes. Then he left.", False), ("Yes", "first line\n- yes!\nlast line", True),
        ("New York", "I live in New York City", False), ("New York", "a list:\nNew York\r\nBoston", True),
        ("Who wrote Hamlet?", "A quiz. Who wrote Hamlet? Nobody knew.", True), ("Who wrote Hamlet?", "He asked who wrote Hamlet and left", False),
        ("Who wrote Hamlet?", "A quiz. Who wrote Othello? Nobody knew.", True), ("What is 3 + 4?", "so. What is 9 + 1? ten", True),
        ("In which year did the war end", "she asked him in which year did the war end and left", True),
    ],
)
def test_short_items(spark, item, text, found):
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id bigint, text string")
    got = D.contaminated(docs, benchmark).collect()
    assert [r["doc_id"] for r in got] == [1] * found
    if found:
        w = D._marked_words
        first = docs.where("doc_id = 1").select(w(docs["text"]).alias("w")).first()["w"]
        size = len(benchmark.where("item_id = 1").select(w(benchmark["text"]).alias("w")).first()["w"])
        assert got[0]["n_words"] == size == got[0]["last_word"] - got[0]["first_word"] + 1 and got[0]["last_word"] < len(first)


def test_a_column_of_the_caller_is_no_row_number(spark):
    text = "a very plain item of more than eight words that stands in a text as it is"
    docs = spark.createDataFrame([(k, text if k % 2 else "nothing here", 7, 7) for k in range(4)], "doc_id bigint, text string, _doc int, __doc int")
    benchmark = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    assert sorted(r["doc_id"] for r in D.contaminated(docs, benchmark).collect()) == [1, 3]
    left = D.decontaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 2]
