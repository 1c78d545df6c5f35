"""Each operator against brute force, on edge cases and a small table."""

from __future__ import annotations

import hashlib
import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from abiflow.llm import decontaminate, jaccard, langid, licenses, packing, pii, quality, sharding, token_files
from abiflow.llm.common import scratch
from abiflow.llm.components import components
from abiflow.llm.token_ids import BYTE_LEVEL, WORD_ENDS, Encoder, public_path

from . import brute

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def plain_ids(name, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_path(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


# --- 1 ---------------------------------------------------------------------


def test_curve_steps_to_neighbours():
    cells = {}
    side = 1 << sharding.BITS
    for number, at in sharding.curve_table():
        cells[at] = (number // side // side, number // side % side, number % side)
    assert sorted(cells) == list(range(side**3))
    assert all(sum(abs(a - b) for a, b in zip(cells[k], cells[k + 1])) == 1 for k in range(side**3 - 1))


@pytest.mark.parametrize("which", ["edge", "small"])
def test_shards_are_even_gapless_runs_of_the_curve(which, request):
    docs = request.getfixturevalue(which)
    placed = sharding.hilbert_shards(docs, 7).select("doc_id", "text", "_place.*").collect()
    assert Counter((r["doc_id"], r["text"]) for r in placed) == Counter(rows_of(docs))
    n = Counter(r["shard"] for r in placed)
    assert max(n.values()) - min(n.values()) <= 1 and set(n) == set(range(7))
    for k in n:
        assert sorted(r["slot"] for r in placed if r["shard"] == k) == list(range(n[k]))
    ordered = sorted(placed, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in ordered)
    for r in placed:
        assert r["size"] == len((r["text"] or "").encode()) + 8 and r["text_crc32"] == brute.crc(r["text"] or "")
    # copies are neighbours
    texts = [r["text"] or "" for r in ordered]
    assert len([k for k in range(len(texts)) if k == 0 or texts[k] != texts[k - 1]]) == len(set(texts))


def test_manifest_and_files(spark, small):
    placed = sharding.hilbert_shards(small, 5)
    out = scratch(spark, "shards")
    sharding.write_shards(placed, out)
    back = spark.read.parquet(out)
    assert back.count() == small.count()
    assert {r["shard"]: r["n_rows"] for r in sharding.manifest(placed).collect()} == {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()}


def test_names_keep_their_order_in_the_cells(spark):
    names = ["", "corpus/a", "corpus/b", "corpus/ba", "corpus/z"]
    docs = spark.createDataFrame([(k, "t", lang, s) for k, (lang, s) in enumerate((a, b) for a in ("de", "en", "es", "fr", None) for b in names)], "doc_id int, text string, lang string, source string")
    for column, (skip, cuts) in zip(("lang", "source"), sharding.name_cuts(docs)):
        name = F.coalesce(column, F.lit(""))
        step = {r[0]: r[1] for r in docs.select(name, sharding._step(sharding._number(name, skip), cuts)).distinct().collect()}
        assert len(set(step.values())) == 5 and [step[k] for k in sorted(step)] == sorted(step.values())
    many = spark.range(4000).select(F.lit("x").alias("lang"), F.format_string("site%04d", "id").alias("source"))
    skip, cuts = sharding.name_cuts(many)[1]
    n = Counter(r[0] for r in many.select(sharding._step(sharding._number(F.col("source"), skip), cuts)).collect())
    assert set(n) == set(range(16)) and max(n.values()) <= 252


def test_shards_of_no_rows_and_of_odd_names(spark, nothing):
    assert sharding.hilbert_shards(nothing, 24).count() == 0
    rows = [(None, None, None, None), (1, "a", None, None), (1, "a", "", None), (2, "", "é", "日本"), (3, "b", "é", "日本x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    placed = sharding.hilbert_shards(docs, 2).select("_place.shard", "_place.slot").collect()
    assert sorted(tuple(r) for r in placed) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_a_reader_skips_shards_by_the_manifest(spark, small):
    placed = sharding.hilbert_shards(small, 24)
    ends = {r["shard"]: r for r in sharding.manifest(placed).collect()}
    held = {(r["lang"], r["source"], r["shard"]) for r in placed.select("lang", "source", "_place.shard").distinct().collect()}
    read, fewest = {"lang": [], "source": []}, {"lang": [], "source": []}
    for column, at in (("lang", 0), ("source", 1)):
        for value in {h[at] for h in held} - {None}:
            of = {k for k, e in ends.items() if e[f"least_{column}"] is not None and e[f"least_{column}"] <= value <= e[f"most_{column}"]}
            need = {h[2] for h in held if h[at] == value}
            assert need <= of  # no row is lost
            read[column].append(len(of))
            fewest[column].append(len(need))
    # shards read on average; with names hashed to cells 12.25 and 17.6
    assert sum(read["lang"]) / len(read["lang"]) <= 12, (read, fewest)
    assert sum(read["source"]) / len(read["source"]) <= 12, (read, fewest)


def test_a_shared_text_is_ranked_in_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"))
    n = Counter(r["shard"] for r in sharding.hilbert_shards(docs, 24).select("_place.shard").collect())
    assert set(n.values()) == {125}


# --- 2, 5 ------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    w = quality.train(quality.sample(docs, labels, rest != 0))
    p = quality.score(docs, w).join(labels, "doc_id").where(rest == 0).toPandas()
    good, bad = p[p.quality == 1].score.values, p[p.quality == 0].score.values
    assert len(bad) and (good[:, None] > bad[None]).mean() > 0.95
    assert (good >= 0.3).mean() > 0.97


def test_quality_score_is_a_sparse_dot_product():
    w = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    texts = ["The the word&&& END 12", None, "", "one " * 50, "x"]
    got = quality.score_batch(w, pa.array(texts, pa.string()))
    for t, s in zip(texts, got, strict=True):
        alone = quality.score_batch(w, pa.array([t], pa.string()))[0]
        assert np.isclose(alone, s)
    assert np.isclose(got[1], 1 / (1 + np.exp(-w[-1]))) and got[1] == got[2]


def test_quality_edge(spark, edge, nothing):
    labels = spark.createDataFrame([(3, 1), (14, 0), (None, 1), (6, None)], "doc_id bigint, quality int")
    w = quality.train(quality.sample(edge, labels, F.lit(True)))
    assert quality.score(edge, w).where("score between 0 and 1").count() == edge.count()
    none = quality.train(quality.sample(nothing, labels, F.lit(True)))
    assert not none.any()
    assert {r["score"] for r in quality.score(edge, none).collect()} == {0.5}
    assert quality.score(nothing, w).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    trees = langid.train(langid.sample(docs, rest != 1))
    p = langid.predict(docs, trees).join(docs.select("doc_id", "lang"), "doc_id").where(rest == 1).toPandas()
    assert (p.lang == p.lang_pred).mean() > 0.98
    states, symbols = (x.ravel() for x in np.indices((len(trees.shorter), trees.n_symbols)))
    bits = langid._bits(trees, states, symbols).astype(float)
    held = np.exp2(-bits.reshape(-1, trees.n_symbols, len(trees.languages)).transpose(0, 2, 1)).sum(-1)
    assert np.allclose(held, 1, atol=1e-5)  # every context holds a distribution


def test_code_lengths_follow_the_trees():
    """Escape by escape, from counts, for every byte of a text."""
    train = {"aa": ["abracadabra " * 30, "abba"], "bb": ["bcbcbcbd cab " * 20]}
    batch = pa.record_batch([pa.array([k for k, v in train.items() for _ in v]), pa.array([t for v in train.values() for t in v])], names=["lang", "text"])
    counts = pa.Table.from_batches(langid._gram_counts(iter([batch]))).to_pydict()
    trees = langid.grow(counts["lang"], np.array(counts["gram"]), np.array(counts["n"]))
    alphabet = sorted({c for v in train.values() for t in v for c in t.encode()} | {10})
    size = len(alphabet) + 1

    def p(lang, context, byte):
        """Probability of a byte after a context, escaping to shorter ones."""
        def seen(k):
            out = Counter()
            for t in train[lang]:
                b = b"\n" * 3 + t.encode()
                for j in range(3, len(b)):
                    if b[j - k : j] == context[len(context) - k :]:
                        out[b[j]] += 1
            return out

        dist = {c: 1 / size for c in [*alphabet, None]}
        for k in range(langid.ORDER + 1):
            c = seen(k)
            total = sum(c.values())
            if not total:
                continue
            if k == langid.ORDER:
                everywhere = sum(sum((b"\n" * 3 + t.encode())[j - 3 : j] == context for j in range(3, len(t.encode()) + 3)) for v in train.values() for t in v)
                if everywhere < langid.LEAST_CONTEXT:
                    continue
            left = sum(v for x, v in dist.items() if x not in c)
            kinds = len(c) if left > 0 else 0
            dist = {x: c[x] / (total + kinds) if x in c else kinds / (total + kinds) * v / left for x, v in dist.items()}
        return dist[byte if byte in dist else None]

    text = "abra cab zbd"
    got = langid.code_lengths(trees, pa.array([text]))[0]
    for lang, bits in zip(trees.languages, got, strict=True):
        b = b"\n" * 3 + text.encode()
        want = -sum(np.log2(p(lang, b[j - 3 : j], b[j])) for j in range(3, len(b)))
        assert abs(bits - want) < 0.05, (lang, bits, want)


def test_a_hundred_languages_of_many_scripts(monkeypatch):
    """Trees hold what was seen, and give the same bits in blocks of any size."""
    rng = np.random.default_rng(5)
    langs, texts = [], []
    for k in range(100):
        letters = [chr(0x61 + j) for j in range(26)] if k % 4 == 0 else [chr(0x4E00 + 0x100 * (k % 40) + j) for j in range(40)]
        words = ["".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(60)]
        for _ in range(4):
            langs.append(f"l{k:02}")
            texts.append(" ".join(rng.choice(words, 150)))
    batch = pa.record_batch([pa.array(langs), pa.array(texts)], names=["lang", "text"])
    counts = pa.Table.from_batches(langid._gram_counts(iter([batch]))).to_pydict()
    grams = np.array(counts["gram"])
    trees = langid.grow(counts["lang"], grams, np.array(counts["n"]))
    dense = len(trees.shorter) * trees.n_symbols * 100 * 4
    assert len(trees.bits) <= sum(len(np.unique(grams & (256**k - 1))) for k in (2, 3, 4)) + trees.n_symbols
    assert trees.bits.nbytes + trees.escape.nbytes < dense / 10
    names, score, _ = langid.predict_batch(trees, pa.array(texts))
    assert names == langs and (score > 0.99).all()
    whole = langid.code_lengths(trees, pa.array([*texts[:9], "", None]))
    monkeypatch.setattr(langid, "BLOCK", 1 << 12)
    again = langid.grow(counts["lang"], grams, np.array(counts["n"]))
    assert all(np.array_equal(a, b) for a, b in zip(trees[1:], again[1:], strict=True))
    assert np.allclose(whole, langid.code_lengths(again, pa.array([*texts[:9], "", None])), rtol=1e-6) and not whole[-2:].any()


def test_language_edge(spark, edge, nothing):
    trees = langid.train(langid.sample(edge, F.lit(True)))
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(edge, trees).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (9, "und"), (8, "de"), (6, "en")} <= got
    assert langid.predict(edge, trees).where("score not between 0 and 1").count() == 0
    none = langid.train(langid.sample(nothing, F.lit(True)))
    assert {r["lang_pred"] for r in langid.predict(edge, none).collect()} == {"und"}
    assert langid.predict(nothing, trees).count() == 0
    assert langid.with_language(edge, trees).select("_language.lang_pred").count() == edge.count()
    named = edge.withColumn("_Language", F.lit("own"))
    with pytest.raises(ValueError, match="_language"):
        langid.with_language(named, trees)
    other = langid.with_language(named, trees, "__language").where("_Language = 'own' and __language.score between 0 and 1")
    assert other.count() == edge.count()


# --- 3, 8 ------------------------------------------------------------------


@pytest.mark.parametrize("which", ["edge", "small"])
def test_token_files_round_trip(which, request, spark):
    docs = request.getfixturevalue(which)
    out = scratch(spark, "tokens-test")
    token_files.write_token_files(docs, out, public_path(WORD), seq_len=64)
    got = token_files.read_token_files(spark, out).collect()
    assert len(got) == docs.count()
    want = sorted(((d is not None, d or 0, plain_ids(WORD, t)) for d, t in rows_of(docs)), key=lambda x: x[:2])
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == [d if some else None for some, d, _ in want]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d if s else None, len(i), brute.crc(as_bytes(i))) for s, d, i in want)
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]


def test_sequences_are_views_of_equal_length(spark, small):
    out = scratch(spark, "tokens-test")
    index = token_files.write_token_files(small, out, public_path(WORD), seq_len=32).orderBy("file_no", "start_in_file").collect()
    fs, root = pafs.FileSystem.from_uri(out)
    name = index[0]["file"]
    f = token_files.TokenFile(fs, root, name)
    n = sum(r["n_tokens"] for r in index if r["file"] == name)
    ids, mask = f.sequence(n // 32)
    assert len(ids) == len(mask) == 32 and not ids.flags.owndata
    assert mask.to_pylist() == [k < n % 32 for k in range(32)]


def test_no_token_files(spark, nothing):
    out = scratch(spark, "tokens-test")
    token_files.write_token_files(nothing, out, public_path(WORD))
    assert token_files.read_token_files(spark, out).count() == 0


@pytest.mark.parametrize("which", ["edge", "small"])
def test_packing_places_every_id_once(which, request):
    docs = request.getfixturevalue(which)
    pieces = packing.pack_documents(docs, public_path(BYTE), with_ids=True).collect()
    want = Counter()
    for d, t in rows_of(docs):
        ids = plain_ids(BYTE, t)
        want.update((d, len(ids), k, i) for k, i in enumerate(ids))
    got = Counter()
    for p in pieces:
        assert p["ids_crc32"] == brute.crc(as_bytes(p["ids"])) and len(p["ids"]) == p["length"] > 0
        got.update((p["doc_id"], p["doc_tokens"], p["start"] + k, i) for k, i in enumerate(p["ids"]))
    assert got == want
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    partial = Counter()
    for s, parts in by.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        partial[s >> 40] += end < 2048
    assert max(partial.values()) <= 1


def test_sum_of_squares_takes_the_best_level():
    rng = random.Random(5)
    s = packing.SumOfSquares(16, 10**6)
    for _ in range(2000):
        size = rng.randint(1, 15)
        best = {0: s.count.copy()}
        for level in range(1, 17 - size):
            if s.count[level]:
                after = s.count.copy()
                after[level] -= 1
                after[level + size] += level + size < 16
                best[level] = after
        best[0][size] += 1
        cost = {k: int((v[:16] ** 2).sum()) for k, v in best.items()}
        assert cost[s._level(size)] == min(cost.values())
        s.add(0, np.arange(size, dtype=np.uint32))
    assert s.open == s.count.sum() == sum(len(x) for x in s.at.values())
    s.pour()
    assert sum(sum(len(p.ids) for p in w) < 16 for w in s.out) <= 1


def test_windows_put_together(small):
    pieces = packing.pack_documents(small, public_path(BYTE), with_ids=True)
    for r in packing.sequences(pieces).collect():
        n = r["n_tokens"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 2048)


def test_no_pieces(nothing):
    assert packing.pack_documents(nothing, public_path(BYTE)).count() == 0


# --- 4 ---------------------------------------------------------------------


def check_classes(docs, n, percent):
    rows = rows_of(docs)
    want = brute.classes(rows, n, percent)
    got = jaccard.jaccard_classes(docs, n, percent).collect()
    pick = lambda x: (x is not None, x or 0)
    key = lambda t: (pick(t[0]), t[1], pick(t[2]), t[3])
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got), key=key) == sorted(((rows[k][0], *v) for k, v in want.items()), key=key)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_classes_of_edge_cases(edge, n, percent):
    check_classes(edge, n, percent)


def near_copies(spark, n=160, seed=4):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(90)]
    common = [f"c{k}" for k in range(60)]
    rows = []
    for k in range(n):
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(t)))
        rows.append((n + k, " ".join([f"y{rng.randint(0, 10**6)}" for _ in range(50)] + common)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_classes_of_many_near_copies(spark):
    check_classes(near_copies(spark), 3, 90)


def test_families_cut_into_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 10)
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 3)
    monkeypatch.setattr(jaccard, "FRAGMENT", 64)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    check_classes(near_copies(spark), 3, 80)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_without_an_id_of_their_own(spark, doc_id):
    """Null or shared ids: a set is met by rows of its own text, not by all rows of that id."""
    docs = near_copies(spark, 60).withColumn("doc_id", F.lit(doc_id).cast("bigint"))
    docs = docs.union(docs.limit(40))
    check_classes(docs, 3, 90)
    sets = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("fp"))
    nodes = sets.selectExpr("fp", "doc_id", "text_hash", "1L AS family", "1L AS copies", "88L AS n_shingles")
    plan = jaccard._links(docs, nodes, 3, 90)._jdf.queryExecution().optimizedPlan().toString()
    assert [x for x in plan.splitlines() if "Join" in x and "_hash#" in x and "text_hash#" in x]


def test_no_classes(nothing):
    assert jaccard.jaccard_classes(nothing).count() == 0


def test_components_of_a_long_path(spark):
    e = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 1001), (5, 5)], "a bigint, b bigint"))
    got = {r["node"]: r["root"] for r in components(e, "a", "b").collect()}
    assert got == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000}


# --- 6, 7 ------------------------------------------------------------------

NOTICE = next(t for t, label in licenses.NOTICES.items() if label == "bsd")


def test_license_base(spark, edge, small):
    more = [(100, "MIT License. The MIT, License; mit-license"), (101, "GNU General Public License CC BY-NC 4.0"), (102, "cc by cc by"), (103, "gnu general public licenses"), (104, "İmit license MİT license")]
    for docs in (edge, small, spark.createDataFrame(more, "doc_id bigint, text string")):
        got = licenses.license_scan(docs).collect()
        want = Counter((d, *brute.license_base(t)) for d, t in rows_of(docs))
        assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
        assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)


def test_notices_with_words_put_in_or_left_out(spark):
    w = NOTICE.split()
    cases = {1: w, 2: w[:9] + ["really"] + w[9:], 3: w[:7] + w[8:], 4: w[:6], 5: w[::-1], 6: ["x"] * 40 + w + ["y"] * 40 + w}
    docs = spark.createDataFrame([(k, " ".join(v).title()) for k, v in cases.items()], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["labels"], r["base_labels"]) for r in licenses.license_scan(docs).collect()}
    assert got == {1: ("bsd", ""), 2: ("bsd", ""), 3: ("bsd", ""), 4: ("", ""), 5: ("", ""), 6: ("bsd", "")}
    spans = licenses.license_spans(docs.where("doc_id = 6")).where("template is not null").orderBy("first_word").collect()
    assert [(r["first_word"], r["last_word"]) for r in spans] == [(40, 39 + len(w)), (80 + len(w), 79 + 2 * len(w))]


def test_no_licenses(nothing):
    assert licenses.license_scan(nothing).count() == 0


@pytest.mark.parametrize(("path", "layout"), [(BYTE, BYTE_LEVEL), (WORD, WORD_ENDS)])
def test_what_an_encoder_remembers_is_bounded(path, layout):
    """Texts that can't be cut and long words go as they came; ids stay right."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    whole = [" ".join(rng.choices(words, k=50)) + "\xa0\u2013  x" for _ in range(30)]
    long = ["y" * 3000 + " " + w for w in words[:20]]
    enc = Encoder(public_path(path), layout, characters=4000)
    for _ in range(3):
        for texts in (whole, [" ".join(rng.choices(words, k=400)) for _ in range(5)], [*long, "\t \t", "", None], whole[:3] + long[:3] + whole[:3]):
            ids, at = enc(texts)
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain_ids(path, t) for t in texts]
            assert len(enc.code) == len(enc.at) - 1 == len(enc.met) and enc.at[-1] == len(enc.flat)
            kept = [w for w in enc.code if w]
            assert max(map(len, kept)) <= enc.longest and not set(whole) & set(kept) and sum(map(len, kept)) <= 4000 + 2000 * 10
        assert enc.held == sum(map(len, kept)) - 1 or enc.held == sum(map(len, kept))


def test_ids_beyond_16_bits_are_an_error():
    f = token_files._File(pa.BufferOutputStream(), 4, False)
    f.add(np.array([65535], np.uint32))
    with pytest.raises(ValueError, match="wide"):
        f.add(np.array([1, 65536], np.uint32))
    token_files._File(pa.BufferOutputStream(), 4, True).add(np.array([65536], np.uint32))


# --- 9 ---------------------------------------------------------------------

ITEM = "A train leaves the station with 42 passengers at a speed of 80 km and later Alice counts 42 tickets before the bridge near the old mill"


def test_reworded_questions(spark, nothing):
    benchmark = spark.createDataFrame([(7, ITEM), (8, "short one here"), (9, None), (10, "")], "item_id bigint, text string")
    changed = ITEM.replace("42", "57").replace("80 km", "65 miles").replace("Alice", "Robert")
    texts = {
        1: f"Some words before. {ITEM} and after it.", 2: f"intro, {changed}", 3: ITEM.replace("42", "57", 1) + " x", 4: "nothing of it at all",
        5: " ".join(ITEM.split()[:12]), 6: "we saw a Short one, here", 7: None, 8: "", 9: " ".join(reversed(ITEM.split())),
    }
    docs = spark.createDataFrame([*texts.items(), (1, texts[1])], "doc_id bigint, text string")
    got = decontaminate.contaminated(docs, benchmark).collect()
    found = Counter((r["doc_id"], r["item_id"], r["reworded"]) for r in got)
    assert found[1, 7, False] == 2 and found[2, 7, True] == 1
    # one value stood for two: only windows without slots may count
    assert not [r for r in got if r["doc_id"] == 3 and r["n_slots"]]
    assert {d for d, _, _ in found} <= {1, 2, 3, 6}
    left = {r["doc_id"] for r in decontaminate.decontaminated(docs, benchmark).collect()}
    assert {4, 5, 7, 8, 9} <= left and not {1, 2} & left
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("item", "changed"),
    [
        ("A shop sells a shirt for $45 and a hat for $18 each. How much do 6 shirts and 4 hats cost?", "A shop sells a shirt for $12.50 and a hat for $8.75 each. How much do 3 shirts and 9 hats cost?"),
        ("A factory made 900 chairs in May and 450 tables in June so how many pieces is that in all", "A factory made 1,200 chairs in May and 1,450 tables in June so how many pieces is that in all"),
        ("Alice has 12 apples. Bob has 7 pears. Carol has 9 plums. Dora has 5 figs. How many fruits are there?", "Mark has 31 apples. Tom has 4 pears. Lucy has 8 plums. Rita has 6 figs. How many fruits are there?"),
        ("the level went from 5 to -5 and later from 5 to -5 again before the gauge was read", "the level went from 3 to -4 and later from 3 to -4 again before the gauge was read"),
    ],
)
def test_number_formats_and_names_at_sentence_starts(spark, item, changed):
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, changed), (2, f"Some say, {item}"), (3, item.lower()), (4, "She has 12 apples. He was late, and that is all there is to say of it")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert {1, 2} <= set(got) and 4 not in got
    assert got[1]["reworded"] and got[1]["share"] == 1 and got[2]["share"] >= 0.5


def test_items_of_mostly_placeholders(spark):
    items = ["Compute 3 * 4 + 17 / 2 - 9 * 6 exactly.", "What is 12 + 34 * 56 - 78?", "Alice Bob Carol Dora Edgar Frank Gina Henry Ida", "1 2 3 4 5 6 7 8 9 10 11 12"]
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id int, text string")
    others = ["Compute 5 * 1 + 12 / 7 - 3 * 8 exactly.", "What is 99 + 11 * 22 - 33?", "Ann Ben Cleo Dan Eve Fred Gus Hal Ian", "2 1 4 3 6 5 8 7 10 9 12 11"]
    docs = spark.createDataFrame([*enumerate(f"we were asked this: {t} and said no" for t in items + others)], "doc_id int, text string")
    got = {(r["doc_id"], r["item_id"], r["share"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(k, k, 1.0) for k in range(4)}


def test_marks_inside_numbers(spark):
    texts = {"1,200 and 12.50 and 1,234,567.89": ["1200", "and", "12\x0450", "and", "1234567\x0489"], "-5, 10-5, 1,2,3 (3,4) on 12.05.2020.": ["\x035", "10", "5", "1", "2", "3", "3", "4", "on", "12", "05", "2020"]}
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r[0]: r[1] for r in docs.select("text", decontaminate._marked_words(F.col("text"))).collect()} == texts


def test_planted_passages_and_clean_texts(spark):
    base = "/root/testdata/sf0.01"
    docs, benchmark = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    items = benchmark.collect()
    want = {(d, b["item_id"]) for d, t in rows_of(docs) for b in items if b["text"] in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert want and want <= got and len(got - want) <= 0.1 * len(want)


def test_decontamination_edge(spark, edge):
    benchmark = spark.createDataFrame([(1, edge.where("doc_id = 3").first()["text"])], "item_id bigint, text string")
    got = {r["doc_id"] for r in decontaminate.contaminated(edge, benchmark).collect()}
    assert {3, 4, 5, 15} <= got and not got & {0, 1, 2, 7, 8, 13, 14}


# --- 10 --------------------------------------------------------------------


def test_base_spans(edge, small):
    for docs in (edge, small):
        want = Counter()
        for d, t in rows_of(docs):
            found = brute.personal(t)
            joined = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in found[k])
            want[(d, *(len(found[k]) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest())] += 1
        got = pii.span_digest(docs).collect()
        assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_base_spans_of_random_strings():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choices("a1@.+-( 0492%", k=rng.randint(1, 24)))
        assert pii.detect(t) == brute.personal(t)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("mail john (at) example [dot] com now", [("email", "john (at) example [dot] com")]),
        ("write to john at example dot com", [("email", "john at example dot com")]),
        ("jоhn@exаmple.com", [("email", "jоhn@exаmple.com")]),
        ("call plus one five five five one two three four five six seven please", [("phone", "plus one five five five one two three four five six seven")]),
        ("one nine two dot one six eight dot one dot one", [("ip", "one nine two dot one six eight dot one dot one")]),
        ("192 dot 168 dot 0 dot 12", [("ip", "192 dot 168 dot 0 dot 12")]),
        ("card four " + "one " * 14 + "one", [("card", "four " + "one " * 14 + "one")]),
        ("４111 1111 1111 1111", [("card", "４111 1111 1111 1111")]),
        ("call plus one 415 five five five 0142 now", [("phone", "plus one 415 five five five 0142")]),
        ("call +1 555 one two three 4567 now", [("phone", "+1 555 one two three 4567")]),
        ("call +1 415 555 01 four two now", [("phone", "+1 415 555 01 four two")]),
        ("call plus 1 4 1 5 5 5 5 0 1 4 2 now", [("phone", "plus 1 4 1 5 5 5 5 0 1 4 2")]),
        ("call +1 (four one five) 555-0142 now", [("phone", "+1 (four one five) 555-0142")]),
        ("call +1 415 555 014two now, +1 41 two", []),
        ("he is at home. dot com", []),
        ("at one two three of the nine, at the end", []),
        ("", []),
    ],
)
def test_disguises(text, found):
    assert [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text) if not s.base] == found


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 100_000, "a.b" * 40_000, "one " * 30_000, "a@" * 50_000, "(at) " * 30_000, "a dot " * 30_000, "one " * 30_000 + "onex", "1 (" * 30_000, "+1" + "(" * 100_000])
def test_long_texts_take_linear_time(text):
    import time

    began = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - began < 10


def test_redaction(edge, nothing, spark):
    docs = spark.createDataFrame([(1, "ask a@b.co or x (at) y dot org."), (2, None)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()} == {1: "ask [EMAIL] or [EMAIL].", 2: None}
    assert pii.with_spans(edge).select("doc_id", "spans").count() == edge.count()
    assert pii.span_digest(nothing).count() == 0


# --- the whole -------------------------------------------------------------


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as cp

    base = f"/tmp/run-{uuid.uuid4().hex}"
    clean = [f"The {w} walked over the old bridge and looked at the {w} river for a long time with the others of the {w} town" for w in ("farmer", "teacher", "sailor")]
    rows = [
        (1, clean[0]), (2, clean[1]), (3, clean[2]), (4, clean[0]), (5, "1234 5678 ####"), (6, f"Once more: {ITEM} so it was said"), (7, clean[2].replace("others", "friend") + " call a@b.co"), (8, None), (9, ""),
    ]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    d = spark.read.parquet(f"{base}/documents.parquet")
    kept = []
    for _, stage in cp.STAGES[:-1]:
        d = stage(spark, d, base)
        assert d.columns == docs.columns
        kept.append({r["doc_id"] for r in d.collect()})
    assert kept[0] == {1, 2, 3, 4, 6, 7}
    assert kept[1] >= {1, 2, 3, 6} and 4 not in kept[1]
    assert 6 not in kept[2] and kept[2] >= {1, 2, 3}
    assert {r["doc_id"] for r in cp.run(spark, base).select("doc_id").distinct().collect()} == kept[-1]


def test_stages_decide_by_row(spark):
    import corpus_pipeline as cp

    base = f"/tmp/run-{uuid.uuid4().hex}"
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    a, b, c, d = (f"The {w} walked over the old bridge and looked at the {w} river for a long time with the others of the {w} town" for w in ("farmer", "teacher", "sailor", "baker"))
    rows = [(3, a), (None, a), (2, a), (2, a), (None, b), (None, b), (None, c), (7, d), (7, c + " and of all the other towns that lie along the same long river, far away from any sea"), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = Counter((r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs, base).collect())
    assert kept == Counter([(2, a), (None, b), (None, c), (7, d), (7, rows[8][1]), (8, None), (8, None)])
    rows = [(None, a), (None, f"so: {ITEM}"), (5, b), (5, f"and {ITEM}"), (6, c), (6, c)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = Counter((r["doc_id"], r["text"]) for r in cp.benchmark_texts(spark, docs, base).collect())
    assert kept == Counter([(None, a), (5, b), (6, c), (6, c)])


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for _ in range(500):
        common = rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, 200)).astype(np.uint64)])) for _ in range(2))
        assert jaccard.differing(jaccard.parity_bitmap(a), jaccard.parity_bitmap(b)) <= len(np.setxor1d(a, b))
