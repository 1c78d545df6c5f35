"""N-gram Jaccard join by vertical partitioning.

A text is the set of its distinct word n-grams (hashes of 64 bits, lower case
for A-Z); a text of fewer words is its whole sequence as one n-gram, a text
without words, or null, the empty set, which links with nothing.  Two texts
link when ``100 * intersection >= percent * union``.

1. Global n-gram order: n-grams that many texts hold come last (the
   ``FREQUENT`` most held ones above ``FREQUENT_FROM`` texts), all others
   first, by hash.  Any order gives the same links; this one keeps passages
   that many texts share out of the prefixes.
2. Candidates: two sets that link share an n-gram among the first
   ``size - ceil(least overlap) + 1`` of each (prefix filter, no cap).  Where
   up to ``PAIRED`` sets share one, their pairs are tested by size and by
   parity bitmaps: bits that differ are n-grams that differ, so a pair with
   too many of them can't link.  Where more share one, a star of one row per
   set stands for the pairs.  Pairs left and stars form families (their
   connected components), which hold all links.
3. Vertical partitioning: a family's n-grams, in global order, are cut into
   fragments of ``FRAGMENT`` columns; each fragment's partial overlaps are
   counted separately as products of bit rows, and summed per pair.  A
   family too large for a task is cut into blocks of bounded size and every
   pair of blocks with compatible set sizes is one task.  A task returns a
   spanning forest of its links and each set's number of links, not pairs.
4. The components of the links are the classes.

Equal sets are one node (identified by 64 bits); copies are never expanded
into pairs.  Ties: a class is named by its smallest doc_id; repeated rows
are equal sets.  A null doc_id stays null and can't name a class unless it
holds nothing else.  No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, scratch
from .components import components
from .textbytes import LOWER, U64, WHITE_SPACE, chunks, hash_spans, mix, ngrams, spans

#: N-grams held by more texts than this come last in the global order, at
#: most so many of them (8 MB for every task); this bounds memory, not results.
FREQUENT_FROM = 32
FREQUENT = 1_000_000
#: Parts that a frequent prefix n-gram's texts are dealt to.
SALTS = 64
#: Sets that share a prefix n-gram, up to which their pairs are tested one by
#: one; beyond, the block tasks test them all.
PAIRED = 32
#: A task's block: n-grams and sets at most, on average.
BLOCK_GRAMS = 400_000
BLOCK_SETS = 1024
FRAGMENT = 1 << 14
#: Rows up to which the table of family members (about 150 bytes each) is
#: broadcast; beyond: a shuffle.
BROADCAST_ROWS = 250_000


def least_overlap(sizes: np.ndarray | int, percent: int):  # noqa: ANN201
    """Of two sets with so many n-grams together, if they link."""
    return -(-percent * sizes // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """A partner has at least percent * n / 100 n-grams and shares at least
    as many, so at most the rest can be missed."""
    return n - -(-percent * n // 100) + 1


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position in the batch, sorted distinct hashes) of every text."""
    for c in chunks(texts):
        starts, ends, first = spans(c, WHITE_SPACE)
        words = hash_spans(LOWER[c.data], starts, ends)
        grams = ngrams(words, n)
        for k in range(c.hi - c.lo):
            a, b = first[k], first[k + 1]
            if b - a >= n:
                yield c.lo + k, np.unique(grams[a : b - n + 1])
            elif b > a:  # a short text never equals an n-gram
                yield c.lo + k, mix(ngrams(words[a:b], int(b - a)) + U64(b - a))
            else:
                yield c.lo + k, np.zeros(0, U64)


def fingerprint(grams: np.ndarray) -> int:
    """64 bits for a whole set, as a signed number."""
    total = int(np.add.reduce(mix(grams + U64(0x51)), dtype=U64)) ^ (len(grams) << 1)
    return int(mix(np.array([total], U64)).astype(np.int64)[0])


def parity_bitmap(grams: np.ndarray) -> bytes:
    """For each residue of the hashes whether an odd number of n-grams has
    it; as many bits as half the set's size, rounded up to a power of two."""
    width = max(64, 1 << max(0, (len(grams) // 2 - 1).bit_length()))
    odd = np.bincount((grams & U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """At most the number of n-grams that one set has and the other not;
    the wider bitmap is folded to the narrower one's residues."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) != len(y):
        narrow = min(len(x), len(y))
        x = np.bitwise_xor.reduce(x.reshape(-1, narrow), 0)
        y = np.bitwise_xor.reduce(y.reshape(-1, narrow), 0)
    return int(np.bitwise_count(x ^ y).sum())


def _frequent(texts: DataFrame, n: int, percent: int) -> np.ndarray:
    """The n-grams that come last, sorted by hash.  Counted over all texts,
    among the first 1.5 prefixes of each in the order by hash alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            h, m = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(h.view(np.int64)), pa.array(m.astype(np.int32))], names=["h", "n"])

        for b in batches:
            for _, grams in shingle_sets(b.column(0), n):
                early = grams[: prefix_length(len(grams), percent) * 3 // 2] if len(grams) else grams
                held.append(early)
                size += len(early)
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    counts = texts.select("text").mapInArrow(count, "h bigint, n int").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") > FREQUENT_FROM).orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(U64))


def _prefixes(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n_shingles, fp, keys (the prefix in global order) and
    bits (the parity bitmap), both given once for equal sets of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = shared.value, set()
        for b in batches:
            size, fps, keys, bits = [], [], [], []
            for _, grams in shingle_sets(b.column(2), n):
                size.append(len(grams))
                fps.append(fingerprint(grams))
                key, bit = grams[:0], None
                if len(grams) and fps[-1] not in told:
                    told.add(fps[-1])
                    bit = parity_bitmap(grams)
                    want = prefix_length(len(grams), percent)
                    late = _among(grams, last)
                    key = grams[~late][:want]
                    if len(key) < want:
                        key = np.concatenate([key, grams[late][: want - len(key)]])
                keys.append(key.view(np.int64))
                bits.append(bit)
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "fp", "keys", "bits"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, fp bigint, keys array<bigint>, bits binary")


def _among(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(grams), bool)
    at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
    return table[at] == grams


def _families(sets: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """(fp, family) of all sets that may link with another."""
    keys = sets.select("fp", F.col("n_shingles").cast("int").alias("n"), F.explode("keys").alias("key"))
    # the texts of a frequent n-gram are dealt to SALTS groups
    keys = keys.join(F.broadcast(frequent), "key", "left")
    keys = keys.withColumn("part", F.when(F.col("often"), F.pmod(F.xxhash64("fp"), F.lit(SALTS))).otherwise(0))
    group = Window.partitionBy("key", "part")
    held = keys.withColumn("hub", F.min("fp").over(group)).withColumn("far", F.max("fp").over(group)).withColumn("rows", F.count(F.lit(1)).over(group))
    held = held.where(F.col("often") | (F.col("hub") != F.col("far")))
    held = checkpointed(held.select("fp", "n", "hub", "key", (F.col("often").isNotNull() | (F.col("rows") > PAIRED)).alias("star"), "often"))
    stars = held.where("star")
    # the groups of one frequent n-gram are joined at their hubs
    hubs = stars.where("often").select("key", "hub").distinct()
    least = hubs.groupBy(F.col("key").alias("k")).agg(F.min("hub").alias("top"))
    across = hubs.join(least, F.col("key") == F.col("k")).select("hub", "top")
    # pairs of the few sets that share an n-gram, larger set first
    few = held.where("not star").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("n", "fp")), asc=False).alias("sets"))
    small = F.filter(F.slice("sets", F.col("pos") + 2, PAIRED), lambda x: x["n"] * 100 >= F.col("a")["n"] * percent)
    pairs = few.select("sets", F.posexplode("sets").alias("pos", "a")).select("a", F.explode(small).alias("b")).distinct()
    bitmap = checkpointed(sets.where("bits is not null").groupBy("fp").agg(F.first("bits").alias("bits")))
    of = lambda x: bitmap.select(F.col("fp").alias(f"fp_{x}"), F.col("bits").alias(f"bits_{x}"))
    pairs = pairs.select(F.col("a.fp").alias("fp_a"), F.col("b.fp").alias("fp_b"), (F.col("a.n") + F.col("b.n")).alias("n")).join(of("a"), "fp_a").join(of("b"), "fp_b")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy().astype(np.int64)
            most = n - 2 * least_overlap(n, percent)
            diff = np.fromiter((differing(x, y) for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)), np.int64, len(n))
            yield b.select([0, 1]).filter(pa.array(diff <= most))

    pairs = pairs.select("fp_a", "fp_b", "n", "bits_a", "bits_b").mapInArrow(alike, "fp_a bigint, fp_b bigint")
    edges = stars.select("fp", "hub").union(across).union(pairs)
    return components(edges, "fp", "hub").select(F.col("node").alias("fp"), F.col("root").alias("family"))


def _size_class(n: F.Column, percent: int) -> F.Column:
    """Sets whose sizes differ by more than one class can't link."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def _links(docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """(fp, other, links): a spanning forest of the links of each task, and
    at other = fp the number of rows a set links with in that task.
    nodes: fp, family, doc_id and text_hash of one of its texts, copies,
    n_shingles."""
    nodes = nodes.withColumn("size_class", _size_class(F.col("n_shingles"), percent))
    whole = nodes.groupBy("family").agg(F.sum("n_shingles").alias("grams"), F.count(F.lit(1)).alias("sets"))
    per = nodes.groupBy("family", "size_class").agg(F.sum("n_shingles").alias("grams"), F.count(F.lit(1)).alias("sets"))
    blocks = lambda: F.ceil(F.greatest(F.col("grams") / BLOCK_GRAMS, F.col("sets") / BLOCK_SETS)).cast("int")
    per = per.select("family", "size_class", blocks().alias("blocks"))
    large = whole.where((F.col("grams") > BLOCK_GRAMS) | (F.col("sets") > BLOCK_SETS)).select("family", F.lit(True).alias("large"))
    at = per.select("family", F.col("size_class").alias("_c"), F.col("blocks").alias("_b"))
    near = lambda step, name: at.select("family", (F.col("_c") + step).alias("size_class"), F.col("_b").alias(name))
    plan = per.join(near(1, "below"), ["family", "size_class"], "left").join(near(-1, "above"), ["family", "size_class"], "left")
    rows = nodes.join(large, "family", "left").join(plan, ["family", "size_class"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    c = F.col("size_class")

    def task(low_class, low, high_class, high) -> F.Column:  # noqa: ANN001
        cells = (low_class, low, high_class, high)
        return F.struct(*(x.cast("int").alias(k) for k, x in zip(("c1", "b1", "c2", "b2"), cells, strict=True)))

    # every pair of blocks of one class, and of neighbouring classes
    same = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: task(c, F.least(j, own), c, F.greatest(j, own)))
    none = F.array().cast("array<struct<c1:int,b1:int,c2:int,b2:int>>")
    up = F.when(F.col("above").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda j: task(c, own, c + 1, j))).otherwise(none)
    down = F.when(F.col("below").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda j: task(c - 1, j, c, own))).otherwise(none)
    minus = F.lit(-1)
    tasks = F.when(F.col("large"), F.concat(same, up, down)).otherwise(F.array(task(minus, minus, minus, minus)))
    rows = rows.select("fp", "doc_id", "text_hash", "copies", F.concat(F.when(F.col("large"), c).otherwise(-1), F.lit(":"), F.when(F.col("large"), own).otherwise(-1)).alias("mine"), "family", tasks.alias("tasks"))

    few = rows.count() <= BROADCAST_ROWS
    # the row of one text for each set; rows without doc_id, or that share one,
    # meet the sets of their own text only
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    same_row = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    rows = texts.join(F.broadcast(rows) if few else rows, same_row)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = set()
        for b in batches:
            grams = [g for _, g in shingle_sets(b.column(0), n)]
            # repeated rows bring a set once in a task
            keep = []
            for k, (g, fp) in enumerate(zip(grams, b.column(1).to_pylist(), strict=True)):
                if fp not in told and fingerprint(g) == fp:
                    told.add(fp)
                    keep.append(k)
            part = b.take(pa.array(keep, pa.int64()))
            yield pa.record_batch([*part.columns[1:], pa.array([grams[k].view(np.int64) for k in keep], pa.list_(pa.int64()))], names=["fp", "copies", "mine", "family", "tasks", "grams"])

    kind = "fp bigint, copies bigint, mine string, family bigint, tasks array<struct<c1:int,b1:int,c2:int,b2:int>>, grams array<bigint>"
    rows = rows.select("text", "fp", "copies", "mine", "family", "tasks").mapInArrow(hashed, kind)
    rows = rows.select("fp", "copies", "mine", "family", "grams", F.explode("tasks").alias("task"))

    def link(table: pa.Table) -> pa.Table:
        fp, once = np.unique(table.column("fp").to_numpy(), return_index=True)
        table = table.take(pa.array(once))  # a repeated row may bring a set twice
        grams = [x.values.to_numpy().view(U64) for x in table.column("grams")]
        task = table.column("task")[0].as_py()
        sides = table.column("mine").to_pylist()
        first = f"{task['c1']}:{task['b1']}"
        left = np.array([s == first for s in sides])
        across = task["c1"] != task["c2"] or task["b1"] != task["b2"]
        u, v, links = link_block(grams, table.column("copies").to_numpy(), left if across else None, percent)
        some = np.flatnonzero(links)
        return pa.table({
            "fp": pa.array(np.concatenate([fp[u], fp[some]]), pa.int64()),
            "other": pa.array(np.concatenate([fp[v], fp[some]]), pa.int64()),
            "links": pa.array(np.concatenate([np.zeros(len(u), np.int64), links[some]]), pa.int64()),
        })

    return rows.groupBy("family", "task").applyInArrow(link, "fp bigint, other bigint, links bigint")


def link_block(grams: list[np.ndarray], copies: np.ndarray, left: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links among sets (``left`` given: between those and the others only):
    the edges of a spanning forest as two arrays of positions, and for each
    set the number of copies it links with."""
    n = len(grams)
    size = np.array([len(g) for g in grams], np.int64)
    order = np.argsort(size, kind="stable")
    size = size[order]
    flat = np.concatenate([grams[k] for k in order]) if n else np.zeros(0, U64)
    of = np.repeat(np.arange(n), size)
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    shared = held > 1  # an n-gram that one set holds overlaps with nothing
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, of = number[column[keep]], of[keep]
    total = int(shared.sum())
    # partners of a set by size: those up to 100 / percent times as large
    reach = np.searchsorted(size, size * 100 // percent, side="right")
    overlap = [np.zeros(max(0, reach[i] - i - 1), np.int32) for i in range(n)]
    for lo in range(0, total, FRAGMENT):  # fragments of the global order
        inside = (column >= lo) & (column < lo + FRAGMENT)
        width = min(FRAGMENT, total - lo)
        bits = np.zeros((n, -(-width // 64)), U64)
        at = column[inside] - lo
        np.bitwise_or.at(bits, (of[inside], at >> 6), U64(1) << (at & 63).astype(U64))
        for i in range(n):
            if len(overlap[i]):
                used = np.flatnonzero(bits[i])  # words of the row that hold anything
                if len(used):
                    # few rows at a time, so that the products stay small
                    step = max(1, (1 << 20) // len(used))
                    for j in range(i + 1, reach[i], step):
                        part = bits[j : min(reach[i], j + step)][:, used]
                        overlap[i][j - i - 1 : j - i - 1 + len(part)] += np.bitwise_count(part & bits[i][used]).sum(1, dtype=np.int32)
    side = left[order] if left is not None else None
    many = copies[order]
    links = np.zeros(n, np.int64)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    u, v = [], []
    for i in range(n):
        js = np.arange(i + 1, i + 1 + len(overlap[i]))
        good = overlap[i] >= least_overlap(size[i] + size[js], percent)
        if side is not None:
            good &= side[js] != side[i]
        js = js[good]
        links[i] += many[js].sum()
        links[js] += many[i]
        for j in js.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                u.append(order[i])
                v.append(order[j])
    out = np.zeros(n, np.int64)
    out[order] = links
    return np.array(u, np.int64), np.array(v, np.int64), out


def jaccard_classes(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (rows a row links with) of
    every row."""
    spark = docs.sparkSession
    frequent = _frequent(docs, n, percent)
    path = scratch(spark, "sets")
    _prefixes(docs, n, percent, frequent).write.parquet(path)
    sets = spark.read.parquet(path)
    late = spark.createDataFrame(pa.table({"key": pa.array(frequent.view(np.int64)), "often": pa.array(np.ones(len(frequent), bool))}))
    family = checkpointed(_families(sets, late, percent))
    # one row per set, counted in each task before the shuffle
    by_set = sets.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"))
    by_set = checkpointed(by_set)
    links = checkpointed(_links(docs, by_set.join(family, "fp"), n, percent))
    classes = components(links, "fp", "other").select(F.col("node").alias("fp"), "root")
    n_links = links.groupBy("fp").agg(F.sum("links").alias("links"))
    named = by_set.join(classes, "fp", "left").join(n_links, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    # few columns: copies of one set are many rows of one key, which the
    # adaptive join splits; empty sets go round it
    some = sets.where("n_shingles > 0").select("doc_id", "n_shingles", "fp").join(named, "fp")
    some = some.select("doc_id", "n_shingles", "component_id", "n_links")
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"))
    return some.union(empty)
