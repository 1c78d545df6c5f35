"""Near-duplicates by MinHash signatures.

A text is the set of its distinct word n-grams (64-bit hashes, lower case
for A-Z); a text of fewer words is its whole sequence as one, a text without
words, or null, the empty set, which links with nothing.  Two texts link
when ``100 * intersection >= percent * union``.

1. Signature: the minima of ``BANDS * ROWS`` universal hash functions
   ``((a * x + b) mod 2**64) >> 32`` of the set's n-grams, 16 bits of each.
   Equal sets are one node, whatever their number of copies.
2. Banding: sets that agree in all ``ROWS`` minima of a band share a bucket.
   A pair of similarity s shares none with a probability of
   ``(1 - s**ROWS)**BANDS``: 6e-9 at 0.85, 4e-8 at 0.8.
3. Signature verification: of a bucket of up to ``PAIRED`` sets the pairs of
   compatible size are compared; those that agree in fewer minima than
   ``least_agreement`` (six standard deviations below the threshold) go.  A
   bucket of more sets is a star: they are compared in the tasks of step 4.
4. Confirmation: pairs left and stars make families (connected components).
   A family's sets come together in one task, or in a task for each pair of
   blocks of it; there signatures are compared, pairs that may link are
   confirmed on the full sets, and a spanning forest of the links is kept.
   Pairs already joined by links are not confirmed again.  A large family's
   blocks are first linked within themselves and with its first block; only
   families that are not one class by then go on to all pairs of blocks.
5. The links' components, by alternating large-star and small-star, are the
   classes.

Nothing is capped: a bucket or family of any size is compared in blocks.
Ties: a class is named by its smallest doc_id.  Repeated rows are equal sets
and have the same result; a null doc_id stays null and names a class only
if it holds nothing else (then no row of it is kept by name, and ``kept`` is
true for all its rows).  No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, scratch
from .components import components
from .textbytes import LOWER, U64, WHITE_SPACE, chunks, hash_spans, mix, ngrams, spans

BANDS, ROWS = 40, 6
#: Sets of a bucket up to which its pairs are compared one by one.
PAIRED = 32
#: A task's block: n-grams and sets at most, on average.
BLOCK_GRAMS = 400_000
BLOCK_SETS = 1024
#: Rows up to which the table of family members (24 bytes each) is broadcast;
#: beyond: a shuffle.
BROADCAST_ROWS = 500_000

_RANDOM = np.random.default_rng(20_041)
_A = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | U64(1)
_B = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)


def least_agreement(percent: int) -> int:
    """Equal minima of a pair that may link: six standard deviations fewer
    than a pair at the threshold has on average."""
    s, n = percent / 100, BANDS * ROWS
    return int(n * s - 6 * (n * s * (1 - s)) ** 0.5)


# --- sets and signatures ----------------------------------------------------


def shingles(texts: pa.Array, n: int) -> Iterator[list[np.ndarray]]:
    """The batch's texts as sets (sorted distinct hashes), some at a time."""
    for c in chunks(texts):
        starts, ends, first = spans(c, WHITE_SPACE)
        words = hash_spans(LOWER[c.data], starts, ends)
        grams = ngrams(words, n)
        sets = []
        for k in range(c.hi - c.lo):
            a, b = first[k], first[k + 1]
            if b - a >= n:
                sets.append(np.unique(grams[a : b - n + 1]))
            elif b > a:  # a short text never equals an n-gram
                sets.append(mix(ngrams(words[a:b], int(b - a)) + U64(b - a)))
            else:
                sets.append(np.zeros(0, U64))
        yield sets


def identity(grams: np.ndarray) -> int:
    """64 bits for a whole set, as a signed number."""
    total = int(np.add.reduce(mix(grams ^ U64(0xA5A5)), dtype=U64)) + len(grams)
    return int(mix(np.array([total & (1 << 64) - 1], U64)).view(np.int64)[0])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima (16 bits of each) for every set, none of them empty."""
    if not sets:
        return np.zeros((0, BANDS * ROWS), np.uint16)
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), BANDS * ROWS), np.uint16)
    hashed = np.empty_like(flat)
    for k, (a, b) in enumerate(zip(_A, _B, strict=True)):
        np.multiply(flat, a, out=hashed)
        hashed += b
        # the low bits of the upper half
        out[:, k] = np.minimum.reduceat(hashed, at) >> U64(32) & U64(0xFFFF)
    return out


def _signed(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (64 bits of the set) and signature
    (given once for equal sets of a task)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for b in batches:
            size, nodes, signed = [], [], []
            for sets in shingles(b.column(2), n):
                ids = [identity(s) for s in sets]
                new = {i: k for k, (i, s) in enumerate(zip(ids, sets, strict=True)) if len(s) and i not in told}
                told.update(new)
                part: list[bytes | None] = [None] * len(sets)
                for k, row in zip(new.values(), signatures([sets[k] for k in new.values()]), strict=True):
                    part[k] = row.tobytes()
                size += map(len, sets)
                nodes += ids
                signed += part
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signed, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "node", "signature"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, node bigint, signature binary")


# --- candidates -------------------------------------------------------------


def _families(signed: DataFrame, percent: int) -> DataFrame:
    """(node, family) of all sets that may link with another.  signed: node,
    n_shingles, signature, one row each."""
    width = 2 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("signature"), k * width + 1, F.lit(width))))
    rows = signed.select("node", F.col("n_shingles").cast("int").alias("n"), F.explode(bands).alias("bucket"))
    # counted in each task before the shuffle, so that a hot bucket is one row a task
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("hub")).where("many > 1")
    held = checkpointed(rows.join(shared, "bucket"))
    stars = held.where((F.col("many") > PAIRED) & (F.col("node") != F.col("hub"))).select("node", "hub").distinct()
    few = held.where(F.col("many") <= PAIRED).groupBy("bucket").agg(F.sort_array(F.collect_set(F.struct("n", "node")), asc=False).alias("sets"))
    # larger set first
    small = F.filter(F.slice("sets", F.col("pos") + 2, PAIRED), lambda x: x["n"] * 100 >= F.col("a")["n"] * percent)
    pairs = few.select("sets", F.posexplode("sets").alias("pos", "a")).select(F.col("a.node").alias("node"), F.explode(small).alias("b"))
    pairs = pairs.select("node", F.col("b.node").alias("other")).distinct()
    of = lambda x, name: signed.select(F.col("node").alias(x), F.col("signature").alias(name))
    both = pairs.join(of("node", "s"), "node").join(of("other", "t"), "other").select("node", "other", "s", "t")
    least = least_agreement(percent)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, t = (np.array([np.frombuffer(x, np.uint16) for x in b.column(k).to_pylist()]).reshape(b.num_rows, -1) for k in (2, 3))
            yield b.select([0, 1]).filter(pa.array((s == t).sum(1) >= least))

    edges = both.mapInArrow(alike, "node bigint, other bigint").union(stars)
    return components(edges, "node", "other").select("node", F.col("root").alias("family"))


# --- confirmation -----------------------------------------------------------


def confirm(grams: list[np.ndarray], signed: np.ndarray, left: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among sets (``left`` given: between those and the others only)
    as the edges of a spanning forest, two arrays of positions."""
    n = len(grams)
    size = np.array([len(g) for g in grams], np.int64)
    order = np.argsort(size, kind="stable")
    size, signed = size[order], signed[order]
    sets = [grams[k] for k in order]
    side = left[order] if left is not None else None
    label = np.arange(n)
    reach = np.searchsorted(size, size * 100 // percent, side="right")
    least = least_agreement(percent)
    u, v = [], []
    for i in range(n):
        js = np.arange(i + 1, reach[i])
        js = js[label[js] != label[i]]
        if side is not None:
            js = js[side[js] != side[i]]
        # a few at a time: a link found joins many of the rest
        for lo in range(0, len(js), 256):
            part = js[lo : lo + 256]
            part = part[label[part] != label[i]]
            part = part[(signed[part] == signed[i]).sum(1) >= least]
            for j in part.tolist():
                if label[j] == label[i]:
                    continue
                both = size[i] + size[j]
                common = both - len(np.union1d(sets[i], sets[j]))
                if 100 * common >= percent * (both - common):
                    label[label == label[j]] = label[i]
                    u.append(order[i])
                    v.append(order[j])
    return np.array(u, np.int64), np.array(v, np.int64)


def _cell(low_class: Column, low: Column, high_class: Column, high: Column) -> Column:
    return F.struct(*(x.cast("int").alias(k) for k, x in (("c1", low_class), ("b1", low), ("c2", high_class), ("b2", high))))


def _size_class(n: Column, percent: int) -> Column:
    """Sets whose sizes are more than one class apart can't link."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def _tasks(members: DataFrame, percent: int) -> DataFrame:
    """members (node, family, n_shingles) with large (the family is cut into
    blocks), mine (the row's block) and tasks (of the pairs of blocks that it
    takes part in; one task for a family that isn't large).  Blocks hold sets
    of one size class; only equal and neighbouring classes meet."""
    rows = members.withColumn("size_class", _size_class(F.col("n_shingles"), percent))
    total = [F.sum("n_shingles").alias("grams"), F.count(F.lit(1)).alias("sets")]
    large = rows.groupBy("family").agg(*total).where((F.col("grams") > BLOCK_GRAMS) | (F.col("sets") > BLOCK_SETS)).select("family", F.lit(True).alias("large"))
    blocks = F.ceil(F.greatest(F.col("grams") / BLOCK_GRAMS, F.col("sets") / BLOCK_SETS)).cast("int")
    at = rows.groupBy("family", "size_class").agg(*total).select("family", "size_class", blocks.alias("blocks"))
    near = lambda step, name: at.select("family", (F.col("size_class") + step).alias("size_class"), F.col("blocks").alias(name))
    plan = at.join(near(1, "below"), ["family", "size_class"], "left").join(near(-1, "above"), ["family", "size_class"], "left")
    # a family of many small sets can be large without any large class
    rows = rows.join(large, "family", "left").join(plan, ["family", "size_class"])
    c, own = F.col("size_class"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(upto(F.col("blocks")), lambda j: _cell(c, F.least(j, own), c, F.greatest(j, own)))
    up = F.transform(upto(F.col("above")), lambda j: _cell(c, own, c + 1, j))
    down = F.transform(upto(F.col("below")), lambda j: _cell(c - 1, j, c, own))
    one = F.lit(-1)
    tasks = F.when(F.col("large"), F.concat(same, up, down)).otherwise(F.array(_cell(one, one, one, one)))
    mine = F.when(F.col("large"), F.concat(c, F.lit(":"), own)).otherwise(F.lit("-1:-1"))
    return rows.select("node", "family", F.coalesce("large", F.lit(False)).alias("large"), mine.alias("mine"), tasks.alias("tasks"))


def _first(task: Column) -> Column:
    """A block with itself, with its class's first, with the next class's first."""
    return F.when(task["c1"] == task["c2"], (task["b1"] == task["b2"]) | (task["b1"] == 0)).otherwise(task["b2"] == 0)


def _sets(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """node, grams and signature of the members (node, text_hash): one text
    is read for each, copies go before the texts are moved."""
    few = members.count() <= BROADCAST_ROWS
    wanted = members.select("node", "text_hash")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").where("text IS NOT NULL")
    texts = texts.join(F.broadcast(wanted) if few else wanted, "text_hash").select("node", "text").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for sets in shingles(b.column(1), n):
                yield pa.record_batch(
                    [b.column(0).slice(lo, len(sets)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([s.tobytes() for s in signatures(sets)], pa.binary())],
                    names=["node", "grams", "signature"],
                )
                lo += len(sets)

    return texts.mapInArrow(run, "node bigint, grams array<bigint>, signature binary")


def _linked(sets: DataFrame, tasks: DataFrame, percent: int) -> DataFrame:
    """(node, other): spanning forests of the tasks' links.  tasks: node,
    family, mine, tasks."""

    def link(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        grams = [x.values.to_numpy().view(U64) for x in table.column("grams")]
        signed = np.array([np.frombuffer(x, np.uint16) for x in table.column("signature").to_pylist()])
        task = table.column("task")[0].as_py()
        first = f"{task['c1']}:{task['b1']}"
        left = np.array([m == first for m in table.column("mine").to_pylist()])
        across = (task["c1"], task["b1"]) != (task["c2"], task["b2"])
        u, v = confirm(grams, signed, left if across else None, percent)
        return pa.table({"node": pa.array(nodes[u], pa.int64()), "other": pa.array(nodes[v], pa.int64())})

    rows = sets.join(tasks, "node").select("node", "family", "mine", "grams", "signature", F.explode("tasks").alias("task"))
    return rows.groupBy("family", "task").applyInArrow(link, "node bigint, other bigint")


def _links(docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges that join all linked nodes.  members: node, family, n_shingles,
    text_hash."""
    spark = docs.sparkSession
    path = scratch(spark, "members")
    _sets(docs, members, n).write.parquet(path)
    sets = spark.read.parquet(path)
    tasks = checkpointed(_tasks(members, percent))
    pick = lambda wanted: F.filter("tasks", wanted)
    first = tasks.withColumn("tasks", F.when(F.col("large"), pick(_first)).otherwise(F.col("tasks"))).where(F.size("tasks") > 0)
    links = checkpointed(_linked(sets, first, percent))
    rest = tasks.where("large").withColumn("tasks", pick(lambda t: ~_first(t))).where(F.size("tasks") > 0)
    if rest.limit(1).count():
        # only families that are still several classes
        classes = components(links, "node", "other")
        large = tasks.where("large").select("node", "family").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = large.groupBy("family").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("family")
        rest = checkpointed(rest.join(several, "family", "left_semi"))
        if rest.limit(1).count():
            links = checkpointed(links.union(_linked(sets, rest, percent)))
    return links


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    path = scratch(spark, "signatures")
    _signed(docs, n).write.parquet(path)
    rows = spark.read.parquet(path)
    some = rows.where("n_shingles > 0")
    nodes = some.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.max("n_shingles").alias("n_shingles"))
    nodes = checkpointed(nodes)
    path = scratch(spark, "nodes")
    some.where("signature IS NOT NULL").select("node", "n_shingles", "signature").dropDuplicates(["node"]).write.parquet(path)
    family = checkpointed(_families(spark.read.parquet(path), percent))
    members = checkpointed(nodes.join(family, "node").select("node", "family", "n_shingles", "text_hash"))
    classes = components(_links(docs, members, n, percent), "node", "other").select("node", "root")
    named = nodes.select("node", "doc_id").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    # few columns: copies of one set are many rows of one key, which the
    # adaptive join splits; empty sets go round it
    found = some.select("doc_id", "n_shingles", "node").join(named, "node").select("doc_id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
