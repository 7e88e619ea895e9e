"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are runs of five words; a shingle weighs its count in the text times the mean inverse document frequency of its
words. Document frequencies are counted over all documents in SLOTS hashed counters, so every task holds a table of fixed size; a
frequency below one thousandth of the documents counts as that. Of each text SAMPLES consistent weighted samples are drawn: two
texts agree on one with the probability of their weighted Jaccard similarity. Bands are the lines of the affine plane of order
four: 20 sets of four samples, any two samples in exactly one of them. Two texts at 0.8 that agree in no band disagree on 7 of 16 samples or more
and those 7 meet all 20 lines. Texts that share a band are candidates; a link is a pair whose weighted Jaccard similarity, worked
out from both whole texts, is at least 0.8. Classes are the connected texts.

Every candidate pair is compared, or of one class already, or ruled out by a bound that no link passes:

1. In each bucket every text meets the head, the text that shares most buckets with others, so a group of copies around one
   original is settled by one comparison a text.
2. The texts of buckets that still hold several classes are posted under their rarest shingles. In any order that all texts share, the first common shingle
   of a link lies, for the lighter text, among the first ninth of its weight and for the heavier one among the first fifth (or else
   too little is left to share). The rarest come first, so a passage that many texts share posts only the texts that are little
   besides it. Weight in shingles that no other text has cannot be shared, which bounds the similarity of a pair once more.
3. Posts that hold several classes go on in rounds: a growing number of heads meet every text of another class, then leave. A
   pair meets in its first common post only. What is left of a post after its classes are merged costs one comparison for each pair of different classes
   that the bounds allow.

Exact copies are one text from the start. Texts of under five words are one shingle. A null text is empty; empty texts are copies
of each other. A null id takes part but never names a class unless all its ids are null. Repeated rows are copies. A text of any length is
read whole. Only the id and the text are read, so extra columns may have any name. An empty table has no classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressbeat.llm.common import bounded_broadcast, free_name, lengthy, map_arrow, materialize, text_of

SHINGLE, SAMPLES, SIMILAR = 5, 16, 0.8
RARE = 1000
SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS
TABLE = 1 << 16
AT_ONCE = 4_000
HEADS, MORE = 2, 4
#: Shingles of a text's post that are looked at to see whether a pair has met before.
FIRST = 32
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Multiplication in the field of four elements.
FIELD = ((0, 0, 0, 0), (0, 1, 2, 3), (0, 2, 3, 1), (0, 3, 1, 2))
LINES = [[4 * x + (FIELD[m][x] ^ b) for x in range(4)] for m in range(4) for b in range(4)] + [[4 * x + y for y in range(4)] for x in range(4)]
#: Rounding is given the benefit in every bound.
SLACK = 1e-6


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def words_in(text: str) -> list[str]:
    return text.lower().split()


class Words:
    """64-bit codes of words, kept while they are few: the table is cleared between texts, never inside one."""

    MOST = 500_000

    def __init__(self):
        self.slots: dict[str, int] = {}
        self.codes = np.zeros(1 << 16, np.uint64)

    def of(self, text: str) -> np.ndarray:
        words = words_in(text)
        if len(self.slots) >= self.MOST:
            self.slots.clear()
        slots, get = self.slots, self.slots.get
        at = []
        for word in words:
            k = get(word)
            if k is None:
                k = slots[word] = len(slots)
                if k >= len(self.codes):
                    self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
                self.codes[k] = xxhash.xxh64_intdigest(word)
            at.append(k)
        return self.codes[at]


def slots_of(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def common_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The number of documents that hold a word of each slot, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, words, n = np.zeros(SLOTS, np.int64), Words(), 0
        for batch in lengthy(batches):
            for text in batch.column(0).to_pylist():
                seen[np.unique(slots_of(words.of(text)))] += 1
                n += 1
        used = np.flatnonzero(seen)
        at, count = np.append(used, -1), np.append(seen[used], n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count, pa.int64())], ["slot", "n"])

    counted = map_arrow(docs.select(text_of().alias("text")), run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    frequency, total = np.zeros(SLOTS, np.int64), 0
    for part in counted.toArrow().to_batches():  # at most SLOTS + 1 rows
        slot, n = part.column("slot").to_numpy(), part.column("n").to_numpy()
        total += int(n[slot < 0].sum())
        frequency[slot[slot >= 0]] = n[slot >= 0]
    return frequency, total


class Weigher:
    """The weighted shingles of texts: 64-bit shingle codes and weights."""

    def __init__(self, frequency: np.ndarray, total: int):
        total = max(total, 1)
        self.weights = 1 + np.log(total / np.maximum(frequency, total / RARE))
        self.words = Words()

    def __getstate__(self):
        return self.weights

    def __setstate__(self, state):
        self.weights, self.words = state, Words()

    def shingles(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle codes, ascending, and their weights."""
        code = self.words.of(text)
        if not len(code):
            return np.zeros(0, np.uint64), np.zeros(0)
        weight = self.weights[slots_of(code)]
        width = min(SHINGLE, len(code))
        n = len(code) - width + 1
        mixed = np.full(n, width, np.uint64)
        total = np.zeros(n)
        for k in range(width):
            mixed = (mixed ^ code[k : k + n]) * MIX[0] + np.uint64(k)
            mixed ^= mixed >> np.uint64(29)
            total += weight[k : k + n]
        codes, first, count = np.unique(mixed, return_index=True, return_counts=True)
        return codes, count * total[first] / width


def random_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampler's random numbers: gamma(2, 1) steps, logarithms of gamma(2, 1) and uniform shifts, looked up by hash bits."""
    rng = np.random.default_rng(20)
    return rng.gamma(2, 1, TABLE), np.log(rng.gamma(2, 1, TABLE)), rng.random(TABLE)


STEP, LOG_C, SHIFT = random_tables()
SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * MIX[0]) | np.uint64(1)
LOW = np.uint64(TABLE - 1)


def samples(codes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples of the sets that begin at ``starts`` of the flat arrays: one row of SAMPLES codes a set."""
    key = codes[None, :] * SEEDS[:, None]
    key ^= key >> np.uint64(32)
    r = STEP[(key >> np.uint64(48)).astype(np.int64)]
    shift = SHIFT[(key >> np.uint64(32) & LOW).astype(np.int64)]
    t = np.floor(np.log(weights)[None, :] / r + shift)
    value = LOG_C[(key >> np.uint64(16) & LOW).astype(np.int64)] - r * (t - shift + 1)
    least = np.minimum.reduceat(value, starts, axis=1)
    hit = np.nonzero(value == np.repeat(least, np.diff(np.append(starts, len(codes))), axis=1))
    drawn = np.full(value.shape, np.uint64(0xFFFFFFFFFFFFFFFF))  # of equal values the least code counts
    drawn[hit] = mix(key[hit] + t[hit].astype(np.int64).astype(np.uint64) * MIX[0])
    return np.minimum.reduceat(drawn, starts, axis=1).T


def sketches(docs: DataFrame, weigher: Weigher) -> DataFrame:
    """One row per document: doc_id, digest of the text, its samples (none without words) and total weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lengthy(batches, 4 << 20):
            texts = batch.column(1).to_pylist()
            drawn: list = [[]] * len(texts)
            totals, held, size = [], [], 0

            def flush() -> None:
                if held:
                    starts = np.cumsum([0] + [len(c) for _, c, _ in held[:-1]])
                    found = samples(np.concatenate([c for _, c, _ in held]), np.concatenate([w for _, _, w in held]), starts)
                    for (i, _, _), own in zip(held, found.astype(np.int64)):
                        drawn[i] = own

            for i, text in enumerate(texts):
                codes, weights = weigher.shingles(text)
                totals.append(float(weights.sum()))
                if len(codes):
                    held.append((i, codes, weights))
                    size += len(codes)
                if size > AT_ONCE:
                    flush()
                    held, size = [], 0
            flush()
            digest = [hashlib.md5(t.encode()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(drawn, pa.list_(pa.int64())), pa.array(totals, pa.float64())], ["doc_id", "digest", "samples", "weight"]
            )

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return map_arrow(slim, run, "doc_id bigint, digest binary, samples array<bigint>, weight double")


def shared_bands(texts: DataFrame) -> DataFrame:
    """(key, node, weight, n): the bands of each text that n texts have, n being 2 or more."""
    keys = F.array(*(F.xxhash64(F.lit(i), *(F.get("samples", k) for k in line)) for i, line in enumerate(LINES)))
    bands = texts.filter(F.size("samples") > 0).select("node", "weight", F.explode(keys).alias("key"))
    counted = materialize(bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    return materialize(bands.join(counted, "key").select("key", "node", "weight", "n"), "bands")


def may_link(weight: Column, own: Column, other_weight: Column, other_own: Column) -> Column:
    """Whether totals, and the weights in shingles that only one text has, leave room for a link.

    What a text shares is at most its weight w less its own part o, so a link to weight v needs w - o >= 0.8 (v + o).
    """
    room = lambda w, o, v: w - o >= SIMILAR * (v + o) - SLACK * w
    return room(weight, own, other_weight) & room(other_weight, other_own, weight)


def met_heads(members: DataFrame) -> DataFrame:
    """(a, b): the head of each bucket with every other text of it that could be a link."""
    mass = members.groupBy("node").agg(F.sum("n").alias("mass"))
    ranked = members.join(mass, "node")
    heads = ranked.groupBy("key").agg(F.max_by(F.struct(F.col("node").alias("a"), F.col("weight").alias("v")), F.struct("mass", "node")).alias("head")).select("key", "head.*")
    none = F.lit(0.0)
    met = members.join(heads, "key").filter(F.col("node") != F.col("a")).filter(may_link(F.col("weight"), none, F.col("v"), none))
    return met.select("a", F.col("node").alias("b")).distinct()


def verified(pairs: DataFrame, bodies: DataFrame, weigher: Weigher) -> DataFrame:
    """The rows (a, b, ...) of ``pairs`` whose whole texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in lengthy(batches, 4 << 20):
            kept = []
            for i, (a, first, second) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("a", "first", "second")))):
                if known[0] != a:
                    known = a, weigher.shingles(first)
                (codes, weights), (others, more) = known[1], weigher.shingles(second)
                _, x, y = np.intersect1d(codes, others, assume_unique=True, return_indices=True)
                shared = np.minimum(weights[x], more[y]).sum()
                if shared >= (SIMILAR - 1e-9) * (weights.sum() + more.sum() - shared):
                    kept.append(i)
            yield batch.drop_columns(["first", "second"]).take(pa.array(kept, pa.int64()))

    right = pairs.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("second")), "b")
    both = right.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("first")), "a").select(*pairs.columns, "first", "second")
    return map_arrow(both, run, pairs.schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of the connected part of each linked node, in rounds of spreading and pointer jumping."""
    edges = materialize(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "links")
    roots = materialize(edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("root")).withColumnRenamed("u", "node"), "roots")
    while True:
        heard = edges.join(roots.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("heard"))
        spread = roots.join(heard.withColumnRenamed("u", "node"), "node").select("node", F.least("root", "heard").alias("root"), F.col("root").alias("old"))
        spread = materialize(spread, "spread")
        above = spread.select(F.col("node").alias("root"), F.col("root").alias("top"))
        after = materialize(spread.join(above, "root").select("node", F.least("root", "top").alias("root"), "old"), "roots")
        if after.filter("root <> old").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")


def crowd_of(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, weight, root, mass) of the texts of buckets of three or more that hold several classes; in smaller ones all pairs have met."""
    rooted = members.join(roots, "node", "left").select("key", "node", "weight", "n", F.coalesce("root", "node").alias("root"))
    mixed = rooted.filter("n > 2").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    inside = rooted.join(mixed, "key", "left_semi")
    return materialize(inside.groupBy("node").agg(F.first("weight").alias("weight"), F.first("root").alias("root"), F.sum("n").alias("mass")), "crowd")


def posts(crowd: DataFrame, bodies: DataFrame, weigher: Weigher) -> DataFrame:
    """(shingle, place, light, node, weight, root, mass, own, first): the texts of ``crowd`` under their rarest shared shingles.

    ``light`` marks the shingles that the lighter text of a link would share, ``own`` is the weight in shingles no other text of the crowd has,
    ``first`` lists the text's first FIRST posts and ``place`` counts them from 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lengthy(batches, 1 << 20):
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, weights = weigher.shingles(text)
                for at in range(0, len(codes), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(codes[part]), node), pa.int64()), pa.array(codes[part].astype(np.int64)), pa.array(weights[part], pa.float64())], ["node", "shingle", "w"]
                    )

    held = map_arrow(bodies.join(crowd.select("node"), "node", "left_semi").select("node", "text"), run, "node bigint, shingle bigint, w double")
    held = materialize(held, "shingles")
    often = held.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1")
    # one text's shingles at a time
    line = Window.partitionBy("node").orderBy("often", "shingle")
    whole = Window.partitionBy("node")
    shared = held.join(often, "shingle").join(crowd, "node")
    shared = shared.withColumn("own", F.greatest(F.col("weight") - F.sum("w").over(whole), F.lit(0.0)))
    shared = shared.withColumn("ahead", F.col("own") + F.sum("w").over(line) - F.col("w")).withColumn("place", F.row_number().over(line))
    fifth = F.col("ahead") <= (1 - SIMILAR + SLACK) * F.col("weight")
    ninth = F.col("ahead") <= ((1 - SIMILAR) / (1 + SIMILAR) + SLACK) * F.col("weight")
    rows = materialize(shared.filter(fifth).select("shingle", "place", ninth.alias("light"), "node", "weight", "root", "mass", "own"), "posts")
    first = rows.filter(F.col("place") <= FIRST).groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "shingle"))), lambda x: x["shingle"]).alias("first"))
    return mixed_posts(rows).join(first, "node")


def mixed_posts(rows: DataFrame) -> DataFrame:
    """The rows of posts that hold several classes and a text that could be the lighter one of a link."""
    mixed = rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("light").alias("any")).filter("low <> high AND any").select("shingle")
    return rows.join(mixed, "shingle", "left_semi")


def further_links(left: DataFrame, bodies: DataFrame, weigher: Weigher) -> list[DataFrame]:
    """The links between texts of one post: rounds over posts until the texts left in each are of one class."""
    found, width = [], HEADS
    while True:
        left = materialize(mixed_posts(left), "left")
        if left.isEmpty():
            return found
        rank = F.row_number().over(Window.partitionBy("shingle").orderBy(F.desc("mass"), "node"))
        heads = materialize(left.filter("light").withColumn("rank", rank).filter(F.col("rank") <= width).drop("rank"), "heads")
        other = heads.select("shingle", *(F.col(c).alias(f"head_{c}") for c in ("node", "place", "weight", "own", "root", "first")))
        before = lambda first, place: F.slice(first, F.lit(1), F.least(F.col(place) - 1, F.lit(FIRST)))
        met = left.join(other, "shingle").filter(F.col("root") != F.col("head_root"))
        met = met.filter(may_link(F.col("weight"), F.col("own"), F.col("head_weight"), F.col("head_own")))
        met = met.filter(~F.arrays_overlap(before("first", "place"), before("head_first", "head_place")))
        ends = F.when(F.col("node") < F.col("head_node"), F.struct(F.col("node").alias("a"), F.col("head_node").alias("b"), F.col("root").alias("root_a"), F.col("head_root").alias("root_b")))
        ends = ends.otherwise(F.struct(F.col("head_node").alias("a"), F.col("node").alias("b"), F.col("head_root").alias("root_a"), F.col("root").alias("root_b")))
        more = materialize(verified(met.select(ends.alias("e")).select("e.*").distinct(), bodies, weigher), "links")
        left, width = left.join(heads.select("shingle", "node"), ["shingle", "node"], "left_anti"), MORE * width
        if not more.isEmpty():
            found.append(more.select("a", "b"))
            joined = components(more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("top"))
            left = left.join(joined, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, digest) and their texts (digest, first_id, root): texts of one class have one root."""
    weigher = Weigher(*common_words(docs))
    rows = materialize(sketches(docs, weigher), "sketches")
    grouped = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.any_value(F.struct("samples", "weight")).alias("own"))
    texts = materialize(grouped.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id", "own.*"), "texts")
    members = shared_bands(texts)

    needed = materialize(members.select("node").distinct().join(texts.select("node", "digest", "first_id"), "node"), "needed")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    # the texts of candidates only, one row for each text
    picked = slim.join(bounded_broadcast(needed.select(F.col("first_id").alias("doc_id")).filter("doc_id IS NOT NULL").distinct(), "ids"), "doc_id", "left_semi")
    orphan = slim.filter("doc_id IS NULL")
    bodies = picked.unionByName(orphan).withColumn("digest", F.unhex(F.md5("text"))).join(needed.select("digest", "node"), "digest")
    bodies = materialize(bodies.dropDuplicates(["node"]).select("node", "text"), "bodies")

    links = [materialize(verified(met_heads(members), bodies, weigher), "links")]
    roots = components(links[0])
    crowd = crowd_of(members, roots)
    if not crowd.isEmpty():
        more = further_links(posts(crowd, bodies, weigher), bodies, weigher)
        if more:
            links += more
            roots = components(reduce(DataFrame.unionByName, links))
    named = texts.join(roots, "node", "left").select("digest", "first_id", F.coalesce("root", "node").alias("root"))
    return rows.select("doc_id", "digest"), materialize(named, "named")


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class) and kept (it is that one)."""
    rows, named = linked(docs)
    least = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    ids = materialize(named.join(least, "root").select("digest", "class_id"), "classes")
    return rows.join(ids, "digest").select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class: that of the least id and, of one id's texts, of the least digest; of repeated rows of it any one."""
    rows, named = linked(docs)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "digest")
    known = materialize(rows.join(named.select("digest", "root"), "digest"), "known")
    best = known.groupBy("root").agg(F.min(place).alias("best"))
    kept = known.join(best, "root").select("doc_id", "digest", (place == F.col("best")).alias("kept"))
    marks = materialize(kept.groupBy("doc_id", "digest").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")), "marks")
    gone, again = marks.filter("NOT kept"), marks.filter("kept AND n > 1")
    key, mark = free_name(docs, "near_dup_key"), free_name(docs, "near_dup_id")
    named_docs = docs.withColumns({key: F.unhex(F.md5(text_of())), mark: F.col("doc_id").cast("bigint")})

    def among(some: DataFrame) -> tuple[DataFrame, Column]:
        side = bounded_broadcast(some.select(F.col("doc_id").alias("marked_id"), F.col("digest").alias("marked_digest")), "marked")
        return side, named_docs[mark].eqNullSafe(side["marked_id"]) & (named_docs[key] == side["marked_digest"])

    left = named_docs.join(*among(gone), "left_anti")
    if not again.isEmpty():  # few rows, unless a table repeats its rows
        repeated = among(again)
        left = left.join(*repeated, "left_anti").unionByName(left.join(*repeated, "left_semi").dropDuplicates([mark, key]))
    return left.select(*docs.columns)
