"""Merkle manifest of a table, with the proof of every row found by pointer jumping.

A row is a leaf: the digest of its fields, each as its UTF-8 byte count, a colon and the value, a null as ``-``. Per language the
leaves ascend by id; every two neighbours become their parent, one that is left over its own digest, until one node, the subroot,
remains. The subroots, by language, are the leaves of one more tree, whose last node is the root.

Levels are built CHUNK at a time: a group holds the 2 ** CHUNK nodes below one node, never more. Each node then holds a segment: its
sibling on the way to its parent. A self-join doubles the distance to the ancestor that a segment reaches, by joining to it the
segment of that ancestor; after log2(depth) joins each leaf holds its siblings up to the root. In the round of distance d only
nodes on levels that are multiples of d take part, so what the leaves meet shrinks from round to round; it is broadcast only while
it counts at most MOST_BROADCAST nodes, and beyond that no node of it meets more than 2 ** d leaves.

Defined cases: a null id sorts first; rows of one id are ordered by their leaf, so repeated rows are repeated leaves; a null language
is a tree of its own and the first; a lone leaf is its own subroot and a lone subroot the root; an empty table has no rows; long texts
are hashed whole; extra columns are not read and may have any name. A null id is never tampered with, a null n_chars stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressbeat.llm.common import materialize

CHUNK = 8
#: Nodes that a broadcast may hold; a segment has 33 bytes a level.
MOST_BROADCAST = 50_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row, some of its fields replaced."""
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def step(sibling: Column, on_left: Column) -> Column:
    """One level of a proof in 33 bytes: the side of the sibling (L, R, or - for none) and its digest."""
    held = F.concat(F.when(on_left, "L").otherwise("R").cast("binary"), F.unhex(sibling))
    return F.coalesce(held, F.rpad(F.lit("-").cast("binary"), 33, F.lit(" ").cast("binary")))


def steps_of(path: Column) -> Column:
    """The levels of a path as an array of their numbers, empty for an empty path."""
    levels = (F.length(path) / 33).cast("int")
    return F.when(levels > 0, F.sequence(F.lit(0), levels - 1)).otherwise(F.array().cast("array<int>"))


def side_at(path: Column, k: Column) -> Column:
    return F.substring(path, 33 * k + 1, 1).cast("string")


def sibling_at(path: Column, k: Column) -> Column:
    return F.lower(F.hex(F.substring(path, 33 * k + 2, 32)))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, bottom to top."""
    said = F.transform(steps_of(path), lambda k: F.when(side_at(path, k) == "-", "").otherwise(sibling_at(path, k)))
    return F.sha2(F.array_join(said, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def up(below: Column, k: Column) -> Column:
        side, sibling = side_at(path, k), sibling_at(path, k)
        return F.when(side == "L", digest(sibling, below)).when(side == "R", digest(below, sibling)).otherwise(digest(below))

    return F.aggregate(steps_of(path), leaf, up)


def placed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with tree (the number of their language in order) and idx (their place in it), and the trees: tree, lang, n, depth.

    The rows are range-sorted and written once with their row numbers; the places follow from the first number and the count of
    each language in each partition.
    """
    ranged = rows.repartitionByRange("lang", *order).sortWithinPartitions("lang", *order)
    frozen = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("at", 33)
    runs = frozen.groupBy("lang", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # at most one row per partition, and one more for each language
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sizes = runs.groupBy("lang").agg(F.sum("n").alias("n"))
    trees = sizes.select(F.row_number().over(Window.orderBy("lang")).cast("bigint").alias("tree"), "lang", "n", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).alias("depth"))
    trees = materialize(trees.withColumn("tree", F.col("tree") - 1), "trees")
    named = trees.select("tree", "depth", F.col("lang").alias("tree_lang"))
    starts = materialize(runs.join(bounded(named), F.col("lang").eqNullSafe(F.col("tree_lang"))).select("tree", "depth", "lang", "part", (F.col("before") - F.col("first")).alias("shift")), "starts")
    starts = bounded(starts.select("tree", "depth", "shift", F.col("part").alias("run_part"), F.col("lang").alias("run_lang")))
    known = frozen.join(starts, F.col("lang").eqNullSafe(F.col("run_lang")) & (part == F.col("run_part")))
    return known.withColumn("idx", F.col("at") + F.col("shift")).drop("at", "shift", "run_part", "run_lang"), trees


def bounded(rows: DataFrame) -> DataFrame:
    """``rows`` of a written table, to be broadcast while they are few."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def parents(nodes: Column, below: Column) -> Column:
    """The ``below`` levels above an array of neighbours, itself first."""

    def above(level: Column) -> Column:
        pair = F.sequence(F.lit(0), ((F.size(level) - 1) / 2).cast("int"))
        return F.transform(pair, lambda i: digest(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))))

    rounds = F.when(below > 0, F.sequence(F.lit(1), below)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, F.array(nodes), lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))))


def tree(leaves: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame]:
    """From (tree, depth, idx, node) of the leaves: the segments of all nodes below the top ones, and (tree, top)."""
    segments, level, tops = None, 0, None
    while True:
        least = F.least(F.lit(CHUNK), F.col("depth") - level)
        group = leaves.groupBy("tree", "depth", F.shiftright("idx", CHUNK).alias("above")).agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"]).alias("nodes"))
        built = materialize(group.select("tree", "depth", "above", least.cast("int").alias("up"), parents(F.col("nodes"), least.cast("int")).alias("levels")), "levels")

        def own(nodes: Column, k: Column) -> Column:
            def one(i: Column) -> Column:
                odd = i % 2 == 1
                return F.struct((k + level).alias("level"), (F.shiftleft(F.col("above"), CHUNK) / F.pow(2, k) + i).cast("bigint").alias("idx"), step(F.get(nodes, F.when(odd, i - 1).otherwise(i + 1)), odd).alias("path"))

            return F.transform(F.sequence(F.lit(0), F.size(nodes) - 1), one)

        lower = F.slice("levels", F.lit(1), F.col("up"))
        found = built.select("tree", F.explode(F.flatten(F.transform(lower, own))).alias("x")).select("tree", "x.*")
        segments = found if segments is None else segments.unionByName(found)
        level += CHUNK
        last = F.get(F.element_at("levels", -1), 0)
        done = built.filter(F.col("depth") <= level).select("tree", last.alias("top"))
        tops = done if tops is None else tops.unionByName(done)
        if level >= deepest:
            return segments, tops
        leaves = built.filter(F.col("depth") > level).select("tree", "depth", F.col("above").alias("idx"), last.alias("node"))


def jumped(segments: DataFrame, deepest: int) -> DataFrame:
    """(tree, idx, path) of the leaves: segments whose reach a self-join doubles until they end at the top."""
    held, reach = materialize(segments, "segments"), 1
    while reach < deepest:
        far = held.filter(F.col("level") % (2 * reach) == reach)
        far = bounded(far.select("tree", (F.col("level") - reach).alias("level"), F.col("idx").alias("anc"), F.col("path").alias("more")))
        near = held.filter(F.col("level") % (2 * reach) == 0).withColumn("anc", F.shiftright("idx", reach) if reach < 64 else F.lit(0))
        held = near.join(far, ["tree", "level", "anc"], "left").select("tree", "level", "idx", F.concat("path", F.coalesce("more", F.lit(b""))).alias("path"))
        held, reach = materialize(held, "segments"), 2 * reach
    return held.filter("level = 0").select("tree", "idx", "path")


def proofs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, tampered (its leaf if n_chars were one more), subroot, root, path (its siblings)."""
    more = leaf(n_chars=F.col("n_chars") + 1)
    rows, trees = placed(docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), leaf().alias("leaf"), more.alias("tampered")), ["doc_id", "leaf"])
    size = trees.agg(F.max("depth").alias("depth"), F.count("*").alias("n")).first()
    deepest, n = size.depth or 0, size.n
    segments, tops = tree(rows.select("tree", "depth", "idx", F.col("leaf").alias("node")), deepest)
    paths = jumped(segments, deepest)
    # the tree of the subroots
    above = max(n - 1, 0).bit_length()
    subroots = materialize(tops.select("tree", F.col("top").alias("subroot")), "subroots")
    segments, top = tree(subroots.select(F.lit(0).alias("tree"), F.lit(above).alias("depth"), F.col("tree").alias("idx"), F.col("subroot").alias("node")), above)
    top_paths = jumped(segments, above).select(F.col("idx").alias("tree"), F.col("path").alias("top_path"))
    upper = materialize(subroots.join(top_paths, "tree", "left").withColumn("root", top.select("top").scalar()), "upper")
    whole = F.concat(F.coalesce("path", F.lit(b"")), F.coalesce("top_path", F.lit(b"")))
    known = rows.join(paths, ["tree", "idx"], "left").join(bounded(upper), "tree")
    return known.select("doc_id", "leaf", "tampered", "subroot", "root", whole.alias("path"))


def audit(docs: DataFrame) -> DataFrame:
    """The proofs' digests, and the root that each leaf folds to when every row whose id's crc32 is a multiple of 7 is tampered with."""
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    found = proofs(docs).withColumn("folded_root", folded(F.when(touched, F.col("tampered")).otherwise(F.col("leaf")), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
