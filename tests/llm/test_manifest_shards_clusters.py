"""Merkle manifest, external shuffle and bounded k-means against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressbeat.llm import kmeans, merkle, queries, shards


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    n = None if r.n_chars is None else r.n_chars + more
    return sha(*[field(v) for v in (r.doc_id, r.source, r.lang, n, r.text)])


def climb(nodes):
    """The top of a row of nodes and the path of each: (side, sibling) pairs."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, own in enumerate(at):
            if own ^ 1 < len(nodes):
                paths[i].append((own & 1, nodes[own ^ 1]))
            else:
                paths[i].append((None, ""))
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i >> 1 for i in at]
    return nodes[0], paths


def brute_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r.lang].append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    held = {}
    for k in order:
        rs = sorted(trees[k], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        held[k] = rs, *climb([leaf_of(r) for r in rs])
    root, above = climb([held[k][1] for k in order])
    out = []
    for k, upper in zip(order, above):
        for r, path in zip(held[k][0], held[k][2]):
            path = path + upper
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            acc = leaf_of(r, 1 if hit else 0)
            for side, other in path:
                acc = sha(acc) if side is None else sha(other, acc) if side else sha(acc, other)
            out.append((r.doc_id, leaf_of(r), held[k][1], root, sha(*[s for _, s in path]), acc, acc == root))
    return out


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_of(docs):
    found = merkle.audit(docs)
    assert tuple(found.columns) == NAMES
    return sorted(map(tuple, found.collect()), key=repr)


def test_manifest(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, queries.op11_merkle_manifest(spark, sf).collect()), key=repr) == sorted(brute_manifest(docs.collect()), key=repr)
    assert manifest_of(odd) == sorted(brute_manifest(odd.collect()), key=repr)
    for n in (0, 1):
        assert manifest_of(odd.limit(n)) == (sorted(brute_manifest(odd.limit(n).collect()), key=repr) if n else [])


def test_manifest_of_many_sizes(spark, monkeypatch):
    """Trees of one to a few hundred leaves, built two levels at a time, segments joined by a shuffle."""
    monkeypatch.setattr(merkle, "CHUNK", 2)
    monkeypatch.setattr(merkle, "MOST_BROADCAST", 3)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 5, "z": 16, "y": 17, "x": 33, "w": 100, "€": 1}
    rows = [(i * 7 % 1009, k, "s" if i % 3 else None, f"text {k} {i}" if i % 5 else None, None if i % 11 == 0 else i) for k, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string, n_chars bigint").repartition(3)
    assert manifest_of(docs) == sorted(brute_manifest(docs.collect()), key=repr)


def test_shards_of_the_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.op12_external_shuffle(spark, sf).collect()
    assert Counter(r.doc_id for r in found) == Counter(list(docs))
    for r in found:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    check_shards(found, 24)


def check_shards(found, n):
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(n)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_follow_the_files_and_the_seed(spark, tmp_path):
    """Records of several buckets: all there, in the same order each time, in another one for another seed; copies are spread."""
    rows = [(i if i % 3 else 7, "a copied text " * 20 if i % 3 == 0 else f"text {i} " * 20, i) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, record int").repartition(3).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")

    def order(name, seed):
        shards.write_shards(docs, f"{tmp_path}/{name}", 7, 50_000, seed)
        back = shards.read_shards(spark, f"{tmp_path}/{name}", docs.schema)
        got = back.select("shard", "slot", F.col("record.record").alias("n")).collect()
        check_shards(got, 7)
        return [r.n for r in sorted(got)]

    first = order("a", 1)
    assert sorted(first) == list(range(3000)) and first == order("b", 1) and first != order("c", 2)
    copies = np.array([n % 3 == 0 for n in first])
    assert all(120 < part.sum() < 170 for part in np.array_split(copies, 7))
    # a file holds its slots in order
    one = spark.read.parquet(f"{tmp_path}/a").withColumn("at", F.monotonically_increasing_id()).withColumn("f", F.input_file_name()).collect()
    files = defaultdict(list)
    for r in sorted(one, key=lambda r: r["at"]):
        files[r.f].append(r.slot)
    assert all(s == list(range(s[0], s[0] + len(s))) for s in files.values())


def test_shards_edges(spark, odd):
    found = shards.reports(odd, 24).collect()
    assert len(found) == odd.count()
    check_shards(found, 24)
    assert {r.size for r in found if r.doc_id in (1, 2)} == {8} and {r.text_crc32 for r in found if r.doc_id in (1, 2)} == {0}
    assert shards.reports(odd.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_permutations_are_uniform(n):
    rng = np.random.default_rng(3)
    seen = Counter(tuple(shards.fisher_yates(n, rng)) for _ in range(6000))
    assert len(seen) == math.factorial(n) and all(abs(c - 6000 / len(seen)) < 6 * math.sqrt(6000 / len(seen)) + 1 for c in seen.values())


def brute_clusters(rows, k=40, rounds=5):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents, x = np.array([p for _, p in first], np.int64), np.array([p for _, p in kept], np.int64)

    def nearest():
        d = np.stack([((x - c) ** 2).sum(1) for c in cents], 1)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        near, _ = nearest()
        cents = np.array([x[near == j].sum(0) // (near == j).sum() if (near == j).any() else c for j, c in enumerate(cents)])
    near, d = nearest()
    return sorted((str(i), int(c), int(e), int(d[near == c].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, cents[c].tolist())).encode()).hexdigest()) for (i, _), c, e in zip(kept, near, d))


def clusters_of(found):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)


def test_clusters_of_the_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = queries.op13_ns_kmeans(spark, sf).collect()
    assert clusters_of(found) == brute_clusters(rows)
    assert sum(r.evaluated for r in found) < 30 * len(found)  # bounds spare some of 41 distances


def test_clusters_with_ties_copies_and_broken_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-2, 2) / 256 for _ in range(64)], 0) for i in range(300)]
    rows += [(1000 + i, [0.0] * 64, 1) for i in range(150)] + [(5, [1 / 256] * 64, 2), (None, [0.5] * 64, 3), (5, [1 / 256] * 64, 2)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [1.0] * 63, 0), (2003, [1.0] * 63 + [None], 0), (2004, [1.0] * 63 + [float("nan")], 0), (2005, [float("inf")] * 64, 0)]
    kind = "vec_id bigint, embedding array<float>, cluster int"
    docs = spark.createDataFrame(rows, kind).repartition(3)
    assert clusters_of(kmeans.clusters(docs).collect()) == brute_clusters([r[:2] for r in rows])
    few = spark.createDataFrame(rows[:7], kind)
    assert clusters_of(kmeans.clusters(few).collect()) == brute_clusters([r[:2] for r in rows[:7]])
    assert kmeans.clusters(docs.limit(0)).collect() == [] and kmeans.clusters(docs.filter("vec_id >= 2000")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bounds_keep_every_assignment_exact(seed):
    """Rounds over moving centroids, which swing back and stop, give the plain nearest ones, with fewer distances."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-60, 60, (400, 8)) + rng.integers(0, 4, (400, 1)) * 100
    history, state, spared = [x[:13].copy()], None, 0
    for r in range(8):
        state = kmeans.assign(x, history, state and state[:1] + state[2:4])
        d = ((x[:, None, :] - history[-1][None]) ** 2).sum(2)
        assert (state[0] == d.argmin(1)).all() and (state[1] == d.min(1)).all()
        spared += (state[4] < 14).sum()
        c = history[-1].copy()
        if r % 2:
            c[rng.integers(0, 13, 3)] += rng.integers(-30, 30, (3, 8))
        else:
            c = np.array([x[state[0] == j].sum(0) // max((state[0] == j).sum(), 1) for j in range(13)])
        history.append(history[-2].copy() if r == 5 else c)
    assert spared > 300
