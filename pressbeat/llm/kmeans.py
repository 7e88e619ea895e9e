"""Exact integer k-means with norm-of-sum bounds.

The driver keeps the centroids of every round: ROUNDS + 1 tables of K rows. Each vector keeps its cluster and, for every group of
GROUP centroids with neighbouring numbers, a lower bound of its distance to them (its own centroid left out) and the round in which
that bound was last worked out. The bound is loosened by the largest norm of a group member's total displacement since that round, one vector
difference from the history and not the sum of the drifts of the rounds between, so it stays tight when centroids swing back. In each
round the distance to the own centroid is worked out; the groups whose loosened bound is not beyond it are rescanned, every distance
in them exactly. All distances are whole numbers; bounds are rounded down, so a centroid that could tie is always rescanned, and results equal the plain algorithm.

No vector is shuffled: a round maps the written state to the next, and sums of components are combined per task before they meet.

Defined cases: vectors with other than DIMS components, or with one that is null or not finite, are left out; a vector without an id takes part,
but starts a centroid only where there are too few others; repeated ids and vectors are rows of their own; fewer vectors than K make so many centroids;
an empty table gives no rows; extra columns are not read. Components whose squares may leave 63 bits (256 * x beyond 2 ** 27) are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import discard, map_arrow, materialize

K, ROUNDS, DIMS, SCALE, GROUP = 40, 5, 64, 256, 5
LARGEST, EXACT = 1 << 27, 1 << 22
STATE = "vec_id bigint, point array<bigint>, cluster int, distance bigint, bounds array<float>, seen array<tinyint>, evaluated int"


def points(embeddings: DataFrame) -> DataFrame:
    """(vec_id, point): the vectors with all components, as whole numbers."""
    x = F.col("embedding").cast("array<double>")
    whole = (F.size(x) == DIMS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return embeddings.filter(F.coalesce(whole, F.lit(False))).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda v: F.floor(v * SCALE)).alias("point"))


def starts(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The first centroids: the vectors whose ids have the smallest digests."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "point").limit(k).collect()
    return np.array([r.point for r in rows], np.int64).reshape(-1, DIMS)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all centroids."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:  # every sum below is a whole number under 2 ** 53
        p, c = points.astype(float), centroids.astype(float)
        return ((p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centroids], 1)


def floor32(x: np.ndarray) -> np.ndarray:
    """The next smaller float32."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def assign(x: np.ndarray, history: list[np.ndarray], old: tuple | None) -> tuple:
    """Cluster, squared distance, bounds, rounds of the bounds and number of distances worked out, of points under the newest centroids."""
    now, n = history[-1], len(x)
    k, here = len(now), len(history) - 1
    groups = [slice(at, min(at + GROUP, k)) for at in range(0, k, GROUP)]
    far = np.iinfo(np.int64).max
    if old is None:
        cluster, own = np.zeros(n, np.int64), squared(x, now[:1])[:, 0]
        bounds, seen = np.full((n, len(groups)), -np.inf, np.float32), np.zeros((n, len(groups)), np.int8)
    else:
        cluster, bounds, seen = old[0].astype(np.int64), old[1].copy(), old[2].copy()
        own = ((x - now[cluster]) ** 2).sum(1)
    rows = np.arange(n)
    before, own_before = cluster.copy(), own.copy()
    evaluated = np.ones(n, np.int64)
    drift = np.array([[np.sqrt(((now[g] - past[g]) ** 2).sum(1).astype(float)).max() for g in groups] for past in history])
    loose = bounds - drift[seen, np.arange(len(groups))[None, :]] * (1 + 1e-12)
    limit = np.sqrt(own.astype(float)) * (1 + 1e-9) + 1e-9
    failed = ~(loose > limit[:, None])
    scanned: list[tuple[int, np.ndarray, np.ndarray]] = []
    for g, span in enumerate(groups):
        hit = np.flatnonzero(failed[:, g])
        if not len(hit):
            continue
        d = squared(x[hit], now[span])
        scanned.append((g, hit, d))
        evaluated[hit] += d.shape[1]
        best = d.argmin(1)
        least, number = d[np.arange(len(hit)), best], best + span.start
        better = (least < own[hit]) | ((least == own[hit]) & (number < cluster[hit]))
        cluster[hit[better]], own[hit[better]] = number[better], least[better]
    # a bound that still holds does not cover a centroid that was the vector's own until now
    home = before // GROUP
    moved = rows[(cluster != before) & ~failed[rows, home]]
    bounds[moved, home[moved]] = floor32(np.minimum(loose[moved, home[moved]], np.sqrt(own_before[moved].astype(float))))
    seen[moved, home[moved]] = here
    for g, hit, d in scanned:
        inside = (cluster[hit] >= groups[g].start) & (cluster[hit] < groups[g].stop)
        at = np.flatnonzero(inside)
        d[at, cluster[hit[at]] - groups[g].start] = far
        bounds[hit, g] = floor32(np.sqrt(d.min(1).astype(float)))
        seen[hit, g] = here
    return cluster, own, bounds, seen, evaluated


def matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def assigned(state: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """The state after one more round; the first one has points only."""
    first = "cluster" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = batch.column
            x = matrix(col("point"), np.int64)
            if np.abs(x).max() > LARGEST:
                raise ValueError("a component is too large for exact squared distances")
            old = None if first else (col("cluster").to_numpy(), matrix(col("bounds"), np.float32), matrix(col("seen"), np.int8))
            cluster, own, bounds, seen, evaluated = assign(x, history, old)
            width = bounds.shape[1]
            ends = pa.array(np.arange(0, (len(x) + 1) * width, width), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(bounds.ravel(), pa.float32())), pa.ListArray.from_arrays(ends, pa.array(seen.ravel(), pa.int8()))
            columns = [col("vec_id"), col("point"), pa.array(cluster, pa.int32()), pa.array(own, pa.int64()), *lists, pa.array(evaluated, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "point", "cluster", "distance", "bounds", "seen", "evaluated"])

    return map_arrow(state, run, STATE)


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids at the whole-numbered means of their vectors; one without vectors stays."""
    sums = state.select("cluster", F.posexplode("point").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("total"), F.count("*").alias("n"))
    after = centroids.copy()
    for r in sums.collect():  # one row for each centroid and component
        after[r.cluster, r.at] = r.total // r.n
    return after


def fit(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """The state of every vector after the last assignment, and the centroids of every round."""
    vectors = materialize(points(embeddings), "points")
    history = [starts(vectors, k)]
    state = vectors
    if not len(history[0]):
        return vectors.selectExpr("vec_id", "point", "0 AS cluster", "0L AS distance", "0 AS evaluated"), history
    for _ in range(rounds + 1):
        after = materialize(assigned(state, history), "state")
        discard(state)
        state = after
        if len(history) <= rounds:
            history.append(moved(state, history[-1]))
    return state, history


def clusters(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, evaluated (distances worked out in the last round)."""
    state, history = fit(embeddings)
    spark = embeddings.sparkSession
    named = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(history[-1])]
    digests = spark.createDataFrame(named, "cluster int, centroid_sha256 string")
    # one row for each centroid
    per = materialize(state.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")), "inertia")
    whole = per.withColumn("inertia", per.agg(F.sum("cluster_inertia")).scalar()).join(F.broadcast(digests), "cluster")
    return state.join(F.broadcast(whole), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "evaluated")
