"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The n-grams of GRAMS characters of a lower-cased text, its white space made one space, fall into hashed buckets; a text has a
bucket or not. Over the labelled sample each bucket has a log ratio of its smoothed shares in toxic and other texts. The FEATURES
buckets that tell the classes apart best become features, worth their ratio where present; logistic regression weighs them, and
its bias is set back from the balanced sample to the labels' own odds.

The sample is bounded: at most SAMPLE labelled rows of each class, taken by the order of a hash of the id, from training rows
only. Ids, languages and sources never enter a score. Without rows of both classes every score is the share of toxic labels (0
without labels). A null or empty text has the score of no features. Labels that are null are ignored; rows whose id is labelled
twice count twice. Every text is scored whole, in one pass without a shuffle; repeated rows get equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow, materialize, text_of

GRAMS = (3, 4, 5)
BITS = 20
SAMPLE, FEATURES, MIN_TEXTS = 3000, 6000, 8
THRESHOLD = 0.3


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def buckets(text: str) -> np.ndarray:
    """The bucket of every n-gram of a text, repeats included."""
    chars = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), "<u4")
    found = []
    gram = chars
    for n in range(2, max(GRAMS) + 1):
        if len(gram) < 2:
            break
        gram = gram[:-1] * np.uint32(0x01000193) + chars[n - 1 :]
        if n in GRAMS:
            mixed = (gram ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            found.append(mixed * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


class Classifier(NamedTuple):
    """Bias, feature buckets in ascending order, and what each adds where it is present."""

    bias: float
    features: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.features] = self.weights
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found = buckets(text)
            hit = np.unique(found[table[found] != 0])
            out[i] = self.bias + float(table[hit].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, int, int]:
    """The texts and labels of the sample, and how many training labels of each class there are.

    At most twice ``sample`` ids are joined, so they are broadcast and no text is shuffled.
    """
    train = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    train = train.filter(~held_out(F.col("doc_id")))
    size = train.agg(F.sum("toxic").alias("bad"), F.count("*").alias("all")).first()
    bad, other = int(size.bad or 0), int(size.all) - int(size.bad or 0)
    ids = [train.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = materialize(ids[0].unionByName(ids[1]), "labels")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    return materialize(texts, "sample"), bad, other


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, bad, other): in how many sampled texts of each class a bucket occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in lengthy(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic][np.unique(buckets(text))] += 1
        at = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[1][at], pa.int64()), pa.array(counts[0][at], pa.int64())], ["bucket", "bad", "other"])

    return map_arrow(texts, run, "bucket int, bad bigint, other bigint").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("other").alias("other"))


def present(texts: DataFrame, features: np.ndarray) -> DataFrame:
    """(toxic, found): the places in ``features`` of the features each sampled text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        for batch in lengthy(batches):
            found = []
            for text in batch.column(0).to_pylist():
                own = np.unique(place[buckets(text)])
                found.append(own[own >= 0].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["toxic", "found"])

    return map_arrow(texts, run, "toxic int, found binary")


def regression(found: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, rounds: int = 150, penalty: float = 2e-4, rate: float = 0.05) -> tuple[float, np.ndarray]:
    """Bias and weights of logistic regression over ratio-scaled features, both classes weighing the same."""
    flat = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    share = np.where(toxic == 1, 0.5 / max((toxic == 1).sum(), 1), 0.5 / max((toxic == 0).sum(), 1))
    weight, bias = np.ones(len(ratio)) / 10, 0.0
    first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    scaled = ratio[flat]
    for step in range(1, rounds + 1):
        z = bias + np.bincount(row, weight[flat] * scaled, len(found))
        d = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - toxic) * share
        grad = np.append(np.bincount(flat, d[row], len(ratio)) * ratio + penalty * weight, d.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weight, bias = weight - move[:-1], bias - move[-1]
    return bias, weight


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    texts, bad, other = labelled_sample(docs, labels, sample)
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    p, q = sizes.get(1, 0), sizes.get(0, 0)
    if not p or not q:
        share = min(max(bad / (bad + other), 1e-6), 1 - 1e-6) if bad + other else 1e-6
        return Classifier(math.log(share / (1 - share)), np.zeros(0, np.int64), np.zeros(0, np.float32))
    a, b = F.col("bad") / p, F.col("other") / q
    pooled = (F.col("bad") + F.col("other")) / (p + q)
    counts = bucket_counts(texts).filter(F.col("bad") + F.col("other") >= min(MIN_TEXTS, max(1, p // 4)))
    telling = counts.withColumn("tells", F.pow(a - b, 2) / (pooled * (1 - pooled) + 1e-9)).orderBy(F.desc("tells"), "bucket").limit(FEATURES).toPandas().sort_values("bucket")
    features = telling["bucket"].to_numpy(np.int64)
    ratio = np.log((telling["bad"].to_numpy(float) + 1) / (p + 2)) - np.log((telling["other"].to_numpy(float) + 1) / (q + 2))
    rows = present(texts, features).collect()
    toxic = np.array([r.toxic for r in rows])
    bias, weight = regression([np.frombuffer(r.found, "<i4") for r in rows], toxic, ratio)
    return Classifier(bias + math.log(bad / other), features, (weight * ratio).astype(np.float32))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lengthy(batches):
            scores = model.scores(batch.column(2).to_pylist())
            arrays = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return map_arrow(slim, run, "doc_id bigint, held_out boolean, score double, predicted int")
