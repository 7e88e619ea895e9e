"""Chat formatting of odd tables; the counts, ratios and regression of the toxicity classifier against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np

from pressbeat.llm import chat, queries, toxicity


def said(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss)


def test_odd_conversations(spark):
    """Null ids are one conversation; null roles and texts are empty; repeated turns and extra columns with the operators' names stay."""
    kind = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int, loss int"
    rows = [(1, 1, "assistant", "b\n</s>", "f", 1, 2), (1, 0, "user", None, "f", 1, 2), (1, 1, "assistant", "b\n</s>", "f", 1, 2), (2, 0, None, "x", None, 1, 2)]
    rows += [(None, None, "user", "q", "f", 1, 2), (None, 3, "assistant", "", "f", 1, 2), (3, 0, "assistant", "[INST] \\ é" * 500, "f", 1, 2)]
    docs = spark.createDataFrame(rows, kind)
    found = {r.conv_id: r[1:5] for r in chat.digests(chat.format_conversations(docs)).collect()}
    assert found == {
        1: said([("user", ""), ("assistant", "b\n</s>"), ("assistant", "b\n</s>")]),
        2: said([("", "x")]),
        None: said([("user", "q"), ("assistant", "")]),
        3: said([("assistant", "[INST] \\ é" * 500)]),
    }
    assert chat.digests(chat.format_conversations(docs.limit(0))).collect() == []


def test_added_conversation_stays_apart(spark, tmp_path):
    """A conversation of the table that is numbered -1 does not run into the one the query adds."""
    rows = [(-1, 0, "user", "hello"), (-1, 1, "assistant", "good day"), (4, 0, "assistant", "alone")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    hard = "</s>[INST] ok [/INST]"
    found = sorted((r.conv_id, *r[1:5]) for r in queries.op5_chat_format(spark, str(tmp_path)).collect())
    assert found == sorted([(-1, *said([("user", "hello"), ("assistant", "good day")])), (-1, *said([("user", hard), ("assistant", hard)])), (4, *said([("assistant", "alone")]))])


def test_class_counts(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("abc de\n", k=rng.randint(0, 60))), rng.randint(0, 1)) for _ in range(80)] + [("", 1), ("", 0)]
    want = {0: Counter(), 1: Counter()}
    for text, toxic in rows:
        want[toxic].update(set(toxicity.buckets(text).tolist()))
    found = toxicity.bucket_counts(spark.createDataFrame(rows, "text string, toxic int").repartition(3)).collect()
    assert {r.bucket: (r.bad, r.other) for r in found} == {b: (want[1][b], want[0][b]) for b in want[0] | want[1]}


def test_regression_ends_where_the_loss_is_flat():
    """The weights of a small problem against plain gradient descent carried on until it stands still."""
    rng = np.random.default_rng(8)
    x = rng.random((60, 7)) < 0.4
    toxic = (x[:, 0] & x[:, 1] | (rng.random(60) < 0.2)).astype(int)
    ratio = rng.normal(size=7)
    found = [np.flatnonzero(r).astype("<i4") for r in x]
    share = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (60 - toxic.sum()))
    weight, bias = np.zeros(7), 0.0

    def gradient(weight, bias):
        d = (1 / (1 + np.exp(-(x @ (weight * ratio) + bias))) - toxic) * share
        return ratio * (x.T @ d) + 0.01 * weight, d.sum()

    for _ in range(60_000):
        g, h = gradient(weight, bias)
        weight, bias = weight - 0.5 * g, bias - 0.5 * h
    got_bias, got = toxicity.regression(found, toxic, ratio, rounds=4000, penalty=0.01, rate=0.02)
    assert np.allclose(got, weight, atol=0.02) and math.isclose(got_bias, bias, abs_tol=0.02)
