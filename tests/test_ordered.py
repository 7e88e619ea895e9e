"""Ordered operators against pandas, with one group holding a third of the rows and a NULL group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pressbeat.operators import ordered
from pressbeat.operators.clean import duplicate_flag, forward_fill, interpolate, keep_one
from pressbeat.operators.frame import concat_columns
from pressbeat.operators.stats import qcut

ROWS = 600


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    groups = rng.choice(["a", "b", "c", "d", "e"], ROWS).astype(object)
    groups[rng.random(ROWS) < 0.35] = "hot"
    groups[rng.random(ROWS) < 0.05] = None
    values = rng.integers(0, 40, ROWS).astype(float)
    values[rng.random(ROWS) < 0.3] = np.nan
    return pd.DataFrame({"id": rng.permutation(ROWS), "g": groups, "v": values, "n": rng.integers(0, 9, ROWS)})


@pytest.fixture(scope="module")
def frame(spark, sample):
    rows = [(int(r.id), r.g, None if np.isnan(r.v) else float(r.v), int(r.n)) for r in sample.itertuples()]
    return spark.createDataFrame(rows, "id bigint, g string, v double, n bigint").repartition(3)


def in_order(df, columns):
    rows = sorted(df.select("id", *columns).collect(), key=lambda r: r["id"])
    return [tuple(r)[1:] for r in rows]


def grouped(sample):
    ordered_rows = sample.sort_values("id")
    return ordered_rows, ordered_rows.groupby(ordered_rows["g"].fillna("<null>"))


@pytest.mark.parametrize("blocks", [1, 4, 13])
def test_running_sum_and_max(frame, sample, blocks):
    done = ordered.running(frame, {"s": ("sum", "n"), "m": ("max", "n")}, ["id"], ["g"], blocks=blocks)
    rows, groups = grouped(sample)
    assert in_order(done, ["s", "m"]) == list(zip(groups["n"].cumsum(), groups["n"].cummax()))


def test_running_without_groups_and_backwards(frame, sample):
    done = ordered.running(frame, {"s": ("sum", "n")}, ["id"], reverse=True, blocks=5)
    expected = sample.sort_values("id")["n"][::-1].cumsum()[::-1]
    assert [s for (s,) in in_order(done, ["s"])] == list(expected)


def same(mine, expected):
    return all((a is None and np.isnan(b)) or a == pytest.approx(b) for a, b in zip(mine, expected)) and len(mine) == len(expected)


def test_forward_fill(frame, sample):
    _, groups = grouped(sample)
    mine = [v for (v,) in in_order(forward_fill(frame, "v", ["id"], ["g"]), ["v"])]
    assert same(mine, list(groups["v"].ffill()))


def test_interpolation_matches_pandas(frame, sample):
    mine = [v for (v,) in in_order(interpolate(frame, "v", ["id"]), ["v"])]
    assert same(mine, list(sample.sort_values("id")["v"].interpolate()))


@pytest.mark.parametrize("frame_rows", [7, 50, 10_000])
def test_bounded_frames(frame, sample, frame_rows):
    def build(w):
        return {"before": F.lag("n", 2).over(w), "after": F.lead("n", 1).over(w), "roll": F.sum("n").over(w.rowsBetween(-3, 0))}

    done = ordered.bounded_frame(frame, build, ["id"], ["g"], before=3, after=1, frame_rows=frame_rows)
    _, groups = grouped(sample)
    expected = zip(groups["n"].shift(2), groups["n"].shift(-1), groups["n"].rolling(4, min_periods=1).sum().reset_index(level=0, drop=True).sort_index())
    rows = in_order(done, ["before", "after", "roll"])
    assert len(rows) == ROWS
    rolled = groups["n"].transform(lambda s: s.rolling(4, min_periods=1).sum())
    del expected
    assert same([r[0] for r in rows], list(groups["n"].shift(2)))
    assert same([r[1] for r in rows], list(groups["n"].shift(-1)))
    assert [r[2] for r in rows] == list(rolled)


@pytest.mark.parametrize("descending", [False, True])
def test_ranks(frame, sample, descending):
    done = ordered.rank_by(frame, "v", ["g"], descending)
    _, groups = grouped(sample)
    for column, method in (("rank", "min"), ("dense_rank", "dense"), ("rank_avg", "average")):
        mine = [v for (v,) in in_order(done, [column])]
        assert same(mine, list(groups["v"].rank(method=method, ascending=not descending)))


def test_quantiles(frame, sample):
    wanted = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    whole = ordered.quantiles(frame, "v", wanted).first()
    for name, p in wanted.items():
        assert whole[name] == pytest.approx(sample["v"].quantile(p))
    for row in ordered.quantiles(frame, "v", wanted, ["g"]).collect():
        part = sample[sample["g"] == row["g"]]["v"]
        assert [row[n] for n in wanted] == pytest.approx([part.quantile(p) for p in wanted.values()])


def test_qcut_keeps_ties_together(frame, sample):
    mine = [b for (b,) in in_order(qcut(frame.filter("v IS NOT NULL"), "v", 4), ["bin"])]
    known = sample.dropna(subset=["v"]).sort_values("id")
    assert mine == list(pd.qcut(known["v"], 4, labels=False))


def test_keep_one_and_duplicate_flag(frame, sample):
    kept = {(r["g"], r["n"]): r["id"] for r in keep_one(frame.select("g", "n", "id", "v"), ["g", "n"], ["id"]).collect()}
    expected = sample.sort_values("id").drop_duplicates(["g", "n"])
    assert kept == {(g, n): i for g, n, i in zip(expected["g"], expected["n"], expected["id"])}
    flags = [f for (f,) in in_order(duplicate_flag(frame, ["g", "n"], "id"), ["duplicate"])]
    assert flags == list(sample.sort_values("id").duplicated(["g", "n"]))


def test_concat_columns_pads_the_shorter(spark):
    left = spark.createDataFrame([(i,) for i in range(5)], "a int")
    right = spark.createDataFrame([(f"r{i}", i) for i in range(3)], "b string, o int")
    rows = concat_columns(left, right, ["a"], ["o"]).select("a", "b").collect()
    assert sorted((r["a"], r["b"]) for r in rows if r["b"]) == [(0, "r0"), (1, "r1"), (2, "r2")]
    assert len(rows) == 5
