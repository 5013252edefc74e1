"""Exact ranks without a sort."""

from __future__ import annotations

import contextlib
import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.operators import coverage, distance, ranks


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("small, bins", [(4096, 1024), (8, 64)])
def test_percentiles_of_groups_and_weights(spark, monkeypatch, small, bins):
    monkeypatch.setattr(ranks, "SMALL", small)
    monkeypatch.setattr(ranks, "BINS", bins)
    draw = np.random.Generator(np.random.PCG64(2))
    groups = {
        "even": draw.random(201), "ties": draw.integers(0, 4, 90).astype(float), "one": np.array([7.5]), "same": np.full(50, 2.0), "wide": 10.0 ** draw.uniform(-30, 30, 60),
        "ends": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323, -0.5]), "infinite": np.array([math.inf, 1.0, 2.0, -math.inf, math.inf]),
    }
    rows = [(g, float(x), int(w)) for g, xs in groups.items() for x, w in zip(xs, draw.integers(0, 4, len(xs)) if g in ("even", "ties") else np.ones(len(xs)), strict=True)]
    df = spark.createDataFrame(rows + [("none", None, 1), ("even", math.nan, 3), ("even", None, 2)], "k string, x double, w bigint").repartition(3)
    got = {r["k"]: r for r in ranks.percentiles(df, "x", {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}, ("k",), "w").collect()}
    assert set(got) == set(groups)
    for g in groups:
        values = np.sort(np.repeat([x for k, x, _ in rows if k == g], [w for k, _, w in rows if k == g]))
        for name, f in (("p0", 0.0), ("p50", 0.5), ("p95", 0.95), ("p100", 1.0)):
            at = (len(values) - 1) * f
            a, b = values[math.floor(at)], values[math.ceil(at)]
            want = a if a == b else (math.floor(at) + 1 - at) * a + (at - math.floor(at)) * b
            assert got[g][name] == pytest.approx(want, rel=1e-12), (g, name)


@pytest.mark.parametrize("small, bins", [(4096, 1024), (8, 16)])
def test_largest_with_ties_and_large_keys(spark, monkeypatch, small, bins):
    monkeypatch.setattr(ranks, "SMALL", small)
    monkeypatch.setattr(ranks, "BINS", bins)
    draw = np.random.Generator(np.random.PCG64(6))
    keys = draw.permutation(np.concatenate([np.arange(-30, 30), 2**60 + np.arange(60), -(2**60) + np.arange(30)]))
    rows = [(int(i), float(d)) for i, d in zip(keys, draw.integers(0, 5, len(keys)), strict=True)]
    df = spark.createDataFrame(rows + [(500, None), (501, math.nan)], "id bigint, distance double").repartition(4)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (0, 17, 61, len(rows) - 1, 1000):
        assert sorted(r["id"] for r in ranks.largest(df, k).collect()) == sorted(i for i, _ in order[:k]), k


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id bigint, distance double")
    assert ranks.largest(empty, 3).count() == 0 and ranks.percentiles(empty, "distance", {"p": 0.5}).count() == 0
    r = distance.summary(empty).first()
    assert r["n"] == 0 and r["nn_p50"] is None and r["nn_max"] is None


def test_plans_gather_nothing(spark):
    """No limit that grows with the rows, no percentile over a column in one task."""
    df = spark.range(5000).select("id", F.rand(3).alias("distance"))
    for out in (distance.summary(df), distance.farthest(df, 10, 0.5)):
        plan = plan_of(out)
        assert "TakeOrderedAndProject" not in plan and "percentile" not in plan
    assert distance.farthest(df, 10, 0.5).count() == 2500


def test_shares_in_parts_of_the_line(spark):
    draw = np.random.Generator(np.random.PCG64(8))
    shares = np.concatenate([draw.random(40), np.repeat(draw.random(5), 3), [0.0, 1.0]])
    df = spark.createDataFrame([("A", "B", float(s)) for s in shares] + [("A", "C", 0.5)], "a string, b string, b_share double")
    d = [np.abs(np.delete(shares, k) - s).min() for k, s in enumerate(shares)]
    for parts in (7, 1024):
        got = {r["b"]: r for r in coverage.line_distances(df, parts).collect()}
        assert got["B"]["n"] == len(shares) and got["B"]["nn_mean"] == pytest.approx(np.mean(d), abs=1e-8) and got["B"]["nn_p95"] == pytest.approx(np.percentile(d, 95), abs=1e-8)
        assert got["C"]["nn_mean"] is None and got["C"]["nn_p95"] is None
