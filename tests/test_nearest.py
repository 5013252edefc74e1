"""Nearest neighbours by the pivot index against the grid of all blocks."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ferrolite.operators import distance, selection


def frame(spark, v, first=0):
    return spark.createDataFrame([(first + k, [float(y) for y in x]) for k, x in enumerate(v)], "id bigint, v array<double>").repartition(3)


def clustered(seed, n, spread):
    draw = np.random.Generator(np.random.PCG64(seed))
    return draw.normal(0, 20, (30, 5))[draw.integers(0, 30, n)] + draw.normal(0, spread, (n, 5))


def rows_of(df):
    return {r["id"]: (r["distance"], r["positive_distance"]) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.1, 30.0])
def test_equals_the_grid(spark, spread):
    """Clusters that bounds tell apart, and rows that they don't; repeated points, another set, a row with itself."""
    v = np.concatenate([clustered(1, 240, spread), clustered(1, 5, spread)])
    w = clustered(2, 60, spread)
    one, two, seen = frame(spark, v), frame(spark, w, 10_000), {}
    assert rows_of(distance.nearest(one, one, itself=True, block=20, report=seen)) == rows_of(distance.nearest_by_grid(one, one, itself=True, block=500))
    if spread < 1:
        assert seen["visited"] < seen["block_pairs"] / 2
    assert rows_of(distance.nearest(two, one, block=20)) == rows_of(distance.nearest_by_grid(two, one, block=500))


def test_null_vectors_and_empty_sides(spark):
    bad = [(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [4.0, 4.0])]
    df = spark.createDataFrame(bad, "id bigint, v array<double>")
    got = rows_of(distance.nearest(df, df, itself=True))
    assert got[1] == got[6] == (5.0, 5.0) and all(got[k] == (None, None) for k in (2, 3, 4, 5))
    assert rows_of(distance.nearest(df, df.where("id < 0")))[1] == (math.inf, math.inf)
    assert distance.nearest(df.where("id < 0"), df).count() == 0
    assert [r["id"] for r in selection.farthest_points(df, 5).collect()] == [1, 6]
