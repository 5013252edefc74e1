"""Farthest-point selection against a small numpy version."""

from __future__ import annotations

import numpy as np
import pytest

from ferrolite.operators import selection
from ferrolite.plans import identity
from test_queries import SF


@pytest.fixture(scope="module")
def vectors(spark):
    rows = sorted((r["id"], r["v"]) for r in identity._vectors(spark, SF).select("id", "v").collect())
    return np.array([i for i, _ in rows]), np.array([v for _, v in rows])


def greedy(ids, v, least, start=0):
    """(id, distance) of all picks down to ``least``."""
    near, out, at = np.full(len(v), np.inf), [], start
    while near[at] >= least:
        out.append((int(ids[at]), float(near[at])))
        near = np.minimum(near, np.sqrt(((v - v[at]) ** 2).sum(axis=1)))
        near[[int(np.flatnonzero(ids == i)[0]) for i, _ in out]] = -1
        at = int(near.argmax())
    return out


def test_target_count_is_not_capped(spark, vectors):
    picks = [d for _, d in greedy(*vectors, 1.2)]
    assert len(picks) > 12
    got = {r["min_distance"]: r["n"] for r in identity.fps_target_count(spark, SF).collect()}
    assert got == {d: sum(p >= d for p in picks) for d in (1.2, 1.3, 1.35, 1.4, 1.45)}


@pytest.mark.parametrize("candidates", [7, 512])
def test_rounds_change_nothing(spark, vectors, monkeypatch, candidates):
    monkeypatch.setattr(selection, "CANDIDATES", candidates)
    ids, v = vectors[0][:90], vectors[1][:90]
    rows = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "id bigint, v array<double>")
    for first in (0, 17):
        got = selection.farthest_points(rows, 25, first=int(ids[first])).orderBy("pick").collect()
        want = greedy(ids, v, 0.0, first)[:25]
        assert [r["id"] for r in got] == [i for i, _ in want] and np.allclose([r["distance"] for r in got], [d for _, d in want])


def searched(ids, v, target, tolerance, start=0):
    """Picks after the search by doubling and bisection, each probe a selection of its own."""
    count = lambda d: len(greedy(ids, v, d, start))
    high = 0.01
    while count(high) > target:
        high *= 2
    low, best = 0.0, high
    for _ in range(30):
        middle = (low + high) / 2
        n = count(middle)
        if abs(n - target) <= tolerance:
            best = middle
            break
        if n > target:
            low = middle
        else:
            best = high = middle
    return {i for i, _ in greedy(ids, v, best, start)}


def test_split_by_selection(spark, vectors):
    ids, v = vectors[0][:150], vectors[1][:150]
    rows = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "id bigint, v array<double>")
    anchors = rows.where("id % 50 = 3").select("id")
    got = {r["id"]: r["split"] for r in selection.train_test(rows, anchors, 30, 12, 2, 0.5).collect()}
    fixed = {int(i) for i in ids if i % 50 == 3}
    free = np.array([i not in fixed for i in ids])
    train = fixed | searched(ids[free], v[free], 30 - len(fixed), 2)
    inside = np.array([i in train for i in ids])
    near = np.sqrt(((v[~inside][:, None] - v[inside][None]) ** 2).sum(axis=2)).min(axis=1)
    order = np.argsort(-near, kind="stable")[: max(12, int(len(near) * 0.5))]
    keep = np.sort(order)
    pool = ids[~inside][keep]
    test = searched(pool, v[~inside][keep], 12, 2, int(np.flatnonzero(keep == order[0])[0]))
    assert got == {int(i): "train" if i in train else "test" if i in test else "unselected" for i in ids}
    with pytest.raises(ValueError):
        selection.train_test(rows, anchors, 2, 12)


def test_registered_split_reads_descriptors(spark):
    got = [r["split"] for r in identity.train_test_split(spark, SF).collect()]
    assert 190 <= got.count("train") <= 210 and 30 <= got.count("test") <= 50 and set(got) == {"train", "test", "unselected"}
