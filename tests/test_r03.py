"""What the third round's findings were about."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.functions import text as X
from ferrolite.operators import coverage, defects, distance, generators
from ferrolite.plans import tables


def test_lint_reads_the_settings_once(spark):
    m = X.settings_map(F.col("t"))
    rows = spark.createDataFrame([("a = 1 # x\nA=2\n! b = 3\nNSW=5\nnsw = 1\nIBRION = 2\nISIF=3\nISYM=x\nISYM=0 = 1",), ("",), (None,), ("\n".join(f"k{i} = {i}" for i in range(20_000)),)], "t string")
    got = rows.select(m.alias("m"), X.lint(m).alias("w"))
    plan = got.select("w")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    first, empty, none, long = got.collect()
    assert first["m"] == {"A": "2", "NSW": "1", "IBRION": "2", "ISIF": "3", "ISYM": "0 = 1"}
    assert first["w"] == ["NSW > 0: ions move", "IBRION is not -1", "ISIF >= 3: the cell relaxes"]
    assert empty["m"] == {} and empty["w"] == [] and none["m"] is None and len(long["m"]) == 20_000


@pytest.mark.parametrize("block", [4, 1024])
def test_plane_distances_meet_few_tiles(spark, block):
    rng = np.random.default_rng(1)
    some = [("A", "B", "C", *map(int, n)) for n in rng.integers(1, 40, (1500, 3))]
    crowd = [("A", "B", "C", 100_000, *map(int, n)) for n in rng.integers(1, 30, (300, 2))]  # in one corner of the triangle
    rows = [*some, *crowd, ("A", "B", "D", 1, 1, 1), ("A", "C", "D", 1, 1, 1), ("A", "C", "D", 1, 2, 1), ("A", "C", "D", 1, 1, 9)]
    df = spark.createDataFrame(rows, "a string, b string, c string, n_a bigint, n_b bigint, n_c bigint")
    got = {(r["a"], r["b"], r["c"]): r for r in coverage.plane_distances(df, block).collect()}
    for key in {r[:3] for r in rows}:
        n = np.array([r[3:] for r in rows if r[:3] == key], np.float64)
        s = n.sum(axis=1)
        p = np.stack([n[:, 1] / s + n[:, 2] / s / 2, n[:, 2] / s * np.float64(3.0**0.5 / 2)], axis=1)
        d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))
        np.fill_diagonal(d, np.inf)
        near = d.min(axis=1)
        r = got[key]
        assert r["n"] == len(n)
        if len(n) == 1:
            assert r["nn_mean"] is None and r["nn_p95"] is None
        else:
            assert abs(r["nn_mean"] - near.mean()) < 2e-9 and abs(r["nn_p95"] - np.percentile(near, 95)) < 2e-9


def test_long_rows_of_a_small_table_are_dealt_out(spark):
    cube = [[float(x), float(y), float(z)] for x in (0, 2) for y in (0, 2) for z in (0, 2)]
    cell = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
    rows = [(k, ["W"] * 5 + ["Cr"] * 3, cube, cell) for k in range(8)]
    one = spark.createDataFrame(rows, "structure_index bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>").coalesce(1)
    for made in (defects.quasi_random(one, 4.5, 20), defects.displaced(one, [0.01]), defects.with_defects(one, "interstitial", 1, ["H"])):
        assert made.rdd.getNumPartitions() > 1
        assert made.count() == 8


def test_swaps_of_mixed_cells_lower_the_score(spark):
    """The outcome's score is that of its own pairs, counted anew."""
    cube = np.array([[x, y, z] for x in (0, 2) for y in (0, 2) for z in (0, 2)], np.float64)
    rows = [(k, ["Cr"] * 2 + ["Mo"] * 3 + ["W"] * 3, cube.tolist(), (4 * np.eye(3)).tolist()) for k in range(6)]
    df = spark.createDataFrame(rows, "structure_index bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>")
    got = {r["structure_index"]: r for r in defects.quasi_random(df, 4.5, 60).collect()}
    again = spark.createDataFrame([(k, r["symbols"], cube.tolist(), (4 * np.eye(3)).tolist()) for k, r in got.items()], df.schema)
    for r in defects.quasi_random(again, 4.5, 0).collect():
        assert abs(r["before"] - got[r["structure_index"]]["after"]) < 1e-9
        assert got[r["structure_index"]]["after"] <= got[r["structure_index"]]["before"]
    assert sum(r["swaps"] for r in got.values()) > 0


def test_retry_ladders_work_out_their_lists_once(spark):
    jobs = spark.createDataFrame([(1, 1, 4, 2), (2, 8, 1, 1), (3, 2, 200, 5)], "job int, gpu int, ncore int, kpar int").coalesce(1)
    found = generators.retry_ladders(jobs, [1, 2, 2, 4], 64, 4)
    assert found.rdd.getNumPartitions() > 1
    assert found._jdf.queryExecution().optimizedPlan().toString().count("shiftright") == 1
    for job, gpu, ncore, kpar in jobs.collect():
        tiers = [g for g in (1, 2, 2, 4) if g >= gpu] or [gpu]
        want, n = [], max(1, min(ncore, 64))
        for nodes, gpus in [(1, g) for g in tiers] + [(2, tiers[-1]), (4, tiers[-1])]:
            for k in (kpar, max(1, kpar // 2), 1):
                for h in range(n.bit_length()):
                    x = (nodes, gpus, n >> h, k)
                    if x not in want:
                        want.append(x)
        want = [x for x in want if x != (1, gpu, ncore, kpar)]
        got = sorted(found.where(F.col("job") == job).collect(), key=lambda r: r["level"])
        assert [(r["level"], r["nodes"], r["gpus"], r["ncore"], r["kpar"]) for r in got] == [(i + 1, *x) for i, x in enumerate(want)]


def test_nearest_measures_only_what_may_be_nearest(spark):
    """Copies, near copies, rows far from the origin: distances to the last bit."""
    rng = np.random.default_rng(2)
    v = rng.standard_normal((600, 8))
    v[100:200] = v[:100]
    v[200:300] = v[:100] + 1e-9
    v[300:400] = 1e6 + v[300:400] * 1e-6
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    assert distance.ROWS < len(rows)
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = {r["id"]: (r["distance"], r["positive_distance"]) for r in distance.nearest(df, df, itself=True).collect()}
    for i in range(len(v)):
        d = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        assert got[i] == (d.min(), d[d > 1e-12].min())


def test_atoms_are_dealt_by_structure(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 50)
    found = tables.atoms(spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert found.rdd.getNumPartitions() == -(-n // 50)
    # Sums over elements and over structures move no row again.
    plan = C.per_structure(C.element_counts(found))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(structure_index") == 1
