"""Small known cases of the operators."""

from __future__ import annotations

import math

import numpy as np
import pytest

from plain_selection import composition_aware
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.functions import structure as S
from ferrolite.functions import text as X
from ferrolite.operators import benchmark, coverage, distance, fits, generators, registry, selection


def _pairs(spark, shares):
    return spark.createDataFrame([("W", "Y", float(s)) for s in shares], "a string, b string, b_share double")


def _structures(spark, rows):
    flat = [(i, e, n) for i, r in enumerate(rows) for e, n in r.items()]
    return C.per_structure(C.element_counts(spark.createDataFrame(flat, "structure_index bigint, element string, n_atoms bigint")))


def test_binary_and_ternary_projections(spark):
    rows = _structures(spark, [{"W": 3, "Y": 1}, {"Cr": 1, "W": 3, "Y": 1}, {"W": 4}])
    got = [(r["structure_index"], r["b_share"]) for r in C.pairs(rows).where("a = 'W' and b = 'Y'").collect()]
    assert sorted(got) == [(0, 0.25), (1, 0.25)]
    rows = _structures(spark, [{"Cr": 1, "W": 2, "Y": 1, "Zr": 1}])
    assert sorted((r["a"], r["b"], r["c"]) for r in C.triples(rows).collect()) == [("Cr", "W", "Y"), ("Cr", "W", "Zr"), ("Cr", "Y", "Zr"), ("W", "Y", "Zr")]


@pytest.mark.parametrize(
    ("shares", "bins", "want"),
    [((0.05, 0.25, 0.45, 0.65, 0.85), 5, (1.0, 1.0, 0.2, 0.0)), ((0.49, 0.5, 0.5, 0.51, 0.5), 5, (0.2, 0.0, 1.0, 0.8)), ((0.25, 0.25, 0.75), 4, (0.5, 0.459147917, 0.666666667, 0.583333333))],
)
def test_coverage_summary(spark, shares, bins, want):
    r = coverage.summary(coverage.binary_bins(_pairs(spark, shares), bins), ["a", "b"], bins).first()
    assert (r["occupied_fraction"], r["normalized_entropy"], r["max_bin_fraction"], r["gini"]) == pytest.approx(want)


def test_ternary_cells(spark):
    rows = spark.createDataFrame([("Cr", "W", "Y", 25, 50, 25), ("Cr", "W", "Y", 24, 51, 25), ("Cr", "W", "Y", 50, 25, 25)], "a string, b string, c string, n_a long, n_b long, n_c long")
    got = {(r["i"], r["j"], r["k"]): r["n"] for r in coverage.ternary_bins(rows, 8).collect()}
    assert got == {(2, 4, 2): 2, (4, 2, 2): 1} and C.ternary_cells(8) == 45


def test_edge_bins_and_rewards(spark):
    r = spark.range(1).select(*[C.unit_bin(F.lit(v), 20).alias(n) for n, v in (("a", 1.0), ("b", 1 - 1e-13), ("c", -0.5), ("d", 0.25))], *[C.deficit_reward(F.lit(n), F.lit(t), 20).alias(f"r{n}") for n, t in ((0, 10), (1, 20), (2, 20))]).first()
    assert (r["a"], r["b"], r["c"], r["d"]) == (19, 19, 0, 5)
    assert (r["r0"], r["r1"], r["r2"]) == (1.0, 0.5, 0.0)


def test_normalised_and_single_element(spark):
    rows = spark.createDataFrame([({"Y": 1.0, "Zr": 0.0}, ["Y"]), ({"W": 1.0, "Cr": 1.0}, ["W", "Cr"]), (None, ["A", "A"]), (None, ["A", "B"])], "m map<string,double>, s array<string>")
    got = [(r["n"], r["one"]) for r in rows.select(C.normalised(F.col("m")).alias("n"), C.single_element(F.col("m"), F.col("s")).alias("one")).collect()]
    assert got == [({"Y": 1.0}, True), ({"Cr": 0.5, "W": 0.5}, False), (None, True), (None, False)]


def _vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id bigint, v array<double>")


def test_distances(spark):
    rows = _vectors(spark, [(0, 0), (2, 0), (3, 0)])
    r = distance.summary(distance.nearest(rows.where("id > 0"), rows.where("id = 0"))).first()
    assert (r["nn_min"], r["nn_mean"]) == (2.0, 2.5)
    assert distance.nearest(rows, rows.where("id > 9")).first()["distance"] == math.inf
    line = _vectors(spark, [(0,), (1,), (3,)])
    assert distance.summary(distance.nearest(line, line, itself=True)).first()["nn_mean"] == pytest.approx(4 / 3)
    twice = _vectors(spark, [(0,), (0,), (2,)])
    assert distance.nearest(twice, twice, itself=True).agg(F.min("positive_distance")).first()[0] == 2.0


def test_nearest_over_several_blocks(spark):
    x = np.random.default_rng(1).normal(size=(300, 3))
    rows = _vectors(spark, x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    got = {r["id"]: r["distance"] for r in distance.nearest(rows, rows, itself=True, block=64).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(d.min(axis=1))


def _greedy(x, k):
    picks, near = [0], np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(picks) < k:
        j = int(near.argmax())
        picks.append(j)
        near = np.minimum(near, np.sqrt(((x - x[j]) ** 2).sum(1)))
    return picks


def test_farthest_points(spark):
    x = np.random.default_rng(2).normal(size=(120, 4))
    picks = selection.farthest_points(_vectors(spark, x), 8).orderBy("pick").collect()
    assert [r["id"] for r in picks] == _greedy(x, 8)
    falling = [r["distance"] for r in picks]
    assert falling == sorted(falling, reverse=True)
    stop = (falling[4] + falling[5]) / 2
    assert selection.farthest_points(_vectors(spark, x), 8, stop).count() == 5
    same = _vectors(spark, [(1, 1), (1, 1)])
    assert [r["id"] for r in selection.farthest_points(same, 1).collect()] == [0]
    assert selection.farthest_points(same.where("id > 5"), 3).count() == 0


def test_target_distance():
    picks = [math.inf, 0.9, 0.5, 0.3, 0.2, 0.1]
    d = selection.distance_for(picks, 3, 0)
    assert sum(p >= d for p in picks) == 3
    with pytest.raises(ValueError):
        selection.distance_for(picks, 0, 0)


def test_composition_aware_fill():
    same = np.zeros((3, 1))
    bins = [[("Cr", "W", 10)], [("Cr", "W", 10)], [("Cr", "W", 5)]]
    assert composition_aware(same, bins, [0], 2, 1.0) == [0, 2]
    assert composition_aware(np.array([[0.0], [10.0], [8.0]]), bins, [0], 2, 0.5) == [0, 1]
    assert composition_aware(np.array([[0.0], [10.0], [9.5], [7.0]]), [[("A", "B", 1)]] * 3 + [[("A", "B", 2)]], [0], 2, 1.0)[1] == 1
    assert composition_aware(same, bins[:2] + bins[:1], [0], 2, 1.0) == [0, 1]


def _attempt(n, least, positive, mean, score):
    keys = ("binary_occupied_bin_fraction", "binary_normalized_entropy", "ternary_occupied_bin_fraction", "ternary_normalized_entropy")
    return {"attempt_number": n, "train_min_dist": least, "train_positive_min_dist": positive, "train_mean_nn_dist": mean} | dict.fromkeys(keys, score)


def test_attempts():
    base = _attempt(1, 10, 10, 8, 0.3)
    assert selection.best_attempt([base, _attempt(2, 9.4, 9.4, 7.7, 0.9)], 0.95) == 1
    assert selection.best_attempt([base, _attempt(2, 9.6, 9.6, 7.8, 0.4)], 0.95) == 2
    assert selection.best_attempt([base, _attempt(2, 10.2, 10.2, 8, 0.3)], 0.95) == 2
    assert selection.best_attempt([_attempt(1, 0, 4, 8, 0.3), _attempt(2, 0, 3, 8, 0.9)], 0.95) == 1


def test_split_labels(spark):
    rows = spark.range(5).withColumnRenamed("id", "id")
    got = {r["id"]: r["split"] for r in selection.split_labels(rows, [("train", rows.where("id < 3")), ("test", rows.where("id in (2, 3)"))]).collect()}
    assert got == {0: "train", 1: "train", 2: "test", 3: "test", 4: "unselected"}


JOB = "job string, incar_hash string, potcar_hash string, structure_hash string"


def test_reuse(spark):
    reg = spark.createDataFrame([("a", "b", "c", "/old", True), ("x", "b", "c", "/bad", False), ("", "b", "c", "/empty", True)], "incar_hash string, potcar_hash string, structure_hash string, job_path string, complete boolean")
    jobs = spark.createDataFrame([("1", "a", "b", "c"), ("2", "x", "b", "c"), ("3", "a", "z", "c"), ("4", "", "b", "c"), ("5", None, "b", "c")], JOB)
    got = {r["job"]: (r["status"], r["reused_from"]) for r in registry.reuse(jobs, reg).collect()}
    assert got == {"1": ("reused", "/old")} | {k: ("pending", None) for k in "2345"}


def test_upsert_and_priority(spark):
    e = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("b", 2, "only")], "k string, at int, v string")
    assert {r["k"]: r["v"] for r in registry.latest(e, ["k"], "at").collect()} == {"a": "new", "b": "only"}
    s = spark.createDataFrame([("1",), ("2",), ("3",)], "key string")
    one, two = spark.createDataFrame([("1", "own")], "key string, path string"), spark.createDataFrame([("1", "any"), ("2", "b"), ("2", "a")], "key string, path string")
    assert {r["key"]: (r["path"], r["priority"]) for r in registry.prioritised(s, [one, two]).collect()} == {"1": ("own", 1), "2": ("a", 2), "3": (None, None)}


def test_seed_anchors(spark):
    g = spark.createDataFrame([("s0", 0, "unperturbed"), ("s0", 5, "rattled"), ("s2", 3, "unperturbed")], "seed_id string, structure_index bigint, perturbation_type string")
    seeds = spark.createDataFrame([("s0",), ("s2",), ("s9",)], "seed_id string")
    assert {r["seed_id"]: r["structure_index"] for r in registry.seed_anchors(g, seeds).collect()} == {"s0": 5, "s2": 3}
    assert {r["seed_id"]: r["structure_index"] for r in registry.seed_anchors(g, seeds, "unperturbed").collect()} == {"s0": 0, "s2": 3}
    assert [r["seed_id"] for r in registry.unmatched_seeds(g, seeds).collect()] == ["s9"]


def test_structure_hashes_differ(spark):
    rows = spark.createDataFrame([(["Si"], [[0.0, 0.0, 0.0]], 1.0), (["Si"], [[0.25, 0.0, 0.0]], 1.0), (["Si"], [[0.0, 0.0, 0.0]], 2.0)], "s array<string>, p array<array<double>>, a double")
    zero = F.lit(0.0)
    cell = F.array(F.array("a", zero, zero), F.array(zero, F.col("a"), zero), F.array(zero, zero, F.col("a")))
    assert rows.select(S.structure_hash(F.col("s"), F.col("p"), cell, F.lit([True, True, True]))).distinct().count() == 3


def test_settings(spark):
    a, b = "ENCUT = 520\nNCORE = 16\nKPAR = 1\nISMEAR = 0\n", "ENCUT = 520\n ncore=64\nkpar = 4\nISMEAR = 0"
    rows = spark.createDataFrame([(a,), (b,)], "t string")
    assert rows.select(X.settings_hash(F.col("t"))).distinct().count() == 1
    assert rows.select(X.without_resources(F.col("t"))).first()[0] == "ENCUT = 520\nISMEAR = 0\n"
    m = spark.createDataFrame([("a = 1 # x\nA=2\n! b = 3\nNSW=5\nIBRION = 2",)], "t string").select(X.settings_map(F.col("t")).alias("m"))
    assert m.first()["m"] == {"A": "2", "NSW": "5", "IBRION": "2"}
    assert m.select(X.lint(F.col("m"))).first()[0] == ["NSW > 0: ions move", "IBRION is not -1"]
    d = rows.select(X.with_defaults(F.col("t"), [("KSPACING", "0.2"), ("ENCUT", "1")])).first()[0]
    assert d == "ENCUT = 520\nNCORE = 16\nKPAR = 1\nISMEAR = 0\nKSPACING = 0.2\n"


LOG = "running 64 mpi-ranks\n Found     10 irreducible k-points:\n   NELECT =     96.9\n LOOP:  cpu time 1.0: real time   2.0\n LOOP:  cpu time 1.0: real time   4.0\n  in kB  1.0 2.0 3.0 4.0 5.0 6.0\n  in kB  10.0 20.0 30.0 40.0 50.0 60.0\n General timing and\n"


def test_logs(spark):
    t = F.col("t")
    r = spark.createDataFrame([(LOG,), ("running on   8 total cores",), ("",), (None,)], "t string").select(X.ranks(t).alias("r"), X.kpoints(t).alias("k"), X.electrons(t).alias("e"), X.mean_loop_time(t).alias("l"), X.stress_gpa(t).alias("s"), X.is_complete(t).alias("c"), X.error_class(t).alias("x")).collect()
    assert (r[0]["r"], r[0]["k"], r[0]["e"], r[0]["l"], r[0]["c"]) == (64, 10, 96, 3.0, True)
    assert r[0]["s"] == pytest.approx([1.0, 2.0, 3.0, 5.0, 6.0, 4.0])
    assert (r[1]["r"], r[1]["k"], r[1]["l"], r[1]["c"]) == (8, None, 0.0, False)
    assert r[2]["s"] is None and r[3]["c"] is False


def test_walltimes_and_scalars(spark):
    r = spark.createDataFrame([("01:02:03",), ("soon",), ("1:2",)], "t string").select(X.seconds(F.col("t"))).collect()
    assert [x[0] for x in r] == [3723, 10800, 10800]
    r = spark.createDataFrame([("TRUE",), ("-7",), ("1e3",), ("a b",)], "t string").select(X.coerced(F.col("t")).alias("x")).select("x.*").collect()
    assert [x["kind"] for x in r] == ["bool", "int", "float", "string"] and r[2]["d"] == 1000.0


def test_snapping_and_ladder(spark):
    r = spark.createDataFrame([(3,), (48,), (100,)], "v int").select(benchmark.snap(F.col("v"), benchmark.powers_of_two(64))).collect()
    assert [x[0] for x in r] == [2, 32, 64]
    ladder = generators.retry_ladders(spark.createDataFrame([("a", 2, 8, 2)], "job string, gpu int, ncore int, kpar int"), [1, 2, 4], 64, 4).drop("job").orderBy("level").collect()
    assert [r["level"] for r in ladder] == list(range(1, len(ladder) + 1))
    assert (ladder[0]["gpus"], ladder[0]["kpar"], ladder[0]["ncore"]) == (2, 2, 4)
    assert len({tuple(r)[1:] for r in ladder}) == len(ladder) and ladder[-1]["nodes"] == 4


def test_elastic_set(spark):
    rows = generators.elastic_set(spark.createDataFrame([("seed_1",)], "seed_id string"), [-0.01, 0.0, 0.01])
    assert rows.count() == 18 and rows.select("elastic_mode").distinct().count() == 9
    m = {(r["elastic_mode"], r["strain_amplitude"]): np.array(r["strain_matrix"]).reshape(3, 3) for r in rows.collect()}
    cell = 3 * np.eye(3)
    assert (cell @ (np.eye(3) + m["normal_xx", 0.01]))[0, 0] == pytest.approx(3.03)
    assert np.linalg.det(cell @ (np.eye(3) + m["coupled_xy", 0.01])) == pytest.approx(27.0)
    assert m["shear_xy", 0.01][0, 1] == m["shear_xy", 0.01][1, 0] == 0.01
    v = rows.where("elastic_mode = 'shear_xy' and strain_amplitude > 0").select(fits.strain_voigt(F.col("strain_matrix"))).first()[0]
    assert v == pytest.approx([0, 0, 0, 0, 0, 0.02])


def test_ladders():
    assert generators.rattle_ladder(0.01, 0.07, 2) == pytest.approx([0.01, 0.07])
    assert generators.rattle_ladder(0.01, 0.07, 4) == pytest.approx([0.01, 0.03, 0.05, 0.07])
    assert generators.rattle_ladder(0.03, 0.03, 3) == pytest.approx([0.03] * 3)


@pytest.mark.parametrize("symmetry", ["general", "cubic", "hexagonal"])
def test_known_tensor(spark, symmetry):
    c = np.zeros((6, 6))
    a, b, d = 240.0, 140.0, 80.0
    c[:3, :3] = b
    np.fill_diagonal(c, [a, a, a, d, d, (a - b) / 2 if symmetry == "hexagonal" else d])
    rng = np.random.default_rng(3)
    e = rng.normal(0, 0.01, (40, 6))
    s = e @ c + 1.5
    rows = spark.createDataFrame([("g", x.tolist(), y.tolist()) for x, y in zip(e, s, strict=True)], "group_key string, strain_voigt array<double>, stress_voigt_gpa array<double>")
    r = fits.elastic_tensors(rows, symmetry).first()
    assert np.array(r["tensor"]).reshape(6, 6) == pytest.approx(c, abs=1e-6)
    assert r["rmse"] == pytest.approx(0, abs=1e-5) and r["least_eigenvalue"] == pytest.approx(np.linalg.eigvalsh(c).min(), abs=1e-5)
    assert fits.elastic_tensors(rows.limit(3), symmetry).count() == 0
    flat = rows.withColumn("strain_voigt", F.array(*[F.lit(0.0)] * 6))
    assert fits.elastic_tensors(flat, symmetry).first()["tensor"] is None


def test_principal_plane(spark):
    x = np.random.default_rng(5).normal(size=(200, 4)) * [5, 2, 1, 0.1] + 7
    got = np.array([[r["pc1"], r["pc2"]] for r in fits.principal_plane(_vectors(spark, x)).orderBy("id").collect()])
    y = x - x.mean(0)
    _, _, vt = np.linalg.svd(y, full_matrices=False)
    want = y @ vt[:2].T
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-8)


def test_cells(spark):
    m = [[2.0, 1.0, 0.0], [0.0, 3.0, 1.0], [1.0, 0.0, 4.0]]
    r = spark.createDataFrame([(m,), ([[0.0] * 3] * 3,)], "m array<array<double>>").select(S.inverse(F.col("m")).alias("i"), S.times(F.lit([1.0, 2.0, 3.0]), F.col("m")).alias("t")).collect()
    assert np.array(r[0]["i"]) == pytest.approx(np.linalg.inv(m)) and r[1]["i"] is None
    assert r[0]["t"] == pytest.approx(np.array([1, 2, 3]) @ np.array(m))
