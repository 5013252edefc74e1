"""Elastic records, defects, structure sources and tables against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest

from plain_selection import composition_aware
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.functions import structure as S
from ferrolite.functions import text as X
from ferrolite.operators import curation, defects, elastic, fits, generators, selection, validation
from ferrolite.sources import structures as R
from ferrolite.sources import tables, xyz
from ferrolite.streaming import jobs

VOIGT = [(0, 0), (1, 1), (2, 2), (1, 2), (0, 2), (0, 1)]


def test_elastic_records_against_numpy(spark):
    """Primitive bcc and fcc cells, a skew one and a flat one."""
    draw = np.random.Generator(np.random.PCG64(3))
    h = 1.6
    bases = {"bcc": [[-h, h, h], [h, -h, h], [h, h, -h]], "fcc": [[0, h, h], [h, 0, h], [h, h, 0]], "other": [[3.0, 0.1, 0], [0.2, 4.0, 0.3], [0, 0.5, 5.0]], "flat": [[1.0, 0, 0], [2.0, 0, 0], [0, 0, 1.0]]}
    turn = np.linalg.qr(draw.normal(size=(3, 3)))[0]
    frames, outcomes, want = [], [], {}
    for k, (name, base) in enumerate(bases.items()):
        base, strain, stress = np.array(base) @ turn, draw.normal(0, 0.01, (3, 3)), draw.normal(0, 1, (3, 3))
        strain, stress = (strain + strain.T) / 2, (stress + stress.T) / 2
        cell = (np.eye(3) + strain) @ base
        frames.append(("d", k, "elastic_stress", {"W": 1.0}, ["W"], cell.tolist(), name, "h", None, "", None, strain.ravel().tolist(), "m", 0.01))
        outcomes.append(("d", k, "h", stress.ravel().tolist()))
        if name == "flat":
            continue
        f = np.linalg.inv(base) @ cell
        e = (f + f.T) / 2 - np.eye(3)
        a, b, c = base
        axes = {"bcc": np.array([b + c, a + c, a + b]), "fcc": np.array([-a + b + c, a - b + c, a + b - c])}.get(name)
        r = np.eye(3) if axes is None else axes / np.linalg.norm(axes, axis=1)[:, None]
        e, s = r @ e @ r.T, r @ stress @ r.T
        want[k] = ([e[i] * (1 if i[0] == i[1] else 2) for i in VOIGT], [s[i] for i in VOIGT])
    schema = "dataset string, structure_index bigint, perturbation_type string, composition map<string,double>, symbols array<string>, cell array<array<double>>, structure_name string, structure_hash string, seed_id string, material_id string, source string, strain_matrix array<double>, elastic_mode string, strain_amplitude double"
    got = {r["structure_index"]: r for r in elastic.elastic_records(spark.createDataFrame(frames, schema), spark.createDataFrame(outcomes, "dataset string, structure_index bigint, structure_hash string, stress_gpa array<double>")).collect()}
    assert len(got) == 4 and got[3]["reason"] == "reference_failure" and got[0]["group_key"] == "W:bcc"
    for k, (e, s) in want.items():
        assert np.allclose(got[k]["strain_voigt"], e, atol=1e-12) and np.allclose(got[k]["stress_voigt_gpa"], s, atol=1e-12)


def test_cubic_constants_by_pairs_and_by_offsets(spark):
    draw = np.random.Generator(np.random.PCG64(4))
    c = np.zeros((6, 6))
    c[:3, :3] = 130
    c[range(3), range(3)] = 250
    c[range(3, 6), range(3, 6)] = 90
    rows = []
    for g in ("paired", "single"):
        for k in range(24):
            e = draw.normal(0, 0.01, 6)
            offset = np.array([5.0, 5, 5, -2, -2, -2]) if g == "single" else draw.normal(0, 3, 6)
            signs = (1, -1) if g == "paired" else (1,)
            for sign in signs:
                rows.append((g, f"m{k}", 0.01 * sign, (sign * e).tolist(), (c @ (sign * e) + offset).tolist(), k))
    rows.append(("few", "m", 0.01, [0.01, 0.0, 0.0, 0.0, 0.0, 0.0], [1.0] * 6, 1))
    df = spark.createDataFrame(rows, "group_key string, elastic_mode string, amplitude double, strain_voigt array<double>, stress_voigt_gpa array<double>, structure_index bigint")
    got = {r["group_key"]: r for r in elastic.cubic_constants(df).collect()}
    for g, pairs in (("paired", 24), ("single", 0)):
        assert got[g]["pairs"] == pairs and np.allclose([got[g]["c11"], got[g]["c12"], got[g]["c44"]], [250, 130, 90])
    assert got["few"]["c44"] is None
    # Offsets a million times larger than the strains' effect do not spoil the general fit.
    single = spark.createDataFrame([("g", (e := draw.normal(0, 0.01, 6)).tolist(), (c @ e + 1e6).tolist()) for _ in range(40)], "group_key string, strain_voigt array<double>, stress_voigt_gpa array<double>")
    assert np.allclose(np.array(fits.elastic_tensors(single).first()["tensor"]).reshape(6, 6), c, atol=1e-3)
    whole = elastic.summarised(single.withColumn("elastic_mode", F.lit("m")), fits.elastic_tensors(single)).first()
    assert whole["modes"] == {"m": 40} and whole["warnings"] == [] and whole["asymmetry"] < 1e-3


def test_defects_keep_their_distance(spark):
    cell = np.array([[5.0, 0, 0], [1.0, 6.0, 0], [0, 0.5, 7.0]])
    positions = [[0.0, 0.0, 0.0], [2.5, 3.0, 3.5], [2.5, 0.0, 3.0], [0.5, 3.0, 0.0]]
    bases = spark.createDataFrame([(k, ["W"] * 4, positions, cell.tolist()) for k in range(3)], "structure_index bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>")
    for kind in defects.KINDS:
        df = defects.with_defects(bases, kind, 3, ["He"], (0.3, 0.9), 1.1)
        rows = {(r["structure_index"], r["variant"]): r for r in df.collect()}
        assert len(rows) == 9 and [r["positions"] for r in rows.values()] == [r["positions"] for r in sorted(df.repartition(5).collect(), key=lambda r: list(rows).index((r["structure_index"], r["variant"])))]
        for r in rows.values():
            p, inv = np.array(r["positions"]), np.linalg.inv(cell)
            d = p[:, None] - p[None]
            f = d @ inv
            d = np.sqrt((((f - np.rint(f)) @ cell) ** 2).sum(axis=2)) + 99 * np.eye(len(p))
            assert len(p) == len(r["symbols"]) and r["placed"] <= r["asked"] and r["symbols"].count("He") == r["placed"]
            assert kind == "gas_in_vacancy" or d.min() >= 1.1
            if kind == "gas_in_vacancy":
                assert len(p) == 4 and sorted(map(tuple, p.tolist())) == sorted(map(tuple, positions))
    assert {r["placed"] for r in defects.with_defects(bases, "interstitial", 1, ["H"], (0.3, 0.3), 50.0, tries=5).collect()} == {0}
    with pytest.raises(ValueError):
        defects.with_defects(bases, "other", 1, ["H"])


@pytest.mark.parametrize("frontier, weight", [(0.05, 1.0), (0.4, 0.5), (1.0, 2.0)])
def test_composition_aware_points_equal_the_plain_form(spark, monkeypatch, frontier, weight):
    """With all rows as candidates, and with so few that most steps are foreseen wrongly."""
    if frontier != 1.0:
        monkeypatch.setattr(selection, "CANDIDATES", 5 if frontier < 0.1 else 30)
    draw = np.random.Generator(np.random.PCG64(9))
    v = draw.normal(0, 1, (90, 3))
    v[20:24] = v[3]  # at no distance
    bins = [[("a", "b", int(draw.integers(5))), ("a", "b", "c", int(draw.integers(4)), 0)][: 1 + k % 2] for k in range(90)]
    rows = [(k, v[k].tolist(), [("|".join(map(str, b[:2] if len(b) == 3 else b[:3])), str(b[2:] if len(b) == 3 else b[3:]), len(b) > 3) for b in bins[k]]) for k in range(90)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, bins array<struct<subset:string,bin:string,ternary:boolean>>").repartition(3)
    anchors = spark.createDataFrame([(7,), (3,)], "id bigint")
    got = [r["id"] for r in selection.composition_aware_points(df, 15, frontier, anchors, weight, (4, 6), steps=6).orderBy("pick").collect()]
    assert got == composition_aware(v, bins, [3, 7], 15, frontier, weight, (4, 6))
    assert selection.attempt_schedule(0.2, 1.0, 4) == [(0.2, 1.0), (0.1, 1.0), (0.25, 1.0), (0.2, 2.0)] and len(selection.attempt_schedule(0.2, 1.0, 0)) == 1


def test_composition_aware_rounds_are_few_where_the_front_is_wider_than_the_candidates(spark, monkeypatch):
    """What is known of rows that are not on the list: how many are ahead of one, by the sample, whole or not."""
    draw = np.random.Generator(np.random.PCG64(10))
    v = draw.normal(0, 1, (600, 256))
    v /= np.sqrt((v**2).sum(axis=1))[:, None]
    rank = np.argsort(np.argsort(-((v - v[0]) ** 2).sum(axis=1)))  # the emptiest bins are mostly behind the front
    bins = [[("a", "c", k % 40)] if 200 <= rank[k] < 300 else [("a", "b", int(draw.integers(6)))] for k in range(600)]
    rows = [(k, v[k].tolist(), [("|".join(b[:2]), str(b[2:]), False) for b in bins[k]]) for k in range(600)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, bins array<struct<subset:string,bin:string,ternary:boolean>>").repartition(3)
    monkeypatch.setattr(selection, "CANDIDATES", 64)
    monkeypatch.setattr(selection, "STEPS", 64)
    foreseen, rounds = selection._foreseen, []
    monkeypatch.setattr(selection, "_foreseen", lambda *a: rounds.append(1) or foreseen(*a))
    for sample in (16_384, 200):
        monkeypatch.setattr(selection, "SAMPLE", sample, raising=False)
        rounds.clear()
        got = [r["id"] for r in selection.composition_aware_points(df, 30, 0.2, None, 1.0, (4, 6), steps=64).orderBy("pick").collect()]
        assert got == composition_aware(v, bins, [], 30, 0.2, 1.0, (4, 6))
        assert len(rounds) <= 10


def test_rows_that_were_not_foreseen_are_placed_by_the_marks_about_them():
    """Counts at (distance, id) tell on which side of the border a row is, also if nobody asked for that row."""
    marks = [(1.3, 7, 4), (1.2, -1, 9), (1.1, -1, 12)]
    assert selection._place(marks, 1.3, 7, 5) == 4  # counted itself
    assert selection._place(marks, 1.25, 3, 10) == 9 and selection._place(marks, 1.15, 3, 9) == 9  # in front, and behind
    assert selection._place(marks, 1.25, 3, 6) is None and selection._place(marks, 1.0, 3, 20) is None and selection._place([], 1.0, 3, 5) is None
    best = [(-0.5, -1.15, 3), (-0.0, -1.4, 2)]
    assert selection._chosen(best, lambda d, i: selection._place(marks, d, i, 9), 9, 50, 0.5) == 2
    assert selection._not_beaten([(-0.5, -1.3, 1), (-0.2, -1.2, 2), (-0.1, -1.3, 0), (-0.0, -1.4, 5)]) == [(-0.5, -1.3, 1), (-0.1, -1.3, 0), (-0.0, -1.4, 5)]


def test_metrics_are_means_over_subsets(spark):
    two = lambda b: ("W|Y", str(b), False)
    three = lambda b: ("Cr|W|Y", str(b), True)
    rows = [(0, [0.0], [two(10), three(6)]), (1, [1.0], [two(10), three(6)]), (2, [3.0], [two(5), three(9)]), (3, [9.0], [two(1)])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, bins array<struct<subset:string,bin:string,ternary:boolean>>")
    m = selection.attempt_metrics(df, df.where("id < 3"), 0)
    h = -(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3))
    want = {"binary_occupied_bin_fraction": 0.1, "binary_normalized_entropy": h / math.log(20), "ternary_occupied_bin_fraction": 2 / 190, "ternary_normalized_entropy": h / math.log(190), "train_min_dist": 1.0}
    assert all(m[k] == pytest.approx(v) for k, v in want.items()) and m["train_mean_nn_dist"] == pytest.approx(4 / 3)


def test_best_attempt_ties(spark):
    def attempt(n, least, positive, mean=1.0, score=0.5):
        return {"attempt_number": n, "train_min_dist": least, "train_positive_min_dist": positive, "train_mean_nn_dist": mean, "binary_occupied_bin_fraction": score, "binary_normalized_entropy": 0, "ternary_occupied_bin_fraction": 0, "ternary_normalized_entropy": 0}

    assert selection.best_attempt([attempt(0, 0.0, 0.9), attempt(1, 0.1, 0.85)], 0.9) == 1  # ties go by the smallest distance, zero included
    assert selection.best_attempt([attempt(0, 0.5, 0.9), attempt(1, 0.6, 0.7, score=0.9)], 0.9) == 0  # falls below the floor


def test_stress_forms_and_virial(spark):
    block = "STRESS in cartesian coordinates (kB)\n  1.0 2.0 3.0\n  4.0 5.0 6.0\n  7.0 8.0 9.0\n"
    texts = [
        block + " other\n" + block.replace("1.0", "10.0"), "Total STRESS tensor in kB :\n unit kB\n  x  10.0   2.0  3.0\n  y  2.0  5.0 -6.0\n\n  z  3.0 -6.0 9.0\n", "in kB  1.0 2.0 3.0 4.0 5.0 6.0\n last stress (kB) : 10 20 30 40 50 60\n",
        "  in kB    1.00   2.00   3.00   4.00   5.00   6.00\n  in kB   -10.00   20.0   30.0   40.0   50.0   60.0\n", "nothing here",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = [None if r["m"] is None else [round(x, 9) for x in r["m"]] for r in df.select("k", X.stress_matrix_gpa(F.col("t")).alias("m")).orderBy("k").collect()]
    assert got[0] == [1.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9] and got[1] == [1.0, 0.2, 0.3, 0.2, 0.5, -0.6, 0.3, -0.6, 0.9]
    assert got[2] == [1.0, 4.0, 6.0, 4.0, 2.0, 5.0, 6.0, 5.0, 3.0] and got[3] == [-1.0, 4.0, 6.0, 4.0, 2.0, 5.0, 6.0, 5.0, 3.0] and got[4] is None
    assert df.limit(1).select(X.virial(F.array(F.lit(1602.17663)), F.lit(2.0)).alias("v")).first()["v"] == [-2.0]


def test_labels(spark):
    rows = [({"W": 1.0},), ({"W": 0.5, "Cr": 0.3, "C": 0.2},), ({"A": 1 / 3, "B": 2 / 3},), ({"A": 0.996, "B": 0.004},), ({"A": 0.165, "B": 0.835},), (None,)]
    got = [r["l"] for r in spark.createDataFrame(rows, "c map<string,double>").select(C.label(F.col("c")).alias("l")).collect()]
    assert got == ["W", "W0.5-Cr0.3-C0.2", "B0.67-A0.33", "A1-B0.004", f"B{0.835:.2g}-A{0.165:.2g}", None]
    got = spark.createDataFrame([(0.25,), (1 / 3,), (None,)], "x double").select(C.fraction_label("x").alias("l")).collect()
    assert [r["l"] for r in got] == ["1/4", "1/3", None]


def test_facts_of_mixed_layouts(spark, tmp_path):
    names = list(tables.FACTS)
    old, new = ",".join(names[:-1]), ",".join(names)
    (tmp_path / "a.csv").write_text(f"{old}\n2,1,24,1,1,4,1,9.5\n")
    (tmp_path / "b.csv").write_text(f"{new}\n16,1,24,1,1,4,1,0.1,1\n54,1,24,1,1,4,1,7.0,0\nx,1,24,1,1,4,1,7.0,0\n1,2\n")
    (tmp_path / "c.csv").write_text(f"oom,{old}\n1,3,1,24,1,1,4,1,0.2\n\n")
    for order in (["a.csv", "b.csv", "c.csv"], ["c.csv", "b.csv", "a.csv"]):
        rows = tables.read_facts(spark, [str(tmp_path / f) for f in order], keep_oom=True).collect()
        assert sorted((r["n_atoms"], r["oom"], r["avg_loop_time"]) for r in rows if not r["bad"]) == [(2, 0, 9.5), (3, 1, 0.2), (16, 1, 0.1), (54, 0, 7.0)]
        assert sum(r["bad"] for r in rows) == 2
        assert sorted(r["n_atoms"] for r in tables.read_facts(spark, [str(tmp_path / f) for f in order]).collect() if not r["bad"]) == [2, 54]


def test_upsert_and_backfill(spark, tmp_path):
    path, ddl = str(tmp_path / "reg"), "a string, seq bigint, x string"
    one = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("m", 1, "m")], ddl)
    for _ in range(2):  # a replayed batch changes nothing
        jobs.upsert_latest(one, path, ["a"], "seq")
        assert sorted(map(tuple, jobs.upserted(spark, path).select("a", "seq", "x").collect())) == [("k", 3, "new"), ("m", 1, "m")]
    jobs.upsert_latest(spark.createDataFrame([("k", 2, "late"), ("m", 5, "m2")], ddl), path, ["a"], "seq")
    assert sorted(map(tuple, jobs.upserted(spark, path).select("a", "seq", "x").collect())) == [("k", 3, "new"), ("m", 5, "m2")]
    done = spark.createDataFrame([("k", 9, "again"), ("z", 1, "z")], ddl)
    assert jobs.backfilled(done, path, ["a"], "seq", dry_run=True).count() == 1 and jobs.upserted(spark, path).count() == 2
    assert jobs.backfilled(done, path, ["a"], "seq").count() == 1 and jobs.upserted(spark, path).count() == 3
    assert jobs.backfilled(done, path, ["a"], "seq").count() == 0 and jobs.upserted(spark, path).count() == 3


CIF = """data_x
_cell_length_a 4.0(1)
_cell_length_b 5.0
_cell_length_c 6.0
_cell_angle_alpha 90
_cell_angle_beta 90
_cell_angle_gamma 60
loop_
_atom_site_label
_atom_site_fract_x
_atom_site_fract_y
_atom_site_fract_z
W1 0.0 0.0 0.0
O2 0.5 0.5 0.5
"""
FRAME = '2\nLattice="4 0 0 0 4 0 0 0 4" Properties=species:S:1:pos:R:3 energy=%d\nW 0 0 0\nW 1.0 2.0 %d\n'


def test_any_format(spark, tmp_path):
    (tmp_path / "a.cif").write_text(CIF)
    (tmp_path / "b.xyz").write_text(FRAME % (1, 1) + FRAME % (2, 2))
    (tmp_path / "POSCAR").write_text("x\n1.0\n3 0 0\n0 3 0\n0 0 3\nW O\n1 1\nDirect\n0 0 0\n0.5 0.5 0.5\n")
    (tmp_path / "c.pdf").write_text("?")
    (tmp_path / "d.cif").write_text("data_y\n_cell_length_a 4\n")
    got = {(r["path"].rsplit("/", 1)[1], r["frame"]): r for r in R.read_structures(spark, str(tmp_path)).collect()}
    assert set(got) == {("a.cif", 0), ("b.xyz", 0), ("b.xyz", 1), ("POSCAR", 0), ("c.pdf", 0), ("d.cif", 0)}
    assert got["a.cif", 0]["symbols"] == ["W", "O"] and np.allclose(got["a.cif", 0]["positions"][1], [2 + 1.25, 2.5 * np.sqrt(0.75), 3.0])
    assert got["POSCAR", 0]["positions"][1] == [1.5] * 3 and got["b.xyz", 1]["positions"][1] == [1.0, 2.0, 2.0]
    assert got["c.pdf", 0]["problems"] == ["unknown format"] and "no cell" in got["d.cif", 0]["problems"]


def test_frames_of_split_files(spark, tmp_path):
    """Blocks of any size, in the middle of lines, headers and frames, give the frames of the whole file."""
    text = "".join(("\n" if k % 7 == 0 else "") + FRAME % (k, k) for k in range(60))
    (tmp_path / "a.xyz").write_text(text)
    (tmp_path / "b.xyz").write_text(FRAME % (7, 7))
    want = {(r["path"], r["frame"], r["info"]["energy"], str(r["positions"])) for r in xyz.read_xyz(spark, str(tmp_path)).collect()}
    assert len(want) == 61
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("173b", "1001b", "10m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = [(r["path"], r["frame"], r["info"]["energy"], str(r["positions"])) for r in R.read_xyz_split(spark, str(tmp_path)).collect()]
            assert len(got) == 61 and set(got) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.openCostInBytes")


OUTCAR = """ VRHFIN =W: x
 VRHFIN =O : y
   ions per type =               1   1
  direct lattice vectors                 reciprocal lattice vectors
     4.0  0.0  0.0     0.25  0.0  0.0
     0.0  4.0  0.0     0.0  0.25  0.0
     0.0  0.0  4.0     0.0  0.0  0.25
  in kB    16.0217663   0.0   0.0   0.0   0.0   0.0
 POSITION                                       TOTAL-FORCE (eV/Angst)
 -----------------------------------------------------------
      0.0      0.0      0.0         0.1      0.2     -0.3
      2.0      2.0      2.0        -0.1     -0.2      0.3
 -----------------------------------------------------------
  free  energy   TOTEN  =       -12.5 eV
"""


def test_run_records_are_kept_apart(spark):
    rows = [("a", OUTCAR), ("b", OUTCAR.replace("TOTEN", "TOT")), ("c", OUTCAR.replace("   1   1\n", "   1   2\n")), ("d", "")]
    got = {r["path"]: r for r in R.run_records(spark.createDataFrame(rows, "path string, text string")).collect()}
    a = got["a"]
    assert a["problems"] == [] and a["energy"] == -12.5 and a["species"] == ["W", "O"] and a["forces"][1] == [-0.1, -0.2, 0.3] and a["lattice"][2] == [0.0, 0.0, 4.0]
    assert np.isclose(a["virial"][0][0], -0.64) and a["virial"][1][2] == 0
    assert got["b"]["problems"] == ["energy"] and got["c"]["problems"] == ["forces"] and set(got["d"]["problems"]) == {"energy", "lattice"}


def test_job_folders_and_kept_tables(spark, tmp_path):
    for d in ("run/struct_0001", "run/struct_0002/sub", "bench/atoms_16/gpu2_nc8_kp4", "bench/atoms_16/other"):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "POSCAR").write_text("x")
    got = {r["name"]: r for r in R.job_folders(spark, str(tmp_path)).collect()}
    assert set(got) == {"struct_0001", "gpu2_nc8_kp4"} and tuple(got["gpu2_nc8_kp4"]["settings"]) == (2, 8, 4)
    calls = []

    def compute(rows):
        calls.append(sorted(r["structure_hash"] for r in rows.collect()))
        return rows.withColumn("v", F.array(F.lit(1.0)))

    path, of = str(tmp_path / "cache"), lambda *h: spark.createDataFrame([(x,) for x in h], "structure_hash string")
    assert R.cached_descriptors(of(), path, compute).count() == 0
    assert R.cached_descriptors(of("a", "b", "b"), path, compute).count() == 2 and R.cached_descriptors(of("b", "c"), path, compute).count() == 2
    assert R.cached_descriptors(of("c"), path, compute).count() == 1 and calls == [[], ["a", "b"], ["c"], []]
    made = []
    for parts in (["W", "bcc"], ["bcc", "W"], ["W"]):
        assert R.cached_answer(spark, str(tmp_path / "json"), parts, lambda: (made.append(1), spark.createDataFrame([(1, "x")], "a int, b string"))[1]).collect()[0]["a"] == 1
    assert len(made) == 2
    R.write_labelled(spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id int, v array<double>"), spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string"), str(tmp_path / "d"))
    assert {(r["id"], r["label"]) for r in spark.read.parquet(str(tmp_path / "d")).collect()} == {(1, "train"), (2, "test")}
    R.write_csv(spark.createDataFrame([("a-b", 0.5)], "subset string, gini double"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["gini"] == "0.500000000000"
    assert spark.createDataFrame([("x\n generation 250000 \n",), ("y",)], "t string").select(R.target_generation(F.col("t")).alias("g")).collect()[0]["g"] == 250000


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path, ddl = str(tmp_path / "reg"), "a string, seq bigint, x string"
    jobs.upsert_latest(spark.createDataFrame([(f"k{n}", 1, "old") for n in range(300)], ddl), path, ["a"], "seq", 16)

    def versions():
        return {(f.parent.parent.name, f.parent.name) for f in (tmp_path / "reg").glob("bucket=*/version=*/*.parquet")}

    first = versions()
    assert len(first) == 16
    for n in range(2, 6):
        jobs.upsert_latest(spark.createDataFrame([("k7", n, f"new{n}")], ddl), path, ["a"], "seq", 16)
        # One bucket has a new version, and the one before it for those who read it.
        assert len({b for b, _ in versions() - first}) == 1 and len(versions()) == 17
    assert jobs.upserted(spark, path).count() == 300 and jobs.upserted(spark, path).where("a = 'k7'").first()["x"] == "new5"
    jobs.upsert_latest(spark.createDataFrame([], ddl), path, ["a"], "seq", 16)
    assert len(versions()) == 17


def test_outcomes(spark):
    rows = [(1, True, True, True, 9), (2, False, True, None, 2), (3, False, True, False, 3), (4, False, False, True, 0), (5, False, None, None, None), (6, None, False, False, 3)]
    df = spark.createDataFrame([(i, "submitted", *r) for i, *r in rows] + [(7, "pending", True, None, None, 0), (8, "submitted", True, None, None, 0)], "job_id int, status string, completed boolean, oom boolean, has_log boolean, retry_level int")
    got = {r["job_id"]: r["outcome"] for r in jobs.outcomes(df, spark.createDataFrame([(8,), (8,), (None,)], "job_id int")).collect()}
    assert got == {1: "completed", 2: "retry", 3: "failed", 4: "failed", 5: "pending", 6: "failed", 7: "pending", 8: "active"}


def test_settings_against_rules(spark):
    rules = validation.rules(spark, None, {"elements": (["W", "Cr"], True), "lattices": (["bcc", "fcc"], False)})
    rows = [("a", "composition_aware_fps_frontier_fraction", "0"), ("a", "composition_aware_fps_frontier_fraction", "1.0"), ("a", "elements", "w, CR"), ("a", "target_n_atoms", "x"), ("a", "lattices", " "), ("b", "elements", " , "), ("b", "lattices", "hcp"), ("b", "other", None), ("b", "composition_aware_fps_adaptive_retries", "2.5")]
    got = sorted((r["run"], r["key"], r["reason"]) for r in validation.violations(spark.createDataFrame(rows, "run string, key string, value string"), rules).collect())
    frontier, retries = "composition_aware_fps_frontier_fraction", "composition_aware_fps_adaptive_retries"
    assert got == sorted([("a", frontier, "below the range"), ("a", "target_n_atoms", "not a number"), ("b", "elements", "missing"), ("b", "lattices", "unknown item"), ("b", retries, "not a whole number"), ("b", "target_n_atoms", "missing")])
    names = spark.createDataFrame([("w, CR",), ("w,xx",), ("",)], "t string").select(validation.normalised_list(F.col("t"), ["W", "Cr"]).alias("n")).collect()
    assert [r["n"] for r in names] == ["W,Cr", None, ""]


def test_grids_of_odd_nodes(spark):
    got = generators.parameter_grids(spark.createDataFrame([("a", 1, 0), ("b", 12, 3)], "node string, cores int, gpus int")).collect()
    assert [tuple(r) for r in got if r["node"] == "a"] == [("a", 0, 0, 1, 1)]
    assert [tuple(r)[2:] for r in got if r["node"] == "b"] == [(g, n, k) for g in (1, 2) for n in (2, 4) for k in (1, 2)]


def test_principal_plane_of_large_offsets_and_odd_vectors(spark):
    x = np.random.default_rng(5).normal(size=(300, 3)) * [0.5, 0.2, 0.01] + 1e8
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, [1.0, None, 2.0]), (902, [math.nan] * 3), (903, [1.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = {r["id"]: (r["pc1"], r["pc2"]) for r in fits.principal_plane(df).collect()}
    y = x - x.mean(0)
    want = y @ np.linalg.svd(y, full_matrices=False)[2][:2].T
    assert np.allclose(np.abs([got[k] for k in range(300)]), np.abs(want), atol=1e-6) and all(got[k] == (None, None) for k in (900, 901, 902, 903))
    assert fits.principal_plane(df.where("id < 0")).count() == 0 and fits.principal_plane(df, df.where("id < 0")).where("pc1 is null").count() == 304


def test_required_and_axes(spark):
    with pytest.raises(ValueError):
        curation.required(spark.range(0), "rows")
    with pytest.raises(ValueError):
        selection.composition_aware_training(spark.range(0), 3, 0.0)
    cell = F.lit([[2.0, 0.0, 0.0], [0.0, 4.0, 0.0], [1.0, 0.0, 4.0]])
    got = spark.range(1).select(S.scaled(F.lit([[2.0, 2.0, 2.0]]), cell).alias("s"), curation.lattice_record(cell).alias("l")).first()
    assert np.allclose(got["s"][0], np.array([2.0, 2, 2]) @ np.linalg.inv([[2.0, 0, 0], [0, 4, 0], [1, 0, 4]])) and np.isclose(got["l"]["volume"], 32)
