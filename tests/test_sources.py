"""Files in and out, and jobs as a stream."""

from __future__ import annotations

import datetime
import pytest
from pyspark.sql import functions as F

from ferrolite.sources import tables, texts, xyz
from ferrolite.streaming import jobs

XYZ = """2
Lattice="3 0 0 0 3 0 0 0 3" Properties=species:S:1:pos:R:3 pbc="T T F" seed_id=seed_000001 tag="a b"
W 0 0 0
Cr 1.5 1.5 1.5

1
Properties=species:S:1:pos:R:3
H 0 0 0
1
Lattice="1 2 x" Properties=species:S:1:pos:R:3
H 0 0 zero
3
Lattice="1 0 0 0 1 0 0 0 1"
H 0 0 0
"""


def test_xyz(spark, tmp_path):
    (tmp_path / "a.xyz").write_text(XYZ)
    (tmp_path / "empty.xyz").write_text("")
    rows = xyz.read_xyz(spark, str(tmp_path)).orderBy("path", "frame").collect()
    assert [r["problems"] for r in rows] == [[], ["no Lattice"], ["Lattice is not numeric", "atom 0 can't be read"], ["frame 3, line 12: cut off"]]
    r = rows[0]
    assert (r["symbols"], r["positions"][1], r["cell"][0], r["pbc"]) == (["W", "Cr"], [1.5, 1.5, 1.5], [3.0, 0.0, 0.0], [True, True, False])
    assert r["info"] == {"seed_id": "seed_000001", "tag": "a b"}


def test_xyz_round_trip(spark, tmp_path):
    (tmp_path / "a.xyz").write_text(XYZ[: XYZ.index("\n\n1") + 1])
    rows = xyz.read_xyz(spark, str(tmp_path / "a.xyz"))
    frames = rows.select(xyz.structure_frame(F.col("symbols"), F.col("positions"), F.col("cell"), F.col("pbc"), F.col("info")).alias("frame"))
    xyz.write_frames(frames, str(tmp_path / "out"))
    names = ["symbols", "positions", "cell", "pbc", "info", "problems"]
    assert xyz.read_xyz(spark, str(tmp_path / "out")).select(*names).collect() == rows.select(*names).collect()


@pytest.mark.parametrize("virial", [None, [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]])
def test_training_frame(spark, virial):
    schema = "e double, pbc array<boolean>, l array<array<double>>, s array<string>, p array<array<double>>, f array<array<double>>, v array<array<double>>"
    eye = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    rows = spark.createDataFrame([(-1.25, [True] * 3, eye, ["Si"], [[0.0, 0.5, 0.25]], [[0.1, 0.0, -0.1]], virial)], schema)
    lines = rows.select(xyz.training_frame(*[F.col(c) for c in ("e", "pbc", "l", "s", "p", "f", "v")])).first()[0].split("\n")
    assert lines[0] == "1" and lines[1].startswith('energy=-1.2500000000 pbc="T T T" Lattice="1.0000000000 ') and (' virial="' in lines[1]) == (virial is not None)
    assert lines[2] == " Si   0.0000000000   0.5000000000   0.2500000000   0.1000000000   0.0000000000  -0.1000000000"


POSCAR = "c\n2.0\n1 0 0\n0 2 0\n0 0 3\nSi O\n1 2\n{}\n0.5 0.5 0.5\n0 0 0\n0 0.25 0\n"


def test_poscar(spark):
    rows = spark.createDataFrame([(POSCAR.format("Direct"),), (POSCAR.format("Selective\nCartesian"),), ("a\nb",), (POSCAR.replace("2.0", "-1", 1).format("Direct"),), (POSCAR.replace("Si O\n", "").format("Direct\n0 0 0"),)], "t string")
    r = [x["p"] for x in rows.select(xyz.parse_poscar(F.col("t")).alias("p")).collect()]
    assert r[0]["symbols"] == ["Si", "O", "O"] and r[0]["positions"] == [[1.0, 2.0, 3.0], [0.0, 0.0, 0.0], [0.0, 1.0, 0.0]] and r[0]["cell"][2] == [0.0, 0.0, 6.0]
    assert r[1]["positions"][0] == [1.0, 1.0, 1.0]
    assert [x["problem"] for x in r] == [None, None, "fewer than 8 lines", "scale is not positive", "no element line"]


def test_poscar_round_trip(spark):
    rows = spark.createDataFrame([(["O", "Si", "O"], [[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [0.5, 0.0, 0.0]], [[2.0, 0.0, 0.0], [0.0, 2.0, 0.0], [0.0, 0.0, 2.0]])], "s array<string>, p array<array<double>>, c array<array<double>>")
    r = rows.select(xyz.parse_poscar(xyz.poscar_text(F.lit("x"), F.col("s"), F.col("p"), F.col("c"))).alias("p")).first()["p"]
    assert r["symbols"] == ["O", "O", "Si"] and r["positions"][1] == [0.5, 0.0, 0.0]


def test_facts(spark, tmp_path):
    (tmp_path / "f.csv").write_text("n_atoms,gpus,ncore,kpar,avg_loop_time,oom\n2,1,2,1,10.5,0\n2,2,2,1,,1\n16,1,x,1,3.0,0\n")
    rows = tables.read_facts(spark, str(tmp_path / "f.csv")).orderBy("n_atoms").collect()
    assert [(r["n_atoms"], r["ncore"], r["n_kpoints_irr"], r["bad"]) for r in rows] == [(2, 2, 0, False), (16, None, 0, True)]
    assert tables.read_facts(spark, str(tmp_path / "f.csv"), keep_oom=True).count() == 3
    tables.append_facts(tables.read_facts(spark, str(tmp_path / "f.csv")).where("not bad"), str(tmp_path / "o"))
    assert tables.read_facts(spark, str(tmp_path / "o")).count() == 1


def test_trend(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("structures\tmean\tp95\tp99\n20\t0.2\t0.3\t0.4\n10\t0.5\t0.6\t0.7\n")
    assert [r["structures"] for r in tables.read_trend(spark, str(tmp_path / "t.tsv")).collect()] == [10, 20]
    (tmp_path / "bad.csv").write_text("structures,mean\n1,2\n")
    with pytest.raises(ValueError, match="p95"):
        tables.read_trend(spark, str(tmp_path / "bad.csv"))


def test_file_lists(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("b.xyz", "ab.xyz", "d/b.xyz"):
        (tmp_path / name).write_text("1")

    def found(paths, **k):
        return sorted(r["path"].split(str(tmp_path))[1][1:] for r in texts.files(spark, paths, recursive=True, **k).collect())

    top = str(tmp_path)
    assert found(top, exclude="b.xyz") == ["ab.xyz"] and found(top, exclude="d/b.xyz") == ["ab.xyz", "b.xyz"] and found(top, exclude=f"file:{top}/b.xyz") == ["ab.xyz", "d/b.xyz"]
    assert found([f"{top}/b.xyz", top]) == ["ab.xyz", "b.xyz", "d/b.xyz"]


def test_registry_document(spark, tmp_path):
    names = [c.split()[0] for c in tables.ENTRY.split(", ")]
    rows = spark.createDataFrame([("i", "p", "s1", "/a", "x", "train", 42, "now", "o", "v"), ("i", "p", "s2", "/b", "x", "test", 1, "now", None, "v")], f"incar_hash string, potcar_hash string, structure_hash string, {tables.ENTRY}")
    tables.registry_document(rows).write.text(str(tmp_path / "r"))
    got = tables.read_registry(spark, str(tmp_path / "r")).orderBy("structure_hash")
    assert got.select(*rows.columns).collect() == rows.collect() and got.columns[3:] == names
    tables.registry_lines(rows).write.text(str(tmp_path / "l"))
    lines = tables.read_registry(spark, str(tmp_path / "l"), lines=True).orderBy("structure_hash")
    assert lines.select(*rows.columns).collect() == rows.collect()
    (tmp_path / "broken.json").write_text("{")
    assert tables.read_registry(spark, str(tmp_path / "broken.json")).count() == 0


def test_file_lists(spark, tmp_path):
    (tmp_path / "POTCAR_Si").write_text("x ZVAL   =    4.000 y")
    (tmp_path / "POTCAR_O").write_text("none")
    (tmp_path / "list.txt").write_text("# all\nPOTCAR_Si # first\n\n/abs/x\n")
    assert {r["element"]: r["zval"] for r in texts.potentials(spark, str(tmp_path)).collect()} == {"Si": 4.0, "O": None}
    assert [r["path"] for r in texts.path_list(spark, f"{tmp_path}/list.txt").collect()] == [f"{tmp_path}/POTCAR_Si", "/abs/x"]
    (tmp_path / "loss.out").write_text("100 0.5 1\n200 0.25 1\n\n")
    r = texts.last_line(spark, f"{tmp_path}/loss.out").first()
    assert (r["generation"], r["loss"]) == (200, 0.25)
    names = spark.createDataFrame([("POSCAR_1",), ("a.cif",), ("b.extxyz",), ("c.txt",)], "n string")
    assert [r[0] for r in names.select(texts.structure_format(F.col("n"))).collect()] == ["vasp", "cif", "extxyz", None]


EVENTS = [(1, 1, "submitted"), (1, 2, "oom"), (1, 3, "completed"), (1, 4, "failed"), (2, 5, "submitted"), (3, 6, "oom"), (3, 7, "oom"), (3, 8, "oom"), (3, 9, "oom"), (3, 10, "completed"), (4, 11, "reused"), (5, 12, "running")]
STATES = {1: ("completed", 1, 3), 2: ("submitted", 0, 5), 3: ("failed", 3, 9), 4: ("reused", 0, 11), 5: ("running", 0, 12)}


def test_replay_and_stream(spark, tmp_path):
    schema = "job_id bigint, seq bigint, kind string"
    rows = spark.createDataFrame(EVENTS, schema)
    assert {r[0]: tuple(r)[1:] for r in jobs.replay(rows).collect()} == STATES
    for k in range(3):
        rows.where((F.col("seq") > 4 * k) & (F.col("seq") <= 4 * k + 4)).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
    out: dict[int, tuple] = {}
    stream = jobs.stream_states(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in"))
    query = stream.writeStream.outputMode("update").foreachBatch(lambda b, _: out.update({r[0]: tuple(r)[1:] for r in b.collect()})).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert out == STATES
    assert jobs.replay(rows.where("job_id > 9")).count() == 0


def test_jobs_that_never_run_are_pending_again(spark, tmp_path):
    """Stream and replay agree; a job that starts late runs all the same, and free slots admit what is pending."""
    schema = "job_id bigint, seq bigint, kind string, ts timestamp"
    at = lambda m: datetime.datetime(2024, 1, 1, m // 60, m % 60)
    every = [(1, 1, "submitted", 0), (2, 2, "submitted", 1), (3, 3, "submitted", 2), (2, 4, "running", 5), (4, 5, "running", 100), (3, 6, "running", 130), (5, 7, "submitted", 300), (6, 8, "oom", 300), (7, 9, "completed", 330)]
    rows = spark.createDataFrame([(j, s, k, at(m)) for j, s, k, m in every], schema)
    for k in range(3):
        rows.where((F.col("seq") > 3 * k) & (F.col("seq") <= 3 * k + 3)).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
    want = {1: ("pending", 0, 1), 2: ("running", 0, 4), 3: ("running", 0, 6), 4: ("running", 0, 5), 5: ("submitted", 0, 7), 6: ("submitted", 1, 8), 7: ("completed", 0, 9)}
    assert {r[0]: tuple(r)[1:] for r in jobs.replay(rows, patience=3600).collect()} == want
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in").withWatermark("ts", "0 seconds")
    table, admitted = f"{tmp_path}/states", []
    stream = jobs.stream_states(read, patience=3600).writeStream.outputMode("update").foreachBatch(lambda b, _: jobs.admit_batch(b, table, 6, admitted.append))
    stream.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert {r["job_id"]: (r["status"], r["retry_level"], r["last_event"]) for r in jobs.upserted(spark, table).collect()} == want
    assert admitted[-1] == [1]


def test_admission_and_tally(spark):
    rows = spark.createDataFrame([(1, "pending"), (2, "running"), (3, "pending"), (4, "reused"), (5, "pending")], "job_id bigint, status string")
    assert [r[0] for r in jobs.admitted(rows, 3).collect()] == [1, 3]
    assert jobs.admitted(rows, 1).count() == 0
    r = jobs.tally(rows, F.lit("d")).first()
    assert (r["total"], r["completed"], r["failed"], r["active"]) == (5, 1, 0, 4)
