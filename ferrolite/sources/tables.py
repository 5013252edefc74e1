"""CSV and JSON tables: benchmark history, trends, the registry of completed jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = {"n_atoms": "int", "n_kpoints_irr": "int", "n_electrons": "int", "nodes": "int", "gpus": "int", "ncore": "int", "kpar": "int", "avg_loop_time": "double", "oom": "int"}
TREND = ["structures", "mean", "p95", "p99"]
ENTRY = "job_path string, project_name string, dataset string, selected_index bigint, completed_at string, outcar_hash string, vasprun_hash string"


def read_facts(spark: SparkSession, path: str | list[str], keep_oom: bool = False) -> DataFrame:
    """Benchmark rows with typed columns; columns that older files lack are 0.

    Each file is read by its own header, so files of different layouts may stand side by side. A row that does not fit
    its types or its header's width is not dropped with the whole file: it comes with ``bad`` set and nulls. Rows that ran
    out of memory are left out unless ``keep_oom``.
    """
    # The numbers need no quotes: a line is split at its commas.
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.transform(F.split("value", ","), lambda x: F.trim(x)).alias("v"))
    is_header = F.exists("v", lambda x: x.isin(*FACTS))
    headers = lines.where(is_header).groupBy("file").agg(F.min("v").alias("names"))  # a row for each file
    raw = lines.where(~is_header).join(headers, "file", "left").withColumn("fits", F.coalesce(F.size("v") == F.size("names"), F.lit(False)))
    raw = raw.withColumn("m", F.when(F.col("fits"), F.map_from_arrays("names", "v")))

    def value(n: str) -> Column:
        return F.nullif(F.try_element_at("m", F.lit(n)), F.lit(""))

    typed = {n: F.when(~F.col("fits"), None).when(F.array_contains("names", n), value(n).try_cast(t)).otherwise(F.lit(0).cast(t)) for n, t in FACTS.items()}
    wrong = [value(n).isNotNull() & value(n).try_cast(t).isNull() for n, t in FACTS.items()]
    bad = ~F.col("fits") | (F.greatest(*[F.coalesce(w, F.lit(False)).cast("int") for w in wrong], F.lit(0)) == 1)
    rows = raw.select(*[v.alias(n) for n, v in typed.items()], bad.alias("bad"))
    return rows if keep_oom else rows.where("oom is null or oom <> 1")


def append_facts(rows: DataFrame, path: str) -> None:
    """Append in the current layout; old files without the last column stay readable."""
    rows.select(*FACTS).write.mode("append").option("header", True).csv(path)


def read_trend(spark: SparkSession, path: str) -> DataFrame:
    """structures, mean, p95, p99 of a comma- or tab-separated file; an error if a column is missing."""
    head = spark.read.text(path).first()
    sep = "\t" if head and "\t" in head["value"] else ","
    rows = spark.read.option("header", True).option("sep", sep).csv(path)
    if missing := [c for c in TREND if c not in rows.columns]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return rows.select(F.col("structures").cast("int").alias("structures"), *[F.col(c).cast("double").alias(c) for c in TREND[1:]]).orderBy("structures")


def read_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A registry document (jobs[incar][potcar][structure] = entry) as a flat table; a missing or broken one is empty.
    With ``lines`` each line is a document."""
    rows = spark.read.text(path, wholetext=not lines)
    jobs = F.from_json("value", f"struct<version:int, jobs:map<string, map<string, map<string, struct<{ENTRY.replace(' ', ':').replace(',:', ', ')}>>>>>")["jobs"]
    flat = rows.select(F.explode(jobs).alias("incar_hash", "a")).select("incar_hash", F.explode("a").alias("potcar_hash", "b")).select("incar_hash", "potcar_hash", F.explode("b").alias("structure_hash", "e"))
    return flat.select("incar_hash", "potcar_hash", "structure_hash", "e.*")


def registry_lines(entries: DataFrame) -> DataFrame:
    """A flat registry as JSON documents of one entry each, which ``read_registry`` reads with ``lines``: nothing is
    gathered, and lines of several registries can be put together."""
    names = [c.split()[0] for c in ENTRY.split(", ")]
    keyed = F.create_map("structure_hash", F.struct(*names))
    for key in ("potcar_hash", "incar_hash"):
        keyed = F.create_map(key, keyed)
    return entries.select(F.to_json(F.struct(F.lit(1).alias("version"), keyed.alias("jobs"))).alias("value"))


def registry_document(entries: DataFrame) -> DataFrame:
    """One JSON document of a small flat registry, for exchange with tools that read one; ``registry_lines`` has a row for
    each entry, and the registry itself is a table."""
    names = [c.split()[0] for c in ENTRY.split(", ")]
    inner = entries.groupBy("incar_hash", "potcar_hash").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("structure_hash", F.struct(*names))))).alias("c"))
    middle = inner.groupBy("incar_hash").agg(F.map_from_entries(F.collect_list(F.struct("potcar_hash", "c"))).alias("b"))
    whole = middle.agg(F.map_from_entries(F.collect_list(F.struct("incar_hash", "b"))).alias("jobs"))
    return whole.select(F.to_json(F.struct(F.lit(1).alias("version"), "jobs")).alias("value"))


def read_status(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """path and the fields of each JSON document; broken ones have nulls."""
    rows = spark.read.text(paths, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("d")).select("path", "d.*")
