"""Whole-file text readers for structure, settings and log files, on any file system that Spark reads.

Every reader takes a path, a glob or a list of them, and gives one row for each file with its path; parsers then work
on columns. Directories are read with ``recursive``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.functions import text as X


def files(spark: SparkSession, paths: str | list[str], pattern: str | None = None, recursive: bool = False, exclude: str | None = None) -> DataFrame:
    """path, name, text: one row for each file, in no order, also where several paths meet it.

    ``exclude`` is left out, as is nothing else: one file if it is absolute, or else the files whose path ends with these
    names of folders and file.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    if not isinstance(paths, str) and len(paths) > 1:
        rows = rows.dropDuplicates(["path"])
    if exclude is None:
        return rows
    plain = F.regexp_replace("path", r"^\w+:(//[^/]*)?", "")
    other = re.sub(r"^\w+:(//[^/]*)?", "", exclude)
    return rows.where(plain != other if other.startswith("/") else ~F.concat(F.lit("/"), plain).endswith(f"/{other}"))


def structure_format(name: Column) -> Column:
    """vasp, cif or extxyz by the file's name; null for others."""
    low = F.lower(name)
    return (
        F.when(F.upper(name).rlike("^(POSCAR|CONTCAR)") | low.endswith(".vasp"), "vasp").when(low.endswith(".cif"), "cif").when(low.endswith(".xyz") | low.endswith(".extxyz"), "extxyz")
    )


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """path: the lines of a list file; blank lines and those after # are left out, relative ones are below the list's folder."""
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    rows = spark.read.text(path).select(line.alias("path")).where("path <> ''")
    return rows.select(F.when(F.col("path").rlike(r"^(/|\w+:)"), F.col("path")).otherwise(F.concat(F.lit(f"{folder}/"), F.col("path"))).alias("path"))


def tagged(rows: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    """``rows`` (path) with a boolean column that tells whether the path is listed."""
    mark = listed.select("path").distinct().withColumn("_on", F.lit(True))
    return rows.join(mark, "path", "left").withColumn(name, F.coalesce("_on", F.lit(False))).drop("_on")


def potentials(spark: SparkSession, folder: str) -> DataFrame:
    """element, zval, text_hash of the POTCAR_<element> files of a folder."""
    rows = files(spark, folder, "POTCAR_*")
    zval = F.nullif(F.regexp_extract("text", r"ZVAL\s*=\s*([0-9.]+)", 1), F.lit("")).cast("double")
    return rows.select(F.regexp_extract("name", r"POTCAR_(.+)", 1).alias("element"), zval.alias("zval"), F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"))


def logs(spark: SparkSession, paths: str | list[str], recursive: bool = True) -> DataFrame:
    """path and what the run's log says; see ``functions.text`` for each column."""
    rows, t = files(spark, paths, "OUTCAR*", recursive), F.col("text")
    return rows.select(
        "path", X.job_path(F.col("path")).alias("job"), X.ranks(t).alias("ranks"), X.kpoints(t).alias("n_kpoints_irr"), X.electrons(t).alias("n_electrons"), X.mean_loop_time(t).alias("avg_loop_time"),
        X.stress_gpa(t).alias("stress_gpa"), X.is_complete(t).alias("complete"),
    )


def last_line(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, generation, loss: the last line of each loss table."""
    rows = files(spark, paths)
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    parts = F.split(F.trim(F.element_at(lines, -1)), r"\s+")
    return rows.where(F.size(lines) > 0).select("path", parts[0].try_cast("bigint").alias("generation"), parts[1].try_cast("double").alias("loss"))
