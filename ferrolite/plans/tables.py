"""The driver's tables in the roles that the queries give them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of lineitem that a task sums up on average.
TASK_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """structure_index, element, n_atoms: an order is a structure, the part's type an element, the quantity its atoms."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_orderkey").alias("structure_index"), F.col("l_quantity").cast("bigint").alias("n_atoms"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("element"))
    # More parts as the table grows, so that no task sums up more than so many rows; all of a structure are in one.
    n = max(2 * spark.sparkContext.defaultParallelism, -(-items.count() // TASK_ROWS))
    return items.join(parts, "l_partkey").select("structure_index", "element", "n_atoms").repartition(n, "structure_index")


ATOMS_SQL = """
    counts AS (
        SELECT l_orderkey AS structure_index, p_type AS element, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n_atoms
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE CAST(l_quantity AS BIGINT) > 0 GROUP BY ALL
    )"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark facts (n_atoms, n_kpoints_irr, n_electrons, nodes, gpus, ncore, kpar, avg_loop_time, oom) from lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") * 16).cast("int").alias("n_atoms"),
        (F.col("l_suppkey") % 10 + 1).cast("int").alias("n_kpoints_irr"),
        (F.col("l_linenumber") * 96).cast("int").alias("n_electrons"),
        F.lit(1).alias("nodes"),
        F.expr("cast(shiftleft(1, cast(l_suppkey % 3 as int)) as int)").alias("gpus"),
        F.expr("cast(shiftleft(2, cast(l_partkey % 6 as int)) as int)").alias("ncore"),
        F.expr("cast(shiftleft(1, cast(l_orderkey % 3 as int)) as int)").alias("kpar"),
        F.col("l_extendedprice").alias("avg_loop_time"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("oom"),
    )


FACTS_SQL = """
    facts AS (
        SELECT CAST(l_linenumber * 16 AS INTEGER) AS n_atoms, CAST(l_suppkey % 10 + 1 AS INTEGER) AS n_kpoints_irr, CAST(l_linenumber * 96 AS INTEGER) AS n_electrons,
               1 AS nodes, CAST(1 << (l_suppkey % 3)::INT AS INTEGER) AS gpus, CAST(2 << (l_partkey % 6)::INT AS INTEGER) AS ncore,
               CAST(1 << (l_orderkey % 3)::INT AS INTEGER) AS kpar, l_extendedprice AS avg_loop_time, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS oom
        FROM lineitem
    )"""
