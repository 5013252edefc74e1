"""Best settings from a history of benchmark runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.operators.distance import nearest_values

SETTINGS = ["ncore", "kpar"]


def fastest(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group the settings of the fastest run that did not run out of memory; ties to smaller settings."""
    good = facts.where("oom <> 1")
    best = good.groupBy(*keys).agg(F.min(F.struct("avg_loop_time", *SETTINGS)).alias("x"))
    return best.select(*keys, "x.*")


def cheapest_viable(facts: DataFrame) -> DataFrame:
    """Of each n_atoms the run with the fewest GPUs, then the shortest time, and how much slower it is than the fastest
    of all. Sizes that always ran out of memory stay, with nulls."""
    good = facts.where("oom <> 1")
    best = good.groupBy("n_atoms").agg(F.min(F.struct("gpus", "avg_loop_time", *SETTINGS)).alias("x"), F.min("avg_loop_time").alias("fastest"))
    every = facts.select("n_atoms").distinct().join(best, "n_atoms", "left")
    return every.select("n_atoms", "x.gpus", "x.avg_loop_time", "x.ncore", "x.kpar", "fastest", (F.col("x.avg_loop_time") / F.col("fastest")).alias("ratio"))


def outcomes(facts: DataFrame) -> DataFrame:
    """n_atoms, gpus, n_ok, n_oom for all pairs of the two dimensions, those without runs included.

    Both dimensions are distinct values of settings; their product has as many rows as the report has cells.
    """
    found = facts.groupBy("n_atoms", "gpus").agg(F.count_if(F.col("oom") == 0).alias("n_ok"), F.count_if(F.col("oom") == 1).alias("n_oom"))
    dims = found.agg(F.collect_set("n_atoms").alias("a"), F.collect_set("gpus").alias("g"))
    grid = dims.select(F.explode("a").alias("n_atoms"), "g").select("n_atoms", F.explode("g").alias("gpus"))
    return grid.join(found, ["n_atoms", "gpus"], "left").na.fill(0, ["n_ok", "n_oom"])


def grid(facts: DataFrame, kpars: list[int], order: str) -> DataFrame:
    """ncore by kpar: the time of the last run (by ``order``); null where any run of the cell ran out of memory."""
    last = F.max_by("avg_loop_time", F.col(order))
    cells = facts.groupBy("ncore", "kpar").agg(F.when(F.max("oom") == 1, F.lit(None)).otherwise(last).alias("t"))
    return cells.groupBy("ncore").agg(*[F.max(F.when(F.col("kpar") == k, F.col("t"))).alias(f"kpar_{k}") for k in kpars])


def snap(value: Column, valid: list[int]) -> Column:
    """The valid value nearest to ``value``, the smaller one of two as near."""
    options = F.array(*[F.struct(F.abs(F.lit(v) - value).alias("d"), F.lit(v).alias("v")) for v in valid])
    return F.array_min(options)["v"]


def powers_of_two(cores: int) -> list[int]:
    return [1 << k for k in range(cores.bit_length()) if cores % (1 << k) == 0]


def predicted(queries: DataFrame, facts: DataFrame, cores: int = 64, gpus: list[int] | None = None) -> DataFrame:
    """Settings for new jobs (query_id, n_electrons, n_kpoints_irr) from the nearest benchmark runs.

    Features are standardised over the history; of the points at the smallest distance (within 1e-6) the fewest GPUs
    and then the shortest time decide. Both sides are first reduced to different points, and these meet in blocks, of
    which each returns its nearest ones. Null with fewer than three rows of history.
    """
    good = facts.where("oom <> 1")
    moments = good.agg(
        F.count(F.lit(1)).alias("rows"), F.avg("n_electrons").alias("me"), F.stddev_pop("n_electrons").alias("se"), F.avg("n_kpoints_irr").alias("mk"), F.stddev_pop("n_kpoints_irr").alias("sk")
    )
    points = good.groupBy("n_electrons", "n_kpoints_irr").agg(F.min(F.struct("gpus", "avg_loop_time", "ncore", "kpar")).alias("best"))

    def sd(c: str) -> Column:
        return F.when(F.col(c) == 0, 1.0).otherwise(F.col(c))

    def standard(rows: DataFrame) -> DataFrame:
        """Rows with both features standardised; the moments are one row."""
        e, k = (F.col("n_electrons") - F.col("me")) / sd("se"), (F.col("n_kpoints_irr") - F.col("mk")) / sd("sk")
        return rows.join(F.broadcast(moments.where("rows >= 3"))).withColumn("v", F.array(e, k))

    asked = queries.select("n_electrons", "n_kpoints_irr").distinct()
    near = nearest_values(standard(asked).withColumn("id", F.xxhash64("n_electrons", "n_kpoints_irr")), standard(points), "best", "struct<gpus:int,avg_loop_time:double,ncore:int,kpar:int>")
    least = near.groupBy("id").agg(F.min("d").alias("least"))
    best = near.join(least, "id").where(F.col("d") <= F.col("least") + 1e-6).groupBy("id").agg(F.min("best").alias("b"))
    found = queries.withColumn("id", F.xxhash64("n_electrons", "n_kpoints_irr")).join(best, "id", "left")
    return found.select("query_id", snap(F.col("b.gpus"), gpus or [1, 2, 4]).alias("gpus"), snap(F.col("b.ncore"), powers_of_two(cores)).alias("ncore"), F.col("b.kpar").alias("kpar"), F.col("b.avg_loop_time").alias("avg_loop_time"))
