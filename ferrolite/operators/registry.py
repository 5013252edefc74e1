"""Content identity and reuse: hashes, deduplication, look-ups in a table of completed jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ["incar_hash", "potcar_hash", "structure_hash"]


def first_of_each(rows: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order. The window keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def unseen(rows: DataFrame, existing: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """Rows whose key is not in ``existing``, the first of each key only."""
    return first_of_each(rows.join(existing.select(key).distinct(), key, "left_anti"), key, order)


def latest(entries: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Upsert by append: of each key the entry with the largest ``order``."""
    rest = [c for c in entries.columns if c not in keys]
    return entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("x")).select(*keys, "x.*")


def reuse(jobs: DataFrame, registry: DataFrame) -> DataFrame:
    """``jobs`` with ``status`` and ``reused_from``: reused if a completed entry has all three hashes, else pending.

    An empty or null hash never matches.
    """
    known = registry.where(F.col("complete")).select(*IDENTITY, F.col("job_path").alias("reused_from"))
    filled = [F.when(F.col(c) != "", F.col(c)).alias(c) for c in IDENTITY]
    found = jobs.select(*[c for c in jobs.columns if c not in IDENTITY], *filled).join(known, IDENTITY, "left")
    return found.withColumn("status", F.when(F.col("reused_from").isNotNull(), "reused").otherwise("pending"))


def misses(jobs: DataFrame, registry: DataFrame) -> DataFrame:
    return jobs.join(registry.where(F.col("complete")).select(*IDENTITY), IDENTITY, "left_anti")


def prioritised(structures: DataFrame, candidates: list[DataFrame]) -> DataFrame:
    """``structures`` (key) with path and priority of the first candidate source that has the key.

    ``candidates`` are (key, path) tables, the preferred one first; within one the smaller path wins.
    """
    every = None
    for k, c in enumerate(candidates):
        part = c.select("key", "path", F.lit(k + 1).alias("priority"))
        every = part if every is None else every.union(part)
    best = every.groupBy("key").agg(F.min(F.struct("priority", "path")).alias("x"))
    return structures.join(best, "key", "left").select(structures["key"], F.col("x.path").alias("path"), F.col("x.priority").alias("priority"))


def seed_anchors(generated: DataFrame, seeds: DataFrame, mode: str = "last") -> DataFrame:
    """structure_index of each seed: the last generated row of the seed, or (``unperturbed``) the last unperturbed one."""
    rows = generated if mode == "last" else generated.where(F.col("perturbation_type") == "unperturbed")
    return rows.groupBy("seed_id").agg(F.max("structure_index").alias("structure_index")).join(seeds.select("seed_id").distinct(), "seed_id").select("seed_id", "structure_index")


def unmatched_seeds(generated: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds (null ones included) that no generated row has: must be empty for a valid selection."""
    return seeds.select("seed_id").distinct().join(generated.select("seed_id").distinct(), "seed_id", "left_anti")


def positional(structures: DataFrame, jobs: DataFrame) -> DataFrame:
    """structure_index, path: the job at the structure's own index, void if its identity is another."""
    other = jobs.select("structure_index", F.col("identity").alias("found"), "path")
    joined = structures.join(other, "structure_index", "left")
    return joined.select("structure_index", F.when(F.col("identity") == F.col("found"), F.col("path")).alias("path"), (F.col("found").isNotNull() & ~F.col("identity").eqNullSafe(F.col("found"))).alias("mismatch"))
