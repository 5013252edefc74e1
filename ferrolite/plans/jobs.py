"""Queries on the life of jobs and on file texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.plans.tables import table
from ferrolite.sources import xyz
from ferrolite.streaming import jobs

KIND = {"signup": "submitted", "view": "running", "click": "oom", "purchase": "completed", "error": "failed"}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for kv in KIND.items() for x in kv])
    return table(spark, sf_dir, "events").select((F.col("event_id") % 997).alias("job_id"), F.col("event_id").alias("seq"), kind[F.col("event_type")].alias("kind"), "ts", "value")


def job_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.replay(_events(spark, sf_dir))


def job_status_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.tally(jobs.replay(_events(spark, sf_dir)), F.col("job_id") % 5)


def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = _events(spark, sf_dir).select("job_id", "seq", F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("ts"), "value").withColumn("ts", F.col("ts") / 1_000_000)
    return jobs.progress(polls, 100.0).select("job_id", "seq", F.round(F.col("rate") * 1e6, 6).alias("rate"), F.round("remaining", 3).alias("remaining"))


def job_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as jobs: a purchase is the marker of the end, a click a lack of memory, a view a log; orders are the scheduler's queue."""
    kind = F.col("event_type")
    found = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("job_id")).agg(
        F.max(kind == "purchase").alias("completed"), F.max(kind == "click").alias("oom"), F.max(kind == "view").alias("has_log"), F.count_if(kind == "error").cast("int").alias("retry_level"),
        F.when(F.max(kind == "signup"), "submitted").otherwise("pending").alias("status"),
    )
    queue = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("job_id"))
    return jobs.outcomes(found, queue).select("job_id", "status", "retry_level", "outcome")


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.windowed(_events(spark, sf_dir))


def training_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 of the training text of each customer's structure of two atoms."""
    c = table(spark, sf_dir, "customer")
    a, zero = F.col("c_nationkey").cast("double"), F.lit(0.0)
    cell = F.array(F.array(a, zero, zero), F.array(zero, a, zero), F.array(zero, zero, a))
    positions = F.array(F.array(zero, zero, zero), F.array(a / 2, a / 2, zero))
    forces = F.array(F.array(F.col("c_acctbal") / 1000, zero, zero), F.array(-F.col("c_acctbal") / 1000, zero, zero))
    virial = F.when(F.col("c_custkey") % 2 == 0, cell)
    frame = xyz.training_frame(F.col("c_acctbal"), F.lit([True, True, False]), cell, F.lit(["W", "Cr"]), positions, forces, virial)
    return c.select("c_custkey", F.md5(frame.cast("binary")).alias("frame_md5"))


_EVENTS = f"""e AS (SELECT event_id % 997 AS job_id, event_id AS seq, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in KIND.items())} END AS kind, ts, value FROM events)"""
_REPLAY = f"""WITH {_EVENTS}, n AS (SELECT *, sum((kind = 'oom')::INT) OVER w AS k FROM e WINDOW w AS (PARTITION BY job_id ORDER BY seq)),
    f AS (SELECT *, kind IN ('completed', 'failed', 'reused') OR (kind = 'oom' AND k = {jobs.MAX_RETRY + 1}) AS fin FROM n),
    g AS (SELECT *, coalesce(sum(fin::INT) OVER (PARTITION BY job_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past FROM f),
    states AS (SELECT job_id, CASE WHEN arg_max(kind, seq) = 'oom' THEN CASE WHEN max(k) > {jobs.MAX_RETRY} THEN 'failed' ELSE 'submitted' END ELSE arg_max(kind, seq) END AS status,
        least(max(k), {jobs.MAX_RETRY})::INTEGER AS retry_level, max(seq) AS last_event FROM g WHERE past = 0 GROUP BY 1)"""

QUERIES = {f.__name__: f for f in (job_state_machine, job_status_tally, job_progress, event_windows, training_frames, job_outcomes)}

ORACLES = {
    "job_state_machine": f"{_REPLAY} SELECT * FROM states",
    "job_status_tally": f"""{_REPLAY} SELECT job_id % 5 AS dataset, count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed,
        count(*) FILTER (status NOT IN ('completed', 'failed')) AS active FROM states GROUP BY 1""",
    "job_progress": f"""WITH {_EVENTS}, p AS (SELECT job_id, seq, value, epoch_us(ts)::DOUBLE / 1000000 AS t FROM e),
        r AS (SELECT *, CASE WHEN t - lag(t) OVER w > 0 THEN (value - lag(value) OVER w) / (t - lag(t) OVER w) END AS rate FROM p WINDOW w AS (PARTITION BY job_id ORDER BY seq))
        SELECT job_id, seq, round(rate * 1e6, 6) AS rate, round(CASE WHEN rate > 0 THEN greatest(100 - value, 0) / rate END, 3) AS remaining FROM r""",
    "job_outcomes": f"""WITH j AS (SELECT user_id AS job_id, CASE WHEN bool_or(event_type = 'signup') THEN 'submitted' ELSE 'pending' END AS status, count(*) FILTER (event_type = 'error')::INTEGER AS retry_level,
            bool_or(event_type = 'purchase') AS completed, bool_or(event_type = 'click') AS oom, bool_or(event_type = 'view') AS has_log FROM events GROUP BY 1)
        SELECT job_id, status, retry_level, CASE WHEN status <> 'submitted' THEN status WHEN job_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'active' WHEN completed THEN 'completed'
            WHEN oom AND retry_level < {jobs.MAX_RETRY} THEN 'retry' WHEN retry_level >= {jobs.MAX_RETRY} OR has_log THEN 'failed' ELSE 'pending' END AS outcome FROM j""",
    "event_windows": f"WITH {_EVENTS} SELECT date_trunc('day', ts)::TIMESTAMP AS start, kind, count(*) AS n FROM e GROUP BY 1, 2",
    "training_frames": """WITH c AS (SELECT c_custkey, c_acctbal AS e, c_nationkey::DOUBLE AS a, printf('%.10f', 0::DOUBLE) AS z FROM customer),
        x AS (SELECT *, concat_ws(' ', printf('%.10f', a), z, z, z, printf('%.10f', a), z, z, z, printf('%.10f', a)) AS l, printf('%15.10f', 0::DOUBLE) AS o FROM c)
        SELECT c_custkey, md5('2' || chr(10) || 'energy=' || printf('%.10f', e) || ' pbc="T T F" Lattice="' || l || '" Properties=species:S:1:pos:R:3:force:R:3'
            || CASE WHEN c_custkey % 2 = 0 THEN ' virial="' || l || '"' ELSE '' END || chr(10) || '  W' || o || o || o || printf('%15.10f', e / 1000) || o || o || chr(10)
            || ' Cr' || printf('%15.10f', a / 2) || printf('%15.10f', a / 2) || o || printf('%15.10f', -e / 1000) || o || o) AS frame_md5 FROM x""",
}
