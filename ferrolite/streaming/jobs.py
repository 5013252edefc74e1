"""The life of jobs from a log of events: in batch, as a stream with state, and what is derived from it.

Events move a job from pending to submitted to running, and then to completed or failed. Running out of memory sends
it back with the next level of the retry ladder, or fails it after the last one. Completed, failed and reused are final.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ferrolite.operators.registry import latest
from ferrolite.sources.scratch import stash

FINAL = ("completed", "failed", "reused")
MAX_RETRY = 3


def replay(events: DataFrame, max_retry: int = MAX_RETRY, patience: float | None = None) -> DataFrame:
    """job_id, status, retry_level, last_event: the state after all events (job_id, seq, kind).

    With ``patience`` (seconds; events have ts then) a job that was submitted last, and whose newest event is older than
    the newest of all by more than that, never ran: it is pending again.

    Only combined aggregates and a ranked filter are used: the final event of a job is the first of its completed,
    failed and reused ones and its ``max_retry`` + 1st lack of memory; what comes later changes nothing. So a job with
    very many events is never gathered in one place.
    """
    final = events.where(F.col("kind").isin(*FINAL)).groupBy("job_id").agg(F.min("seq").alias("done"))
    nth = Window.partitionBy("job_id").orderBy("seq")
    lacks = events.where("kind = 'oom'").withColumn("n", F.row_number().over(nth)).where(F.col("n") <= max_retry + 1)
    lacks = lacks.where(F.col("n") == max_retry + 1).select("job_id", F.col("seq").alias("spent"))
    ends = final.join(lacks, "job_id", "full").select("job_id", F.least("done", "spent").alias("end"), (F.coalesce(F.col("spent") < F.col("done"), F.col("done").isNull())).alias("gave_up"))
    before = events.join(ends, "job_id", "left").where(F.col("end").isNull() | (F.col("seq") <= F.col("end")))
    last = before.groupBy("job_id").agg(F.max_by("kind", "seq").alias("kind"), F.max("seq").alias("last_event"), F.count_if(F.col("kind") == "oom").alias("ooms"), F.first("gave_up").alias("gave_up"))
    status = F.when(F.coalesce("gave_up", F.lit(False)), "failed").when(F.col("kind") == "oom", "submitted").otherwise(F.col("kind"))
    if patience is None:
        return last.select("job_id", status.alias("status"), F.least(F.col("ooms"), F.lit(max_retry)).cast("int").alias("retry_level"), "last_event")
    newest = events.agg(F.max("ts").alias("now"))
    seen = before.groupBy("job_id").agg(F.max("ts").alias("seen"))
    quiet = F.unix_millis(F.col("seen").cast("timestamp")) + int(patience * 1000) <= F.unix_millis(F.col("now").cast("timestamp"))
    both = last.join(seen, "job_id").join(F.broadcast(newest), F.lit(True))  # one row
    status = F.when((status == "submitted") & quiet, "pending").otherwise(status)
    return both.select("job_id", status.alias("status"), F.least(F.col("ooms"), F.lit(max_retry)).cast("int").alias("retry_level"), "last_event")


def step(status: str, level: int, kind: str, max_retry: int = MAX_RETRY) -> tuple[str, int]:
    """One transition."""
    if status in FINAL:
        return status, level
    if kind == "oom":
        return ("submitted", level + 1) if level < max_retry else ("failed", level)
    return kind, level


def stream_states(events: DataFrame, max_retry: int = MAX_RETRY, patience: float | None = None) -> DataFrame:
    """The same from a stream of (job_id long, seq long, kind): the changed jobs of each micro-batch (update mode).

    Events of a job must come in the order of seq across batches; within one they are sorted here. With ``patience``
    (seconds) the events need ts and a watermark on it; a timer of each submitted job then puts it back to pending when
    the watermark has passed its last event by as much: it never ran, and what admits jobs submits it again.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, level, last, at = state.get if state.exists else ("pending", 0, -1, 0)
        if state.hasTimedOut:
            status = "pending" if status == "submitted" else status
        else:
            columns = ["seq", "kind", "ts"] if patience is not None else ["seq", "kind"]
            for seq, kind, *ts in sorted(row for b in batches for row in zip(*[b[c] for c in columns], strict=True)):
                if status not in FINAL:
                    status, level = step(status, level, kind, max_retry)
                    last = int(seq)
                    at = max(at, int(pd.Timestamp(ts[0]).timestamp() * 1000)) if ts else at
            if patience is not None and status == "submitted":
                due = at + int(patience * 1000)
                if due <= state.getCurrentWatermarkMs():
                    status = "pending"
                else:
                    state.setTimeoutTimestamp(due)
        state.update((status, level, last, at))
        yield pd.DataFrame({"job_id": [key[0]], "status": [status], "retry_level": [level], "last_event": [last]})

    return events.groupBy("job_id").applyInPandasWithState(
        run, "job_id bigint, status string, retry_level int, last_event bigint", "status string, retry_level int, last_event bigint, at bigint", "update",
        GroupStateTimeout.NoTimeout if patience is None else GroupStateTimeout.EventTimeTimeout,
    )


def admit_batch(states: DataFrame, path: str, slots: int, submit: Callable[[list], None]) -> None:
    """For foreachBatch of ``stream_states``: the newest states go into the keyed table at ``path``, and ``submit`` gets the
    pending jobs, smallest id first, that the free slots admit (``slots`` at most). A replayed batch changes no state."""
    upsert_latest(states.withColumn("order", F.struct("last_event", F.when(F.col("status") == "pending", 1).otherwise(0))), path, ["job_id"], "order")
    ready = admitted(upserted(states.sparkSession, path), slots)
    submit([r["job_id"] for r in ready.orderBy("job_id").collect()])  # ``slots`` at most


#: Buckets of a keyed table; all calls for one table must agree.
BUCKETS = 64


def upsert_latest(batch: DataFrame, path: str, keys: list[str], order: str, buckets: int = BUCKETS) -> None:
    """For foreachBatch: a table with the newest entry (by ``order``) of each key, the batch's entries merged into it.

    Keys are dealt into ``buckets`` by a hash, and only buckets that the batch touches are read and written: each gets a new
    version as one file, which readers see as a whole or not at all, and keeps the version before it; older ones are
    deleted. A batch that is replayed changes nothing. ``upserted`` reads the newest versions.
    """
    spark = batch.sparkSession
    columns = batch.columns
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    batch = stash(latest(batch, keys, order).select(*columns).withColumn("bucket", bucket))
    touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())  # ``buckets`` at most
    if not touched:
        return
    versions = dict.fromkeys(touched, 0)
    try:
        old = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    except AnalysisException:  # no version yet
        old = None
    if old is not None:
        versions |= {r["bucket"]: r["v"] for r in old.groupBy("bucket").agg(F.max("version").alias("v")).collect()}
        live = old.where(_is_newest(versions)).select(*columns, "bucket")
        batch = latest(live.unionByName(batch), keys, order).select(*columns, "bucket")
    number = F.element_at(F.create_map(*[F.lit(x) for b, v in versions.items() for x in (b, v + 1)]), F.col("bucket"))
    batch.withColumn("version", number).repartition(len(touched), "bucket").write.mode("append").partitionBy("bucket", "version").parquet(path)
    for b, v in versions.items():
        for gone in range(v - 1, 0, -1):
            if not _deleted(spark, f"{path}/bucket={b}/version={gone}"):
                break


def _is_newest(versions: dict[int, int]) -> Column:
    return F.array_contains(F.array(*[F.lit(f"{b}/{v}") for b, v in versions.items()]), F.concat_ws("/", F.col("bucket").cast("string"), F.col("version").cast("string")))


def _deleted(spark: SparkSession, folder: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))


def upserted(spark: SparkSession, path: str) -> DataFrame:
    """The newest versions of a table made by ``upsert_latest``."""
    rows = spark.read.parquet(path)
    versions = {r["bucket"]: r["v"] for r in rows.groupBy("bucket").agg(F.max("version").alias("v")).collect()}  # a row for each bucket
    return rows.where(_is_newest(versions)).drop("bucket", "version")


def outcome(completed: Column, oom: Column, has_log: Column, retry_level: Column, max_retry: int = MAX_RETRY) -> Column:
    """What becomes of a job that has left the scheduler: completed; retry (out of memory, with retries left); failed (out
    of retries, or a log without the marker of the end); pending (it left no log: it never ran, and is submitted again).
    Null flags count as false, a null level as 0."""
    spent = F.coalesce(retry_level, F.lit(0)) >= max_retry
    return (
        F.when(completed, "completed").when(oom, F.when(spent, "failed").otherwise("retry")).when(spent | F.coalesce(has_log, F.lit(False)), "failed").otherwise("pending")
    )


def outcomes(jobs: DataFrame, scheduled: DataFrame, max_retry: int = MAX_RETRY) -> DataFrame:
    """``jobs`` (job_id, status, completed, oom, has_log, retry_level) with ``outcome``: ``active`` for those that the
    scheduler (job_id) still has, their status for those that weren't submitted."""
    there = scheduled.select("job_id").where("job_id is not null").distinct().withColumn("_there", F.lit(True))
    found = outcome(F.col("completed"), F.col("oom"), F.col("has_log"), F.col("retry_level"), max_retry)
    kind = F.when(F.col("status") != "submitted", F.col("status")).when(F.col("_there"), "active").otherwise(found)
    return jobs.join(there, "job_id", "left").withColumn("outcome", kind).drop("_there")


def backfilled(completed: DataFrame, path: str, keys: list[str], order: str, dry_run: bool = False) -> DataFrame:
    """Completed jobs whose identity the registry at ``path`` lacks; they are added unless ``dry_run``. Running it again
    adds nothing."""
    try:
        missing = completed.join(upserted(completed.sparkSession, path).select(*keys), keys, "left_anti")
    except AnalysisException:
        missing = completed
    missing = stash(latest(missing, keys, order).select(*completed.columns))
    if not dry_run and missing.take(1):
        upsert_latest(missing, path, keys, order)
    return missing


def tally(states: DataFrame, dataset: Column) -> DataFrame:
    """Jobs by status for each dataset; reused ones count as completed."""
    done = F.col("status").isin("completed", "reused")
    return states.groupBy(dataset.alias("dataset")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(~done & (F.col("status") != "failed")).alias("active")
    )


def admitted(states: DataFrame, slots: int) -> DataFrame:
    """job_id of the pending jobs that may be submitted now: as many, smallest id first, as slots are free."""
    active = states.agg(F.count_if(F.col("status").isin("submitted", "running")).alias("n")).first()["n"]
    return states.where("status = 'pending'").orderBy("job_id").limit(max(0, slots - active)).select("job_id")


def progress(polls: DataFrame, target: float) -> DataFrame:
    """job_id, seq, value, rate, remaining: growth of ``value`` since the job's last poll, and the time to the target.

    ``polls``: job_id, seq, ts (seconds), value.
    """
    w = Window.partitionBy("job_id").orderBy("seq")
    dt, dv = F.col("ts") - F.lag("ts").over(w), F.col("value") - F.lag("value").over(w)
    rows = polls.withColumn("rate", F.when(dt > 0, dv / dt))
    return rows.select("job_id", "seq", "value", "rate", F.when(F.col("rate") > 0, F.greatest(F.lit(target) - F.col("value"), F.lit(0.0)) / F.col("rate")).alias("remaining"))


def windowed(events: DataFrame, width: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """Extra: events by kind in tumbling windows of their time, with a watermark when streamed."""
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", width), "kind").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "kind", "n")
