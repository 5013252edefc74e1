"""Operator 13: hard negatives by search over buckets of equal norms.

Vectors are sorted by norm, longest first, and cut into buckets. By Cauchy and Schwarz no row of a bucket scores more
against an anchor than the product of the anchor's norm and the bucket's largest one. An anchor meets the bucket of the
longest vectors first and has a running k-th score for each of its windows by then; of the other buckets it is sent only
to those whose bound reaches the smallest of what its windows still ask for, a window's lower limit or its k-th score
so far, and within a bucket it meets only the leading rows that can reach that. Positives are found in the same way in
buckets of one label, with one window that has no limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import only, stash, tuned
from ferrolite.llm.topk import finite, integers

BUCKET_ROWS, RANGE_ROWS = 4096, 1 << 20
#: Anchors that meet one copy of a bucket.
COPY_ANCHORS = 16_384
#: Rows of bounds (one for each bucket, or each group's first one) up to which these are broadcast.
BOUND_ROWS = 500_000
#: What a bound may be too small by, relatively: norms are floating-point numbers.
SLACK = 1e-9
NO_LIMIT = -(2**63)
WINDOWS = "array<struct<j:int,least:bigint,hi:bigint>>"


class Bucket:
    """Vectors of one bucket, longest first; products in floating point where that is exact."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, norms: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(-norms, kind="stable")
        self.ids, self.rows, self.labels, self.norms, self.x = ids[order], rows[order], labels[order], norms[order], x[order]
        self.most = int(np.abs(x).max(initial=0))
        self.floats = self.x.astype(np.float64) if self.most < 2**53 else None

    def scores(self, q: np.ndarray, n: int) -> np.ndarray:
        """Products of the anchors ``q`` with the first ``n`` rows, as whole numbers."""
        if self.floats is not None and float(np.abs(q).astype(np.float64).sum(axis=1).max(initial=0)) * self.most < 2.0**53:
            return (q.astype(np.float64) @ self.floats[:n].T).astype(np.int64)
        return q @ self.x[:n].T

    def answer(self, own: np.ndarray, label: np.ndarray, q: np.ndarray, norms: np.ndarray, windows: list, same: bool, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor's place, window, places of rows, their scores): the k best rows of each window, ties to smaller ids."""
        least = np.array([min((w["least"] for w in ws), default=2**63 - 1) for ws in windows], dtype=np.float64)
        # Rows are sorted by norm, so those that reach an anchor's limit lead.
        reach = np.searchsorted(-(self.norms * (1 + SLACK)), norms.max() and -((least.min() - 1) / norms.max()), side="right") if least.min() > 0 else len(self.norms)
        table = self.scores(q, int(reach))
        ids, labels = self.ids[:reach], self.labels[:reach]
        for a in range(len(q)):
            s = table[a]
            fit = ((labels == label[a]) == same) & (ids != own[a])
            for w in windows[a]:
                rows = np.flatnonzero(fit & (s >= w["least"]) & (s <= w["hi"]))
                if len(rows) > 4 * k:
                    rows = rows[s[rows] >= np.partition(s[rows], len(rows) - k)[len(rows) - k]]
                rows = rows[np.lexsort((self.rows[rows], ids[rows], -s[rows]))[:k]]
                if len(rows):
                    yield a, w["j"], rows, s[rows]


_HIT = pa.schema([("anchor", pa.int64()), ("j", pa.int32()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
_HIT_DDL = "anchor bigint, j int, vec_id bigint, row bigint, score bigint"


def _search(same: bool, k: int):
    """Over rows sorted by (dim, bucket, part), a bucket's vectors before the anchors sent to it. A task holds one bucket
    and one batch of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        parts: list[tuple] = []
        bucket: Bucket | None = None
        for batch in batches:
            names = ("dim", "bucket", "part", "asks", "vec_id", "row", "label", "norm")
            dim, number, part, asks, ids, rows, labels, norms = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            lists = batch.column("v")
            values, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
            windows = batch.column("windows").to_pylist() if asks.any() else []
            change = np.flatnonzero((np.diff(dim) != 0) | (np.diff(number) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            out: list[list] = [[] for _ in _HIT]
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(ids)], strict=True):
                if a == b:
                    continue
                key = (dim[a], number[a], part[a])
                if key != at:
                    at, parts, bucket = key, [], None
                x = values[edges[a] : edges[b]].reshape(b - a, int(dim[a]))
                if not asks[a]:
                    parts.append((ids[a:b], rows[a:b], labels[a:b], norms[a:b], x))
                    continue
                if bucket is None and parts:
                    bucket, parts = Bucket(*[np.concatenate(c) for c in zip(*parts, strict=True)]), []
                if bucket is not None:
                    for n, j, places, scores in bucket.answer(ids[a:b], labels[a:b], x, norms[a:b], windows[a:b], same, k):
                        for column, more in zip(out, ([rows[a + n]] * len(places), [j] * len(places), bucket.ids[places], bucket.rows[places], scores), strict=True):
                            column.extend(more)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _HIT, strict=True)], schema=_HIT)

    return run


def _met(buckets: DataFrame, sent: DataFrame, same: bool, k: int, anchors: int) -> DataFrame:
    """Hits of the anchors in the buckets that they are sent to; a bucket that many anchors meet is there several times."""
    copies = max(1, -(-anchors // COPY_ANCHORS))
    part = F.pmod("row", F.lit(copies)).cast("bigint")
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint")))
    columns = ["dim", "bucket", "part", "asks", "vec_id", "row", "label", "norm", "v", "windows"]
    both = buckets.withColumn("part", parts).withColumn("asks", F.lit(False)).withColumn("windows", F.lit(None).cast(WINDOWS)).select(*columns)
    both = both.union(sent.withColumn("part", part).withColumn("asks", F.lit(True)).select(*columns))
    keys = ["dim", "bucket", "part"]
    return both.repartition(*keys).sortWithinPartitions(*keys, "asks").mapInArrow(_search(same, k), _HIT_DDL)


def _sorted(rows: DataFrame, count: int, bucket_rows: int, *group: str) -> DataFrame:
    """``rows`` with the number of their bucket: consecutive runs in the order of the groups and, within each, of norms."""
    order = [*group, F.desc("norm"), "row"]
    dealt = rows.repartitionByRange(max(1, -(-count // RANGE_ROWS)), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    dealt = dealt.withColumn("at", at).withColumn("run", F.shiftright("at", 33) * F.lit(2**31) + F.floor(F.col("at").bitwiseAND(F.lit(2**33 - 1)) / F.lit(bucket_rows)))
    # Where a run holds the end of one group and the begin of others, these are buckets of their own.
    return stash(dealt.withColumn("bucket", F.xxhash64("run", *group)).drop("at"))


def _few(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BOUND_ROWS else df


def _best(buckets: DataFrame, asks: DataFrame, same: bool, k: int, anchors: int, *group: str) -> DataFrame:
    """The k best rows of each anchor's windows (anchor, j, vec_id, row, score, nth) among the buckets of its group."""
    bounds = stash(buckets.groupBy(*group, "bucket").agg(F.max("norm").alias("top"), F.min("run").alias("run")))
    first = bounds.groupBy(*group).agg(F.min_by("bucket", "run").alias("first"), F.count(F.lit(1)).alias("n"))
    size = first.agg(F.sum("n").alias("buckets"), F.count(F.lit(1)).alias("groups"), F.max("n").alias("most")).first()
    asks = asks.join(_few(first.select(*group, "first"), size["groups"]), list(group))
    hits = _met(buckets, asks.withColumnRenamed("first", "bucket"), same, k, anchors)
    if (size["most"] or 0) > 1:
        hits = stash(hits)
        # The k-th score so far of each window; an anchor has few windows.
        known = hits.groupBy("anchor", "j").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        known = known.groupBy(F.col("anchor").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("j", "least"))).alias("known"))
        asks = asks.join(known, "row", "left")
        now = F.transform("windows", lambda w: F.struct(w["j"].alias("j"), F.coalesce(F.try_element_at("known", w["j"]), w["least"]).alias("least"), w["hi"].alias("hi")))
        asks = stash(asks.withColumn("windows", now.cast(WINDOWS)).withColumn("limit", F.array_min(F.transform("windows", lambda w: w["least"])).cast("double")).drop("known"))
        if size["buckets"] <= BOUND_ROWS:
            sent = asks.join(F.broadcast(bounds.drop("run")), list(group))
        else:  # bounds are dealt by a salt, and anchors are copied for each of its values
            salts = -(-size["buckets"] // BOUND_ROWS)
            spread = asks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
            sent = spread.join(bounds.drop("run").withColumn("salt", F.pmod("bucket", F.lit(salts))), [*group, "salt"]).drop("salt")
        sent = sent.where("bucket <> first").where(F.col("norm") * F.col("top") * (1 + SLACK) + 1 >= F.col("limit"))
        hits = hits.union(_met(buckets, sent, same, k, anchors))
    order = Window.partitionBy("anchor", "j").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def _percent(score: Column, percent: int) -> Column:
    """score * percent / 100, exactly."""
    return score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(5,0)") * F.expr("0.01BD")


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A row's score is its integer inner product with the anchor. An anchor's positives are the ``positives`` best other
    rows of its ``label``; for each of them the ``negatives`` best rows of other labels are returned whose score is
    between ``low`` and ``high`` percent of the positive's. Ties go to the smaller id; where there are fewer, all are
    returned; a positive without negatives, and an anchor without positives, gives no row.
    Rows without an id, a label or a vector, and those with null or non-finite components take no part. Rows that are
    repeated as a whole count once; rows that share an id are rows of their own, but no anchor meets its own id. Vectors
    are compared with those of their own length only. Sums must fit into 64 bits. The buckets of one label that holds
    most rows are as small as others. Anchors against all buckets that bounds don't rule out are work to do; an anchor
    and its windows are one row for each of them.
    """
    tuned(vectors.sparkSession)
    rows = vectors.select(F.col("`vec_id`").cast("bigint").alias("vec_id"), F.col("`embedding`").alias("embedding"), label.cast("bigint").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding")))
    rows = rows.select("vec_id", "label", "anchor", integers(F.col("embedding")).alias("v")).distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = stash(rows.select("*", F.size("v").cast("bigint").alias("dim"), norm.alias("norm"), F.xxhash64("vec_id", "label", "v").alias("row")))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    rows_of = ["dim", "vec_id", "row", "label", "norm", "v"]

    asks = rows.where("anchor").select(*rows_of)
    free = F.array(F.struct(F.lit(0).alias("j"), F.lit(NO_LIMIT).alias("least"), F.lit(2**63 - 1).alias("hi"))).cast(WINDOWS)
    alike = _sorted(rows.select(*rows_of), count["n"], bucket_rows, "dim", "label")
    found = stash(_best(alike, asks.withColumn("windows", free), True, positives, count["anchors"], "dim", "label"))

    score = F.col("score")
    window = F.struct(F.col("nth").alias("j"), F.ceil(_percent(score, low)).cast("bigint").alias("least"), F.floor(_percent(score, high)).cast("bigint").alias("hi"))
    wanted = found.select(F.col("anchor").alias("row"), window.alias("w")).where("w.least <= w.hi").groupBy("row").agg(F.collect_list("w").cast(WINDOWS).alias("windows"))
    every = _sorted(rows.select(*rows_of), count["n"], bucket_rows, "dim")
    hard = _best(every, asks.join(wanted, "row"), False, negatives, count["anchors"], "dim")

    positive = found.select("anchor", F.col("nth").alias("j"), F.col("vec_id").alias("positive_id"), score.alias("positive_score"))
    negative = hard.select("anchor", "j", F.col("nth").alias("rank"), F.col("vec_id").alias("negative_id"), score.alias("negative_score"))
    named = asks.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negative.join(positive, ["anchor", "j"]).join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
