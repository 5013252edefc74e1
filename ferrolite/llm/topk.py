"""Operator 5: exact top-k inner products by MaxScore over shards of integer vectors.

Components are terms. A shard keeps a posting list for each term, the rows whose component is not 0 with its value, and
the term's largest and smallest value. A query's terms are ordered by what they can add at most. The trailing terms
that together stay below the threshold, the k-th best score known so far, are non-essential: only the postings of the
others are traversed, and a row that stands in none of them can't compete. The non-essential terms are probed for the
rows left, a few at a time, while these are competitive, and the threshold rises meanwhile. A query meets its home shard
first, which gives it a threshold; of the other shards it is sent only to those whose bounds reach that. The shards'
lists are merged in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import only, stash, tuned

SHARD_ROWS, BLOCK_QUERIES = 8192, 1024
#: Rows scored first for a threshold (the best ones of this many leading terms), and terms of one probe.
SEED_TERMS, SEEDS, PROBE = 6, 4, 6
#: Numbers that the bounds of all shards may have to be broadcast; beyond, every query goes to every shard.
BOUND_NUMBERS = 4_000_000


def integers(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component, as whole numbers."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def finite(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    ok = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return embedding.isNotNull() & F.coalesce(ok, F.lit(False))


class Shard:
    """Vectors of one shard as posting lists, with the terms' extremes and their rows of highest and lowest impact."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.high, self.low = x.max(axis=0), x.min(axis=0)
        self.postings: list[tuple[np.ndarray | None, np.ndarray]] = []
        for column in x.T:
            rows = np.flatnonzero(column)
            self.postings.append((None, column.copy()) if len(rows) == len(column) else (rows, column[rows]))  # None: all rows
        n = min(SEEDS, len(x))
        self.most = np.argpartition(-x, n - 1, axis=0)[:n] if x.shape[1] else np.zeros((0, 0), np.int64)
        self.least = np.argpartition(x, n - 1, axis=0)[:n] if x.shape[1] else np.zeros((0, 0), np.int64)

    def best(self, q: np.ndarray, own: int, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the id ``own``, ties to smaller ids; rows that score less
        than ``least`` may be left out."""
        a, b = q * self.high, q * self.low
        # A row without a posting gets nothing, so that 0 is among the values of every term with a gap.
        gap = np.array([rows is not None for rows, _ in self.postings], dtype=bool)
        up, low = np.maximum(a, b), np.minimum(a, b)
        up, low = np.where(gap, np.maximum(up, 0), up), np.where(gap, np.minimum(low, 0), low)
        terms = np.argsort(np.minimum(low, 0) - np.maximum(up, 0), kind="stable")
        after_up = np.append(np.cumsum(up[terms][::-1])[::-1], 0)
        after_low = np.append(np.cumsum(low[terms][::-1])[::-1], 0)
        # What a row in none of the leading postings reaches at most.
        beyond = np.append(np.cumsum(np.maximum(up, 0)[terms][::-1])[::-1], 0)

        if len(terms):
            lead = terms[:SEED_TERMS]
            seeds = np.unique(np.where(q[lead] > 0, self.most[:, lead], self.least[:, lead]))
            seeds = seeds[self.ids[seeds] != own]
            if len(seeds) >= k:
                known = np.partition(self.x[seeds] @ q, len(seeds) - k)[len(seeds) - k]
                least = known if least is None else max(least, known)

        at = len(terms) if least is None else int(np.argmax(beyond < least)) if beyond[-1] < least else len(terms)
        # Rows without any posting score 0 and take part only if that can be enough.
        total, met = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), least is None or least <= 0)
        for t in terms[:at]:
            rows, values = self.postings[t]
            if rows is None:
                total += q[t] * values
                met[:] = True
            else:
                total[rows] += q[t] * values
                met[rows] = True
        rows = np.flatnonzero(met & (self.ids != own))
        partial = total[rows]
        while len(rows):
            if len(rows) >= k:
                bound = np.partition(partial, len(partial) - k)[len(partial) - k] + after_low[at]
                least = bound if least is None else max(least, bound)
            if least is not None:
                ok = partial + after_up[at] >= least
                rows, partial = rows[ok], partial[ok]
            if at >= len(terms):
                break
            step = terms[at : at + PROBE]
            partial = partial + self.x[np.ix_(rows, step)] @ q[step]
            at = min(len(terms), at + PROBE)
        order = np.lexsort((self.ids[rows], -partial))[:k]
        return self.ids[rows[order]], partial[order]


_HIT = pa.schema([(c, pa.int64()) for c in ("query_id", "qrow", "vec_id", "score", "dim", "shard")] + [("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])
_HIT_DDL = "query_id bigint, qrow bigint, vec_id bigint, score bigint, dim bigint, shard bigint, high array<bigint>, low array<bigint>"


def _search(k: int, bounds: bool):
    """Over rows sorted by (dim, shard, part), a shard's vectors before its queries: one row for each hit, and, if asked
    for, one for each shard's bounds. A task holds one shard's vectors and one batch of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        shard: Shard | None = None
        out: list[tuple] = []

        def build() -> None:
            nonlocal shard, ids, vectors
            if ids:
                shard = Shard(np.array(ids, np.int64), np.array(vectors, np.int64).reshape(len(ids), -1))
                ids, vectors = [], []
                if bounds:
                    out.append((None, None, None, None, at[0], at[1], shard.high.tolist(), shard.low.tolist()))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(_HIT)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HIT, strict=True)], schema=_HIT)

        for batch in batches:
            lists = batch.column("v")
            values, edges = lists.values.to_numpy(), lists.offsets.to_pylist()
            names = ("dim", "shard", "part", "asks", "vec_id", "qrow", "known", "least")
            for n, (dim, number, part, asks, own, qrow, known, least) in enumerate(zip(*[batch.column(c).to_pylist() for c in names], strict=True)):
                v = values[edges[n] : edges[n + 1]]
                if (dim, number, part) != at:
                    build()
                    at, shard = (dim, number, part), None
                if not asks:
                    ids.append(own)
                    vectors.append(v)
                    continue
                build()
                if shard is not None:
                    found, scores = shard.best(v, own, k, least if known else None)
                    out += [(own, qrow, i, s, dim, number, None, None) for i, s in zip(found.tolist(), scores.tolist(), strict=True)]
            yield batch_of(out)
            out.clear()
        build()
        yield batch_of(out)

    return run


def _met(vectors: DataFrame, queries: DataFrame, k: int, bounds: bool) -> DataFrame:
    """Hits (and bounds) of the ``queries`` in the shards that they are sent to."""
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    both = vectors.select("dim", "shard", "part", no.alias("asks"), "vec_id", "v", zero.alias("qrow"), no.alias("known"), zero.alias("least"))
    asked = queries.select("dim", "shard", "part", F.lit(True).alias("asks"), "vec_id", "v", "qrow", F.col("least").isNotNull().alias("known"), F.coalesce("least", zero).alias("least"))
    keys = ["dim", "shard", "part"]
    return both.union(asked).repartition(*keys).sortWithinPartitions(*keys, "asks").mapInArrow(_search(k, bounds), _HIT_DDL)


def search(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each row where ``is_query`` holds.

    ``vectors`` has vec_id and embedding (array of numbers). Candidates are dealt into shards of about ``shard_rows`` by
    a hash. In a first round each query meets the shard that its own row is in; in a second one it goes, with the
    threshold that it has by then, to every other shard whose bounds reach it. A task streams queries past one shard, so
    it holds a bounded number of rows; where a shard gets more than 16 times ``block_queries`` of them, these are dealt
    over several copies of the shard. All pairs of queries and shards are work to do unless the bounds rule them out;
    what is moved is one row for each of them, against ``shard_rows`` products.
    Vectors that are null, hold null or non-finite components, or have no id take no part. Vectors are compared with
    those of their own length only; an empty vector scores 0. Rows repeated as a whole count once; a query is not
    compared with rows of its own id; ties go to the smaller id; fewer than k other rows are all returned. Sums must fit
    into 64 bits (components below 2^31 and fewer than 2^31 of them do; larger ones raise no error and wrap around).
    """
    tuned(vectors.sparkSession)
    rows = only(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), integers(F.col("embedding")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = stash(rows.withColumn("dim", F.size("v")).distinct().withColumn("h", F.xxhash64("vec_id", "v")))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q"), F.count_distinct("dim").alias("dims"), F.max("dim").alias("dim")).first()
    shards = max(1, -(-count["n"] // shard_rows))
    placed = rows.withColumn("shard", F.pmod("h", F.lit(shards)).cast("bigint"))
    none, first = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    asked = placed.where("asked").select("dim", "vec_id", "v", F.col("h").alias("qrow"), none.alias("least"), "shard", first.alias("part"))
    home = stash(_met(placed.withColumn("part", first), asked, k, True))
    hits = home.where("query_id is not null").select("query_id", "qrow", "vec_id", "score")
    if shards > 1:
        # The k-th best score so far; a query that has fewer hits has none.
        so_far = hits.groupBy("query_id", "qrow").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("qrow", "query_id", "least")
        known = asked.drop("least").join(so_far.withColumnRenamed("query_id", "vec_id"), ["qrow", "vec_id"], "left").withColumnRenamed("shard", "own")
        limits = home.where("high is not null").select("dim", "shard", "high", "low")
        if shards * count["dims"] * 2 * max(1, count["dim"]) <= BOUND_NUMBERS:  # an upper bound of the numbers that are broadcast
            sent = known.join(F.broadcast(limits), "dim").where("shard <> own")
            reach = F.zip_with(F.arrays_zip("high", "low"), "v", lambda b, q: F.greatest(b["high"] * q, b["low"] * q))
            sent = sent.where(F.col("least").isNull() | (F.aggregate(reach, F.lit(0).cast("bigint"), lambda s, x: s + x) >= F.col("least")))
        else:
            every = F.explode(F.sequence(first, F.lit(shards - 1).cast("bigint"))).alias("shard")
            sent = known.select("*", every).where("shard <> own")
        copies = max(1, -(-count["q"] // (16 * block_queries)))
        sent = sent.withColumn("part", F.pmod("qrow", F.lit(copies)).cast("bigint"))
        dealt = placed.withColumn("part", F.explode(F.sequence(first, F.lit(copies - 1).cast("bigint"))))
        hits = hits.union(_met(dealt, sent, k, False).select("query_id", "qrow", "vec_id", "score"))
    order = Window.partitionBy("query_id", "qrow").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
