"""Operator 5 against all inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import queries as Q
from ferrolite.llm import topk


def brute(rows, asked, k=5):
    rows = {d: np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64) for d, v in rows}
    out = []
    for q in sorted(d for d in rows if asked(d)):
        best = sorted((-int(rows[q] @ x), d) for d, x in rows.items() if d != q and len(x) == len(rows[q]))[:k]
        out += [(q, n + 1, d, -s) for n, (s, d) in enumerate(best)]
    return out


def test_query_equals_brute_force_and_sql(spark, sf):
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in Q.op5_maxscore_topk(spark, sf).collect())
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got == brute(rows, lambda d: d % 50 == 0)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert sorted(con.sql(f"select query_id, rank, vec_id, score from ({Q.ORACLES['op5_maxscore_topk']})").fetchall()) == got


@pytest.mark.parametrize("shard_rows, block", [(7, 3), (1000, 1000)])
def test_ties_and_bad_vectors(spark, shard_rows, block):
    draw = np.random.Generator(np.random.PCG64(8))
    good = [(k, [float(x) for x in draw.choice([-0.5, 0.0, 0.25, 1.0], 6)]) for k in range(120)]  # many ties
    empty = [(50, []), (60, []), (61, [])]  # they meet each other, with score 0
    good = [(k, v) for k, v in good if k not in (50, 60, 61)] + empty
    bad = [(1000, None), (1010, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1020, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0]), (1030, [math.inf] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(good + good[:9] + bad + [(2000, [1.0, 2.0]), (2001, [1.0, 1.0])], "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1)).withColumn("dim", F.lit("x"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_queries=block).collect())
    assert got == brute(good + [(2000, [1.0, 2.0]), (2001, [1.0, 1.0])], lambda d: d % 10 == 0)


def test_empty_table(spark):
    assert topk.search(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_sparse_clustered_and_large_numbers(spark, seed):
    """Gaps in the posting lists, shards that bounds rule out, ids beyond 2^53, scores near 2^62, fewer than k + 1 rows of a length."""
    draw = np.random.Generator(np.random.PCG64(seed))
    rows = [(k, [float(x) for x in draw.normal(0, 3, 8) * (draw.random(8) < 0.3)]) for k in range(150)]
    rows += [(k, [100.0 + k % 5] * 8) for k in range(150, 180)] + [(2**60 + 10 * k, [float(x) for x in draw.integers(-2, 3, 5)]) for k in range(4)]
    rows += [(k, [2.0**22, -(2.0**22)]) for k in (500, 501, 510)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, F.col("vec_id") % 10 == 0, shard_rows=25, block_queries=1).collect())
    assert got == brute(rows, lambda d: d % 10 == 0)


def test_postings_prune(spark):
    """A threshold from elsewhere leaves only rows that reach it, whatever is traversed."""
    draw = np.random.Generator(np.random.PCG64(5))
    x = draw.integers(-9, 10, (400, 12)) * (draw.random((400, 12)) < 0.4)
    shard = topk.Shard(np.arange(400), x)
    for q in draw.integers(-9, 10, (40, 12)):
        want = sorted((-int(s), i) for i, s in enumerate(x @ q))[:5]
        for least in (None, -want[-1][0], -want[-1][0] - 50, -want[0][0] + 1, 0):
            ids, scores = shard.best(q, -1, 5, least)
            kept = [(s, i) for s, i in want if least is None or -s >= least]
            assert [(-int(s), int(i)) for i, s in zip(ids, scores, strict=True)][: len(kept)] == kept
