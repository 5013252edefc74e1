"""Operator 13 against all inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import negatives as N
from ferrolite.llm import queries as Q


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """rows: different (id, label, vector) of good values."""
    rows = [(d, y, [math.floor(256 * float(x)) for x in v]) for d, y, v in rows]
    out = []
    for d, y, v in rows:
        if not anchor(d):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), e, z) for e, z, w in rows if e != d and len(w) == len(v))
        for s, p in [(-s, e) for s, e, z in scored if z == y][:positives]:
            hard = [(e, -t) for t, e, z in scored if z != y and low * s <= -100 * t <= high * s][:negatives]
            out += [(d, p, n + 1, e, s, t) for n, (e, t) in enumerate(hard)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def relabelled(d, y):
    return (y + 1) % 10 if d % 7 == 0 else y


def test_query_equals_brute_force_and_sql(spark, sf):
    found = got(Q.op13_hard_negatives(spark, sf))
    rows = [(r["vec_id"], relabelled(r["vec_id"], r["label"]), r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert found == brute(rows, lambda d: d % 50 == 0)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert sorted(con.sql(f"select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ({Q.ORACLES['op13_hard_negatives']})").fetchall()) == found


@pytest.mark.parametrize("seed, bucket_rows", [(0, 7), (1, 1000), (2, 16)])
def test_norms_that_differ_ties_and_bad_rows(spark, monkeypatch, seed, bucket_rows):
    """Clusters of different norms, a hot label, many ties, several lengths, negative scores, repeated and bad rows, large numbers."""
    draw = np.random.Generator(np.random.PCG64(seed))
    rows = [(k, int(draw.choice([0, 0, 0, 1, 2])), [float(x) for x in draw.normal(0, draw.choice([0.1, 1, 5]), 6)]) for k in range(160)]
    rows += [(k, k % 2, [float(x) for x in draw.choice([-0.5, 0.0, 0.25], 6)]) for k in range(160, 230)]
    rows += [(k, k % 3, [1.0, 2.0]) for k in range(230, 240)] + [(k, k % 2, []) for k in range(240, 246)] + [(2**60, 5, [1.0] * 6), (2**60 + 10, 5, [-1.0] * 6)]
    rows += [(k, k % 2, [2.0**22, -(2.0**22) + k]) for k in range(500, 512)]
    bad = [(1000, 0, None), (1010, 0, [1.0, None] + [0.0] * 4), (1020, 0, [math.nan] * 6), (1030, 0, [math.inf] * 6), (None, 0, [1.0] * 6), (1040, None, [1.0] * 6)]
    df = spark.createDataFrame(rows + rows[:30] + bad, "vec_id bigint, label int, embedding array<double>").repartition(5)
    df = df.select("*", *[F.lit(3).alias(c) for c in ("row", "v", "dim", "norm", "bucket", "anchor", "j", "windows", "run")])
    monkeypatch.setattr(N, "RANGE_ROWS", 60)
    want = brute(rows, lambda d: d % 10 == 0)
    assert want and got(N.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), bucket_rows=bucket_rows)) == want


def test_buckets_that_bounds_rule_out_and_salted_bounds(spark, monkeypatch):
    draw = np.random.Generator(np.random.PCG64(4))
    rows = [(k, k % 2, [float(x) for x in draw.normal(0, 1, 4) * 1.5 ** (k // 40)]) for k in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    sent = []
    met = N._met
    monkeypatch.setattr(N, "_met", lambda b, s, *a: (sent.append(s.count()), met(b, s, *a))[1])
    want = brute(rows, lambda d: d % 10 == 0)
    assert got(N.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), bucket_rows=20)) == want
    # Positives: the first bucket of 10 of the label, then the others; negatives: the first of 20, then the others.
    assert sent[0] == 40 and sent[1] < 40 * 9 / 2 and sent[3] < 40 * 19
    monkeypatch.setattr(N, "BOUND_ROWS", 3)
    monkeypatch.setattr(N, "COPY_ANCHORS", 15)
    assert got(N.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), bucket_rows=20)) == want


def test_empty_table(spark):
    assert N.mine(spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>"), F.lit(True), F.col("label")).count() == 0
