"""Operator 2: held-out accuracy, gradients by behaviour, and whole texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ferrolite.llm import quality
from ferrolite.llm import queries as Q


def area(score, label):
    """Share of pairs of both classes that are in the right order."""
    a, b = np.array(score)[np.array(label) == 1], np.array(score)[np.array(label) == 0]
    return float(np.mean([(x > b).mean() + 0.5 * (x == b).mean() for x in a]))


def test_held_out_accuracy(spark, sf, rows):
    got = {r["doc_id"]: r for r in Q.op2_quality(spark, sf).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    held = [(got[r["doc_id"]]["score"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert area(*zip(*held, strict=True)) > 0.9


def _net():
    texts = [b"good clean prose that reads on and on. " * 3, b"$$$ BUY NOW!!! $$$ CLICK $$$ " * 4] * 40
    return quality.train(texts, [1, 0] * 40)


def plain_score(net, text):
    """The same network, position by position."""
    data = text.encode()
    pad = data + b"\0" * (quality.WIDTH - 1)
    response = [sum(net.tables[k][pad[p + k]] for k in range(quality.WIDTH)) for p in range(len(data))] or [sum(net.tables[k][0] for k in range(quality.WIDTH))]
    response = np.array(response)
    chunks, at = [], 0
    while True:
        chunks.append(np.maximum(response[at : at + quality.CHUNK].max(axis=0) + net.offset, 0))
        if at + quality.CHUNK >= len(response):
            break
        at += quality.BLOCK * quality.STEP
    f = np.array(chunks)
    return 1 / (1 + np.exp(-(np.concatenate([f.mean(axis=0), f.max(axis=0), f.min(axis=0)]) @ net.weights + net.bias)))


def test_learns_and_scores_whole_texts():
    net = _net()
    texts = ["good clean prose that reads on and on. " * 2, "$$$ BUY NOW!!! $$$ CLICK $$$ " * 2, "", "x", "y" * 511, "z" * 512, "w" * 513, "good clean prose that reads on. " * 60 + "$$$ BUY NOW!!! " * 40, "über " * 300]
    got = net.scores(pa.array(texts))
    assert got[0] > 0.5 > got[1]
    assert np.allclose(got, [plain_score(net, t) for t in texts], atol=1e-4)
    assert np.allclose(got, [net.scores(pa.array([t]))[0] for t in texts], atol=1e-5)


def test_odd_rows(spark, odd, odd_rows, none):
    net = _net()
    got = quality.score(odd, net).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.accepted(odd, net, 0.0)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert quality.accepted(odd, net, 1.1).count() == 0 and quality.score(none, net).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (9, 0), (None, 1), (3, None), (77, 1)], "doc_id bigint, quality int").withColumn("text", F.lit("x"))
    assert quality.fit(odd, labels, F.lit(True)).bias != 0
    assert quality.score(odd, quality.fit(odd, labels.limit(0), F.lit(True))).where("score <> 0.5").count() == 0
