"""Texts far longer than a pass: the same results as in one piece, in bounded memory; keys that most rows have."""

from __future__ import annotations

import resource
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import common, components, quality
from ferrolite.llm import words as W


def test_passes_change_no_hash(monkeypatch):
    draw = np.random.Generator(np.random.PCG64(6))
    texts = pa.array(["".join(draw.choice(list("ab c\n"), n)) for n in (0, 5, 3000, 1, 9000)] + ["y" * 5000, " z" * 700])
    whole = W.words(texts)
    monkeypatch.setattr(W, "PASS", 257)
    parts = W.words(texts)
    assert (whole.hashes == parts.hashes).all() and (whole.bounds == parts.bounds).all()


def test_passes_change_no_score(monkeypatch):
    draw = np.random.Generator(np.random.PCG64(7))
    net = quality.train([b"good text here " * 9, b"x!x!x!" * 40] * 20, [1, 0] * 20)
    texts = pa.array(["".join(draw.choice(list("abc !x"), n)) for n in (0, 3, 128, 129, 5000, 40_000)])
    whole = net.scores(texts)
    monkeypatch.setattr(quality, "PASS", 300)
    assert np.allclose(whole, net.scores(texts), atol=1e-12)


CODE = """
import resource, sys
import numpy as np, pyarrow as pa
from ferrolite.llm import words as W, quality, neardup, decontaminate as D, langmodel as L
draw = np.random.Generator(np.random.PCG64(1))
words = np.array(["w%d" % k for k in range(50_000)])
text = pa.array([" ".join(words[draw.integers(0, 50_000, 17_500_000)])])
assert len(text[0].as_py()) > 100_000_000
what = sys.argv[1]
if what == "op2":
    net = quality.train([b"good " * 30, b"x!" * 40] * 8, [1, 0] * 8)
    assert 0 <= net.scores(text)[0] <= 1
elif what == "op3":
    assert sum(len(D.Templates(p, r).hashes) for p, _ in D.pieces(W.raw(text)[0]) for r in D.READINGS) > 17_500_000
elif what == "op4":
    assert len(W.words(text).hashes) == 17_500_000
else:
    assert next(iter(neardup._sign(iter([pa.RecordBatch.from_arrays([pa.array([1]), text], names=["doc_id", "text"])])))).column("n_shingles")[0].as_py() > 10_000_000
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


@pytest.mark.parametrize("what", ["op2", "op3", "op4", "op6"])
def test_a_hundred_megabytes(what):
    done = subprocess.run([sys.executable, "-c", CODE, what], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 3000  # MB, the text itself and its making included


def test_frequent_keys_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    rows = spark.createDataFrame([(k % 7 if k < 60 else 100 + k % 3, k) for k in range(400)], "key bigint, x bigint")
    one = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("most")).where("key <> 3")
    got = sorted((r["key"], r["x"], r["n"], r["most"]) for r in common.spread_join(rows, one, "key").select("key", "x", "n", "most").collect())
    want = sorted((r["key"], r["x"], r["n"], r["most"]) for r in rows.join(one, "key").select("key", "x", "n", "most").collect())
    assert got == want and len(got) > 300


def test_components_of_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB_LINKS", 4)
    monkeypatch.setattr(common, "HOT_KEYS", 50)
    draw = np.random.Generator(np.random.PCG64(2))
    links = [(0, k) for k in range(1, 60)] + [(100 + k, 101 + k) for k in range(37)] + [(int(a), int(b)) for a, b in draw.integers(200, 400, (150, 2))] + [(500, 500), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in parent}
