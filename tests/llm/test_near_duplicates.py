"""Operator 6 against a brute-force version over all pairs that share a shingle."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ferrolite.llm import neardup
from ferrolite.llm import queries as Q
from ferrolite.llm import words as W
from ferrolite.llm.common import sifted
from ferrolite.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in texts.items()}
    having = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    common = Counter((a, b) for ids in having.values() for a in ids for b in ids if a < b)
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_words_and_shingles():
    texts = ["A b\tC d E f", "", "ü  x", "a b c d e f"]
    w = W.words(pa.array(texts))
    assert np.diff(w.bounds).tolist() == [6, 0, 2, 6]
    s = W.shingles(w)
    assert [len(x) for x in s] == [2, 0, 1, 2] and s[0].tolist() == s[3].tolist()


def test_estimate_follows_similarity(spark):
    draw = np.random.Generator(np.random.PCG64(1))
    base = draw.integers(0, 2**63, 1000, dtype=np.uint64)
    other = base.copy()
    other[:111] = draw.integers(0, 2**63, 111, dtype=np.uint64)  # similarity 889 / 1111
    sig = [neardup.packed(neardup.minima(x, np.array([0])))[0].view(np.int64).tolist() for x in (base, other)]
    got = spark.createDataFrame([(sig[0], sig[1])], "a array<bigint>, b array<bigint>").select(neardup.estimate("a", "b").alias("e")).first()["e"]
    assert abs(got - 889 / 1111) < 0.2


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 90, 90: 90, 95: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_query_equals_brute_force(spark, sf, rows):
    got = Q.op6_minhash_near_dedup(spark, sf).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute({r["doc_id"]: r["text"] for r in rows})
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chains_at_the_threshold_and_large_groups(spark, make):
    """Copies of one template that differ in a few words: some pairs linked, some not, all in the same buckets."""
    draw = random.Random(3)
    texts = {}
    for g in range(4):
        base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
        for _ in range(120):
            t = list(base)
            for k in draw.sample(range(120), draw.randint(0, 6)):
                t[k] = f"v{draw.randrange(10**6)}"
            texts[len(texts) + 1] = " ".join(t)
    for k in range(400):
        texts[1000 + k] = "one and the same text of many rows"
    got = result(neardup.near_duplicates(make([(d, t, None) for d, t in texts.items()])))
    assert got == brute(texts)


def test_odd_rows(odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == 14
    of = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [of[k]["component_id"] for k in (1, 2, 3, 4, 5, 6, 7)] == [1, 1, 3, 4, 5, 6, 7]
    assert [of[k]["n_shingles"] for k in (3, 4, 5, 6, 10)] == [0, 0, 0, 1, 1]
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)


def test_empty_table(none):
    assert neardup.near_duplicates(none).count() == 0


def test_texts_without_a_near_copy_are_not_moved(spark):
    """Of 600 long texts of random words 6 have a copy in which a word differs; the others' texts are not shuffled."""
    draw = random.Random(5)
    texts = {k: " ".join(f"{draw.getrandbits(64):016x}" for _ in range(400)) for k in range(600)}
    for k in range(6):
        texts[1000 + k] = texts[k] + " end"
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    stashed = neardup.stash(docs)

    def written():
        spark.range(1).count()
        time.sleep(1)  # figures reach the status store with a delay
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite()

    conf, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(conf, "-1")
    try:
        before = written()
        got = result(neardup.near_duplicates(stashed))
        moved = written() - before
    finally:
        spark.conf.set(conf, was)
    assert {d: c for d, (_, c) in got.items()} == {d: d - 1000 if d >= 1000 else d for d in texts}
    assert moved < 0.6 * sum(map(len, texts.values())), moved


def test_sieve_keeps_all_that_are_asked_for(spark, monkeypatch):
    rows = spark.range(-5000, 5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).union(spark.createDataFrame([(None, "x")], "doc_id bigint, text string"))
    ids = spark.range(-4000, 4000, 40).select(F.col("id").alias("u"))
    got = [r["doc_id"] for r in sifted(rows, ids, "doc_id").collect()]
    assert set(range(-4000, 4000, 40)) <= set(got) and len(got) < 2000
    assert sifted(rows, ids.limit(0), "doc_id").count() == 0
    monkeypatch.setattr("ferrolite.llm.common.SIEVE_MOST", 1 << 6)  # the filter is full: nothing is lost
    assert set(range(-4000, 4000, 40)) <= {r["doc_id"] for r in sifted(rows, ids, "doc_id").collect()}
