"""Operator 12 against all pairs."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import jaccard as J
from ferrolite.llm import queries as Q

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, percent=90):
    """rows: (id, text); each row with an id is a document of its own unless linked."""
    by_set = defaultdict(list)
    for d, t in rows:
        if d is not None:
            by_set[shingles(t)].append(d)
    found = list(by_set)
    up = {s: s for s in found}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    by_size = sorted((s for s in found if s), key=len)
    for a, s in enumerate(by_size):
        for t in by_size[a + 1 :]:
            if 100 * len(s) < percent * len(t):
                break
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                up[root(s)] = root(t)
    least = {}
    for s in by_size:
        least[root(s)] = min(least.get(root(s), 2**63), *by_set[s])
    return sorted((d if d is not None else -1, len(s := shingles(t)), least[root(s)] if s and d is not None else (d if d is not None else -1)) for d, t in rows)


def got(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"]) for r in df.collect())


def test_query_equals_brute_force(spark, sf, rows):
    found = got(Q.op12_jaccard_join(spark, sf))
    want = brute([(r["doc_id"], r["text"]) for r in rows])
    assert found == want and any(d != c for d, _, c in want)


def families(seed):
    """Chains of edits, families whose texts differ little, a passage that many texts share, sizes at the edge of bands."""
    draw = np.random.Generator(np.random.PCG64(seed))
    word = lambda n: [f"w{x}" for x in draw.integers(0, 4000, n)]
    passage, rows = word(30), []
    for _ in range(6):
        base = word(int(draw.integers(20, 200)))
        for _ in range(int(draw.integers(2, 25))):
            rows.append(list(base))
            if draw.random() < 0.6:  # the next one is made from this one: a chain
                base = list(base)
            for _ in range(int(draw.integers(0, 3))):
                base[int(draw.integers(len(base)))] = word(1)[0]
    rows += [[*word(int(draw.integers(1, 8))), *passage, *word(int(draw.integers(1, 8)))] for _ in range(60)]
    rows += [base[:k] for k in range(1, 12)] + [word(400)[: 400 - k] for k in (0, 39, 40, 41)] + [base + word(1) * k for k in range(4)]
    return [(int(d), " ".join(w)) for d, w in zip(draw.permutation(len(rows)), rows, strict=True)]


@pytest.mark.parametrize("seed, block, hot, copies", [(0, 2048, 256, 4096), (1, 5, 4, 2), (2, 3, 1, 3)])
def test_families_and_frequent_shingles(spark, monkeypatch, seed, block, hot, copies):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SET_BLOCK", block)
    monkeypatch.setattr(J, "FEW", 48 if block > 4 else 4)
    monkeypatch.setattr(J, "COPY_PAIRS", copies)
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(J.join(df, hot_from=hot)) == brute(rows)


def test_other_threshold(spark):
    with pytest.raises(ValueError):
        J.join(spark.createDataFrame([], "doc_id bigint, text string"), percent=50)
    rows = families(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(J.join(df, percent=60, hot_from=8)) == brute(rows, 60)


def test_odd_rows(spark, odd, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert got(J.join(odd)) == brute(rows)


def test_one_id_with_several_texts_and_empty_table(spark, none):
    rows = [(7, f"number {k} of the many texts of one id with other words {k * k} {k + 3}") for k in range(30)] + [(3, "number 4 of the many texts of one id with other words 16 7")] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(J.join(df)) == brute(rows)
    assert J.join(none).count() == 0


def test_bounds_never_lie_under_the_overlap(spark):
    draw = np.random.Generator(np.random.PCG64(9))
    rows = []
    for _ in range(120):
        pool = draw.integers(0, 2**63, int(draw.integers(2, 400)), dtype=np.uint64) * np.uint64(2)
        a, b = (np.unique(draw.choice(pool, int(draw.integers(1, len(pool) + 1)), replace=False)) for _ in range(2))
        if max(J.bits(len(a)), J.bits(len(b))) <= 2 * min(J.bits(len(a)), J.bits(len(b))):
            rows.append((len(a), J.bitmap(a).view(np.int64).tolist(), len(b), J.bitmap(b).view(np.int64).tolist(), len(np.intersect1d(a, b))))
    df = spark.createDataFrame(rows, "n bigint, a array<bigint>, m bigint, b array<bigint>, both bigint")
    out = df.select("both", J.overlap_bound(F.col("n"), F.col("a"), F.col("m"), F.col("b")).alias("bound")).collect()
    assert all(r["bound"] >= r["both"] for r in out) and sum(r["bound"] < r["both"] + 20 for r in out) > 30


def test_linked_sets_share_a_prefix_element():
    draw = np.random.Generator(np.random.PCG64(3))
    hot = np.sort(draw.integers(0, 2**64, 50, dtype=np.uint64))
    for _ in range(300):
        s = np.unique(np.concatenate([draw.integers(0, 2**64, int(draw.integers(1, 60)), dtype=np.uint64), draw.choice(hot, 10)]))
        t = np.unique(np.concatenate([draw.choice(s, len(s) - int(draw.integers(0, 2)), replace=False), draw.integers(0, 2**64, int(draw.integers(0, 3)), dtype=np.uint64)]))
        both = len(np.intersect1d(s, t))
        if 100 * both >= 90 * (len(s) + len(t) - both):
            for keys in (hot, hot[:0]):
                assert len(np.intersect1d(J._prefix(s, 90, keys), J._prefix(t, 90, keys)))


def test_long_text_is_read_whole():
    """A text of 12 MB: its set is the one of all its words."""
    text = " ".join(str(k * 7) for k in range(1_500_000))
    assert [len(s) for s in J.sets(pa.array([text]))] == [1_499_998]
