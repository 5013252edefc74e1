"""What round 4 mended: nearest rows without copies of the vectors for each pair of blocks, training texts learnt from equally often."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import langmodel
from ferrolite.operators import distance
from ferrolite.plans import identity


def shuffled(spark):
    """Bytes that all tasks of the session have shuffled so far."""
    there = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(there.apply(k).totalShuffleWrite() for k in range(there.size()))


def plain(v, w, ids=None, others=None):
    """Least and least positive distance of each row of v from those of w with another id."""
    out = np.full((len(v), 2), np.inf)
    for i, x in enumerate(v):
        d = np.sqrt(((w - x) ** 2).sum(axis=1))
        if ids is not None:
            d[others == ids[i]] = np.inf
        out[i] = d.min(), np.where(d > 1e-12, d, np.inf).min()
    return out


def frame(spark, v, ids):
    return spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "id bigint, v array<double>").repartition(3)


def odd_rows(seed, n):
    """Without clusters, with copies, near copies, and rows far from the others."""
    draw = np.random.default_rng(seed)
    v = draw.normal(0, 1, (n, 16))
    v[20:40], v[40:60], v[60:80] = v[:20], v[:20] + 1e-9, v[60:80] + 1e6
    return v


def test_rows_are_not_shuffled_for_each_pair_of_blocks(spark):
    """what is shuffled stays near the size of the input, however many blocks meet."""
    draw = np.random.default_rng(5)
    v = draw.normal(0, 1, (2400, 64))
    df, before, seen = frame(spark, v, range(len(v))).localCheckpoint(), shuffled(spark), {}
    got = {r["id"]: (r["distance"], r["positive_distance"]) for r in distance.nearest(df, df, itself=True, block=100, report=seen).collect()}
    assert seen["visited"] == seen["block_pairs"] > 300  # nothing can be ruled out
    assert shuffled(spark) - before < 3 * v.nbytes
    want = plain(v, v, np.arange(len(v)), np.arange(len(v)))
    assert [got[k] for k in range(len(v))] == [tuple(x) for x in want.tolist()]


@pytest.mark.parametrize("block", [7, 64])
def test_equals_a_plain_loop(spark, block):
    v, w = odd_rows(1, 150), odd_rows(2, 90)
    w[5:9] = v[5:9]
    ids, others = np.arange(150), 100 + np.arange(90)
    one, two = frame(spark, v, ids), frame(spark, w, others)
    for left, right, itself, want in ((one, one, True, plain(v, v, ids, ids)), (one, two, False, plain(v, w)), (two, one, True, plain(w, v, others, ids))):
        got = {r["id"]: (r["distance"], r["positive_distance"]) for r in distance.nearest(left, right, itself=itself, block=block).collect()}
        assert [got[k] for k in sorted(got)] == [tuple(x) for x in want.tolist()]


def test_a_pair_of_blocks_lowers_both_sides():
    v, w = odd_rows(3, 600), odd_rows(4, 300)
    w[:30] = v[:30]
    w[30:32] = 1e200  # squares beyond the range of numbers: all pairs are measured
    for some in (w[:30], w[32:], w):
        ids, others = np.arange(600), 590 + np.arange(len(some))
        a, b = np.full((2, 600), np.inf), np.full((2, len(some)), np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            for at in (0, 200, 400):
                rows = slice(at, at + 200)
                distance._lower(v[rows], some, ids[rows], others, True, a[:, rows], b)
            assert (a.T == plain(v, some, ids, others)).all() and (b.T == plain(some, v, others, ids)).all()


def test_selected_min_distance_shuffles_no_copies(spark, tmp_path):
    """the query over more rows than a block has."""
    draw = np.random.default_rng(6)
    v = draw.normal(0, 1, (9000, 64)).astype(np.float32)
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    v[8000] = v[17]
    rows = pa.table({"vec_id": pa.array(range(len(v)), pa.int64()), "embedding": pa.array(list(v), pa.list_(pa.float32())), "label": pa.array([0] * len(v), pa.int32())})
    pq.write_table(rows, tmp_path / "embeddings.parquet")
    before = shuffled(spark)
    got = identity.selected_min_distance(spark, str(tmp_path)).first()
    assert shuffled(spark) - before < 3 * v.astype(np.float64).nbytes
    w = v.astype(np.float64)
    near = np.sort((w * w).sum(axis=1)[:, None] + (w * w).sum(axis=1) - 2 * w @ w.T + 9 * np.eye(len(w)), axis=None)
    assert got["min_distance"] == 0 and abs(got["min_positive_distance"] - near[2] ** 0.5) < 1e-7  # the copies, twice, come first


@pytest.mark.parametrize(("share", "times"), [(1.5, 3), (2.5, 3), (3.5, 1)])
def test_all_spans_are_learnt_from_equally_often(spark, monkeypatch, share, times):
    """in no size does one span come in more rounds than another, and all words of all texts are in some."""
    texts = [" ".join(f"w{(k * j) % 89}" for j in range(n)) for k, n in enumerate([0, 1, 95, 96, 97, 500] * 4)]
    tokens = sum(len(t.split()) + 1 for t in texts)
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    monkeypatch.setattr(langmodel, "ROUND_WORDS", int(tokens / share))
    fed, averaged = [], langmodel._averaged

    def held(net, dealt, *rest):
        fed.append(Counter(tuple(r["ids"]) for r in dealt.collect()))
        return averaged(net, dealt, *rest)

    monkeypatch.setattr(langmodel, "_averaged", held)
    _, vocab, _ = langmodel.fit(docs, F.lit(True))
    learner = langmodel._Learner(vocab)
    spans = Counter(tuple(s.tolist()) for s in learner.spans(langmodel.W.words(pa.array(texts))))
    assert sum(fed, Counter()) == Counter({s: n * times for s, n in spans.items()})
    assert sum((len(s) - 1) * n for s, n in spans.items()) == tokens == vocab.tokens


def test_a_pass_learns_from_each_word_once(monkeypatch):
    """no word of a span is left out when spans of different lengths go side by side."""
    counts = np.arange(60, 10, -1)
    vocab = langmodel.Vocabulary(np.arange(50, dtype=np.uint64), counts, np.arange(1, 51, dtype=np.int32), 51, np.concatenate([[40], counts]), np.zeros(langmodel.BINS), int(counts.sum()) + 40, 51)
    draw = np.random.default_rng(7)
    spans = [np.concatenate([[0], draw.integers(0, 51, n)]) for n in (1, 2, 23, 24, 25, 95, 96) * 9]
    seen, gradients = Counter(), langmodel._gradients

    def held(net, x, y, *rest):
        seen.update(y[y >= 0].tolist())
        return gradients(net, x, y, *rest)

    monkeypatch.setattr(langmodel, "_gradients", held)
    langmodel.Trainer(langmodel.Network(vocab), 0.005, streams=8).feed(spans)
    assert seen == Counter(np.concatenate([s[1:] for s in spans]).tolist())
