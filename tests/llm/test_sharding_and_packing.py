"""Operators 8 and 10: exact covers, checked row by row."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ferrolite.llm import packing, sharding
from ferrolite.llm import queries as Q
from ferrolite.llm.common import smallest
from ferrolite.llm.tokens import WordTokenizer, vocabulary


def check_shards(got, texts):
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(24))
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    mean, largest = sum(r["size"] for r in got) / 24, max(r["size"] for r in got)
    assert all(abs(sum(r["size"] for r in by[k]) - mean) <= largest for k in range(24))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in order] == sorted(r["doc_id"] for r in got)  # contiguous


def test_shards(spark, sf, rows):
    got = Q.op10_sharding(spark, sf).collect()
    check_shards(got, [(r["doc_id"], r["text"]) for r in rows])
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_shards_of_one_repeated_row(make):
    check_shards(sharding.shard_by_bytes(make([(5, "one text", None)] * 3000)).collect(), [(5, "one text")] * 3000)


def test_shards_of_odd_rows(odd, none):
    got = sharding.shard_by_bytes(odd).collect()
    assert len(got) == 14 and min(r["size"] for r in got) == 8
    assert sharding.shard_by_bytes(none).count() == 0


def test_sample_is_that_of_a_full_sort(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select((F.col("id") / 2).cast("bigint").alias("doc_id"), (F.col("id") % 3 == 0).alias("kind")).union(spark.sql("select null, true"))
    order = [F.shiftrightunsigned(F.xxhash64("doc_id"), 1), F.col("doc_id")]
    known = df.where("doc_id is not null").distinct()
    assert [r["doc_id"] for r in smallest(df, 50).collect()] == [r["doc_id"] for r in known.select("doc_id").distinct().orderBy(*order).limit(50).collect()]
    for kind in (True, False):
        want = {r["doc_id"] for r in known.where(F.col("kind") == kind).orderBy(*order).limit(50).collect()}
        assert {r["doc_id"] for r in smallest(df, 50, "kind").where(F.col("kind") == kind).collect()} == want
    assert smallest(df.limit(0), 50).count() == smallest(df.limit(0), 50, "kind").count() == 0


TRICKY = ["", " ", "It's THE end, don't 'll we'd 12ab3 _x_ a--b c…d", "Ünïcode Straße İstanbul ŉ ß ſ", "日本語 テキスト", "a<|endoftext|>b <|x", "é Å  x y", "\x00\x01 z​", "😀😀 ok", "ÀÉ ŸŽ µ ª²³¹º¼", "a\x0bb\x0cc\x1cd\x85e"]


def test_tokens_are_those_of_the_library(rows):
    whole, mine = Tokenizer.from_file(vocabulary()), WordTokenizer(vocabulary())
    for text in TRICKY + [r["text"] or "" for r in rows[:400]]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids)}I", mine.ids(text))) == ids, text[:80]


def check_pack(got, texts, slack):
    """Every id of every row in exactly one piece; sequences without gaps; padding only in the last one."""
    whole = Tokenizer.from_file(vocabulary())
    want = defaultdict(list)
    for d, t in texts:
        want[d].append(whole.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for d, docs in want.items():
        assert {r["doc_tokens"] for r in by_doc[d]} == {len(x) for x in docs}
        if len(docs) > 1:
            continue
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            part = docs[0][at : at + r["length"]]
            assert r["start"] == at and len(part) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(docs[0])
    assert sorted(by_seq) == list(range(len(by_seq)))
    short = 0
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        short += at < 2048
    assert short <= slack
    assert sum(r["length"] for r in got) == sum(len(x) for docs in want.values() for x in docs)


def test_packing(spark, sf, rows):
    check_pack(Q.op8_packing(spark, sf).collect(), [(r["doc_id"], r["text"]) for r in rows], 1)


def test_packing_of_odd_rows(odd, odd_rows, none):
    check_pack(packing.pack(odd, vocabulary()).collect(), [(d, t) for d, t, _ in odd_rows], 1)
    assert packing.pack(none, vocabulary()).count() == 0


def test_combinations_fill_the_window():
    combos = packing.combinations(8)
    assert all(sum(c) == 8 and 2 <= len(c) <= 4 for c in combos) and len(set(combos)) == len(combos)
    assert (4, 4) in combos and (5, 1, 1, 1) in combos and (7, 1) in combos


@pytest.mark.parametrize("seed", range(5))
def test_least_squares_and_rounding(seed):
    draw = np.random.Generator(np.random.PCG64(seed))
    a, b = draw.random((12, 30)), draw.normal(size=12)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6  # the optimum's conditions
    combos, have = packing.combinations(16), draw.integers(0, 60, 17)
    have[[0, 16]] = 0
    n = packing.repeats(have, combos)
    used = np.zeros(17, np.int64)
    for c, k in zip(combos, n.tolist(), strict=True):
        for u in c:
            used[u] += k
    left = have - used
    assert (n >= 0).all() and (left >= 0).all()
    assert not any(all(left[u] >= c.count(u) for u in c) for c in combos)  # no window could still be filled
