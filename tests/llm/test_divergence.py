"""Operator 11 against its SQL and a plain version."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ferrolite.llm import divergence as D
from ferrolite.llm import queries as Q

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, ranks=10):
    """rows: (text, lang, source)."""
    rows = [(t or "", a or "", b or "") for t, a, b in rows]
    count, docs = Counter(), Counter()
    for t, a, b in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(UPPER))
        count.update((a, b, x) for x in terms)
        docs.update((a, x) for x in set(terms))
    out = []
    groups = {(a, b) for _, a, b in rows}
    for lang in {a for a, _ in groups}:
        kept = sorted(x for (a, x), n in docs.items() if a == lang and n >= least)
        sources = sorted(b for a, b in groups if a == lang)
        v = len(kept)

        def shares(counts):
            total = sum(counts)
            return [1 + 1_000_000_000 * (c + 2) // (total + 2 * v) for c in counts]

        q = shares([sum(count[lang, b, x] for b in sources) for x in kept])
        p = {b: shares([count[lang, b, x] for x in kept]) for b in sources}
        for b in sources:
            pair = [(-sum((x - y) ** 2 // (x + y) for x, y in zip(p[b], p[o], strict=True)), o) for o in sources if o != b]
            term = [(-((x - y) ** 2 // (x + y)), t) for t, x, y in zip(kept, p[b], q, strict=True) if count[lang, b, t] and x > y]
            for part, found, most in (("pair", pair, None), ("term", term, ranks)):
                found = sorted(found, key=lambda r: (r[0], r[1].encode()))[:most]
                out += [(lang, b, part, item, -value, n + 1) for n, (value, item) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def test_query_equals_sql_and_plain_version(spark, sf, rows):
    found = got(Q.op11_source_divergence(spark, sf))
    assert found == brute([(r["text"], r["lang"], r["source"]) for r in rows])
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(con.sql(f"select lang, source, part, item, value, rank from ({Q.ORACLES['op11_source_divergence']})").fetchall()) == found


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_odd_rows(spark, piece):
    """Nulls, empty texts, repeated rows, groups without terms, ties, long texts in pieces, letters beyond ASCII and beyond 16 bits."""
    rows = [("The the THE cat", "en", "a"), ("The the THE cat", "en", "a"), (None, "en", None), ("", None, None), ("dog cat é É İ", "en", "b"), ("\U0001f600\U0001f601 x\x00y K[z]", "en", "b"), ("123 !?", "fr", "c"), ("", "fr", "d"), ("only", "es", "e")]
    rows += [("xyz" * 5 + " " + "ab " * 30 + "é" * 40, "en", "a"), ("ab xyz cat", "en", "c"), ("ab xyz cat", "en", None), ("b a", "de", "s"), ("a b", "de", "t")]
    df = spark.createDataFrame([(1, *r) for r in rows], "doc_id bigint, text string, lang string, source string").repartition(3)
    df = df.select("*", *[F.lit(7).alias(c) for c in ("term", "n", "p", "q", "number", "salt", "docs", "kept", "rank")])
    for least in (1, 2, 3):
        assert got(D.audit(df, least_docs=least, piece=piece)) == brute(rows, least)


def test_long_terms_and_texts_in_pieces(spark):
    text = "a" * 5000 + " b" * 4000 + " " + "c" * 9000
    rows = [(text, "x", "s"), ("b c", "x", "t")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    counts = {(r["source"], r["term"][:2]): (r["occurrences"], r["docs"]) for r in D.term_counts(df, piece=1000).collect()}
    assert counts == {("s", "aa"): (1, 1), ("s", "b"): (4000, 1), ("s", "cc"): (1, 1), ("t", "b"): (1, 1), ("t", "c"): (1, 1)}


def test_counts_beyond_ten_to_the_tenth(spark):
    n = 10**15
    row = spark.sql(f"select {n}L as c, {3 * n}L as t, 5L as v").select(D.share(F.col("c"), F.col("t"), F.col("v")).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 2) // (3 * n + 10)


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
