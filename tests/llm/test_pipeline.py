"""The pipeline's stages: columns, what goes and what stays, and run() against the stages one by one."""

from __future__ import annotations

import corpus_pipeline as P
import pytest

from ferrolite.llm import decontaminate, quality, secrets
from ferrolite.llm import queries as Q
from ferrolite.llm.common import fold
from ferrolite.llm.tokens import vocabulary
from ferrolite.llm import packing
from test_near_duplicates import brute


@pytest.fixture(scope="module")
def outcome(spark, docs, sf, tmp_path_factory):
    """Rows of each stage's input, and of the last one's result."""
    out, now = [], docs
    for k, (_, stage) in enumerate(P.STAGES):
        out.append(now)
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, now, sf).write.parquet(path)
        now = spark.read.parquet(path)
    return [*out, now]


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(docs, outcome):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "packing"]
    assert all(df.dtypes == docs.dtypes for df in outcome[:-1])


def test_each_stage_on_its_own_input(spark, sf, outcome):
    from pyspark.sql import functions as F

    net = quality.fit(outcome[0], spark.read.parquet(f"{sf}/labels.parquet"), fold(F.col("doc_id"), 3) != 1)
    assert ids(outcome[1]) == ids(quality.score(outcome[0], net).where("score >= 0.5"))
    classes = brute({r["doc_id"]: r["text"] for r in outcome[1].collect()})
    assert ids(outcome[2]) == {d for d, (_, c) in classes.items() if d == c}
    held = ids(decontaminate.matches(outcome[2], spark.read.parquet(f"{sf}/benchmark.parquet")))
    assert held and ids(outcome[3]) == ids(outcome[2]) - held
    assert ids(outcome[4]) == ids(outcome[3])
    model = secrets.fit(outcome[3])
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(outcome[3], model).collect()}
    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in outcome[3:5])
    assert any(spans.values())
    assert all(bool(spans[d]) == (before[d] != after[d]) and after[d].count("[secret]") <= before[d].count("[secret]") + len(spans[d]) for d in before)
    assert all(before[d][s["start"] : s["end"]] not in after[d] or before[d].count(before[d][s["start"] : s["end"]]) > 1 for d in before for s in spans[d] if s["kind"] == "access")


def test_clean_documents_stay(spark, sf, outcome):
    """Of the documents labelled 1, learnt from or not, few go in the first stage."""
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["quality"] == 1} & ids(outcome[0])
    assert len(good & ids(outcome[1])) >= 0.95 * len(good)


def test_run_gives_the_same(spark, sf, outcome):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = lambda df: df.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    got = P.run(spark, sf)
    assert set(columns) <= set(got.columns) and sorted(total(got), key=str) == sorted(total(outcome[-1]), key=str)


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows_in_every_stage(spark, sf, request, which):
    df = request.getfixturevalue(which)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns, name
        assert out.count() <= df.count()
    assert packing.pack(df, vocabulary()).count() >= df.count()


def test_repeated_rows_are_one_document(spark, make, sf):
    rows = [(1, "one text of these documents that is here several times over", None)] * 3 + [(2, "another text of its own that nothing else is like at all", None)] * 2 + [(None, "no id", None)] * 2
    left = sorted(r["doc_id"] or 0 for r in P.keep_one_of_each(spark, make(rows), sf).collect())
    assert left == [0, 0, 1, 2]


def test_registered():
    import __spark_entry__ as entry

    assert {k.split("_")[0] for k in Q.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert {*Q.QUERIES, "pipeline"} <= set(entry.queries()) and "pipeline" not in entry.oracle_sql()
