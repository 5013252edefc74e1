"""Every query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from ferrolite.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, tmp_path, name):
    out = str(tmp_path / "out")
    catalog.QUERIES[name](spark, SF).write.parquet(out)
    got = con.sql(f"select * from '{out}/*.parquet'")
    columns = sorted(got.columns)
    if name not in catalog.ORACLES:
        assert con.sql(f"select count(*) from '{out}/*.parquet'").fetchall()[0][0] > 0
        return
    pick = ", ".join(f'"{c}"' for c in columns)
    assert columns == sorted(con.sql(catalog.ORACLES[name]).columns)
    left, right = f"select {pick} from '{out}/*.parquet'", f"select {pick} from ({catalog.ORACLES[name]})"
    assert con.sql(f"({left}) except all ({right})").fetchall() == []
    assert con.sql(f"({right}) except all ({left})").fetchall() == []


def test_every_query_has_sql_or_is_known_not_to():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"pca_2d", "composition_aware_selection", "interstitials", "displaced_structures", "quasi_random_structures"}
