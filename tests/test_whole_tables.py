"""Queries read whole tables: each against its registered SQL without the filter that leaves rows out."""

from __future__ import annotations

import pytest

from ferrolite.plans import catalog
from test_queries import SF, con  # noqa: F401

EVENTS = "WHERE event_type IN ('signup', 'view', 'click') OR event_id % 9 = 0"
FILTERS = {"job_state_machine": EVENTS, "job_status_tally": EVENTS, "job_progress": EVENTS, "event_windows": EVENTS}
FILTERS |= {"missing_dimension": " WHERE s_suppkey < 20", "strain_voigt": "WHERE p_size <= 10", "config_pivot": "WHERE n_atoms <= 32 OR ncore < 16"}


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_no_row_is_left_out(spark, con, tmp_path, name):  # noqa: F811
    out = str(tmp_path / "out")
    catalog.QUERIES[name](spark, SF).write.parquet(out)
    pick = ", ".join(f'"{c}"' for c in sorted(con.sql(f"select * from '{out}/*.parquet'").columns))
    left, right = f"select {pick} from '{out}/*.parquet'", f"select {pick} from ({catalog.ORACLES[name].replace(FILTERS[name], '')})"
    assert con.sql(f"({left}) except all ({right})").fetchall() == []
    assert con.sql(f"({right}) except all ({left})").fetchall() == []


def test_suppliers_beyond_twenty_count(spark, tmp_path):
    supplier, part = str(tmp_path / "supplier.parquet"), str(tmp_path / "part.parquet")
    spark.createDataFrame([(1, 1), (30, 2)], "s_suppkey bigint, s_nationkey int").write.parquet(supplier)
    spark.createDataFrame([("Brand#1",), ("Brand#2",), ("Brand#3",)], "p_brand string").write.parquet(part)
    assert [r["element"] for r in catalog.QUERIES["missing_dimension"](spark, str(tmp_path)).collect()] == ["Brand#3"]
