"""Every query of the library by name, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrolite.plans import composition, curation, identity, jobs, numerics, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _part in (composition, identity, runs, numerics, jobs, curation):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
