"""Settings against rules: both are tables, and what is wrong comes out as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "key string, kind string, low double, low_open boolean, high double, high_open boolean, allowed array<string>, required boolean"

# The settings that are checked, and their ranges.
RULES = [
    ("composition_aware_fps_frontier_fraction", "number", 0.0, True, 1.0, False, None, False),
    ("composition_aware_fps_ternary_weight", "number", 0.0, False, None, None, None, False),
    ("composition_aware_fps_adaptive_retries", "whole", 1.0, False, None, None, None, False),
    ("composition_aware_fps_descriptor_floor_fraction", "number", 0.0, True, 1.0, False, None, False),
    ("target_n_atoms", "whole", 1.0, False, None, None, None, True),
]


def rules(spark: SparkSession, rows: list[tuple] | None = None, lists: dict[str, tuple[list[str], bool]] | None = None) -> DataFrame:
    """A table of rules: ranges of numbers, and for each key of ``lists`` the allowed items of a comma-separated list and
    whether it must have one."""
    every = list(RULES if rows is None else rows) + [(k, "list", None, None, None, None, items, needed) for k, (items, needed) in (lists or {}).items()]
    return spark.createDataFrame(every, RULE)


def violations(settings: DataFrame, rules: DataFrame) -> DataFrame:
    """run, key, value, reason of each setting (run, key, value string) that breaks its rule, and of each required key that
    a run lacks (value null); settings without a rule are free.

    missing: null or blank where a value is required; not a number; not a whole number; below or above the range; unknown
    item: an item of a list is not allowed, whatever its case. An optional blank value is none.
    """
    rule = F.broadcast(rules)  # a rule for each key that is known
    text = F.trim(F.coalesce("value", F.lit("")))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    items = F.filter(F.transform(F.split(text, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    known = F.transform("allowed", lambda x: F.lower(x))
    is_list = F.col("kind") == "list"
    blank = F.when(is_list, F.size(items) == 0).otherwise(text == "")
    reason = (
        F.when(blank, F.when(F.col("required"), "missing"))
        .when(is_list, F.when(F.size(F.array_except(items, known)) > 0, "unknown item"))
        .when(number.isNull(), "not a number")
        .when((F.col("kind") == "whole") & (number != F.floor(number)), "not a whole number")
        .when((number < F.col("low")) | (F.coalesce("low_open", F.lit(False)) & (number == F.col("low"))), "below the range")
        .when((number > F.col("high")) | (F.coalesce("high_open", F.lit(False)) & (number == F.col("high"))), "above the range")
    )
    wrong = settings.join(rule, "key").select("run", "key", "value", reason.alias("reason")).where("reason is not null")
    needed = settings.select("run").distinct().join(F.broadcast(rules.where("required").select("key")), F.lit(True))
    lacking = needed.join(settings.select("run", "key").distinct(), ["run", "key"], "left_anti")
    return wrong.union(lacking.select("run", "key", F.lit(None).cast("string").alias("value"), F.lit("missing").alias("reason")))


def normalised_list(value, known: list[str]):
    """A comma-separated list as its known items in their own spelling, in the list's order; null if one is unknown."""
    names = F.array(*[F.lit(k) for k in known])
    items = F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")
    low = F.transform(names, lambda x: F.lower(x))
    found = F.transform(items, lambda x: F.get(names, (F.array_position(low, F.lower(x)) - 1).cast("int")))
    return F.when(~F.exists(found, lambda x: x.isNull()), F.array_join(found, ","))
