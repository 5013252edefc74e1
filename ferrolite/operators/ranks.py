"""Exact ranks of large columns without a sort: counts over ranges that narrow round by round.

A round deals each open range into ``BINS`` equal parts and counts the rows of every part, combined before they are
moved; a rank's next range is the one from the smallest to the largest value of the part that it falls into. A range is
done when one value is all that is left of it, or when its rows are so few that they can be sorted as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.sources.scratch import stash

#: Parts of a range, rows (different values of a group, if weighted) that are sorted as one array, and ranges up to which
#: they are broadcast.
BINS, SMALL, BROADCAST_RANGES = 1024, 4096, 100_000


def _part(x: Column, lo: Column, hi: Column) -> Column:
    """The part of [lo, hi] that ``x`` lies in; halves keep the width finite, infinite ends are parts of their own."""
    at = F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2) * BINS
    inner = F.when(F.isnan(at) | at.isNull(), 1).otherwise(F.least(F.greatest(F.floor(at), F.lit(0)), F.lit(BINS - 1)))
    return F.when(x >= hi, BINS).when(x <= lo, 0).otherwise(inner).cast("int")


def at_ranks(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """g, t, x: the value of each wanted rank (g, t, rank from 0) among the rows (g, x double, w bigint, how often).

    Values are those in ascending order, without nulls and NaN; a rank outside of its group has no row.
    """
    held = stash(rows.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.col("w") > 0)).select("g", "x", "w"))
    whole = held.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows"))
    ranges = stash(wanted.join(whole, "g").where("rank >= 0 and rank < n").select("g", "t", "rank", "lo", "hi", "rows"))
    open_ = (F.col("lo") < F.col("hi")) & (F.col("rows") > SMALL)
    while ranges.where(open_).take(1):
        asked = ranges.where(open_).select("g", "lo", "hi").distinct()
        few = asked.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES
        inside = held.join(F.broadcast(asked) if few else asked, "g").where("x >= lo and x <= hi")
        counts = inside.groupBy("g", "lo", "hi", _part(F.col("x"), F.col("lo"), F.col("hi")).alias("part")).agg(
            F.min("x").alias("a"), F.max("x").alias("b"), F.sum("w").alias("n"), F.count(F.lit(1)).alias("part_rows")
        )
        before = Window.partitionBy("g", "lo", "hi").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        counts = stash(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
        found = ranges.where(open_).drop("rows").join(counts, ["g", "lo", "hi"]).where("rank >= before and rank < before + n")
        found = found.select("g", "t", (F.col("rank") - F.col("before")).alias("rank"), F.col("a").alias("lo"), F.col("b").alias("hi"), F.col("part_rows").alias("rows"))
        ranges = stash(ranges.where(~open_).union(found))
    done = ranges.where("lo = hi").select("g", "t", F.col("lo").alias("x"))
    short = ranges.where("lo < hi")
    asked = short.select("g", "lo", "hi").distinct()
    few = asked.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES
    inside = held.join(F.broadcast(asked) if few else asked, "g").where("x >= lo and x <= hi")
    order = Window.partitionBy("g", "lo", "hi").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    values = inside.groupBy("g", "lo", "hi", "x").agg(F.sum("w").alias("w")).withColumn("to", F.sum("w").over(order))  # SMALL rows of a range at most
    picked = short.join(values, ["g", "lo", "hi"]).where(F.col("to") > F.col("rank")).groupBy("g", "t").agg(F.min("x").alias("x"))
    return done.union(picked)


def percentiles(rows: DataFrame, value: str, fractions: dict[str, float], by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """``by`` and one column for each fraction: exact percentiles, linear between neighbours, as ``percentile`` has them.

    Nulls and NaN are left out; a group without values has no row. ``weight`` says how often a row counts.
    """
    g = F.struct(*by) if by else F.lit(0)
    held = stash(rows.select(g.alias("g"), F.col(value).cast("double").alias("x"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w")))
    sizes = held.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("g").agg(F.sum("w").alias("n"))
    spots = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(f)).alias("f")) for name, f in fractions.items()])).alias("s")
    at = (F.col("n") - 1) * F.col("s.f")
    ends = F.explode(F.array(F.struct(F.lit("a").alias("end"), F.floor(at).alias("rank")), F.struct(F.lit("b").alias("end"), F.ceil(at).alias("rank")))).alias("e")
    wanted = stash(sizes.select("g", "n", spots).select("g", F.col("s.name").alias("name"), at.alias("at"), ends))
    found = at_ranks(held, wanted.select("g", F.struct("name", "e.end").alias("t"), F.col("e.rank").alias("rank")))
    values = found.select("g", F.col("t.name").alias("name"), F.col("t.end").alias("end"), "x").groupBy("g", "name").agg(
        F.max(F.when(F.col("end") == "a", F.col("x"))).alias("a"), F.max(F.when(F.col("end") == "b", F.col("x"))).alias("b")
    )
    spot = wanted.where("e.end = 'a'").select("g", "name", "at", F.col("e.rank").cast("double").alias("low"))
    linear = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.col("low") + 1 - F.col("at")) * F.col("a") + (F.col("at") - F.col("low")) * F.col("b"))
    named = values.join(spot, ["g", "name"]).groupBy("g").agg(*[F.max(F.when(F.col("name") == name, linear)).alias(name) for name in fractions])
    return named.select(*[F.col(f"g.{c}").alias(c) for c in by], *fractions)


def largest(rows: DataFrame, k: int, value: str = "distance", key: str = "id") -> DataFrame:
    """The ``k`` rows of largest ``value``, ties to the smaller ``key`` (bigint, without repeats); all, if they are fewer.

    The k-th row is found by ranks and the others by comparison with it, so nothing is sorted or gathered, however
    large ``k`` is. Rows without a value take no part. ``rows`` is read several times: cut its lineage before.
    """
    x, i = F.col(value).cast("double"), F.col(key)
    there = rows.where(x.isNotNull() & ~F.isnan(x))
    n = there.count()
    if k <= 0 or k >= n:
        return there if k > 0 else there.limit(0)

    def one(column: Column, which: DataFrame, rank: int) -> float:
        asked = rows.sparkSession.createDataFrame([(0, 0, rank)], "g int, t int, rank bigint")
        return at_ranks(which.select(F.lit(0).alias("g"), column.cast("double").alias("x"), F.lit(1).cast("bigint").alias("w")), asked).first()["x"]

    least = one(x, there, n - k)
    above, equal = there.where(x > least), there.where(x == least)
    left = k - above.count()
    if left >= equal.count():
        return there.where(x >= least)
    # Keys beyond 2^53 are no exact floating-point numbers: first their upper, then their lower 32 bits.
    high = int(one(F.shiftright(i, 32), equal, left - 1))
    rest = left - equal.where(F.shiftright(i, 32) < high).count()
    low = int(one(i.bitwiseAND(F.lit(2**32 - 1)), equal.where(F.shiftright(i, 32) == high), rest - 1))
    return there.where((x > least) | ((x == least) & (i <= high * 2**32 + low)))
