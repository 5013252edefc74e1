"""Compositions as columns: fractions, element subsets, bins on the unit interval and on the ternary simplex."""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDGE = 1e-12


def normalised(composition: Column) -> Column:
    """A map of element to amount: non-positive and null amounts dropped, shares that add up to 1, keys in order.

    Null if nothing positive is left.
    """
    kept = F.map_filter(composition, lambda k, v: v.isNotNull() & (v > 0))
    total = F.aggregate(F.map_values(kept), F.lit(0.0), lambda a, x: a + x)
    entries = F.array_sort(F.map_entries(F.transform_values(kept, lambda k, v: v / total)))
    return F.when(F.size(kept) > 0, F.map_from_entries(entries))


def single_element(composition: Column, symbols: Column) -> Column:
    """Exactly one positive share; without any, exactly one distinct symbol."""
    positive = F.size(F.map_filter(composition, lambda k, v: v > 0))
    return F.when(F.coalesce(positive, F.lit(0)) > 0, positive == 1).otherwise(F.coalesce(F.size(F.array_distinct(symbols)) == 1, F.lit(False)))


def element_counts(atoms: DataFrame) -> DataFrame:
    """(structure_index, element, n_atoms) rows, summed; amounts of zero or less do not count."""
    return atoms.where("n_atoms > 0").groupBy("structure_index", "element").agg(F.sum("n_atoms").alias("n_atoms"))


def per_structure(counts: DataFrame) -> DataFrame:
    """One row for each structure with ``entries``, its (element, n_atoms) in element order, and ``total``."""
    entry = F.struct("element", "n_atoms")
    return counts.groupBy("structure_index").agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.sum("n_atoms").alias("total"))


def pairs(structures: DataFrame) -> DataFrame:
    """A row for each structure and pair a < b of its elements: n_a, n_b, and b's share among the two.

    Subsets come from a structure's own array, so they take no join.
    """
    both = F.expr(
        "flatten(transform(entries, (a, i) -> transform(slice(entries, i + 2, greatest(size(entries) - i - 1, 0)), b -> struct(a.element as a, b.element as b, a.n_atoms as n_a, b.n_atoms as n_b))))"
    )
    rows = structures.select("structure_index", "total", F.size("entries").alias("n_elements"), F.explode(both).alias("s")).select("structure_index", "total", "n_elements", "s.*")
    return rows.withColumn("b_share", F.col("n_b") / (F.col("n_a") + F.col("n_b")))


def triples(structures: DataFrame) -> DataFrame:
    """A row for each structure and triple a < b < c of its elements, with their counts."""
    every = F.expr(
        """flatten(flatten(transform(entries, (a, i) -> transform(slice(entries, i + 2, greatest(size(entries) - i - 1, 0)), (b, j) ->
           transform(slice(entries, i + j + 3, greatest(size(entries) - i - j - 2, 0)),
           c -> struct(a.element as a, b.element as b, c.element as c, a.n_atoms as n_a, b.n_atoms as n_b, c.n_atoms as n_c))))))"""
    )
    return structures.select("structure_index", F.explode(every).alias("s")).select("structure_index", "s.*")


def unit_bin(value: Column, bins: int) -> Column:
    """Bin of a value clamped to [0, 1]; what lies within 1e-12 of 1 is in the last one."""
    v = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
    return F.when(v >= 1 - EDGE, F.lit(bins - 1)).otherwise(F.least(F.floor(v * bins), F.lit(bins - 1))).cast("int")


def largest_remainder(values: list[Column], total: int) -> list[Column]:
    """Whole numbers that add up to ``total``, near ``values`` that do: all rounded down, then one more for the largest
    remainders, the earlier position first among equals."""
    floors = [F.floor(v) for v in values]
    rests = [v - f for v, f in zip(values, floors, strict=True)]
    left = F.lit(total) - sum(floors[1:], floors[0])
    out = []
    for i, f in enumerate(floors):
        ahead = F.lit(0)
        for j in range(len(values)):
            if j != i:
                ahead = ahead + F.when(rests[j] >= rests[i] if j < i else rests[j] > rests[i], 1).otherwise(0)
        out.append((f + F.when(ahead < left, 1).otherwise(0)).cast("int"))
    return out


def ternary_cell(n_a: Column, n_b: Column, n_c: Column, resolution: int) -> list[Column]:
    """Cell (i, j, k), i + j + k = resolution, of the barycentric point of three counts."""
    s = n_a + n_b + n_c
    return largest_remainder([n * resolution / s for n in (n_a, n_b, n_c)], resolution)


def ternary_cells(resolution: int) -> int:
    return (resolution + 1) * (resolution + 2) // 2


def cartesian(b: Column, c: Column) -> tuple[Column, Column]:
    """Plane coordinates of a barycentric point (a, b, c)."""
    return b + c / 2, c * F.lit(3.0**0.5 / 2)


def deficit_reward(count: Column, total: Column, bins: int) -> Column:
    """How far a bin is below one more than the even share, from 0 to 1."""
    target = F.greatest(F.lit(1), F.floor(total / bins) + 1)
    return F.greatest(F.lit(0), target - count) / target


@F.pandas_udf(T.StringType())
def _labels(names: pd.Series, shares: pd.Series) -> pd.Series:
    return pd.Series(["-".join(k if v == 1 else f"{k}{v:.2g}" for k, v in zip(n, s, strict=True)) if n is not None else None for n, s in zip(names, shares, strict=True)], dtype=object)


def label(composition: Column) -> Column:
    """Elements by falling share, ties by name, joined by -: each with its share to two significant digits, but the bare
    name at 1. Digits are those of C's %.2g, which no built-in function rounds alike, hence the Arrow function."""
    entries = F.array_sort(F.transform(F.map_entries(composition), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k"))))
    return _labels(F.transform(entries, lambda e: e["k"]), F.transform(entries, lambda e: -e["s"]))


@F.pandas_udf(T.StringType())
def fraction_label(values: pd.Series) -> pd.Series:
    """p/q where a fraction of a denominator up to a million is within 1e-12, six decimals otherwise."""
    out = []
    for v in values:
        f = Fraction(v).limit_denominator() if v is not None and math.isfinite(v) else None
        out.append(None if f is None else f"{f.numerator}/{f.denominator}" if abs(float(f) - v) <= 1e-12 else f"{v:.6f}")
    return pd.Series(out, dtype=object)


def bin_centre(bin_: Column, bins: int) -> Column:
    return (bin_ + 0.5) / bins


def ternary_centre(i: Column, j: Column, k: Column, resolution: int) -> list[Column]:
    """Barycentric coordinates of a cell."""
    return [x / F.lit(float(resolution)) for x in (i, j, k)]
