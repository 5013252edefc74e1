"""How evenly structures cover composition space: histograms and their statistics for each subset of elements."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.functions.composition import cartesian, ternary_cell, unit_bin
from ferrolite.operators import ranks
from ferrolite.sources.scratch import stash


def fractions(counts: DataFrame) -> DataFrame:
    """structure_index, element, n_atoms, fraction."""
    whole = Window.partitionBy("structure_index")
    return counts.withColumn("fraction", F.col("n_atoms") / F.sum("n_atoms").over(whole))


def binary_bins(pairs: DataFrame, bins: int) -> DataFrame:
    """a, b, bin, n: occupied bins only. Combined before the shuffle, so popular pairs cost no more than others."""
    return pairs.groupBy("a", "b", unit_bin(F.col("b_share"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def ternary_bins(triples: DataFrame, resolution: int) -> DataFrame:
    """a, b, c, i, j, k, n: occupied cells only."""
    cells = [x.alias(n) for n, x in zip("ijk", ternary_cell(F.col("n_a"), F.col("n_b"), F.col("n_c"), resolution), strict=True)]
    return triples.select("a", "b", "c", *cells).groupBy("a", "b", "c", "i", "j", "k").agg(F.count(F.lit(1)).alias("n"))


def summary(histogram: DataFrame, keys: list[str], total_bins: int) -> DataFrame:
    """For each subset: structures, occupied bins and their share, normalised entropy, largest share, Gini coefficient.

    ``histogram`` has the occupied bins; the empty ones enter the Gini coefficient by their number: in rising order
    they come first and weigh nothing, so only the ranks of the others shift.
    """
    size = Window.partitionBy(*keys)
    ranked = histogram.withColumn("rank", F.row_number().over(size.orderBy("n")) + F.lit(total_bins) - F.count(F.lit(1)).over(size)).withColumn("all", F.sum("n").over(size))
    p = F.col("n") / F.col("all")
    entropy = F.sum(-p * F.ln(p)) / F.ln(F.lit(float(max(total_bins, 2))))
    gini = F.sum((2 * F.col("rank") - total_bins - 1) * F.col("n")) / (F.lit(total_bins) * F.max("all"))
    return ranked.groupBy(*keys).agg(
        F.sum("n").alias("structure_count"),
        F.count(F.lit(1)).alias("occupied_bins"),
        F.round(F.count(F.lit(1)) / total_bins, 9).alias("occupied_fraction"),
        F.round(entropy, 9).alias("normalized_entropy"),
        F.round(F.max("n") / F.max("all"), 9).alias("max_bin_fraction"),
        F.round(gini, 9).alias("gini"),
    )


#: Parts of the line in which shares are put in order; only the parts' ends meet those of other parts.
LINE_PARTS = 1024


def _spread(near: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, nn_mean, nn_p95 of distances ``d`` that occur ``n`` times each; exact percentiles without a sort."""
    near = stash(near.select(*keys, "d", "n"))
    known = F.when(F.col("d").isNotNull(), F.col("n"))
    means = near.groupBy(*keys).agg(F.sum("n").alias("n"), F.round(F.sum(F.col("d") * F.col("n")) / F.sum(known), 9).alias("nn_mean"))
    p95 = ranks.percentiles(near, "d", {"p95": 0.95}, tuple(keys), "n")
    return means.join(p95, keys, "left").select(*keys, "n", "nn_mean", F.round("p95", 9).alias("nn_p95"))


def line_distances(pairs: DataFrame, parts: int = LINE_PARTS) -> DataFrame:
    """a, b, n, nn_mean, nn_p95: distance of each structure's share to the nearest other one's in the same pair.

    On a line the nearest is a neighbour in order. Equal shares are one row with a count first; structures that share
    a value are at distance 0. Shares are ordered within parts of the line, and a part's ends meet those of the parts
    next to it, so that no pair is ordered in one task. Null for a pair with a single structure.
    """
    values = pairs.groupBy("a", "b", "b_share").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.floor(F.col("b_share") * parts))
    values = stash(values)
    ends = values.groupBy("a", "b", "part").agg(F.min("b_share").alias("first"), F.max("b_share").alias("last"))
    line = Window.partitionBy("a", "b").orderBy("part")
    ends = ends.select("a", "b", "part", F.lag("last").over(line).alias("below"), F.lead("first").over(line).alias("above"))
    order = Window.partitionBy("a", "b", "part").orderBy("b_share")
    near = values.join(ends, ["a", "b", "part"])
    before, after = F.coalesce(F.lag("b_share").over(order), F.col("below")), F.coalesce(F.lead("b_share").over(order), F.col("above"))
    gap = F.least(F.col("b_share") - before, after - F.col("b_share"))
    return _spread(near.withColumn("d", F.when(F.col("n") > 1, F.lit(0.0)).otherwise(gap)), ["a", "b"])


#: Different points of a tile at most, and points that a tile of the first grid has on average.
BLOCK, SPARSE = 1024, 256


def _tiles(points: DataFrame, keys: list[str], block: int) -> DataFrame:
    """``points`` (keys, x, y of [0, 1], n) with their cell (w wide, gx, gy) of the subset's first grid and their ``tile`` in it.

    The grid has as many cells as the subset's number of points asks for; a cell that holds more than ``block`` of them is
    cut into eight by eight, and so on, so that points that crowd do not share a tile.
    """
    sizes = points.groupBy(*keys).agg(F.greatest(F.lit(1.0), F.ceil(F.sqrt(F.count(F.lit(1)) / min(SPARSE, block)))).cast("double").alias("g"))
    found = points.join(sizes, keys).withColumn("w", 1 / F.col("g")).withColumn("gx", F.floor(F.col("x") / F.col("w"))).withColumn("gy", F.floor(F.col("y") / F.col("w")))
    placed = stash(found.select(*points.columns, "w", "gx", "gy", F.xxhash64("gx", "gy").alias("tile"), F.col("w").alias("side")))
    while True:
        full = stash(placed.groupBy(*keys, "tile").agg(F.count(F.lit(1)).alias("held"), F.min("side").alias("least")).where((F.col("held") > block) & (F.col("least") > 1e-15)).select(*keys, "tile", F.lit(True).alias("full")))
        if not full.take(1):
            return placed
        part = F.col("side") / 8
        marked = placed.join(full, [*keys, "tile"], "left").withColumn("tile", F.when(F.col("full"), F.xxhash64("tile", F.floor(F.col("x") / part), F.floor(F.col("y") / part))).otherwise(F.col("tile")))
        placed = stash(marked.withColumn("side", F.when(F.col("full"), part).otherwise(F.col("side"))).select(placed.columns))


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The distance of each of ``p`` to the nearest of ``q`` that is another point; infinite without any."""
    d = np.empty(len(p))
    for k in range(len(p)):
        apart = np.sqrt(((q - p[k]) ** 2).sum(axis=1))
        d[k] = apart[apart > 0].min(initial=np.inf)
    return d


def plane_distances(triples: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b, c, n, nn_mean, nn_p95: distance of each structure's point in the triangle to the nearest other one's.

    Equal points are one row with a count first, at distance 0. The others look for their nearest in their own tile, and
    those that a nearer one may await elsewhere visit the tiles within the distance that they have found by then: a
    point is moved some few times, however many there are. Null for a subset with a single structure.
    """
    keys, s = ["a", "b", "c"], F.col("n_a") + F.col("n_b") + F.col("n_c")
    x, y = cartesian(F.col("n_b") / s, F.col("n_c") / s)
    points = stash(triples.select(*keys, x.alias("x"), y.alias("y")).groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("n")))
    placed = _tiles(points, keys, block)

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf[["x", "y"]].to_numpy()
        return pdf.assign(d=_apart(p, p))

    # A point that occurs more than once is at distance 0 and looks for nothing.
    home = stash(placed.groupBy(*keys, "tile").applyInPandas(near, ", ".join(f"{c} {t}" for c, t in placed.dtypes) + ", d double"))
    ends = [f(c).alias(f"{c}{k}") for c in "xy" for k, f in ((0, F.min), (1, F.max))]
    outlines = stash(home.groupBy(*keys, "tile").agg(F.first("gx").alias("gx"), F.first("gy").alias("gy"), *ends))
    low, high, w = F.col("d") * (1 + 1e-9), F.col("d"), F.col("w")
    asking = home.where("n = 1").select(*keys, "x", "y", "d", "w", "tile")
    # Distances to the nearest and the farthest place of an outline.
    sides = [F.greatest(F.col(f"{c}0") - F.col(c), F.col(c) - F.col(f"{c}1"), F.lit(0.0)) for c in "xy"]
    spans = [F.greatest(F.abs(F.col(f"{c}0") - F.col(c)), F.abs(F.col(f"{c}1") - F.col(c))) for c in "xy"]
    inside, reach = F.sqrt(sides[0] * sides[0] + sides[1] * sides[1]), F.sqrt(spans[0] * spans[0] + spans[1] * spans[1])
    theirs = outlines.withColumnRenamed("tile", "other")
    # Those with a neighbour within a cell's width meet the cells around them, the few others all outlines of their subset.
    cells = [F.sequence(F.floor((F.col(c) - low) / w), F.floor((F.col(c) + low) / w)) for c in "xy"]
    around = asking.where(high <= w).withColumn("gx", F.explode(cells[0])).withColumn("gy", F.explode(cells[1])).join(theirs, [*keys, "gx", "gy"])
    lone = asking.where(high > w)
    bound = lone.toDF(*lone.columns).join(theirs.toDF(*theirs.columns), keys).where("other <> tile").groupBy(*keys, "x", "y").agg(F.min(reach).alias("most"))
    alone = lone.join(bound, [*keys, "x", "y"]).withColumn("d", F.least("d", F.col("most") * (1 + 1e-9))).join(theirs, keys)
    columns = [*keys, F.col("other").alias("tile"), "x", "y"]
    visits = [v.where((F.col("other") != F.col("tile")) & (inside <= low)).select(*columns) for v in (around, alone)]

    def visit(key: tuple, mine: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
        p = guests[["x", "y"]].to_numpy()
        return pd.DataFrame({"a": key[0], "b": key[1], "c": key[2], "x": p[:, 0], "y": p[:, 1], "d": _apart(p, mine[["x", "y"]].to_numpy())})

    kind = ", ".join(f"{c} {t}" for c, t in points.dtypes if c in (*keys, "x", "y"))
    tiles, guests = home.toDF(*home.columns).select(*keys, "tile", "x", "y").groupBy(*keys, "tile"), visits[0].union(visits[1]).groupBy(*keys, "tile")
    seen = tiles.cogroup(guests).applyInPandas(visit, f"{kind}, d double").groupBy(*keys, "x", "y").agg(F.min("d").alias("seen"))
    both = home.toDF(*home.columns).select(*keys, "x", "y", "n", "d").join(seen, [*keys, "x", "y"], "left").withColumn("d", F.least("d", "seen"))
    return _spread(both.withColumn("d", F.when(F.col("n") > 1, F.lit(0.0)).when(F.col("d") < float("inf"), F.col("d"))), keys)


def report(summaries: DataFrame, distances: DataFrame, keys: list[str], total_bins: int) -> DataFrame:
    """The coverage report's twelve columns for the subsets of one size."""
    rows = summaries.join(distances.select(*keys, "nn_mean", "nn_p95"), keys, "left")
    return rows.select(
        F.concat_ws("-", *keys).alias("subset_label"), F.lit(len(keys)).alias("subset_size"), F.lit(len(keys) - 1).alias("dimensions"), "structure_count", F.lit(total_bins).alias("total_bins"), "occupied_bins",
        F.col("occupied_fraction").alias("occupied_bin_fraction"), "normalized_entropy", "max_bin_fraction", "gini", F.col("nn_mean").alias("nn_distance_mean"), F.col("nn_p95").alias("nn_distance_p95"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """The report in the order of subset sizes and labels: ranges are sorted apart, so no task sorts it all."""
    return rows.orderBy("subset_size", "subset_label")


def subset_means(summaries: DataFrame) -> DataFrame:
    """One row: mean occupied share and mean entropy over the subsets, 0 without any."""
    return summaries.agg(
        F.count(F.lit(1)).alias("subsets"),
        F.round(F.coalesce(F.avg("occupied_fraction"), F.lit(0.0)), 8).alias("mean_occupied"),
        F.round(F.coalesce(F.avg("normalized_entropy"), F.lit(0.0)), 8).alias("mean_entropy"),
    )


def pair_frequencies(pairs: DataFrame) -> DataFrame:
    """a, b, b_fraction (of the whole structure), frequency, distinct_elements.

    The frequency of a (pair, fraction) is repeated on each row of its different numbers of elements.
    """
    points = pairs.withColumn("b_fraction", F.col("n_b") / F.col("total")).groupBy("a", "b", "b_fraction").agg(F.count(F.lit(1)).alias("frequency"), F.collect_set("n_elements").alias("ks"))
    return points.select("a", "b", "b_fraction", "frequency", F.explode(F.array_sort("ks")).alias("distinct_elements"))

