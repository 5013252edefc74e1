"""Fits: error metrics, elastic tensors for each group, and principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.operators.distance import usable


def error_metrics(rows: DataFrame, truth: str, model: str, keys: list[str] | None = None, digits: int = 9) -> DataFrame:
    """n, rmse, r2, slope, intercept of ``model`` against ``truth``, over rows that have both."""
    both = rows.where(F.col(truth).isNotNull() & F.col(model).isNotNull())
    d = F.col(model) - F.col(truth)
    return both.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sqrt(F.avg(d * d)), digits).alias("rmse"),
        F.round(F.regr_r2(model, truth), digits).alias("r2"),
        F.round(F.regr_slope(model, truth), digits).alias("slope"),
        F.round(F.regr_intercept(model, truth), digits).alias("intercept"),
    )


def strain_voigt(m: Column) -> Column:
    """xx yy zz yz xz xy of a row-major 3 x 3 strain, shears doubled."""
    return F.array(m[0], m[4], m[8], m[5] + m[7], m[2] + m[6], m[1] + m[3])


def stress_voigt(m: Column) -> Column:
    return F.array(m[0], m[4], m[8], (m[5] + m[7]) / 2, (m[2] + m[6]) / 2, (m[1] + m[3]) / 2)


def paired_differences(records: DataFrame, value: str, order: str = "path") -> DataFrame:
    """group_key, mode, amplitude, k, difference: of each mode and size of amplitude, the k-th positive record's value
    less the k-th negative one's, both in ``order``; what has no partner is left out."""
    size, positive = F.round(F.abs("amplitude"), 12), F.col("amplitude") > 0
    w = Window.partitionBy("group_key", "mode", "size", "positive").orderBy(order)
    ranked = records.where("amplitude <> 0").withColumn("size", size).withColumn("positive", positive).withColumn("k", F.row_number().over(w))
    plus = ranked.where("positive").select("group_key", "mode", F.col("size").alias("amplitude"), "k", F.col(value).alias("p"))
    minus = ranked.where("not positive").select("group_key", "mode", F.col("size").alias("amplitude"), "k", F.col(value).alias("m"))
    return plus.join(minus, ["group_key", "mode", "amplitude", "k"]).select("group_key", "mode", "amplitude", "k", (F.col("p") - F.col("m")).alias("difference"))


# Which of the tensor's entries are one constant, for the symmetries with closed lists of constants.
_CUBIC = {"c11": [(0, 0), (1, 1), (2, 2)], "c12": [(0, 1), (0, 2), (1, 2)], "c44": [(3, 3), (4, 4), (5, 5)]}
_HEXAGONAL = {"c11": [(0, 0), (1, 1)], "c12": [(0, 1)], "c13": [(0, 2), (1, 2)], "c33": [(2, 2)], "c44": [(3, 3), (4, 4)]}


def _bases(symmetry: str) -> tuple[list[str], np.ndarray]:
    """Names and 6 x 6 patterns of the constants."""
    table = _CUBIC if symmetry == "cubic" else _HEXAGONAL
    out = np.zeros((len(table), 6, 6))
    for n, cells in enumerate(table.values()):
        for i, j in cells:
            out[n, i, j] = out[n, j, i] = 1
    if symmetry == "hexagonal":  # the sixth is half the difference of the first two
        out[0, 5, 5], out[1, 5, 5] = 0.5, -0.5
    return list(table), out


def fit_tensor(moments: np.ndarray, symmetry: str) -> tuple[np.ndarray, int, float]:
    """6 x 6 tensor, rank and asymmetry from the moments of centred strains and stresses: (strain x strain, strain x stress)."""
    ee, es = moments[:36].reshape(6, 6), moments[36:72].reshape(6, 6)
    rank = int(np.linalg.matrix_rank(ee, tol=1e-12 * max(1e-30, np.abs(ee).max())))
    if symmetry == "general":
        if rank < 6:
            return np.full((6, 6), np.nan), rank, np.nan
        c = np.linalg.solve(ee, es)
        return (c + c.T) / 2, rank, float(np.abs(c - c.T).max())
    _, bases = _bases(symmetry)
    # Least squares over all components: <B_m e, B_n e> and <B_m e, s>, both sums over the moments.
    a = np.array([[np.trace(m @ ee @ n.T) for n in bases] for m in bases])
    b = np.array([np.trace(m @ es) for m in bases])
    if np.linalg.matrix_rank(a) < len(bases):
        return np.full((6, 6), np.nan), int(np.linalg.matrix_rank(a)), np.nan
    return np.tensordot(np.linalg.solve(a, b), bases, axes=1), len(bases), 0.0


def elastic_tensors(records: DataFrame, symmetry: str = "general", least_records: int = 7) -> DataFrame:
    """group_key, n, rank, tensor (36 numbers, row-major, null if the strains do not determine it), rmse,
    least_eigenvalue, asymmetry (the largest difference of mirrored entries before they are made equal).

    ``records``: group_key, strain_voigt, stress_voigt_gpa (arrays of six). The fit has an intercept and needs only
    covariances, which Spark combines for each group before the shuffle and in which small strains and large offsets do
    not cancel; the small algebra is done on one row for each group.
    """
    e = [F.col("strain_voigt")[i] for i in range(6)]
    s = [F.col("stress_voigt_gpa")[i] for i in range(6)]
    n = F.count(F.lit(1))
    both = e + s
    covariance = {(i, j): F.covar_pop(both[i], both[j]) * n for i in range(12) for j in range(i, 12)}

    def block(rows: range, columns: range) -> list[Column]:
        return [covariance[min(i, j), max(i, j)] for i in rows for j in columns]

    strain, stress = range(6), range(6, 12)
    sums = block(strain, strain) + block(strain, stress) + block(stress, stress)
    grouped = records.groupBy("group_key").agg(n.alias("n"), F.array(*sums).alias("m")).where(F.col("n") >= least_records)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, n, m in zip(pdf["group_key"], pdf["n"], pdf["m"], strict=True):
                ee, es, ss = np.asarray(m, float).reshape(3, 6, 6)
                c, rank, asymmetry = fit_tensor(np.concatenate([ee.ravel(), es.ravel()]), symmetry)
                ok = bool(np.isfinite(c).all())
                rest = np.trace(ss) - 2 * np.trace(c @ es) + np.trace(c @ ee @ c.T) if ok else np.nan
                rows.append((key, n, rank, c.ravel().tolist() if ok else None, float(np.sqrt(max(rest, 0) / (6 * n))) if ok else None, float(np.linalg.eigvalsh((c + c.T) / 2).min()) if ok else None, asymmetry if ok else None))
            yield pd.DataFrame(rows, columns=["group_key", "n", "rank", "tensor", "rmse", "least_eigenvalue", "asymmetry"])

    kind = records.schema["group_key"].dataType.simpleString()
    return grouped.mapInPandas(solve, f"group_key {kind}, n bigint, rank int, tensor array<double>, rmse double, least_eigenvalue double, asymmetry double")


def principal_plane(rows: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """id, pc1, pc2: centred vectors on their first two principal components (fitted on ``fit_on``, if given).

    The components' means are aggregated in Spark first and their moments about these then, so that large offsets cancel
    nothing; a component's largest entry is made positive. Vectors that are null, hold null or non-finite components, or
    have another length than the longest take no part and have nulls; so have all without any vector to fit on.
    """
    source = (fit_on if fit_on is not None else rows).where(usable(F.col("v"))).select("v")
    d = source.agg(F.max(F.size("v")).alias("d")).first()["d"]
    if not d or d < 2:
        return rows.select("id", F.lit(None).cast("double").alias("pc1"), F.lit(None).cast("double").alias("pc2"))
    source = source.where(F.size("v") == d)
    means = source.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n")).collect()  # d rows
    first, n = np.array([r["x"] for r in sorted(means, key=lambda r: r["at"])]), means[0]["n"]

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, square = np.zeros(d), np.zeros((d, d))
        for pdf in batches:
            x = np.array(pdf["v"].tolist(), float).reshape(-1, d) - first
            total, square = total + x.sum(axis=0), square + x.T @ x
        yield pd.DataFrame({"total": [total.tolist()], "square": [square.ravel().tolist()]})

    parts = source.mapInPandas(moments, "total array<double>, square array<double>")
    both = parts.select(F.posexplode(F.concat("total", "square")).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").toPandas()  # d + d * d rows
    rest = both["x"].to_numpy()[:d] / n  # what the rounding of the first mean leaves
    _, vectors = np.linalg.eigh(both["x"].to_numpy()[d:].reshape(d, d) / n - np.outer(rest, rest))
    top = vectors[:, [-1, -2]].T
    top = top * np.sign(top[np.arange(2), np.abs(top).argmax(axis=1)])[:, None]
    centred = F.zip_with("v", F.lit((first + rest).tolist()), lambda a, b: a - b)

    def project(w: np.ndarray) -> Column:
        return F.when(usable(F.col("v")) & (F.size("v") == d), F.aggregate(F.zip_with(centred, F.lit(w.tolist()), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))

    return rows.select("id", project(top[0]).alias("pc1"), project(top[1]).alias("pc2"))
