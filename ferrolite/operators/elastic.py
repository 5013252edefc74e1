"""From strained cells and stresses to elastic records, fits of cubic constants by paired differences, and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.functions.composition import single_element
from ferrolite.functions.structure import inverse, let, product
from ferrolite.operators.fits import strain_voigt, stress_voigt

# The limits beyond which a fit is warned about (GPa).
MOST_RMSE, MOST_ASYMMETRY = 10.0, 5.0


def rows_of(flat: Column) -> Column:
    """Nine numbers, row-major, as three rows."""
    return F.array(*[F.slice(flat, 3 * i + 1, 3) for i in range(3)])


def deformation(strain: Column) -> Column:
    """The unit matrix plus a strain of nine numbers."""
    return F.array(*[F.array(*[flat_at(strain, i, j) + (1.0 if i == j else 0.0) for j in range(3)]) for i in range(3)])


def flat_at(m: Column, i: int, j: int) -> Column:
    return m[3 * i + j]


def reference_cell(strained: Column, strain: Column) -> Column:
    """The cell that the strain was applied to; null if it can't be undone."""
    return product(inverse(deformation(strain)), strained)


def cell_strain(reference: Column, strained: Column) -> Column:
    """Nine numbers, row-major: the symmetric strain between two cells of row vectors; null for a flat reference."""
    return let(
        product(inverse(reference), strained), lambda f: F.when(f.isNotNull(), F.array(*[(f[i][j] + f[j][i]) / 2 - (1.0 if i == j else 0.0) for i in range(3) for j in range(3)]))
    )


def conventional_axes(cell: Column, structure: Column) -> Column:
    """Unit rows of the cubic axes of a primitive bcc or fcc cell; null for other structures."""

    def mix(c: Column, *weights: int) -> Column:
        v = F.array(*[sum((c[k][j] * w for k, w in enumerate(weights) if w), F.lit(0.0)) for j in range(3)])
        return let(v, lambda x: let(F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2]), lambda size: F.when(size > 0, F.transform(x, lambda y: y / size))))

    def axes(c: Column) -> Column:
        bcc = F.array(mix(c, 0, 1, 1), mix(c, 1, 0, 1), mix(c, 1, 1, 0))
        fcc = F.array(mix(c, -1, 1, 1), mix(c, 1, -1, 1), mix(c, 1, 1, -1))
        return F.when(F.lower(structure) == "bcc", bcc).when(F.lower(structure) == "fcc", fcc)

    return let(let(cell, axes), lambda a: F.when(F.forall(a, lambda r: r.isNotNull()), a))


def rotated(m: Column, axes: Column) -> Column:
    """R M R^T of nine numbers in the rows ``axes``; as it is without them."""
    def inside(a: Column) -> Column:
        return F.flatten(product(product(a, rows_of(m)), F.array(*[F.array(*[a[i][j] for i in range(3)]) for j in range(3)])))

    return let(axes, lambda a: F.when(a.isNull(), m).otherwise(inside(a)))


def elastic_records(frames: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every elastic single-element frame with group_key, strain and stress (six numbers each, on conventional axes) or the
    ``reason`` for which it gives no record.

    ``frames``: dataset, structure_index, perturbation_type, composition, symbols, cell, structure_name, structure_hash,
    seed_id, material_id, source, strain_matrix (nine numbers), elastic_mode, strain_amplitude. ``jobs``: dataset,
    structure_index, structure_hash, stress_gpa (nine numbers, null if it could not be read).
    """
    kept = frames.where((F.coalesce("perturbation_type", F.lit("")) == "elastic_stress") & single_element(F.col("composition"), F.col("symbols")))
    found = kept.join(jobs.select("dataset", "structure_index", F.col("structure_hash").alias("_hash"), "stress_gpa", F.lit(True).alias("_job")), ["dataset", "structure_index"], "left")
    rows = found.withColumn("_base", reference_cell(F.col("cell"), F.col("strain_matrix")))
    rows = rows.withColumn("_axes", conventional_axes(F.col("_base"), F.col("structure_name"))).withColumn("_strain", cell_strain(F.col("_base"), F.col("cell")))
    rows = rows.withColumn("_e", rotated(F.col("_strain"), F.col("_axes"))).withColumn("_s", rotated(F.col("stress_gpa"), F.col("_axes")))
    reason = (
        F.when(F.col("strain_matrix").isNull() | F.col("elastic_mode").isNull() | F.col("strain_amplitude").isNull(), "missing_metadata")
        .when(F.col("_job").isNull(), "unresolved_outcar")
        .when(~F.col("structure_hash").eqNullSafe(F.col("_hash")), "identity_mismatch")
        .when(F.col("stress_gpa").isNull(), "unparsed_stress")
        .when(F.col("_strain").isNull(), "reference_failure")
    )
    symbols = F.array_join(F.array_sort(F.array_distinct("symbols")), "-")
    ids = [F.nullif(F.col(c), F.lit("")) for c in ("seed_id", "material_id", "source")]
    group = F.coalesce(*ids, F.concat_ws(":", symbols, F.coalesce("structure_name", F.lit("unknown"))))
    return rows.select(
        "dataset", "structure_index", group.alias("group_key"), "elastic_mode", F.col("strain_amplitude").alias("amplitude"), reason.alias("reason"),
        F.when(reason.isNull(), strain_voigt(F.col("_e"))).alias("strain_voigt"),
        F.when(reason.isNull(), stress_voigt(F.col("_s"))).alias("stress_voigt_gpa"),
    )


def scan_counters(frames: DataFrame, records: DataFrame) -> DataFrame:
    """One row: frames seen, elastic and single-element candidates, records, and one counter for each reason."""
    seen = frames.agg(F.count(F.lit(1)).alias("frames_seen"), F.count_if(F.coalesce("perturbation_type", F.lit("")) == "elastic_stress").alias("elastic_candidates"))
    reasons = ("missing_metadata", "unresolved_outcar", "identity_mismatch", "unparsed_stress", "reference_failure")
    mine = records.agg(
        F.count(F.lit(1)).alias("single_element_candidates"), F.count_if(F.col("reason").isNull()).alias("matched_completed_records"), *[F.count_if(F.col("reason") == r).alias(r) for r in reasons]
    )
    return seen.join(mine)  # one row each


def _sums(e: list[Column], s: list[Column]) -> list[Column]:
    """Sums of the normal equations of c11, c12 (with one offset) and c44 (with one)."""
    rest = [e[1] + e[2], e[0] + e[2], e[0] + e[1]]
    normal = list(zip(e[:3], rest, s[:3], strict=True))
    shear = list(zip(e[3:], s[3:], strict=True))

    def total(xs: list[Column]) -> Column:
        return F.sum(sum(xs[1:], xs[0]))

    return [
        total([x * x for x, _, _ in normal]).alias("xx"), total([x * y for x, y, _ in normal]).alias("xy"), total([y * y for _, y, _ in normal]).alias("yy"),
        total([x * t for x, _, t in normal]).alias("xt"), total([y * t for _, y, t in normal]).alias("yt"), total([x for x, _, _ in normal]).alias("x"),
        total([y for _, y, _ in normal]).alias("y"), total([t for _, _, t in normal]).alias("t"), total([x * x for x, _ in shear]).alias("zz"),
        total([x * t for x, t in shear]).alias("zt"), total([x for x, _ in shear]).alias("z"), total([t for _, t in shear]).alias("u"), F.count(F.lit(1)).alias("m"),
    ]


def _six(c: str) -> list[Column]:
    return [F.col(c)[i] for i in range(6)]


def cubic_constants(records: DataFrame, order: str = "structure_index") -> DataFrame:
    """group_key, n, pairs, c11, c12, c44 by least squares.

    Strains and stresses of opposite amplitudes of a mode are subtracted in pairs, which takes any offset out; where a
    group's pairs do not determine the constants (or it has none) all its records are used, with one offset for the
    normal and one for the shear components. Null if these do not determine them either. ``records``: group_key,
    elastic_mode, amplitude, strain_voigt, stress_voigt_gpa and ``order``, by which equal amplitudes are paired.
    """
    w = Window.partitionBy("group_key", "elastic_mode", "size", "positive").orderBy(order)
    sized = records.where("amplitude <> 0").withColumn("size", F.round(F.abs("amplitude"), 12)).withColumn("positive", F.col("amplitude") > 0).withColumn("k", F.row_number().over(w))
    keys = ["group_key", "elastic_mode", "size", "k"]
    plus = sized.where("positive").select(*keys, F.col("strain_voigt").alias("ep"), F.col("stress_voigt_gpa").alias("sp"))
    minus = sized.where("not positive").select(*keys, F.col("strain_voigt").alias("em"), F.col("stress_voigt_gpa").alias("sm"))
    pairs = plus.join(minus, keys).select("group_key", F.zip_with("ep", "em", lambda a, b: a - b).alias("e"), F.zip_with("sp", "sm", lambda a, b: a - b).alias("s"))
    paired = pairs.groupBy("group_key").agg(*_sums(_six("e"), _six("s")))

    def pair(det: Column, a: Column) -> Column:
        return F.when(det > 1e-24, a / det)

    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    by_pairs = paired.select(
        "group_key", F.col("m").alias("pairs"), pair(det, F.col("xt") * F.col("yy") - F.col("yt") * F.col("xy")).alias("p11"),
        pair(det, F.col("yt") * F.col("xx") - F.col("xt") * F.col("xy")).alias("p12"), F.when(F.col("zz") > 1e-12, F.col("zt") / F.col("zz")).alias("p44"),
    )
    single = records.groupBy("group_key").agg(*_sums(_six("strain_voigt"), _six("stress_voigt_gpa")))
    n = 3 * F.col("m")

    def centred(xy: str, x: str, y: str) -> Column:
        return F.col(xy) - F.col(x) * F.col(y) / n

    xx, xy, yy, xt, yt = centred("xx", "x", "x"), centred("xy", "x", "y"), centred("yy", "y", "y"), centred("xt", "x", "t"), centred("yt", "y", "t")
    zz, zt = centred("zz", "z", "z"), centred("zt", "z", "u")
    det = xx * yy - xy * xy
    by_all = single.select(
        "group_key", F.col("m").alias("n"), pair(det, xt * yy - yt * xy).alias("a11"), pair(det, yt * xx - xt * xy).alias("a12"), F.when(zz > 1e-12, zt / zz).alias("a44")
    )
    both = by_all.join(by_pairs, "group_key", "left")
    ok = F.col("p11").isNotNull() & F.col("p12").isNotNull() & F.col("p44").isNotNull()
    chosen = [F.when(ok, F.col(f"p{k}")).otherwise(F.col(f"a{k}")).alias(f"c{k}") for k in (11, 12, 44)]
    return both.select("group_key", "n", F.coalesce("pairs", F.lit(0)).cast("bigint").alias("pairs"), *chosen)


def summarised(records: DataFrame, fitted: DataFrame) -> DataFrame:
    """``fitted`` (see ``fits.elastic_tensors``) with ``modes``, the records of each mode, and ``warnings``."""
    modes = records.groupBy("group_key", "elastic_mode").agg(F.count(F.lit(1)).alias("c"))
    modes = modes.groupBy("group_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("elastic_mode", "c")))).alias("modes"))  # one entry a mode
    warnings = F.array_compact(
        F.array(
            F.when(F.col("rmse") > MOST_RMSE, "high_rmse"), F.when(F.col("least_eigenvalue") <= 0, "non_positive_definite"),
            F.when(F.col("asymmetry") > MOST_ASYMMETRY, "large_asymmetry_before_symmetrization"),
        )
    )
    return fitted.join(modes, "group_key").withColumn("warnings", warnings)
