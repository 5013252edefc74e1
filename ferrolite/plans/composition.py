"""Queries on compositions and their coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.operators import coverage, generators
from ferrolite.plans.tables import ATOMS_SQL, atoms, table
from ferrolite.sources.scratch import stash

BINS, RESOLUTION = 20, 18


def _structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.per_structure(C.element_counts(atoms(spark, sf_dir)))


def composition_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.fractions(C.element_counts(atoms(spark, sf_dir)))


def binary_projection_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.binary_bins(C.pairs(_structures(spark, sf_dir)), BINS)


def ternary_projection_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.ternary_bins(C.triples(_structures(spark, sf_dir)), RESOLUTION)


def binary_coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.summary(binary_projection_bins(spark, sf_dir), ["a", "b"], BINS)


def ternary_coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.summary(ternary_projection_bins(spark, sf_dir), ["a", "b", "c"], C.ternary_cells(RESOLUTION))


def binary_neighbour_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.line_distances(C.pairs(_structures(spark, sf_dir)))


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve columns for every pair and triple of elements."""
    found = stash(_structures(spark, sf_dir))  # the tables are joined once for the report's four parts
    cells = C.ternary_cells(RESOLUTION)
    two = coverage.report(coverage.summary(coverage.binary_bins(C.pairs(found), BINS), ["a", "b"], BINS), coverage.line_distances(C.pairs(found)), ["a", "b"], BINS)
    three = coverage.report(coverage.summary(coverage.ternary_bins(C.triples(found), RESOLUTION), ["a", "b", "c"], cells), coverage.plane_distances(C.triples(found)), ["a", "b", "c"], cells)
    return coverage.ordered(two.union(three))


def composition_subset_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = coverage.subset_means(binary_coverage_summary(spark, sf_dir)).withColumn("kind", F.lit("binary"))
    return two.unionByName(coverage.subset_means(ternary_coverage_summary(spark, sf_dir)).withColumn("kind", F.lit("ternary")))


def pair_composition_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.pair_frequencies(C.pairs(_structures(spark, sf_dir)))


def composition_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = table(spark, sf_dir, "part").select(F.col("p_type").alias("element")).distinct()
    return generators.composition_grid(elements, 0.1)


def composition_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.transform("entries", lambda e: F.struct(e["element"].alias("key"), (e["n_atoms"] / F.col("total")).alias("value")))
    return _structures(spark, sf_dir).select("structure_index", C.label(F.map_from_entries(entries)).alias("label"))


def largest_remainder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.integer_counts(C.element_counts(atoms(spark, sf_dir)), 54)


def single_element_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = _structures(spark, sf_dir).select(
        "structure_index", F.map_from_entries(F.transform("entries", lambda e: F.struct(e["element"].alias("key"), e["n_atoms"].cast("double").alias("value")))).alias("m"), F.transform("entries", lambda e: e["element"]).alias("symbols")
    )
    return maps.where(C.single_element(F.col("m"), F.col("symbols"))).select("structure_index", F.col("symbols")[0].alias("element"))


def structure_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structures by perturbation and by configuration type (missing: unknown), and in total, in one pass."""
    orders = table(spark, sf_dir, "orders").select(
        F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")), F.lit("unknown")).alias("perturbation_type"), F.col("o_orderstatus").alias("configurational_type")
    )
    sets = orders.groupingSets([["perturbation_type"], ["configurational_type"], []], "perturbation_type", "configurational_type")
    return sets.agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n")).select("level", "perturbation_type", "configurational_type", "n")


def estimated_electrons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.electrons(C.element_counts(atoms(spark, sf_dir)), spark.createDataFrame(VALENCE, "element string, zval double"))


def bin_deficit_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = binary_projection_bins(spark, sf_dir)
    totals = bins.groupBy("a", "b").agg(F.sum("n").alias("total"))
    return bins.join(F.broadcast(totals), ["a", "b"]).select("a", "b", "bin", F.round(C.deficit_reward(F.col("n"), F.col("total"), BINS), 9).alias("reward"))


VALENCE = [("STANDARD", 6.0), ("SMALL", 12.0), ("MEDIUM", 11.0), ("LARGE", 4.0), ("ECONOMY", 14.0), ("PROMO", 5.0)]

_PAIRS = f"""WITH {ATOMS_SQL},
    totals AS (SELECT structure_index, sum(n_atoms) AS total, count(*) AS k FROM counts GROUP BY 1),
    pairs AS (
        SELECT x.structure_index, x.element AS a, y.element AS b, x.n_atoms AS n_a, y.n_atoms AS n_b, y.n_atoms / (x.n_atoms + y.n_atoms) AS b_share, total, k
        FROM counts x JOIN counts y ON x.structure_index = y.structure_index AND x.element < y.element JOIN totals t ON t.structure_index = x.structure_index
    ),
    bins AS (SELECT a, b, CAST(CASE WHEN b_share >= 1 - 1e-12 THEN {BINS - 1} ELSE least(floor(b_share * {BINS}), {BINS - 1}) END AS INTEGER) AS bin, count(*) AS n FROM pairs GROUP BY ALL)"""
_TRIPLES = f"""WITH {ATOMS_SQL},
    raw AS (
        SELECT x.element AS a, y.element AS b, z.element AS c, x.n_atoms * {RESOLUTION} / (x.n_atoms + y.n_atoms + z.n_atoms) AS fa,
               y.n_atoms * {RESOLUTION} / (x.n_atoms + y.n_atoms + z.n_atoms) AS fb, z.n_atoms * {RESOLUTION} / (x.n_atoms + y.n_atoms + z.n_atoms) AS fc
        FROM counts x JOIN counts y ON x.structure_index = y.structure_index AND x.element < y.element
        JOIN counts z ON z.structure_index = x.structure_index AND y.element < z.element
    ),
    cut AS (SELECT *, floor(fa) AS ia, floor(fb) AS ib, floor(fc) AS ic, fa - floor(fa) AS ra, fb - floor(fb) AS rb, fc - floor(fc) AS rc FROM raw),
    cells AS (
        SELECT a, b, c,
               CAST(ia + CASE WHEN (rb > ra)::INT + (rc > ra)::INT < {RESOLUTION} - ia - ib - ic THEN 1 ELSE 0 END AS INTEGER) AS i,
               CAST(ib + CASE WHEN (ra >= rb)::INT + (rc > rb)::INT < {RESOLUTION} - ia - ib - ic THEN 1 ELSE 0 END AS INTEGER) AS j,
               CAST(ic + CASE WHEN (ra >= rc)::INT + (rb >= rc)::INT < {RESOLUTION} - ia - ib - ic THEN 1 ELSE 0 END AS INTEGER) AS k
        FROM cut
    ),
    bins AS (SELECT a, b, c, i, j, k, count(*) AS n FROM cells GROUP BY ALL)"""


def _summary_sql(head: str, keys: str, total: int) -> str:
    return f"""{head}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n) + {total} - count(*) OVER (PARTITION BY {keys}) AS r, sum(n) OVER (PARTITION BY {keys}) AS whole FROM bins
    ) SELECT {keys}, CAST(sum(n) AS BIGINT) AS structure_count, count(*) AS occupied_bins, round(count(*) / {total}, 9) AS occupied_fraction,
        round(sum(-(n / whole) * ln(n / whole)) / ln({total}), 9) AS normalized_entropy, round(max(n) / max(whole), 9) AS max_bin_fraction,
        round(sum((2 * r - {total} - 1) * n) / ({total} * max(whole)), 9) AS gini FROM ranked GROUP BY {keys}"""


_BINARY = _summary_sql(_PAIRS, "a, b", BINS)
_TERNARY = _summary_sql(_TRIPLES, "a, b, c", C.ternary_cells(RESOLUTION))
_MEANS = "count(*) AS subsets, round(coalesce(avg(occupied_fraction), 0), 8) AS mean_occupied, round(coalesce(avg(normalized_entropy), 0), 8) AS mean_entropy"

QUERIES = {
    f.__name__: f
    for f in (
        composition_fractions, binary_projection_bins, ternary_projection_bins, binary_coverage_summary, ternary_coverage_summary, binary_neighbour_distances,
        coverage_report, composition_subset_means, pair_composition_frequency, composition_grid, composition_label, largest_remainder_counts, single_element_structures,
        structure_type_counts, estimated_electrons, bin_deficit_rewards,
    )
}

ORACLES = {
    "composition_fractions": f"WITH {ATOMS_SQL} SELECT *, n_atoms / sum(n_atoms) OVER (PARTITION BY structure_index) AS fraction FROM counts",
    "binary_projection_bins": f"{_PAIRS} SELECT * FROM bins",
    "ternary_projection_bins": f"{_TRIPLES} SELECT * FROM bins",
    "binary_coverage_summary": _BINARY,
    "ternary_coverage_summary": _TERNARY,
    "binary_neighbour_distances": f"""{_PAIRS}, gaps AS (
            SELECT a, b, least(b_share - lag(b_share) OVER w, lead(b_share) OVER w - b_share) AS d FROM pairs WINDOW w AS (PARTITION BY a, b ORDER BY b_share)
        ) SELECT a, b, count(*) AS n, round(avg(d), 9) AS nn_mean, round(quantile_cont(d, 0.95), 9) AS nn_p95 FROM gaps GROUP BY a, b""",
    "coverage_report": f"""WITH s2 AS ({_BINARY}), g2 AS ({_PAIRS}, gaps AS (
            SELECT a, b, least(b_share - lag(b_share) OVER w, lead(b_share) OVER w - b_share) AS d FROM pairs WINDOW w AS (PARTITION BY a, b ORDER BY b_share)
        ) SELECT a, b, round(avg(d), 9) AS m, round(quantile_cont(d, 0.95), 9) AS p FROM gaps GROUP BY a, b),
        s3 AS ({_TERNARY}), p3 AS (WITH {ATOMS_SQL} SELECT x.element AS a, y.element AS b, z.element AS c,
            y.n_atoms / (x.n_atoms + y.n_atoms + z.n_atoms) + z.n_atoms / (x.n_atoms + y.n_atoms + z.n_atoms) / 2 AS px, z.n_atoms / (x.n_atoms + y.n_atoms + z.n_atoms) * (sqrt(3::DOUBLE) / 2) AS py, count(*) AS n
            FROM counts x JOIN counts y ON x.structure_index = y.structure_index AND x.element < y.element JOIN counts z ON z.structure_index = x.structure_index AND y.element < z.element GROUP BY ALL),
        d3 AS (SELECT i.a, i.b, i.c, i.n, CASE WHEN i.n > 1 THEN 0 ELSE sqrt(min((i.px - j.px) ** 2 + (i.py - j.py) ** 2)) END AS d FROM p3 i LEFT JOIN p3 j ON i.a = j.a AND i.b = j.b AND i.c = j.c AND (i.px <> j.px OR i.py <> j.py)
            GROUP BY i.a, i.b, i.c, i.px, i.py, i.n),
        g3 AS (SELECT a, b, c, round(avg(d), 9) AS m, round(quantile_cont(d, 0.95), 9) AS p FROM (SELECT a, b, c, d, unnest(range(n)) FROM d3) GROUP BY 1, 2, 3)
        SELECT a || '-' || b AS subset_label, 2 AS subset_size, 1 AS dimensions, structure_count, {BINS} AS total_bins, occupied_bins, occupied_fraction AS occupied_bin_fraction, normalized_entropy, max_bin_fraction, gini,
            m AS nn_distance_mean, p AS nn_distance_p95 FROM s2 JOIN g2 USING (a, b)
        UNION ALL SELECT a || '-' || b || '-' || c, 3, 2, structure_count, {C.ternary_cells(RESOLUTION)}, occupied_bins, occupied_fraction, normalized_entropy, max_bin_fraction, gini, m, p FROM s3 JOIN g3 USING (a, b, c)""",
    "composition_subset_means": f"SELECT {_MEANS}, 'binary' AS kind FROM ({_BINARY}) UNION ALL SELECT {_MEANS}, 'ternary' AS kind FROM ({_TERNARY})",
    "pair_composition_frequency": f"""{_PAIRS}, points AS (
            SELECT a, b, n_b / total AS b_fraction, count(*) AS frequency, list_distinct(list(k)) AS ks FROM pairs GROUP BY 1, 2, 3
        ) SELECT a, b, b_fraction, frequency, CAST(unnest(ks) AS INTEGER) AS distinct_elements FROM points""",
    "composition_grid": """WITH e AS (SELECT DISTINCT p_type AS element FROM part), s AS (SELECT i::INTEGER AS i FROM range(1, 10) t(i))
        SELECT e.element AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS c, 1.0::DOUBLE AS x_a, NULL::DOUBLE AS x_b, NULL::DOUBLE AS x_c FROM e
        UNION ALL SELECT x.element, y.element, NULL, round(1 - round(i * 0.1::DOUBLE, 10), 10), round(i * 0.1::DOUBLE, 10), NULL FROM e x JOIN e y ON x.element < y.element CROSS JOIN s
        UNION ALL SELECT x.element, y.element, z.element, round(1 - round(s.i * 0.1::DOUBLE, 10) - round(t.i * 0.1::DOUBLE, 10), 10), round(s.i * 0.1::DOUBLE, 10), round(t.i * 0.1::DOUBLE, 10)
        FROM e x JOIN e y ON x.element < y.element JOIN e z ON y.element < z.element CROSS JOIN s CROSS JOIN s t
        WHERE round(1 - round(s.i * 0.1::DOUBLE, 10) - round(t.i * 0.1::DOUBLE, 10), 10) > 0""",
    "composition_label": f"""WITH {ATOMS_SQL}, t AS (SELECT structure_index, element, n_atoms / sum(n_atoms) OVER (PARTITION BY structure_index) AS f FROM counts)
        SELECT structure_index, string_agg(CASE WHEN f = 1 THEN element ELSE element || printf('%.2g', f) END, '-' ORDER BY f DESC, element) AS label FROM t GROUP BY 1""",
    "largest_remainder_counts": f"""WITH {ATOMS_SQL}, x AS (SELECT structure_index, element, n_atoms * 54 / sum(n_atoms) OVER (PARTITION BY structure_index) AS f FROM counts),
        y AS (SELECT *, floor(f) AS base, 54 - sum(floor(f)) OVER (PARTITION BY structure_index) AS rest, row_number() OVER (PARTITION BY structure_index ORDER BY f - floor(f) DESC, element) AS r FROM x)
        SELECT structure_index, element, CAST(base + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS n FROM y""",
    "single_element_structures": f"WITH {ATOMS_SQL} SELECT structure_index, min(element) AS element FROM counts GROUP BY 1 HAVING count(*) = 1",
    "structure_type_counts": """WITH o AS (SELECT coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'unknown') AS perturbation_type, o_orderstatus AS configurational_type FROM orders)
        SELECT grouping_id(perturbation_type, configurational_type)::BIGINT AS level, perturbation_type, configurational_type, count(*) AS n
        FROM o GROUP BY GROUPING SETS ((perturbation_type), (configurational_type), ())""",
    "estimated_electrons": f"""WITH {ATOMS_SQL}, v(element, zval) AS (VALUES {', '.join(f"('{e}', {z}::DOUBLE)" for e, z in VALENCE)})
        SELECT structure_index, CAST(trunc(sum(zval * n_atoms)) AS BIGINT) AS n_electrons FROM counts JOIN v USING (element) GROUP BY 1""",
    "bin_deficit_rewards": f"""{_PAIRS}, t AS (SELECT *, greatest(1, floor(sum(n) OVER (PARTITION BY a, b) / {BINS}) + 1) AS target FROM bins)
        SELECT a, b, bin, round(greatest(0, target - n) / target, 9) AS reward FROM t""",
}
