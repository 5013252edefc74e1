"""Queries on fits, structure variants and per-atom comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.functions import structure as S
from ferrolite.operators import fits, generators
from ferrolite.plans.tables import ATOMS_SQL, atoms, table


def linear_fit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_quantity") * 1000).alias("truth"), F.col("l_extendedprice").alias("model"))
    return fits.error_metrics(rows, "truth", "model", ["l_returnflag"], 6)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 20).alias("group_key"), F.col("l_shipdate").cast("date").cast("string").alias("day"), F.element_at(F.lit(list(generators.MODES)), F.col("l_linenumber")).alias("mode"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_discount")).otherwise(-F.col("l_discount")).alias("amplitude"), F.col("l_extendedprice").alias("stress"),
    )


def paired_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _records(spark, sf_dir).groupBy("group_key", "mode", "amplitude", "day").agg(F.max("stress").alias("stress"))
    return fits.paired_differences(one.withColumnRenamed("day", "path"), "stress").withColumn("difference", F.round("difference", 6))


def strain_voigt(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_index"))
    rows = generators.elastic_set(bases, [-0.02, -0.01, 0.0, 0.01, 0.02])
    v = fits.strain_voigt(F.col("strain_matrix"))
    return rows.select("structure_index", "elastic_mode", "strain_amplitude", *[F.round(v[i], 12).alias(f"e{i + 1}") for i in range(6)])


def _elastic(spark: SparkSession, sf_dir: str, c: list[list[float]]) -> DataFrame:
    """Strained cells of every supplier with the stresses of a known tensor scaled by the supplier."""
    bases = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("group_key"))
    rows = generators.elastic_set(bases, [-0.01, 0.01]).withColumn("strain_voigt", fits.strain_voigt(F.col("strain_matrix")))
    scale = 1 + F.col("group_key") % 10 / 100

    def stress(i: int) -> Column:
        return sum((F.col("strain_voigt")[j] * c[i][j] for j in range(6)), F.lit(0.0)) * scale + 0.5

    return rows.withColumn("stress_voigt_gpa", F.array(*[stress(i) for i in range(6)]))


def _cubic_like(hexagonal: bool) -> list[list[float]]:
    a, b, c13, c33, c44 = (240.0, 140.0, 110.0, 260.0, 80.0) if hexagonal else (240.0, 140.0, 140.0, 240.0, 80.0)
    c66 = (a - b) / 2 if hexagonal else c44
    return [[a, b, c13, 0, 0, 0], [b, a, c13, 0, 0, 0], [c13, c13, c33, 0, 0, 0], [0, 0, 0, c44, 0, 0], [0, 0, 0, 0, c44, 0], [0, 0, 0, 0, 0, c66]]


def _constants(fitted: DataFrame, names: dict[str, int]) -> DataFrame:
    return fitted.select("group_key", "n", *[F.round(F.col("tensor")[k], 6).alias(c) for c, k in names.items()])


def elastic_general_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _constants(fits.elastic_tensors(_elastic(spark, sf_dir, _cubic_like(True))), {"c11": 0, "c12": 1, "c13": 2, "c33": 14, "c44": 21, "c66": 35})


def elastic_cubic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _constants(fits.elastic_tensors(_elastic(spark, sf_dir, _cubic_like(False)), "cubic"), {"c11": 0, "c12": 1, "c44": 21})


def elastic_hexagonal_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _constants(fits.elastic_tensors(_elastic(spark, sf_dir, _cubic_like(True)), "hexagonal"), {"c11": 0, "c12": 1, "c13": 2, "c33": 14, "c44": 21})


def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return fits.principal_plane(rows)


def volume_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_index"), F.col("p_size").cast("double").alias("a"))
    rows = generators.volume_profile(bases, 0.9, 1.1, 5)
    return rows.select("structure_index", "volume_index", F.round("volume_scale", 9).alias("volume_scale"), F.round(F.col("a") * F.col("linear_factor"), 9).alias("a"))


def supercell_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", generators.supercell_factor(F.col("p_size"), 128).alias("factor"))


def rattle_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    stds = F.posexplode(F.lit(generators.rattle_ladder(0.01, 0.07, 4))).alias("rattle_index", "rattle_std")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("structure_index"), stds).withColumn("rattle_std", F.round("rattle_std", 9))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("structure_index").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber", "l_tax", "l_discount")
    rows = table(spark, sf_dir, "lineitem").withColumn("structure_index", F.col("l_orderkey")).withColumn("site", (F.row_number().over(order) - 1).cast("bigint"))
    return rows.select("structure_index", "site", F.col("l_returnflag").alias("element"), F.col("l_extendedprice").alias("coordinate"))


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.vacancies(_sites(spark, sf_dir).drop("coordinate"), 0.3, 7)


def layered_segregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _sites(spark, sf_dir)
    counts = sites.groupBy("structure_index", "element").agg(F.count(F.lit(1)).alias("n"))
    return generators.layered(sites.drop("element"), counts)


def atom_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each structure's atoms begin in its customer's list."""
    sizes = C.element_counts(atoms(spark, sf_dir)).groupBy("structure_index").agg(F.sum("n_atoms").alias("n_atoms"))
    rows = sizes.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_index"), F.col("o_custkey").alias("dataset")), "structure_index")
    before = Window.partitionBy("dataset").orderBy("structure_index").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("dataset", "structure_index", "n_atoms", F.coalesce(F.sum("n_atoms").over(before), F.lit(0)).alias("first_atom"))


def per_atom_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each atom: force components, magnitude, and the structure's energy for each atom."""
    order = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", F.col("l_discount").alias("fx"), F.col("l_tax").alias("fy"))
    records = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("structure_index")).agg(F.array_sort(F.collect_list(order)).alias("forces"), F.sum("l_extendedprice").alias("energy"))
    rows = records.select("structure_index", "energy", F.size("forces").alias("n"), F.posexplode("forces").alias("atom_index", "f"))
    return rows.select("structure_index", "atom_index", F.round(F.sqrt(F.col("f.fx") ** 2 + F.col("f.fy") ** 2), 9).alias("force"), F.round(F.col("energy") / F.col("n"), 6).alias("energy_per_atom"))


def cell_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("p_size").cast("double"), (F.col("p_partkey") % 7).cast("double")
    zero = F.lit(0.0)
    m = F.array(F.array(a, b, zero), F.array(zero, a + 1, b), F.array(b, zero, a + 2))
    inverse = S.inverse(m)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(S.determinant(m), 6).alias("det"), *[F.round(inverse[i][i], 9).alias(f"d{i}") for i in range(3)], S.replicates(m, F.lit(6.0))[0].alias("repeat_a"))


_RECORDS = f"""r AS (SELECT l_suppkey % 20 AS group_key, l_shipdate::DATE::VARCHAR AS path, [{', '.join(f"'{m}'" for m in generators.MODES)}][l_linenumber] AS mode,
        CASE WHEN l_orderkey % 2 = 0 THEN l_discount ELSE -l_discount END AS amplitude, max(l_extendedprice) AS stress FROM lineitem GROUP BY ALL)"""
_SITES = """s AS (SELECT l_orderkey AS structure_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice, l_linenumber, l_tax, l_discount) - 1 AS site,
        l_returnflag AS element, l_extendedprice AS coordinate FROM lineitem)"""


def _tensor_sql(**constants: float) -> str:
    return "SELECT s_suppkey AS group_key, 18::BIGINT AS n, " + ", ".join(f"round({v}::DOUBLE * (1 + s_suppkey % 10 / 100), 6) AS {k}" for k, v in constants.items()) + " FROM supplier"


QUERIES = {
    f.__name__: f
    for f in (
        linear_fit_metrics, paired_differences, strain_voigt, elastic_general_fit, elastic_cubic_fit, elastic_hexagonal_fit, pca_2d, volume_profile, supercell_factors,
        rattle_ladder, vacancies, layered_segregation, atom_offsets, per_atom_compare, cell_inverse,
    )
}

ORACLES = {
    "linear_fit_metrics": """SELECT l_returnflag, count(*) AS n, round(sqrt(avg((l_extendedprice - l_quantity * 1000) ** 2)), 6) AS rmse, round(regr_r2(l_extendedprice, l_quantity * 1000), 6) AS r2,
        round(regr_slope(l_extendedprice, l_quantity * 1000), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity * 1000), 6) AS intercept FROM lineitem GROUP BY 1""",
    "paired_differences": f"""WITH {_RECORDS}, k AS (SELECT *, round(abs(amplitude), 12) AS size, amplitude > 0 AS pos, row_number() OVER (PARTITION BY group_key, mode, round(abs(amplitude), 12), amplitude > 0 ORDER BY path) AS k FROM r WHERE amplitude <> 0)
        SELECT p.group_key, p.mode, p.size AS amplitude, p.k::INTEGER AS k, round(p.stress - m.stress, 6) AS difference FROM k p JOIN k m ON p.pos AND NOT m.pos AND p.group_key = m.group_key AND p.mode = m.mode AND p.size = m.size AND p.k = m.k""",
    "strain_voigt": """WITH m AS (SELECT p_partkey AS structure_index, mode AS elastic_mode, a AS strain_amplitude FROM part, (VALUES (-0.02::DOUBLE), (-0.01), (0.01), (0.02)) t(a),
            (VALUES ('normal_xx'), ('normal_yy'), ('normal_zz'), ('coupled_xy'), ('coupled_yz'), ('coupled_zx'), ('shear_xy'), ('shear_yz'), ('shear_zx')) u(mode)),
        k AS (SELECT *, strain_amplitude AS a, 1 / (1 - strain_amplitude * strain_amplitude) - 1 AS c, elastic_mode AS e FROM m)
        SELECT structure_index, elastic_mode, strain_amplitude,
            round(CASE e WHEN 'normal_xx' THEN a WHEN 'coupled_xy' THEN a WHEN 'coupled_yz' THEN c WHEN 'coupled_zx' THEN -a ELSE 0 END, 12) AS e1,
            round(CASE e WHEN 'normal_yy' THEN a WHEN 'coupled_xy' THEN -a WHEN 'coupled_yz' THEN a WHEN 'coupled_zx' THEN c ELSE 0 END, 12) AS e2,
            round(CASE e WHEN 'normal_zz' THEN a WHEN 'coupled_xy' THEN c WHEN 'coupled_yz' THEN -a WHEN 'coupled_zx' THEN a ELSE 0 END, 12) AS e3,
            round(CASE e WHEN 'shear_yz' THEN 2 * a ELSE 0 END, 12) AS e4, round(CASE e WHEN 'shear_zx' THEN 2 * a ELSE 0 END, 12) AS e5, round(CASE e WHEN 'shear_xy' THEN 2 * a ELSE 0 END, 12) AS e6 FROM k""",
    "elastic_general_fit": _tensor_sql(c11=240, c12=140, c13=110, c33=260, c44=80, c66=50),
    "elastic_cubic_fit": _tensor_sql(c11=240, c12=140, c44=80),
    "elastic_hexagonal_fit": _tensor_sql(c11=240, c12=140, c13=110, c33=260, c44=80),
    "volume_profile": """SELECT p_partkey AS structure_index, i::INTEGER AS volume_index, round(0.9::DOUBLE + 0.05::DOUBLE * i, 9) AS volume_scale, round(p_size * pow(0.9::DOUBLE + 0.05::DOUBLE * i, 1 / 3), 9) AS a FROM part, range(0, 5) t(i)""",
    "supercell_factors": "SELECT p_partkey, greatest(1, round_even(pow(128.0::DOUBLE / p_size, 1 / 3), 0))::INTEGER AS factor FROM part",
    "rattle_ladder": "SELECT s_suppkey AS structure_index, i::INTEGER AS rattle_index, round(0.01::DOUBLE + 0.02::DOUBLE * i, 9) AS rattle_std FROM supplier, range(0, 4) t(i)",
    "vacancies": f"""WITH {_SITES}, k AS (SELECT structure_index, site, element, row_number() OVER (PARTITION BY structure_index ORDER BY md5(structure_index || '|' || site || '|7'), site) AS r, count(*) OVER (PARTITION BY structure_index) AS n FROM s)
        SELECT structure_index, site, element FROM k WHERE r > least(greatest(1, floor(n * 0.3::DOUBLE)), n - 1)""",
    "layered_segregation": f"""WITH {_SITES}, a AS (SELECT structure_index, site, row_number() OVER (PARTITION BY structure_index ORDER BY coordinate, site) AS r FROM s),
        e AS (SELECT structure_index, element, row_number() OVER (PARTITION BY structure_index ORDER BY element, site) AS r FROM s) SELECT structure_index, site, element FROM a JOIN e USING (structure_index, r)""",
    "atom_offsets": f"""WITH {ATOMS_SQL}, n AS (SELECT structure_index, CAST(sum(n_atoms) AS BIGINT) AS n_atoms FROM counts GROUP BY 1)
        SELECT o_custkey AS dataset, structure_index, n_atoms, CAST(coalesce(sum(n_atoms) OVER (PARTITION BY o_custkey ORDER BY structure_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_atom
        FROM n JOIN orders ON o_orderkey = structure_index""",
    "per_atom_compare": """SELECT l_orderkey AS structure_index, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax) - 1)::INTEGER AS atom_index,
        round(sqrt(l_discount ** 2 + l_tax ** 2), 9) AS force, round(sum(l_extendedprice) OVER (PARTITION BY l_orderkey) / count(*) OVER (PARTITION BY l_orderkey), 6) AS energy_per_atom FROM lineitem""",
    "cell_inverse": """WITH m AS (SELECT p_partkey, p_size::DOUBLE AS a, (p_partkey % 7)::DOUBLE AS b FROM part), d AS (SELECT *, a * (a + 1) * (a + 2) + b * b * b AS det FROM m)
        SELECT p_partkey, round(det, 6) AS det, round((a + 1) * (a + 2) / det, 9) AS d0, round(a * (a + 2) / det, 9) AS d1, round(a * (a + 1) / det, 9) AS d2, greatest(1, ceil(12 / a))::INTEGER AS repeat_a FROM d""",
}
