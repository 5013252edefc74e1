"""Row generators: grids, ladders and structure variants from their parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrolite.functions.text import once


def composition_grid(elements: DataFrame, step: float) -> DataFrame:
    """a, b, c, x_a, x_b, x_c: each element alone, each pair and each triple in steps of ``step``, interior points only.

    ``elements`` is one column of distinct names: the grid is made from their sorted array, so no join is needed.
    """
    names = elements.agg(F.array_sort(F.collect_set("element")).alias("e"))
    n = round(1 / step) - 1
    x = F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda i: F.round(i * F.lit(step), 10)) if n > 0 else F.array().cast("array<double>")
    names = names.withColumn("x", x)
    none, no = F.lit(None).cast("string"), F.lit(None).cast("double")
    one = names.select(F.explode("e").alias("a")).select("a", none.alias("b"), none.alias("c"), F.lit(1.0).alias("x_a"), no.alias("x_b"), no.alias("x_c"))
    two = names.select("e", "x", F.posexplode("e").alias("i", "a")).select("e", "x", "a", "i", F.explode(F.expr("slice(e, i + 2, size(e))")).alias("b")).select("e", "x", "a", "b", F.explode("x").alias("x_b"))
    three = two.select("a", "b", "x", "x_b", F.explode(F.expr("filter(e, v -> v > b)")).alias("c")).select("a", "b", "c", "x_b", F.explode("x").alias("x_c"))
    two = two.select("a", "b", none.alias("c"), F.round(1 - F.col("x_b"), 10).alias("x_a"), "x_b", no.alias("x_c"))
    three = three.withColumn("x_a", F.round(1 - F.col("x_b") - F.col("x_c"), 10)).where("x_a > 0").select("a", "b", "c", "x_a", "x_b", "x_c")
    return one.union(two).union(three)


def integer_counts(counts: DataFrame, target: int) -> DataFrame:
    """structure_index, element, n: ``target`` atoms shared out by largest remainders, ties to the earlier element."""
    whole = Window.partitionBy("structure_index")
    f = counts.withColumn("f", F.col("n_atoms") * target / F.sum("n_atoms").over(whole))
    f = f.withColumn("base", F.floor("f"))
    f = f.withColumn("rest", F.lit(target) - F.sum("base").over(whole)).withColumn("r", F.row_number().over(whole.orderBy(F.desc(F.col("f") - F.col("base")), "element")))
    return f.select("structure_index", "element", (F.col("base") + F.when(F.col("r") <= F.col("rest"), 1).otherwise(0)).cast("bigint").alias("n"))


def electrons(counts: DataFrame, valence: DataFrame) -> DataFrame:
    """structure_index, n_electrons: valences times counts, cut to a whole number. ``valence`` is one row an element."""
    return counts.join(valence, "element").groupBy("structure_index").agg(F.sum(F.col("zval") * F.col("n_atoms")).cast("bigint").alias("n_electrons"))


def missing_elements(counts: DataFrame, known: DataFrame) -> DataFrame:
    """Elements in use that the dimension table lacks."""
    return counts.select("element").distinct().join(known.select("element"), "element", "left_anti")


def _powers(least: int, most: int) -> Column:
    return F.array(*[F.lit(2**k) for k in range(least, most)])


def parameter_grids(nodes: DataFrame) -> DataFrame:
    """``nodes`` (any columns, with cores and gpus of a node) by every combination of gpus, ncore and kpar to measure,
    numbered from 0 in this order of nesting.

    gpus: 1, 2, 4, 8 up to the node's; ncore: powers of two from 2 that divide its cores; kpar: powers of two up to its
    gpus. Where there is none, its gpus, its cores and 1 are all there is.
    """
    gpu = F.filter(_powers(0, 4), lambda x: x <= F.col("gpus"))
    core = F.filter(_powers(1, 12), lambda x: (x <= F.col("cores")) & (F.col("cores") % x == 0))
    kpar = F.filter(_powers(0, 8), lambda x: x <= F.col("gpus"))
    lists = [F.when(F.size(x) > 0, x).otherwise(F.array(y.cast("int"))) for x, y in ((gpu, F.col("gpus")), (core, F.col("cores")), (kpar, F.lit(1)))]
    every = F.flatten(F.transform(lists[0], lambda g: F.flatten(F.transform(lists[1], lambda n: F.transform(lists[2], lambda k: F.struct(g.alias("gpus"), n.alias("ncore"), k.alias("kpar")))))))
    kept = [c for c in nodes.columns if c not in ("cores", "gpus")]
    return nodes.select(*kept, F.posexplode(every).alias("job", "x")).select(*kept, "job", "x.*")


def retry_ladders(jobs: DataFrame, gpu_tiers: list[int], cores: int, max_nodes: int) -> DataFrame:
    """job, level, nodes, gpus, ncore, kpar: what each of ``jobs`` (job, gpu, ncore, kpar) tries next if it runs out of memory.

    For the job's own tier and each larger one: ncore halves from its start, at falling kpar; after the last tier the
    nodes double. The first settings and repeats are left out; levels count from 1. Each job is a row for itself.
    """
    tiers = F.filter(F.lit(list(dict.fromkeys(gpu_tiers))), lambda g: g >= F.col("gpu"))
    tiers = F.when(F.size(tiers) > 0, tiers).otherwise(F.array(F.col("gpu").cast("int")))
    doubled = [2**k for k in range(1, max(1, max_nodes).bit_length())]
    start = F.greatest(F.lit(1), F.least(F.col("ncore"), F.lit(cores))).cast("int")
    halves = F.transform(F.sequence(F.lit(0), F.floor(F.log2(start.cast("double"))).cast("int")), lambda k: F.call_function("shiftright", start, k))
    falling = F.array_distinct(F.array(F.col("kpar").cast("int"), F.greatest(F.lit(1), F.floor(F.col("kpar") / 2)).cast("int"), F.lit(1)))
    own = F.struct(F.lit(1).alias("nodes"), F.col("gpu").cast("int").alias("gpus"), F.col("ncore").cast("int").alias("ncore"), F.col("kpar").cast("int").alias("kpar"))

    def steps(t: Column) -> Column:
        one = F.transform(t, lambda g: F.struct(F.lit(1).alias("nodes"), g.alias("gpus")))
        wide = [F.struct(F.lit(n).alias("nodes"), F.element_at(t, -1).alias("gpus")) for n in doubled]
        return F.concat(one, F.array(*wide)) if wide else one

    # Tiers, nodes, halves and falling numbers are different ones each, and so is every combination of them.
    def product(t: Column, h: Column, f: Column) -> Column:
        return F.flatten(F.transform(steps(t), lambda s: F.flatten(F.transform(f, lambda k: F.transform(h, lambda n: F.struct(s["nodes"].alias("nodes"), s["gpus"].alias("gpus"), n.alias("ncore"), k.alias("kpar")))))))

    every = once(tiers, lambda t: once(halves, lambda h: once(falling, lambda f: product(t, h, f))))
    # A row becomes many, and a small table is read by one task.
    dealt = jobs.repartition(4 * jobs.sparkSession.sparkContext.defaultParallelism)
    left = dealt.select("job", F.filter(every, lambda x: x != own).alias("every"))
    # An inner posexplode would first work the list out once more, to see whether it is empty.
    return left.select("job", F.posexplode_outer("every").alias("at", "x")).where("at is not null").select("job", (F.col("at") + 1).alias("level"), "x.*")


# The nine deformation modes.
MODES = ("normal_xx", "normal_yy", "normal_zz", "coupled_xy", "coupled_yz", "coupled_zx", "shear_xy", "shear_yz", "shear_zx")


def strain_matrix(mode: Column, a: Column) -> Column:
    """Row-major 3 x 3 strain of a mode and amplitude: one axis; two axes in opposite senses with the third keeping the
    volume; or a symmetric shear."""
    zero = F.lit(0.0)
    keep = 1 / (1 - a * a) - 1

    def diagonal(x: Column, y: Column, z: Column) -> Column:
        return F.array(x, zero, zero, zero, y, zero, zero, zero, z)

    def shear(i: int, j: int) -> Column:
        return F.array(*[a if (r, c) in ((i, j), (j, i)) else zero for r in range(3) for c in range(3)])

    made = (diagonal(a, zero, zero), diagonal(zero, a, zero), diagonal(zero, zero, a), diagonal(a, -a, keep), diagonal(keep, a, -a), diagonal(-a, keep, a), shear(0, 1), shear(1, 2), shear(2, 0))
    out = F.when(mode == MODES[0], made[0])
    for m, x in zip(MODES[1:], made[1:], strict=True):
        out = out.when(mode == m, x)
    return out


def elastic_set(bases: DataFrame, amplitudes: list[float]) -> DataFrame:
    """Every base with each non-zero amplitude (outer) and mode (inner): adds strain_amplitude, elastic_mode, strain_matrix."""
    amps = [a for a in amplitudes if a != 0]
    rows = bases.withColumn("strain_amplitude", F.explode(F.lit(amps) if amps else F.array().cast("array<double>"))).withColumn("elastic_mode", F.explode(F.lit(list(MODES))))
    return rows.withColumn("strain_matrix", strain_matrix(F.col("elastic_mode"), F.col("strain_amplitude")))


def volume_profile(bases: DataFrame, low: float, high: float, n: int) -> DataFrame:
    """Every base at n volumes from ``low`` to ``high``: volume_index, volume_scale and the linear factor."""
    k = F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))
    rows = bases.withColumn("volume_index", k)
    scale = F.lit(low) + (F.lit((high - low) / (n - 1)) * F.col("volume_index") if n > 1 else F.lit(0.0))
    return rows.withColumn("volume_scale", scale).withColumn("linear_factor", F.pow("volume_scale", F.lit(1 / 3)))


def rattle_ladder(low: float, high: float, n: int) -> list[float]:
    """Displacements from ``low`` to ``high`` at equal distances; one only: ``low``."""
    return [low + (high - low) * k / (n - 1) if n > 1 else low for k in range(n)]


def supercell_factor(n_atoms: Column, target: int) -> Column:
    """Repeats along each axis that bring the atoms near the target: half-even rounding, 1 at least."""
    return F.greatest(F.lit(1), F.bround(F.pow(F.lit(float(target)) / n_atoms, F.lit(1 / 3)), 0).cast("int"))


def vacancies(sites: DataFrame, fraction: float, seed: int) -> DataFrame:
    """``sites`` (structure_index, site, element) without max(1, int(fraction * n)), but n - 1 at most, of each structure.

    Which go is decided by a hash of structure, site and seed, so that the outcome depends on no order of arrival.
    """
    whole = Window.partitionBy("structure_index")
    key = F.md5(F.concat_ws("|", F.col("structure_index"), F.col("site"), F.lit(seed)))
    n = F.count(F.lit(1)).over(whole)
    ranked = sites.withColumn("r", F.row_number().over(whole.orderBy(key, "site"))).withColumn("n", n)
    gone = F.least(F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(fraction))), F.col("n") - 1)
    return ranked.where(F.col("r") > gone).select("structure_index", "site", "element")


def layered(sites: DataFrame, counts: DataFrame) -> DataFrame:
    """structure_index, site, element: sites in order of ``coordinate`` are filled with the elements' counts in turn; what
    is left goes to the last element. ``counts``: structure_index, element, n."""
    order = Window.partitionBy("structure_index").orderBy("coordinate", "site")
    upto = Window.partitionBy("structure_index").orderBy("element")
    blocks = counts.withColumn("high", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0))).withColumn("last", F.lead("element").over(upto).isNull())
    blocks = blocks.withColumn("low", F.col("high") - F.col("n"))
    # One small array of blocks for each structure keeps this an equi-join with one match.
    blocks = blocks.groupBy("structure_index").agg(F.array_sort(F.collect_list(F.struct("low", "high", "element", "last"))).alias("blocks"))
    ranked = sites.withColumn("r", F.row_number().over(order) - 1).join(blocks, "structure_index")
    hit = F.filter("blocks", lambda b: (F.col("r") >= b["low"]) & ((F.col("r") < b["high"]) | b["last"]))
    return ranked.select("structure_index", "site", F.get(hit, F.lit(0))["element"].alias("element"))
