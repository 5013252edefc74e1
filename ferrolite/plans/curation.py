"""Queries on filters, metadata, ids, membership and elastic records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.functions import composition as C
from ferrolite.functions import structure as S
from ferrolite.functions import text as X
from ferrolite.operators import curation, defects, elastic, fits, generators, registry
from ferrolite.plans import composition as P
from ferrolite.plans import numerics
from ferrolite.plans.tables import ATOMS_SQL, atoms, table


def _structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """structure_index, composition (a map), symbols, perturbation_type, seed_id of every order with atoms."""
    found = C.per_structure(C.element_counts(atoms(spark, sf_dir)))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("structure_index"), "o_custkey", "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", "elastic_stress").when(F.col("o_orderpriority") == "2-HIGH", "rattle").alias("perturbation_type"),
    )
    shares = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["element"], (e["n_atoms"] / F.col("total")).alias("v"))))
    return found.select("structure_index", shares.alias("composition"), F.transform("entries", lambda e: e["element"]).alias("symbols")).join(orders, "structure_index")


def elastic_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.required(curation.elastic_only(_structures(spark, sf_dir)), "elastic structures").select("structure_index", "o_custkey")


def single_element_elastic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.elastic_only(_structures(spark, sf_dir), single=True).select("structure_index", F.col("symbols")[0].alias("element"))


def subset_compounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 most stable of the structures that have no other elements than the asked ones."""
    rows = _structures(spark, sf_dir).withColumnRenamed("symbols", "elements")
    rows = curation.within_elements(rows, ["SMALL", "LARGE", "PROMO"]).withColumn("energy_above_hull", F.when(F.col("structure_index") % 5 != 0, F.col("o_totalprice") / 1000))
    return curation.most_stable(rows, 50, "structure_index").select("structure_index", F.round("energy_above_hull", 6).alias("energy_above_hull"), F.array_join("elements", "-").alias("formula"))


def gas_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structures with one of the gas elements, and the list that their interstitials are drawn from."""
    rows = curation.with_any(_structures(spark, sf_dir), ["ECONOMY", "PROMO"], "symbols")
    return rows.select("structure_index", F.array_join(curation.draw_list(F.col("symbols"), F.lit(["ECONOMY", "PROMO"])), "-").alias("drawn"))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents of phases: every fifth has two elements, every seventh no symmetry."""
    number = F.element_at(F.lit([229, 225, 194, 227, 221, 62]), (F.col("p_size") % 6 + 1).cast("int"))
    system = F.when(F.col("p_partkey") % 7 != 0, F.when(F.col("p_partkey") % 11 == 0, "Orthorhombic").when(number == 194, "Hexagonal").otherwise("Cubic"))
    elements = F.when(F.col("p_partkey") % 5 == 0, F.array("p_brand", "p_type")).otherwise(F.array("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", elements.alias("elements"), system.alias("crystal_system"), number.alias("space_group"), (F.col("p_size") / 4.0 + 2).alias("lattice_a"))


def symmetry_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = curation.of_structures(_docs(spark, sf_dir), ["bcc", "FCC", "hcp", "cesium"])
    return kept.select("p_partkey", curation.structure_name(F.col("space_group")).alias("structure"))


def space_group_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("p_partkey", curation.structure_name(F.col("space_group")).alias("structure"))


def pure_lattices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primitive cells of the pure phases with a known structure, as the record of their lattice."""
    rows = _docs(spark, sf_dir).withColumn("structure", curation.structure_name(F.col("space_group")))
    rows = rows.where("structure <> 'unknown'").withColumn("l", curation.lattice_record(curation.pure_cell(F.col("structure"), F.col("lattice_a"))))
    return rows.select("p_partkey", "structure", *[F.round(f"l.{c}", 6).alias(c) for c in ("a", "b", "c", "alpha", "beta", "gamma", "volume")])


def inherited_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as perturbed structures of the customer: a source of their own for errors, the customer's otherwise."""
    bases = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("base"), F.format_string("seed_%06d", "c_custkey").alias("seed_id"), F.col("c_mktsegment").alias("source"), F.lit("mp_phase").alias("configurational_type"))
    children = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("base"), F.when(F.col("event_type") == "error", "own").alias("source"))
    return curation.inherited(children, bases, "base", "strain").select("event_id", "seed_id", "source", "configurational_type", "perturbation_type")


def record_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as records with planted faults: energy, forces, lattice and virial."""
    k = F.col("s_suppkey")
    row = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    rows = table(spark, sf_dir, "supplier").select(
        k, F.when(k % 7 == 0, F.lit(None)).when(k % 13 == 0, float("nan")).otherwise(F.col("s_acctbal")).alias("energy"), F.array_repeat(row, F.when(k % 5 == 0, 1).otherwise(2)).alias("forces"),
        F.array(F.lit("W"), F.lit("Cr")).alias("species"), F.when(k % 11 == 0, F.array(row, row)).otherwise(F.array(row, row, row)).alias("lattice"),
        F.when(k % 3 == 0, F.array(row, row, F.array(F.lit(1.0)))).when(k % 3 == 1, F.array(row, row, row)).alias("virial"),
    )
    return curation.validated(rows).select("s_suppkey", F.array_join("problems", ",").alias("problems"))


def position_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of odd keys that have the positions and formula of a part with an even one."""
    x = [F.round(F.col(c) / F.lit(d), 9) for c, d in (("p_size", 7.0), ("p_retailprice", 9000.0))]
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), S.position_key(F.col("p_type"), F.array(F.array(x[0], F.round(x[1], 0), F.lit(0.0)))).alias("key"))
    return curation.matched_positions(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("struct_id")).agg(F.array_sort(F.collect_list(item)).alias("x"), F.sum("l_extendedprice").alias("energy"))
    return rows.select("struct_id", "energy", F.transform("x", lambda i: i["l_returnflag"]).alias("species"), F.transform("x", lambda i: F.array(i["l_discount"], i["l_tax"], F.lit(0.01))).alias("forces"))


def dft_ml_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reference calculations, events as model output for the order of their number."""
    ml = table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("event_id").alias("struct_id"), (F.col("user_id") % 7).cast("int").alias("atoms"))
    found = curation.compared(_frames(spark, sf_dir), ml)
    return found.select("struct_id", "atom_id", "species", F.round("energy_per_atom", 6).alias("energy_per_atom"), F.round("force_magnitude", 9).alias("force_magnitude"), "mismatch")


def frames_of_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("structure_index"), F.col("l_linenumber").alias("atom_index"))
    return curation.frames_of_atoms(chosen)


def scheduler_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "customer").select(F.format_string("job_%d", "c_custkey").alias("name"))
    queue = table(spark, sf_dir, "events").select(F.format_string("job_%d", "user_id").alias("name"), "event_type")
    running = F.col("event_type").isin("purchase", "error")
    return curation.scheduled(jobs, queue.where(running), queue.where(~F.coalesce(running, F.lit(False))))


def element_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.distinct_elements(_structures(spark, sf_dir))


def distinct_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different bins the structures' pairs and triples fall into."""
    two, three = P.binary_projection_bins(spark, sf_dir), P.ternary_projection_bins(spark, sf_dir)
    pairs = two.agg(F.count_distinct(F.struct("a", "b", "bin")).alias("binary_bins"))
    return pairs.join(three.agg(F.count_distinct(F.struct("a", "b", "c", "i", "j", "k")).alias("ternary_bins")))  # one row each


def next_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next dataset number behind those of the customers' segments' folders, and of seeds."""
    names = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 == 0, F.format_string("dataset_%04d", F.col("c_custkey") % 977)).otherwise(F.concat(F.lit("dataset_x"), "c_custkey")).alias("name"))
    seeds = table(spark, sf_dir, "supplier").select(F.format_string("seed_%06d", F.col("s_suppkey") * 3).alias("name"))
    one = curation.next_number(names, "name", "dataset_").select(F.lit("dataset").alias("kind"), "next")
    return one.union(curation.next_number(seeds, "name", "seed_", 0).select(F.lit("seed"), "next")).union(curation.next_number(seeds, "name", "none_", 5).select(F.lit("none"), "next"))


def seed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, then customers, in one sequence; customers in debt have an id already."""
    first = table(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"))
    second = table(spark, sf_dir, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, F.concat(F.lit("old_"), "c_custkey")).alias("seed_id"))
    return curation.united([first, second], "id")


def composition_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three phases of each formula, the most stable first."""
    rows = _structures(spark, sf_dir).select("structure_index", F.array_join("symbols", "-").alias("formula"), "o_totalprice")
    return curation.capped(rows, "formula", ["o_totalprice", "structure_index"], 3).select("formula", "structure_index")


def latest_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", F.format_string("potentials/%06d", "o_orderkey").alias("path"))
    return curation.newest(rows, "o_custkey", "o_orderdate", "path")


def first_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of those of the cheapest formula: the one of the smallest total, then of the smallest number."""
    rows = _structures(spark, sf_dir).select("structure_index", F.array_join("symbols", "-").alias("formula"), "o_totalprice")
    return curation.first_record(rows, ["o_totalprice", "structure_index"])


def unresolved_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight orders without lines, for a report."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_index"))
    return orders.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("structure_index")), "structure_index", "left_anti").orderBy("structure_index").limit(8)


def anchor_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of both kinds, once each: the newest structure of each customer, and single elements under elastic strain."""
    seeds = table(spark, sf_dir, "customer").select(F.format_string("seed_%06d", "c_custkey").alias("seed_id"))
    made = table(spark, sf_dir, "orders").select(F.format_string("seed_%06d", "o_custkey").alias("seed_id"), F.col("o_orderkey").alias("structure_index"))
    return registry.seed_anchors(made, seeds).select("structure_index").union(single_element_elastic(spark, sf_dir).select("structure_index")).distinct()


def perturbation_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier with its strained, elastic, volume and rattled variants."""
    bases = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("structure_index"), F.format_string("seed_%06d", "s_suppkey").alias("seed_id"))
    only = bases.select("structure_index")
    strained = only.select("structure_index", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("variant"))
    modes = F.create_map(*[F.lit(x) for k, m in enumerate(generators.MODES) for x in (m, k)])
    stressed = generators.elastic_set(only, [-0.01, 0.01]).select("structure_index", (modes[F.col("elastic_mode")] + F.when(F.col("strain_amplitude") > 0, 9).otherwise(0)).alias("variant"))
    volumes = generators.volume_profile(only, 0.9, 1.1, 5).select("structure_index", F.col("volume_index").alias("variant"))
    rattled = only.select("structure_index", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("variant"))
    return curation.perturbed(bases, {"strain": strained, "elastic_stress": stressed, "volume": volumes, "rattle": rattled})


def hash_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("old"), "doc_id"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", old.alias("structure_hash"), F.when(F.col("doc_id") % 4 == 0, "structure-v0").alias("structure_hash_version"))
    return curation.annotated(rows, F.sha2(F.coalesce("source", F.lit("")).cast("binary"), 256)).drop("source")


def potential_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = curation.parameter_hash(F.lit("6 5"), F.lit("4 4"), F.lit("8 8"), F.lit("4 2 1"), F.col("p_size"))
    name = curation.potential_name(F.col("p_partkey"), F.col("p_size") % 2 == 0, (F.col("p_size") % 4).cast("double"), F.col("p_size") % 3 == 0, params)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


def fraction_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") / 64.0).otherwise(F.col("p_size") / 77.0).alias("x"))
    return rows.select("p_partkey", C.fraction_label("x").alias("label"))


def bin_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = P.ternary_projection_bins(spark, sf_dir)
    a, b, c = C.ternary_centre(F.col("i"), F.col("j"), F.col("k"), P.RESOLUTION)
    x, y = C.cartesian(b, c)
    return cells.select("a", "b", "c", "i", "j", "k", F.round(a, 9).alias("share_a"), F.round(x, 9).alias("x"), F.round(y, 9).alias("y"))


def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return curation.min_max(rows, "s_acctbal", "s_nationkey").select("s_suppkey", F.round("s_acctbal", 9).alias("scaled"))


def virials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stress and virial of a log with a block of three rows for each part."""
    rows = F.concat(*[F.format_string(" %12.5f %12.5f %12.5f\n", *[(F.col("p_size") * (i + 1) + j * 10).cast("double") for j in range(3)]) for i in range(3)])
    log = F.concat(F.lit(" STRESS in cartesian coordinates (kB)\n 1 2 3\n 4 5 6\n 7 8 9\n other\n STRESS in cartesian coordinates (kB)\n"), rows, F.lit(" done\n"))
    gpa = X.stress_matrix_gpa(F.col("log"))
    made = table(spark, sf_dir, "part").select("p_partkey", log.alias("log")).withColumn("s", gpa)
    v = X.virial(F.transform("s", lambda x: x * 10), F.lit(125.0))
    return made.select("p_partkey", F.round(F.col("s")[0], 6).alias("xx"), F.round(F.col("s")[5], 6).alias("yz"), F.round(v[0], 9).alias("virial_xx"), F.round(v[3], 9).alias("virial_yx"))


def kpoint_meshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, zero = (F.col("p_size") / 3.0 + 2), F.lit(0.0)
    cell = F.array(F.array(a, zero, zero), F.array(zero, a * 2, zero), F.array(zero, zero, a * 3))
    mesh = S.kpoint_mesh(cell, F.lit(0.3))
    return table(spark, sf_dir, "part").select("p_partkey", mesh[0].alias("n1"), mesh[1].alias("n2"), mesh[2].alias("n3"))


def kpoints_irreducible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-points that symmetry leaves for one atom in every part's cubic, tetragonal or orthorhombic cell."""
    kind, zero = F.col("p_partkey") % 3, F.lit(0.0)
    a = (F.col("p_size") % 9).cast("double") + 2
    b, c = F.when(kind == 2, a * 1.25).otherwise(a), F.when(kind > 0, a * 1.5).otherwise(a)
    cell = F.array(F.array(a, zero, zero), F.array(zero, b, zero), F.array(zero, zero, c))
    rows = table(spark, sf_dir, "part").select("p_partkey", cell.alias("cell"))
    # Parts share few cells: each is worked out once.
    cells = rows.select("cell").distinct().withColumn("mesh", S.kpoint_mesh(F.col("cell"), F.lit(0.4)))
    n = S.irreducible_kpoints(F.col("cell"), F.lit([[0.0, 0.0, 0.0]]), F.lit(["W"]), F.col("mesh"))
    return rows.join(cells.withColumn("n", n), "cell").select("p_partkey", F.col("mesh")[0].alias("n1"), F.col("mesh")[1].alias("n2"), F.col("mesh")[2].alias("n3"), F.col("n").alias("n_kpoints_irr"))


def _elastic_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Strained cubic cells of every supplier, with planted gaps, and the outcome of their jobs."""
    bases = table(spark, sf_dir, "supplier").select(F.col("s_suppkey"), (F.col("s_suppkey") % 5 + 3).cast("double").alias("a"))
    rows = generators.elastic_set(bases, [-0.02, 0.02])
    place = F.create_map(*[F.lit(x) for k, m in enumerate(generators.MODES) for x in (m, k)])[F.col("elastic_mode")] + F.when(F.col("strain_amplitude") > 0, 9).otherwise(0)
    rows = rows.withColumn("structure_index", (F.col("s_suppkey") * 18 + place).cast("bigint"))
    zero = F.lit(0.0)
    cell = S.product(elastic.deformation(F.col("strain_matrix")), F.array(*[F.array(*[F.col("a") if i == j else zero for j in range(3)]) for i in range(3)]))
    k = F.col("structure_index")
    frames = rows.select(
        F.lit("train").alias("dataset"), "structure_index", F.when(k % 17 != 0, "elastic_stress").alias("perturbation_type"), F.create_map(F.lit("W"), F.lit(1.0)).alias("composition"),
        F.array(F.lit("W")).alias("symbols"), cell.alias("cell"), F.lit("simple_cubic").alias("structure_name"), F.concat(F.lit("h"), k).alias("structure_hash"),
        F.format_string("seed_%06d", "s_suppkey").alias("seed_id"), F.lit(None).cast("string").alias("material_id"), F.lit("x").alias("source"),
        F.when(k % 19 != 0, F.col("strain_matrix")).alias("strain_matrix"), "elastic_mode", "strain_amplitude",
    )
    v = fits.strain_voigt(F.col("strain_matrix"))
    c = [[240.0, 140.0, 140.0], [140.0, 240.0, 140.0], [140.0, 140.0, 240.0]]
    normal = [sum((v[j] * c[i][j] for j in range(3)), F.lit(0.5)) for i in range(3)]
    yz, xz, xy = [v[j] * 80.0 + 0.25 for j in (3, 4, 5)]
    stress = F.array(normal[0], xy, xz, xy, normal[1], yz, xz, yz, normal[2])
    jobs = rows.where("structure_index % 23 <> 0").select(
        F.lit("train").alias("dataset"), "structure_index", F.when(k % 29 == 0, "other").otherwise(F.concat(F.lit("h"), k)).alias("structure_hash"), F.when(k % 31 != 0, stress).alias("stress_gpa")
    )
    return frames, jobs


def elastic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = elastic.elastic_records(*_elastic_frames(spark, sf_dir))
    return found.select("structure_index", "group_key", "reason", *[F.round(F.col("strain_voigt")[i], 9).alias(f"e{i + 1}") for i in range(6)], *[F.round(F.col("stress_voigt_gpa")[i], 6).alias(f"s{i + 1}") for i in range(6)])


def elastic_scan_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames, jobs = _elastic_frames(spark, sf_dir)
    return elastic.scan_counters(frames, elastic.elastic_records(frames, jobs))


def elastic_cubic_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = elastic.elastic_records(*_elastic_frames(spark, sf_dir)).where("reason is null")
    found = elastic.cubic_constants(records)
    return found.select("group_key", "n", *[F.round(c, 6).alias(c) for c in ("c11", "c12", "c44")])


def elastic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = elastic.elastic_records(*_elastic_frames(spark, sf_dir)).where("reason is null")
    found = elastic.summarised(records, fits.elastic_tensors(records, "cubic"))
    modes = F.array_join(F.transform(F.array_sort(F.map_entries("modes")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return found.select("group_key", "n", modes.alias("modes"), F.array_join("warnings", ",").alias("warnings"), F.round(F.abs("rmse"), 4).alias("rmse"), F.round("least_eigenvalue", 4).alias("least_eigenvalue"))


def binary_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bin of every pair, empty ones included."""
    rows = P.binary_projection_bins(spark, sf_dir)
    every = rows.select("a", "b").distinct().select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(P.BINS - 1))).alias("bin"))
    return every.join(rows, ["a", "b", "bin"], "left").select("a", "b", "bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def element_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of settings that name no known element, after blanks and cases are put right."""
    text = F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ,, "), F.upper("p_name"), F.lit(","))
    rows = table(spark, sf_dir, "part").select("p_partkey", X.element_list(text).alias("elements"))
    known = table(spark, sf_dir, "part").select(F.initcap("p_type").alias("element"))
    return curation.unknown_elements(rows, known, "p_partkey", "elements")


def random_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites of every order filled twice with its flags in the order of a hash."""
    sites = numerics._sites(spark, sf_dir)
    counts = sites.groupBy("structure_index", "element").agg(F.count(F.lit(1)).alias("n"))
    return defects.random_solutions(sites, counts, 2, 11)


def solution_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five variants of each formula over three lattices together."""
    rows = _structures(spark, sf_dir).select(F.array_join("symbols", "-").alias("composition"), (F.col("structure_index") % 3).alias("lattice"), F.col("structure_index").alias("variant"))
    return defects.first_of_composition(rows, 5)


def _cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cubic cell of eight atoms for every supplier."""
    zero = F.lit(0.0)
    a = (F.col("s_suppkey") % 4 + 4).cast("double")
    cell = F.array(F.array(a, zero, zero), F.array(zero, a, zero), F.array(zero, zero, a))
    corners = F.array(*[F.array(*[a / 2 if (k >> b) & 1 else zero for b in range(3)]) for k in range(8)])
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("structure_index"), F.array_repeat(F.lit("W"), 8).alias("symbols"), corners.alias("positions"), cell.alias("cell"))


def displaced_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's cubic cell with its atoms displaced by each step of a ladder."""
    found = defects.displaced(_cubes(spark, sf_dir), generators.rattle_ladder(0.01, 0.25, 4), 1.9)
    digest = F.md5(F.array_join(F.transform(F.flatten("positions"), lambda x: F.format_string("%.6f", x)), ","))
    return found.select("structure_index", "rattle_index", F.round("rattle_std", 9).alias("rattle_std"), "moved", F.round("nearest", 6).alias("nearest"), digest.alias("positions_md5"))


def quasi_random_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's cube with one to seven of its eight atoms of a second element, ordered as at random."""
    bases = _cubes(spark, sf_dir)
    second = F.col("structure_index") % 7 + 1
    mixed = bases.withColumn("symbols", F.transform(F.sequence(F.lit(1), F.lit(8)), lambda k: F.when(k <= second, "Cr").otherwise("W")))
    found = defects.quasi_random(mixed, 6.0, 200)
    return found.select("structure_index", F.array_join("symbols", "").alias("order"), F.round("before", 9).alias("before"), F.round("after", 9).alias("after"), "swaps")


def interstitials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's cubic cell of eight atoms with each kind of defect; what was placed keeps its distance."""
    bases = _cubes(spark, sf_dir)
    out = None
    for kind in defects.KINDS:
        gas = ["H", "He"] if kind.startswith("gas") else ["W", "Cr"]
        part = defects.with_defects(bases, kind, 2, gas, (0.1, 0.3))
        out = part if out is None else out.union(part)
    digest = F.md5(F.array_join(F.transform(F.flatten("positions"), lambda x: F.format_string("%.6f", x)), ","))
    return out.select("structure_index", "variant", "perturbation_type", F.size("symbols").alias("n_atoms"), "asked", "placed", digest.alias("positions_md5"))


_S = f"""WITH {ATOMS_SQL}, st AS (SELECT structure_index, list(element ORDER BY element) AS symbols FROM counts GROUP BY 1),
    s AS (SELECT st.*, o_custkey, o_totalprice, CASE o_orderpriority WHEN '1-URGENT' THEN 'elastic_stress' WHEN '2-HIGH' THEN 'rattle' END AS perturbation_type FROM st JOIN orders ON o_orderkey = structure_index)"""
_D = """WITH d AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS n, [229, 225, 194, 227, 221, 62][p_size % 6 + 1] AS g, p_size / 4.0::DOUBLE + 2 AS la FROM part),
    k AS (SELECT *, CASE g WHEN 229 THEN 'bcc' WHEN 225 THEN 'fcc' WHEN 194 THEN 'hcp' WHEN 227 THEN 'diamond' WHEN 221 THEN 'simple_cubic' ELSE 'unknown' END AS structure FROM d)"""
_MODES = ", ".join(f"({k}, '{m}')" for k, m in enumerate(generators.MODES))
_EL = f"""WITH e AS (SELECT s_suppkey, s_suppkey * 18 + m + CASE WHEN a > 0 THEN 9 ELSE 0 END AS k, mode, a, 1 / (1 - a * a) - 1 AS c FROM supplier, (VALUES (-0.02::DOUBLE), (0.02)) t(a), (VALUES {_MODES}) u(m, mode)),
    v AS (SELECT *, CASE mode WHEN 'normal_xx' THEN a WHEN 'coupled_xy' THEN a WHEN 'coupled_yz' THEN c WHEN 'coupled_zx' THEN -a ELSE 0 END AS e1,
        CASE mode WHEN 'normal_yy' THEN a WHEN 'coupled_xy' THEN -a WHEN 'coupled_yz' THEN a WHEN 'coupled_zx' THEN c ELSE 0 END AS e2,
        CASE mode WHEN 'normal_zz' THEN a WHEN 'coupled_xy' THEN c WHEN 'coupled_yz' THEN -a WHEN 'coupled_zx' THEN a ELSE 0 END AS e3,
        CASE mode WHEN 'shear_yz' THEN 2 * a ELSE 0 END AS e4, CASE mode WHEN 'shear_zx' THEN 2 * a ELSE 0 END AS e5, CASE mode WHEN 'shear_xy' THEN 2 * a ELSE 0 END AS e6 FROM e),
    r AS (SELECT *, CASE WHEN k % 19 = 0 THEN 'missing_metadata' WHEN k % 23 = 0 THEN 'unresolved_outcar' WHEN k % 29 = 0 THEN 'identity_mismatch' WHEN k % 31 = 0 THEN 'unparsed_stress' END AS reason FROM v WHERE k % 17 <> 0)"""

QUERIES = {
    f.__name__: f
    for f in (
        elastic_structures, single_element_elastic, subset_compounds, gas_structures, symmetry_filter, space_group_names, pure_lattices, inherited_metadata, record_validation, position_matches,
        dft_ml_comparison, frames_of_atoms, scheduler_membership, element_union, distinct_bins, next_ids, seed_ids, composition_cap, latest_potential, first_lattice, unresolved_preview, anchor_union, perturbation_union,
        hash_annotation, potential_names, fraction_labels, bin_centres, min_max, virials, kpoint_meshes, kpoints_irreducible, elastic_records, elastic_scan_counters, elastic_cubic_paired, elastic_summary, binary_histogram,
        random_solutions, solution_cap, displaced_structures, quasi_random_structures, interstitials, element_lists,
    )
}

ORACLES = {
    "first_lattice": f"{_S} SELECT structure_index, array_to_string(symbols, '-') AS formula, o_totalprice FROM s ORDER BY o_totalprice, structure_index LIMIT 1",
    "elastic_structures": f"{_S} SELECT structure_index, o_custkey FROM s WHERE perturbation_type = 'elastic_stress'",
    "single_element_elastic": f"{_S} SELECT structure_index, symbols[1] AS element FROM s WHERE perturbation_type = 'elastic_stress' AND len(symbols) = 1",
    "subset_compounds": f"""{_S} SELECT structure_index, round(CASE WHEN structure_index % 5 <> 0 THEN o_totalprice / 1000 END, 6) AS energy_above_hull, array_to_string(symbols, '-') AS formula FROM s
        WHERE len(list_filter(symbols, lambda x: x NOT IN ('SMALL', 'LARGE', 'PROMO'))) = 0 ORDER BY coalesce(CASE WHEN structure_index % 5 <> 0 THEN o_totalprice / 1000 END, 0), structure_index LIMIT 50""",
    "gas_structures": f"""{_S} SELECT structure_index, array_to_string(list_concat(symbols, list_filter(['ECONOMY', 'PROMO'], lambda x: NOT list_contains(symbols, x))), '-') AS drawn FROM s
        WHERE list_contains(symbols, 'ECONOMY') OR list_contains(symbols, 'PROMO')""",
    "symmetry_filter": f"""{_D} SELECT p_partkey, structure FROM k WHERE n = 1 AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND structure IN ('bcc', 'fcc', 'hcp')""",
    "space_group_names": f"{_D} SELECT p_partkey, structure FROM k",
    "pure_lattices": f"""{_D}, x AS (SELECT *, CASE structure WHEN 'bcc' THEN la * sqrt(0.75::DOUBLE) WHEN 'fcc' THEN la * sqrt(0.5::DOUBLE) WHEN 'diamond' THEN la * sqrt(0.5::DOUBLE) ELSE la END AS a,
            CASE structure WHEN 'bcc' THEN degrees(acos(-1 / 3::DOUBLE)) WHEN 'fcc' THEN 60 WHEN 'diamond' THEN 60 ELSE 90 END AS al FROM k WHERE structure <> 'unknown')
        SELECT p_partkey, structure, round(a, 6) AS a, round(a, 6) AS b, round(CASE structure WHEN 'hcp' THEN la * 1.633 ELSE a END, 6) AS c, round(al::DOUBLE, 6) AS alpha, round(al::DOUBLE, 6) AS beta,
            round(CASE structure WHEN 'hcp' THEN 120 ELSE al END::DOUBLE, 6) AS gamma,
            round(la ** 3 * CASE structure WHEN 'bcc' THEN 0.5 WHEN 'fcc' THEN 0.25 WHEN 'diamond' THEN 0.25 WHEN 'hcp' THEN 1.633 * sqrt(0.75::DOUBLE) ELSE 1 END, 6) AS volume FROM x""",
    "inherited_metadata": """SELECT event_id, printf('seed_%06d', c_custkey) AS seed_id, CASE WHEN event_type = 'error' THEN 'own' ELSE c_mktsegment END AS source, CASE WHEN c_custkey IS NOT NULL THEN 'mp_phase' END AS configurational_type,
        'strain' AS perturbation_type FROM events LEFT JOIN customer ON c_custkey = user_id""",
    "record_validation": """SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 13 = 0 THEN 'energy' END, CASE WHEN s_suppkey % 5 = 0 THEN 'forces' END,
        CASE WHEN s_suppkey % 11 = 0 THEN 'lattice' END, CASE WHEN s_suppkey % 3 = 0 THEN 'virial' END) AS problems FROM supplier""",
    "position_matches": """WITH k AS (SELECT p_partkey AS id, p_type, round(p_size / 7.0::DOUBLE, 9) AS x, round(round(p_retailprice / 9000.0::DOUBLE, 9), 0) AS y FROM part)
        SELECT t.id AS target_id, max(r.id) AS reference_id FROM k t JOIN k r USING (p_type, x, y) WHERE t.id % 2 = 1 AND r.id % 2 = 0 GROUP BY 1""",
    "dft_ml_comparison": """WITH i AS (SELECT *, row_number() OVER w - 1 AS atom_id, count(*) OVER (PARTITION BY l_orderkey) AS n, sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS energy FROM lineitem
            WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag))
        SELECT l_orderkey AS struct_id, atom_id::INTEGER AS atom_id, l_returnflag AS species, round(energy / n, 6) AS energy_per_atom, round(sqrt(l_discount ** 2 + l_tax ** 2 + 0.01::DOUBLE ** 2), 9) AS force_magnitude,
            user_id % 7 <> n AS mismatch FROM i JOIN events ON event_id = l_orderkey AND event_type <> 'error'""",
    "frames_of_atoms": "SELECT DISTINCT l_orderkey AS structure_index FROM lineitem",
    "scheduler_membership": "SELECT 'job_' || c_custkey AS name, c_custkey IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) AS scheduled FROM customer",
    "element_union": f"{_S} SELECT DISTINCT unnest(symbols) AS element FROM s",
    "distinct_bins": f"SELECT (SELECT count(*) FROM ({P.ORACLES['binary_projection_bins']})) AS binary_bins, (SELECT count(*) FROM ({P.ORACLES['ternary_projection_bins']})) AS ternary_bins",
    "next_ids": """SELECT 'dataset' AS kind, max(c_custkey % 977) + 1 AS next FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'seed', max(s_suppkey * 3) + 1 FROM supplier UNION ALL SELECT 'none', 5""",
    "seed_ids": """WITH u AS (SELECT 0 AS p, 's' AS kind, s_suppkey AS id, NULL::VARCHAR AS old FROM supplier UNION ALL SELECT 1, 'c', c_custkey, CASE WHEN c_acctbal < 0 THEN 'old_' || c_custkey END FROM customer)
        SELECT kind, id, coalesce(old, printf('seed_%06d', row_number() OVER (ORDER BY p, id) - 1)) AS seed_id FROM u""",
    "composition_cap": f"{_S} SELECT array_to_string(symbols, '-') AS formula, structure_index FROM s QUALIFY row_number() OVER (PARTITION BY array_to_string(symbols, '-') ORDER BY o_totalprice, structure_index) <= 3",
    "latest_potential": "SELECT o_custkey, printf('potentials/%06d', arg_max(o_orderkey, (o_orderdate, printf('%06d', o_orderkey)))) AS path FROM orders GROUP BY 1",
    "unresolved_preview": "SELECT o_orderkey AS structure_index FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY 1 LIMIT 8",
    "anchor_union": f"""{_S} SELECT structure_index FROM s WHERE perturbation_type = 'elastic_stress' AND len(symbols) = 1
        UNION SELECT max(o_orderkey) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey""",
    "perturbation_union": """WITH f AS (SELECT * FROM (VALUES ('unperturbed', 0, 1), ('strain', 1, 3), ('elastic_stress', 2, 18), ('volume', 3, 5), ('rattle', 4, 4)) t(perturbation_type, family, n))
        SELECT s_suppkey AS structure_index, v::INTEGER AS variant, perturbation_type, family, printf('seed_%06d', s_suppkey) AS seed_id FROM supplier, f, range(0, 18) t(v) WHERE v < n""",
    "hash_annotation": """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'old' || doc_id ELSE sha256(coalesce(source, '')) END AS structure_hash, CASE WHEN doc_id % 4 = 0 THEN 'structure-v0' ELSE 'structure-v1' END AS structure_hash_version FROM documents""",
    "potential_names": """SELECT p_partkey, concat_ws('_', p_partkey::VARCHAR, CASE WHEN p_size % 2 = 0 THEN 'v' END, CASE WHEN p_size % 4 > 0 THEN (p_size % 4) || '_0' END, CASE WHEN p_size % 3 = 0 THEN 'w' END,
        substr(md5('6 5_4 4_8 8_4 2 1_' || p_size), 1, 8)) AS name FROM part""",
    "fraction_labels": """WITH x AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 3 = 0 THEN 64 ELSE 77 END AS q FROM part)
        SELECT p_partkey, (p_size // gcd(p_size, q)) || '/' || (q // gcd(p_size, q)) AS label FROM x""",
    "bin_centres": f"""SELECT a, b, c, i, j, k, round(i / {P.RESOLUTION}, 9) AS share_a, round(j / {P.RESOLUTION} + k / {P.RESOLUTION} / 2, 9) AS x, round(k / {P.RESOLUTION} * sqrt(3::DOUBLE) / 2, 9) AS y
        FROM ({P.ORACLES['ternary_projection_bins']})""",
    "min_max": """WITH m AS (SELECT *, min(s_acctbal) OVER w AS lo, max(s_acctbal) OVER w AS hi FROM supplier WINDOW w AS (PARTITION BY s_nationkey))
        SELECT s_suppkey, round(CASE WHEN hi > lo THEN (s_acctbal - lo) / (hi - lo) ELSE 0 END, 9) AS scaled FROM m""",
    "virials": """SELECT p_partkey, round(p_size * 0.1::DOUBLE, 6) AS xx, round((p_size * 2 + 20) * 0.1::DOUBLE, 6) AS yz, round(-p_size * 125 / 1602.17663::DOUBLE, 9) AS virial_xx, round(-(p_size * 2) * 125 / 1602.17663::DOUBLE, 9) AS virial_yx FROM part""",
    "kpoints_irreducible": """WITH c AS (SELECT p_partkey, p_partkey % 3 AS k, (p_size % 9)::DOUBLE + 2 AS a FROM part),
        m AS (SELECT p_partkey, k, greatest(1, ceil(2 * pi() / a / 0.4::DOUBLE))::INTEGER AS n1, greatest(1, ceil(2 * pi() / CASE k WHEN 2 THEN a * 1.25::DOUBLE ELSE a END / 0.4::DOUBLE))::INTEGER AS n2,
            greatest(1, ceil(2 * pi() / CASE k WHEN 0 THEN a ELSE a * 1.5::DOUBLE END / 0.4::DOUBLE))::INTEGER AS n3 FROM c),
        h AS (SELECT *, n1 // 2 + 1 AS x, n2 // 2 + 1 AS y, n3 // 2 + 1 AS z FROM m)
        SELECT p_partkey, n1, n2, n3, (CASE k WHEN 0 THEN x * (x + 1) * (x + 2) // 6 WHEN 1 THEN x * (x + 1) // 2 * z ELSE x * y * z END)::INTEGER AS n_kpoints_irr FROM h""",
    "kpoint_meshes": """WITH m AS (SELECT p_partkey, p_size / 3.0::DOUBLE + 2 AS a FROM part) SELECT p_partkey, greatest(1, ceil(2 * pi() / a / 0.3::DOUBLE))::INTEGER AS n1, greatest(1, ceil(pi() / a / 0.3::DOUBLE))::INTEGER AS n2,
        greatest(1, ceil(2 * pi() / (a * 3) / 0.3::DOUBLE))::INTEGER AS n3 FROM m""",
    "elastic_records": f"""{_EL} SELECT k AS structure_index, printf('seed_%06d', s_suppkey) AS group_key, reason, {', '.join(f"CASE WHEN reason IS NULL THEN round(e{i}::DOUBLE, 9) END AS e{i}" for i in range(1, 7))},
        CASE WHEN reason IS NULL THEN round(240 * e1 + 140 * (e2 + e3) + 0.5, 6) END AS s1, CASE WHEN reason IS NULL THEN round(240 * e2 + 140 * (e1 + e3) + 0.5, 6) END AS s2,
        CASE WHEN reason IS NULL THEN round(240 * e3 + 140 * (e1 + e2) + 0.5, 6) END AS s3, {', '.join(f"CASE WHEN reason IS NULL THEN round(80 * e{i} + 0.25, 6) END AS s{i}" for i in (4, 5, 6))} FROM r""",
    "elastic_scan_counters": f"""{_EL} SELECT (SELECT count(*) FROM v) AS frames_seen, count(*) AS elastic_candidates, count(*) AS single_element_candidates, count(*) FILTER (reason IS NULL) AS matched_completed_records,
        {', '.join(f"count(*) FILTER (reason = '{x}') AS {x}" for x in ('missing_metadata', 'unresolved_outcar', 'identity_mismatch', 'unparsed_stress', 'reference_failure'))} FROM r""",
    "elastic_cubic_paired": f"""{_EL} SELECT printf('seed_%06d', s_suppkey) AS group_key, count(*) AS n, 240.0::DOUBLE AS c11, 140.0::DOUBLE AS c12, 80.0::DOUBLE AS c44 FROM r WHERE reason IS NULL GROUP BY s_suppkey""",
    "elastic_summary": f"""{_EL}, m AS (SELECT s_suppkey, mode, count(*) AS c FROM r WHERE reason IS NULL GROUP BY 1, 2)
        SELECT printf('seed_%06d', s_suppkey) AS group_key, sum(c)::BIGINT AS n, string_agg(mode || ':' || c, ',' ORDER BY mode) AS modes, '' AS warnings, 0.0::DOUBLE AS rmse, 80.0::DOUBLE AS least_eigenvalue FROM m GROUP BY s_suppkey HAVING sum(c) >= 7""",
    "random_solutions": f"""WITH {numerics._SITES}, v AS (SELECT structure_index, variant, site, row_number() OVER (PARTITION BY structure_index, variant ORDER BY md5(structure_index || '|' || site || '|' || variant || '|11'), site) AS r
            FROM s, range(0, 2) t(variant)),
        e AS (SELECT structure_index, element, row_number() OVER (PARTITION BY structure_index ORDER BY element) AS r FROM s)
        SELECT structure_index, variant::INTEGER AS variant, site, element FROM v JOIN e USING (structure_index, r)""",
    "element_lists": """SELECT DISTINCT p_partkey, upper(p_name[1]) || lower(p_name[2:]) AS element FROM part WHERE upper(p_name) NOT IN (SELECT upper(p_type) FROM part)""",
    "solution_cap": f"""{_S}, c AS (SELECT array_to_string(symbols, '-') AS composition, structure_index % 3 AS lattice, structure_index AS variant FROM s)
        SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY composition ORDER BY lattice, variant) <= 5""",
    "binary_histogram": f"""WITH b AS ({P.ORACLES['binary_projection_bins']}) SELECT p.a, p.b, t.i::INTEGER AS bin, coalesce(b.n, 0)::BIGINT AS n FROM (SELECT DISTINCT a, b FROM b) p CROSS JOIN range(0, {P.BINS}) t(i)
        LEFT JOIN b ON b.a = p.a AND b.b = p.b AND b.bin = t.i""",
}
