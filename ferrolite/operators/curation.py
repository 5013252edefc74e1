"""Filters, metadata, ids and membership: what decides which structures go on, and under which names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.functions.composition import single_element

# Crystal system, space group and name of the known structures, and the ratio of axes of hcp.
SYMMETRIES = [("cubic", 229, "bcc"), ("cubic", 225, "fcc"), ("hexagonal", 194, "hcp"), ("cubic", 227, "diamond"), ("cubic", 221, "simple_cubic")]
HCP_RATIO = 1.633
INHERITED = ("composition", "actual_composition", "crystal_structure", "configurational_type", "source", "seed_id")


def elastic_only(rows: DataFrame, single: bool = False) -> DataFrame:
    """Rows perturbed for elastic constants; with ``single``, those of one element only (columns composition, symbols)."""
    kept = rows.where(F.coalesce("perturbation_type", F.lit("")) == "elastic_stress")
    return kept.where(single_element(F.col("composition"), F.col("symbols"))) if single else kept


def required(rows: DataFrame, what: str) -> DataFrame:
    """``rows``, or an error if there are none."""
    if not rows.take(1):
        raise ValueError(f"no {what}")
    return rows


def within_elements(rows: DataFrame, elements: list[str]) -> DataFrame:
    """Rows whose ``elements`` are all among the asked ones."""
    return rows.where(F.size(F.array_except("elements", F.lit(elements))) == 0)


def with_any(rows: DataFrame, elements: list[str], column: str = "elements") -> DataFrame:
    """Rows that have at least one of the asked elements."""
    return rows.where(F.arrays_overlap(F.col(column), F.lit(elements)))


def most_stable(rows: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows of smallest ``energy_above_hull`` (a null one counts as 0), ties to the smaller key."""
    return rows.orderBy(F.coalesce("energy_above_hull", F.lit(0.0)), key).limit(n)


def structure_name(space_group: Column) -> Column:
    """The name of a space group's structure, or unknown."""
    known = F.create_map(*[F.lit(x) for _, number, name in SYMMETRIES for x in (number, name)])
    return F.coalesce(F.try_element_at(known, space_group.cast("int")), F.lit("unknown"))


def of_structures(docs: DataFrame, targets: list[str]) -> DataFrame:
    """Docs of a single element whose crystal system and space group belong to one of the target structures, once each.

    Unknown targets and docs without symmetry match nothing.
    """
    wanted = [(system, number) for system, number, name in SYMMETRIES if name in {t.lower() for t in targets}]
    pairs = F.lit([f"{s}:{n}" for s, n in wanted]) if wanted else F.array().cast("array<string>")
    mine = F.concat_ws(":", F.lower("crystal_system"), F.col("space_group").cast("string"))
    return docs.where((F.size("elements") == 1) & F.col("crystal_system").isNotNull() & F.array_contains(pairs, mine))


def pure_cell(structure: Column, a: Column) -> Column:
    """Row vectors of the primitive cell of a structure with the lattice constant ``a``; null for an unknown one."""
    zero, h = F.lit(0.0), a / 2

    def rows(*xs: list[Column]) -> Column:
        return F.array(*[F.array(*x) for x in xs])

    face = rows([zero, h, h], [h, zero, h], [h, h, zero])
    return (
        F.when(structure == "bcc", rows([-h, h, h], [h, -h, h], [h, h, -h]))
        .when(structure.isin("fcc", "diamond"), face)
        .when(structure == "hcp", rows([a, zero, zero], [-h, a * F.lit(3.0**0.5 / 2), zero], [zero, zero, a * HCP_RATIO]))
        .when(structure == "simple_cubic", rows([a, zero, zero], [zero, a, zero], [zero, zero, a]))
    )


def lattice_record(cell: Column) -> Column:
    """struct(a, b, c, alpha, beta, gamma, volume) of a cell of row vectors; angles in degrees."""

    def dot(i: int, j: int) -> Column:
        return cell[i][0] * cell[j][0] + cell[i][1] * cell[j][1] + cell[i][2] * cell[j][2]

    def length(i: int) -> Column:
        return F.sqrt(dot(i, i))

    def angle(i: int, j: int) -> Column:
        return F.degrees(F.acos(F.least(F.greatest(dot(i, j) / (length(i) * length(j)), F.lit(-1.0)), F.lit(1.0))))

    cross = [cell[1][1] * cell[2][2] - cell[1][2] * cell[2][1], cell[1][2] * cell[2][0] - cell[1][0] * cell[2][2], cell[1][0] * cell[2][1] - cell[1][1] * cell[2][0]]
    volume = F.abs(cell[0][0] * cross[0] + cell[0][1] * cross[1] + cell[0][2] * cross[2])
    return F.struct(length(0).alias("a"), length(1).alias("b"), length(2).alias("c"), angle(1, 2).alias("alpha"), angle(0, 2).alias("beta"), angle(0, 1).alias("gamma"), volume.alias("volume"))


def inherited(children: DataFrame, bases: DataFrame, on: str, kind: str) -> DataFrame:
    """``children`` with the metadata (``INHERITED``) that they lack themselves from their base, and their perturbation type."""
    keys = [k for k in INHERITED if k != on]
    theirs = bases.select(on, *[(F.col(k) if k in bases.columns else F.lit(None).cast("string")).alias(f"_{k}") for k in keys])
    joined = children.join(theirs, on, "left")
    own = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) if k in children.columns else F.col(f"_{k}").alias(k) for k in keys]
    rest = [c for c in children.columns if c not in keys and c != "perturbation_type"]
    return joined.select(*rest, *own, F.lit(kind).alias("perturbation_type"))


def validated(records: DataFrame) -> DataFrame:
    """``records`` (energy, forces, species, lattice, virial) with ``problems``: empty for a valid one.

    A null virial is fine; a null or non-finite energy is not.
    """

    def square(c: str) -> Column:
        return (F.size(c) == 3) & F.forall(F.col(c), lambda r: F.coalesce(F.size(r) == 3, F.lit(False)))

    checks = {
        "energy": F.col("energy").isNotNull() & ~F.isnan("energy") & (F.abs("energy") < float("inf")),
        "forces": F.size("forces") == F.size("species"),
        "lattice": square("lattice"),
        "virial": F.col("virial").isNull() | square("virial"),
    }
    return records.withColumn("problems", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])))


def draw_list(elements: Column, gas: Column) -> Column:
    """The elements with the gas elements after them, each once."""
    return F.array_union(elements, F.coalesce(gas, F.array().cast("array<string>")))


def matched_positions(reference: DataFrame, target: DataFrame) -> DataFrame:
    """Index of the reference row (the last of equal keys) of each target row that has its position key, with that row's id.

    Both have id and key (``functions.structure.position_key``); target rows without a partner are left out.
    """
    last = reference.groupBy("key").agg(F.max("id").alias("reference_id"))
    return target.join(last, "key").select(F.col("id").alias("target_id"), "reference_id")


def compared(dft: DataFrame, ml: DataFrame) -> DataFrame:
    """Per-atom rows of structures that both sides have: struct_id, atom_id, species, energies for each atom, force
    magnitude and ``mismatch`` where their numbers of atoms differ. ``dft``: struct_id, energy, species, forces; ``ml``: struct_id, atoms.
    """
    both = dft.join(ml.select("struct_id", F.col("atoms").alias("ml_atoms")), "struct_id")
    n = F.size("species")
    per_atom = both.select("struct_id", (F.col("energy") / n).alias("energy_per_atom"), (F.col("ml_atoms") != n).alias("mismatch"), "forces", F.posexplode("species").alias("atom_id", "species"))
    f = F.get("forces", F.col("atom_id"))
    return per_atom.select("struct_id", "atom_id", "species", "energy_per_atom", F.sqrt(f[0] * f[0] + f[1] * f[1] + f[2] * f[2]).alias("force_magnitude"), "mismatch")


def frames_of_atoms(atoms: DataFrame) -> DataFrame:
    """The structures that chosen atoms (structure_index, atom_index) come from, once each."""
    return atoms.select("structure_index").distinct()


def scheduled(jobs: DataFrame, running: DataFrame, pending: DataFrame) -> DataFrame:
    """``jobs`` (name) with ``scheduled``: whether the scheduler has the job as running or pending."""
    there = running.select("name").union(pending.select("name")).where("name is not null").distinct().withColumn("_there", F.lit(True))
    return jobs.join(there, "name", "left").withColumn("scheduled", F.coalesce("_there", F.lit(False))).drop("_there")


def first_record(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row in an explicit order, if there is any: each task keeps one."""
    return rows.orderBy(*order).limit(1)


def capped(rows: DataFrame, per: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each value of ``per``: a window that keeps n rows a task before the shuffle."""
    w = Window.partitionBy(per).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")


def newest(rows: DataFrame, per: str, time: str, path: str) -> DataFrame:
    """The path of largest ``time`` for each value of ``per``, ties to the larger path."""
    return rows.groupBy(per).agg(F.max(F.struct(time, path)).alias("_x")).select(per, F.col(f"_x.{path}").alias(path))


def next_number(ids: DataFrame, column: str, prefix: str, fallback: int = 1) -> DataFrame:
    """One row, ``next``: one more than the largest number behind the prefix, ``fallback`` without any."""
    number = F.when(F.col(column).rlike(f"^{prefix}[0-9]+$"), F.substring(F.col(column), len(prefix) + 1, 1 << 20).try_cast("bigint"))
    return ids.agg(F.greatest(F.coalesce(F.max(number) + 1, F.lit(fallback)), F.lit(fallback)).alias("next"))


def united(parts: list[DataFrame], order: str, column: str = "seed_id", start: int = 0) -> DataFrame:
    """All parts, in their order and within each by ``order``, with sequential ids ``seed_NNNNNN`` from ``start``.

    Ids that rows have already are kept; the counter goes on over them. Ids come from totals of each part of the key
    range, so that no task sees all rows.
    """
    every = None
    for k, p in enumerate(parts):
        part = p.withColumn("_part", F.lit(k))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    placed = numbered(every, "_part", order)
    fresh = F.format_string("seed_%06d", F.col("_nth") + start)
    old = F.col(column) if column in every.columns else F.lit(None).cast("string")
    return placed.select(*[c for c in placed.columns if c not in ("_part", "_nth", column)], F.coalesce(old, fresh).alias(column))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``_nth`` from 0 in the given order: ranges of the key are counted, and each numbers its own rows."""
    from ferrolite.sources.scratch import stash

    ranged = stash(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_range", "_first", before.alias("_before"))  # a row for each range
    return ranged.join(F.broadcast(starts), "_range").withColumn("_nth", F.col("_before") + F.col("_at") - F.col("_first")).drop("_range", "_at", "_first", "_before")


def perturbed(bases: DataFrame, families: dict[str, DataFrame]) -> DataFrame:
    """All perturbed rows of the bases: ``families`` (name to structure_index, variant) in their order, with the base's
    seed_id, then the bases themselves as unperturbed."""
    out = bases.select("structure_index", F.lit(0).alias("variant"), F.lit("unperturbed").alias("perturbation_type"), F.lit(0).alias("family"))
    for k, (name, rows) in enumerate(families.items()):
        out = out.union(rows.select("structure_index", F.col("variant").cast("int"), F.lit(name), F.lit(k + 1)))
    return out.join(bases.select("structure_index", "seed_id"), "structure_index")


def annotated(rows: DataFrame, made: Column, overwrite: bool = False, version: str = "structure-v1") -> DataFrame:
    """``rows`` with structure_hash and structure_hash_version; a hash that is there stays unless ``overwrite``."""
    keep = F.lit(not overwrite) & F.col("structure_hash").isNotNull() if "structure_hash" in rows.columns else F.lit(False)
    old = F.col("structure_hash") if "structure_hash" in rows.columns else F.lit(None).cast("string")
    was = F.col("structure_hash_version") if "structure_hash_version" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("_v", F.when(keep, was).otherwise(F.lit(version))).withColumn("structure_hash", F.when(keep, old).otherwise(made)).withColumn("structure_hash_version", F.col("_v")).drop("_v")


def counters(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows there are and how many meet each condition, in one pass."""
    return rows.agg(F.count(F.lit(1)).alias("frames_seen"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def distinct_elements(rows: DataFrame) -> DataFrame:
    """Every element of any row's ``symbols``, once."""
    return rows.select(F.explode("symbols").alias("element")).distinct()


def unknown_elements(rows: DataFrame, known: DataFrame, key: str, column: str) -> DataFrame:
    """``key`` and each element of its list ``column`` that the dimension table ``known`` (element) lacks."""
    return rows.select(key, F.explode(column).alias("element")).distinct().join(known.select("element").distinct(), "element", "left_anti").select(key, "element")


def min_max(rows: DataFrame, column: str, per: str) -> DataFrame:
    """``column`` brought to [0, 1] within each group; 0 where a group has one value only. Extremes are aggregated first."""
    ends = rows.groupBy(per).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    return rows.join(ends, per).withColumn(column, F.when(span > 0, (F.col(column) - F.col("_lo")) / span).otherwise(F.lit(0.0))).drop("_lo", "_hi")


def parameter_hash(*parts: Column) -> Column:
    """Eight characters of the md5 of the parameters joined by _."""
    return F.substring(F.md5(F.concat_ws("_", *[p.cast("string") for p in parts]).cast("binary")), 1, 8)


def potential_name(n_train: Column, has_virial: Column, outer: Column, weighted: Column, params: Column) -> Column:
    """<train rows>[_v][_<outer radius>][_w]_<hash of the parameters>, the point of the radius as _."""
    radius = F.when(outer > 0, F.regexp_replace(outer.cast("string"), r"\.", "_"))
    return F.concat_ws("_", n_train.cast("string"), F.when(has_virial, F.lit("v")), radius, F.when(weighted, F.lit("w")), params)
