"""Structures of any known format, runs' records, job folders, and tables that keep what was worked out before."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrolite.functions import text as X
from ferrolite.operators.curation import validated
from ferrolite.sources import xyz
from ferrolite.sources.scratch import stash
from ferrolite.sources.texts import files, structure_format

_COLUMNS = "path string, frame bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>, pbc array<boolean>, info map<string,string>, problems array<string>"


def read_structures(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """path, frame, symbols, positions, cell, pbc, info, problems of POSCAR, CIF and extended XYZ files, by their names.

    A file of another name, and one that can't be read, is one row with the problem.
    """
    names = files(spark, paths, recursive=recursive).withColumn("format", structure_format(F.col("name")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, text, kind in zip(pdf["path"], pdf["text"], pdf["format"], strict=True):
                rows: list[tuple] = []
                if kind == "extxyz":
                    for frame, _, header, body, problem in xyz.split_frames(text):
                        rows.append((path, frame, *(([], [], None, [], {}, [problem]) if problem else xyz.parse_frame(header, body))))
                elif kind == "cif":
                    rows.append((path, 0, *parse_cif(text)))
                else:
                    rows.append((path, 0, [], [], None, [], {}, ["unknown format"]))
                for at in range(0, len(rows), 500):
                    yield pd.DataFrame(rows[at : at + 500], columns=[c.split()[0] for c in _COLUMNS.split(", ")])

    other = names.where("format is null or format <> 'vasp'").select("path", "text", "format").mapInPandas(run, _COLUMNS)
    p = names.where("format = 'vasp'").select("path", xyz.parse_poscar(F.col("text")).alias("p"))
    vasp = p.select(
        "path", F.lit(0).cast("bigint").alias("frame"), "p.symbols", "p.positions", "p.cell", F.lit([True, True, True]).alias("pbc"), F.create_map().cast("map<string,string>").alias("info"),
        F.array_compact(F.array("p.problem")).alias("problems"),
    )
    return other.unionByName(vasp)


def _cell_of(lengths: list[float], angles: list[float]) -> list[list[float]]:
    """Row vectors: a along x, b in the xy plane."""
    (a, b, c), (ca, cb, cg) = lengths, [math.cos(math.radians(x)) for x in angles]
    sg = math.sqrt(1 - cg * cg)
    y = (ca - cb * cg) / sg
    return [[a, 0.0, 0.0], [b * cg, b * sg, 0.0], [c * cb, c * y, c * math.sqrt(max(0.0, 1 - cb * cb - y * y))]]


_TERM = re.compile(r"([+-]?)\s*(?:(\d+)\s*/\s*(\d+)|(\d*\.?\d+))?\s*\*?\s*([xyz]?)")
#: Shares of a cell's vectors up to which images of a site are one atom.
SAME_SITE = 1e-3


def parse_operation(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and shift of an operation such as ``x,1/2-y,z+0.25``."""
    parts = text.strip().strip("'\"").lower().split(",")
    if len(parts) != 3:
        raise ValueError(text)
    matrix, shift = np.zeros((3, 3)), np.zeros(3)
    for i, part in enumerate(parts):
        part, at, terms = part.replace(" ", ""), 0, 0
        while at < len(part):
            m = _TERM.match(part, at)
            if m.end() == at or not (m[2] or m[4] or m[5]) or (at and not m[1]):
                raise ValueError(text)
            size = (int(m[2]) / int(m[3]) if m[2] else float(m[4]) if m[4] else 1.0) * (-1 if m[1] == "-" else 1)
            if m[5]:
                matrix[i, "xyz".index(m[5])] += size
            else:
                shift[i] += size
            at, terms = m.end(), terms + 1
        if not terms:
            raise ValueError(text)
    return matrix, shift


def orbit(site: np.ndarray, operations: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The different images of a site within the cell, its own first; those nearer than ``SAME_SITE`` are one."""
    images = np.array([m @ site + t for m, t in operations])
    images -= np.floor(images + SAME_SITE / 2)
    out: list[np.ndarray] = []
    for p in images:
        if all(np.abs((d := p - q) - np.rint(d)).max() > SAME_SITE for q in out):
            out.append(p)
    return np.array(out)


def parse_cif(text: str) -> tuple[list[str], list[list[float]], list[list[float]] | None, list[bool], dict[str, str], list[str]]:
    """Symbols, Cartesian positions, cell, periodicity, other keys, problems of the first block of a CIF.

    The file's symmetry operations are applied to its sites, and images that coincide are one atom; without any, all atoms
    must be listed, and the name of a space group other than P 1 is a problem.
    """
    number = lambda s: float(re.sub(r"\(\d+\)$", "", s))
    lines = [x.strip() for x in text.splitlines() if x.strip() and not x.strip().startswith("#")]
    single, loops, k = {}, [], 0
    while k < len(lines):
        if lines[k].lower() == "loop_":
            names, rows, k = [], [], k + 1
            while k < len(lines) and lines[k].startswith("_"):
                names.append(lines[k].lower())
                k += 1
            while k < len(lines) and not lines[k].startswith("_") and lines[k].lower() != "loop_" and not lines[k].lower().startswith("data_"):
                rows.append(re.findall(r"'[^']*'|\"[^\"]*\"|\S+", lines[k]))
                k += 1
            loops.append((names, rows))
            continue
        if lines[k].startswith("_") and len(parts := lines[k].split(None, 1)) == 2:
            single[parts[0].lower()] = parts[1].strip("'\"")
        k += 1
    problems, symbols, positions, cell = [], [], [], None
    try:
        cell = _cell_of([number(single[f"_cell_length_{x}"]) for x in "abc"], [number(single[f"_cell_angle_{x}"]) for x in ("alpha", "beta", "gamma")])
    except (KeyError, ValueError, ZeroDivisionError):
        problems.append("no cell")
    operations: list[tuple[np.ndarray, np.ndarray]] = []
    for names, rows in loops:
        column = next((k for k, n in enumerate(names) if n in ("_space_group_symop_operation_xyz", "_symmetry_equiv_pos_as_xyz")), None)
        try:
            # An operation without quotes may hold blanks.
            operations += [parse_operation(r[column] if len(r) == len(names) else "".join(r[column:])) for r in rows] if column is not None else []
        except (ValueError, IndexError, ZeroDivisionError):
            problems.append("symmetry operations can't be read")
    group = next((v for k, v in single.items() if k in ("_symmetry_space_group_name_h-m", "_space_group_name_h-m_alt")), "P 1")
    if not operations and group.replace(" ", "").upper() not in ("P1", "?", "."):
        problems.append(f"no symmetry operations for {group}")
    operations = operations or [(np.eye(3), np.zeros(3))]
    for names, rows in loops:
        if "_atom_site_fract_x" in names and cell:
            at = [names.index(f"_atom_site_fract_{x}") for x in "xyz"]
            name = names.index("_atom_site_type_symbol" if "_atom_site_type_symbol" in names else "_atom_site_label")
            try:
                for r in rows:
                    f, symbol = np.array([number(r[i]) for i in at]), re.match(r"[A-Z][a-z]?", r[name])[0]
                    sites = orbit(f, operations) if len(operations) > 1 else f[None]
                    symbols += [symbol] * len(sites)
                    positions += [[float(sum(p[i] * cell[i][j] for i in range(3))) for j in range(3)] for p in sites]
            except (ValueError, IndexError, TypeError):
                problems.append(f"atom {len(positions)} can't be read")
                symbols, positions = [], []
    if not symbols and not problems:
        problems.append("no atoms")
    return symbols, positions, cell, [True] * 3, single, problems


# ---- extended XYZ, split ------------------------------------------------------------------------------------------


def read_xyz_split(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The frames of extended XYZ files (``xyz.FRAME`` without first_line), read in blocks, so that a file may be of any size.

    A frame begins at a whole number that a line with Lattice= or Properties= follows; blank lines between frames are
    skipped. Frames within a block are parsed where they are read; only what crosses a block's end is moved. Frame numbers
    come from the blocks' counts. ``xyz.read_xyz`` reads files whose frames have no such line.
    """
    source = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out, seq = None, [], [], 0

        def close(last: bool) -> None:
            nonlocal held, seq
            if held:
                out.append((*key, seq, bool(_begins(held)), last, "\n".join(held)))
                seq += 1
            held = []

        for pdf in batches:
            for path, block, line in zip(pdf["path"], pdf["block"], pdf["value"], strict=True):
                if (path, block) != key:
                    close(True)
                    key, seq = (path, block), 0
                held.append(line)
                if len(held) > 2 and _begins(held[-2:]):
                    two, held = held[-2:], held[:-2]
                    close(False)
                    held = two
            if len(out) > 200:
                yield pd.DataFrame(out, columns=["path", "block", "seq", "begins", "last", "text"])
                out.clear()
        close(True)
        yield pd.DataFrame(out, columns=["path", "block", "seq", "begins", "last", "text"])

    parts = stash(source.mapInPandas(run, "path string, block bigint, seq int, begins boolean, last boolean, text string"))
    # A block's last part may go on in the next one, whose first may begin there: both are joined with the last beginning.
    blocks = parts.groupBy("path", "block").agg(F.max(F.when(F.col("begins"), F.struct("block", "seq"))).alias("tail"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", F.last("tail", True).over(before).alias("owner"))  # a row for each block
    known = parts.join(blocks, ["path", "block"])
    own = F.struct("block", "seq")
    whole = F.col("begins") & ~F.col("last")
    glued = known.where(~whole).groupBy("path", F.when(F.col("begins"), own).otherwise(F.coalesce("owner", own)).alias("at"))
    glued = glued.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))), lambda x: x["text"]), "\n").alias("text"))
    every = known.where(whole).select("path", own.alias("at"), "text").union(glued.select("path", "at", "text")).select("path", "at.block", "at.seq", "text")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, block, seq, text in zip(pdf["path"], pdf["block"], pdf["seq"], pdf["text"], strict=True):
                if text.strip():  # the boundary of two blocks can hide a beginning: more than one frame
                    for k, (_, _, header, body, problem) in enumerate(xyz.split_frames(text)):
                        rows.append((path, k, *(([], [], None, [], {}, [problem]) if problem else xyz.parse_frame(header, body)), block, seq))
            yield pd.DataFrame(rows, columns=[*[c.split()[0] for c in _COLUMNS.split(", ")], "block", "seq"])

    parsed = stash(every.mapInPandas(parse, f"{_COLUMNS}, block bigint, seq int"))
    counts = parsed.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    nth = F.row_number().over(Window.partitionBy("path", "block").orderBy("seq", "frame")) - 1
    return parsed.withColumn("frame", nth).join(counts, ["path", "block"]).withColumn("frame", (F.col("frame") + F.col("earlier")).cast("bigint")).drop("block", "seq", "earlier")


def _begins(lines: list[str]) -> bool:
    return len(lines) > 1 and lines[0].strip().isdigit() and ("Lattice=" in lines[1] or "Properties=" in lines[1])


# ---- runs ---------------------------------------------------------------------------------------------------------

_VECTORS = re.compile(r"direct lattice vectors[^\n]*\n((?:[^\n]*\n){3})")
_FORCES = re.compile(r"TOTAL-FORCE[^\n]*\n\s*-+\s*\n((?:\s*[-+\d.eE]+(?:\s+[-+\d.eE]+){5}\s*\n)+)")
_ENERGY = re.compile(r"free\s+energy\s+TOTEN\s*=\s*([-+\d.eE]+)")
_KINDS = re.compile(r"VRHFIN\s*=\s*([A-Za-z]+)\s*:")
_COUNTS = re.compile(r"ions per type\s*=\s*([\d ]+)")


def run_records(texts: DataFrame) -> DataFrame:
    """path, energy, species, positions, forces, lattice, virial, problems of runs' logs (path, text): the last of each.

    A run that lacks something comes with the problem and is not replaced by anything else; the rows without problems are
    the training records.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                energy = _ENERGY.findall(text)
                vectors, forces = _VECTORS.findall(text), _FORCES.findall(text)
                table = [[float(x) for x in line.split()] for line in forces[-1].splitlines() if line.strip()] if forces else []
                lattice = [[float(x) for x in line.replace("-", " -").split()[:3]] for line in vectors[-1].splitlines()] if vectors else None
                counts = _COUNTS.search(text)
                species = [s for s, n in zip(_KINDS.findall(text), counts[1].split() if counts else [], strict=False) for _ in range(int(n))]
                rows.append((path, float(energy[-1]) if energy else None, species, [r[:3] for r in table], [r[3:] for r in table], lattice))
            yield pd.DataFrame(rows, columns=["path", "energy", "species", "positions", "forces", "lattice"])

    parsed = texts.select("path", "text").mapInPandas(run, "path string, energy double, species array<string>, positions array<array<double>>, forces array<array<double>>, lattice array<array<double>>")
    stress = texts.select("path", X.stress_matrix_gpa(F.col("text")).alias("stress"))
    m = [[F.col("lattice")[i][j] for j in range(3)] for i in range(3)]
    volume = F.abs(m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))
    v = X.virial(F.transform("stress", lambda x: x * 10), volume)
    virial = F.when(F.col("stress").isNotNull() & F.col("lattice").isNotNull(), F.array(*[F.slice(v, 3 * i + 1, 3) for i in range(3)]))
    return validated(parsed.join(stress, "path").withColumn("virial", virial).drop("stress"))


def job_folders(spark: SparkSession, root: str) -> DataFrame:
    """path, kind, name, settings: folders below ``root`` that hold a POSCAR and are named struct_* or atoms_*/gpu*_nc*_kp*.

    Only names are listed; contents are not read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "POSCAR").load(root).select(F.regexp_replace("path", r"/POSCAR$", "").alias("path"))
    bench = r"/(atoms_\d+)/(gpu(\d+)_nc(\d+)_kp(\d+))$"
    kind = F.when(F.col("path").rlike(bench), "benchmark").when(F.col("path").rlike(r"/struct_[^/]*$"), "structure")
    number = [F.regexp_extract("path", bench, k).try_cast("int").alias(n) for k, n in ((3, "gpus"), (4, "ncore"), (5, "kpar"))]
    return found.withColumn("kind", kind).where("kind is not null").select("path", "kind", F.element_at(F.split("path", "/"), -1).alias("name"), F.struct(*number).alias("settings"))


def target_generation(text: Column) -> Column:
    """The whole number after the word generation in a training input; null without one."""
    return F.nullif(F.regexp_extract(text, r"(?im)^\s*generation\s+(\d+)", 1), F.lit("")).cast("bigint")


# ---- what is kept -------------------------------------------------------------------------------------------------


def cached_descriptors(structures: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """structure_hash, v of ``structures``: those in the table at ``path``, and the others by ``compute``, which are added."""
    spark = structures.sparkSession
    wanted = structures.dropDuplicates(["structure_hash"])
    try:
        known = spark.read.parquet(path)
        missing = wanted.join(known.select("structure_hash"), "structure_hash", "left_anti")
    except AnalysisException:
        missing = wanted
    made = stash(compute(missing).select("structure_hash", "v"))
    if made.take(1):
        made.write.mode("append").parquet(path)
    elif missing is wanted:
        return made  # nothing to keep yet
    return spark.read.parquet(path).join(wanted.select("structure_hash"), "structure_hash", "left_semi")


def cached_answer(spark: SparkSession, folder: str, parts: list[str], make: Callable[[], DataFrame]) -> DataFrame:
    """The JSON table that an earlier call with the same parameters (in any order) left below ``folder``, or a new one."""
    import hashlib

    path = f"{folder.rstrip('/')}/{hashlib.md5('_'.join(sorted(parts)).encode()).hexdigest()}"
    try:
        return spark.read.json(path)
    except AnalysisException:
        make().write.mode("errorifexists").json(path)
        return spark.read.json(path)


def write_labelled(rows: DataFrame, labels: DataFrame, path: str) -> None:
    """One Parquet table of descriptors (id, v) with the label of each (id, split), a folder for each label."""
    rows.join(labels.select("id", F.col("split").alias("label")), "id").write.mode("overwrite").partitionBy("label").parquet(path)


def write_csv(rows: DataFrame, path: str, digits: int = 12) -> None:
    """A CSV table with a header, numbers with ``digits`` decimals."""
    columns = [F.format_string(f"%.{digits}f", c).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes]
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)

