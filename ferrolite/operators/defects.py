"""Defects and solid solutions: variants of structures whose places and elements are drawn by a hash of their own ids.

Draws depend on (structure, variant, step, try) alone, so neither tasks nor their order change an outcome.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("interstitial", "gas_interstitial", "vacancy_interstitial", "gas_in_vacancy")
_SCHEMA = pa.schema(
    [("structure_index", pa.int64()), ("variant", pa.int32()), ("perturbation_type", pa.string()), ("symbols", pa.list_(pa.string())), ("positions", pa.list_(pa.list_(pa.float64())))]
    + [("asked", pa.int32()), ("placed", pa.int32())]
)
_DDL = "structure_index bigint, variant int, perturbation_type string, symbols array<string>, positions array<array<double>>, asked int, placed int"


def _dealt(bases: DataFrame) -> DataFrame:
    """Rows over all cores: the work of a row is long, and a small table is read by one task."""
    return bases.repartition(4 * bases.sparkSession.sparkContext.defaultParallelism)


def draws(*key: object, n: int = 3) -> np.ndarray:
    """``n`` numbers in [0, 1) from a hash of the key."""
    data = hashlib.blake2b("|".join(map(str, key)).encode(), digest_size=8 * n).digest()
    return np.frombuffer(data, "<u8") / 2.0**64


def nearest_squared(positions: np.ndarray, place: np.ndarray, cell: np.ndarray, inverse: np.ndarray) -> float:
    """Smallest squared distance to the place over the nearest periodic images."""
    f = (positions - place) @ inverse
    f -= np.rint(f)
    return float(((f @ cell) ** 2).sum(axis=1).min()) if len(positions) else np.inf


def with_defects(bases: DataFrame, kind: str, variants: int, elements: list[str], share: tuple[float, float] = (0.01, 0.05), d_min: float = 1.2, tries: int = 500, seed: int = 0) -> DataFrame:
    """``variants`` structures of each base (structure_index, symbols, positions, cell) with one kind of defect.

    interstitial and gas_interstitial add a share of atoms, drawn between the two of ``share`` (one at least), at places
    that keep ``d_min`` from all atoms; vacancy_interstitial takes as many atoms out first; gas_in_vacancy puts the new atoms
    where those were. A place is looked for ``tries`` times: ``placed`` may be less than ``asked``, and no row is dropped.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown defect {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base in batch.to_pylist():
                cell = np.array(base["cell"], np.float64)
                inverse = np.linalg.inv(cell)
                for variant in range(variants):
                    key = (seed, base["structure_index"], variant, kind)
                    symbols, positions = list(base["symbols"]), np.array(base["positions"], np.float64).reshape(-1, 3)
                    low, high = share
                    asked = max(1, int((low + (high - low) * draws(*key, "share", n=1)[0]) * len(symbols)))
                    holes = np.zeros((0, 3))
                    if kind in ("vacancy_interstitial", "gas_in_vacancy"):
                        order = sorted(range(len(symbols)), key=lambda k: tuple(draws(*key, "gone", k, n=1)))[: min(asked, len(symbols) - 1)]
                        holes = positions[order]
                        keep = [k for k in range(len(symbols)) if k not in set(order)]
                        symbols, positions = [symbols[k] for k in keep], positions[keep]
                    placed = 0
                    for step in range(asked):
                        if kind == "gas_in_vacancy":
                            place = holes[step] if step < len(holes) else None
                        else:
                            found = (draws(*key, step, t) @ cell for t in range(tries))
                            place = next((p for p in found if nearest_squared(positions, p, cell, inverse) >= d_min * d_min), None)
                        if place is not None:
                            positions, placed = np.vstack([positions, place]), placed + 1
                            symbols.append(elements[int(draws(*key, step, "element", n=1)[0] * len(elements))])
                    rows.append((base["structure_index"], variant, kind, symbols, positions.tolist(), asked, placed))
            columns = list(zip(*rows, strict=True)) or [()] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    return _dealt(bases.select(F.col("structure_index").cast("bigint").alias("structure_index"), "symbols", "positions", "cell")).mapInArrow(run, _DDL)


_MOVED = pa.schema([("structure_index", pa.int64()), ("rattle_index", pa.int32()), ("rattle_std", pa.float64()), ("symbols", pa.list_(pa.string())), ("positions", pa.list_(pa.list_(pa.float64()))), ("moved", pa.int32()), ("nearest", pa.float64())])
_MOVED_DDL = "structure_index bigint, rattle_index int, rattle_std double, symbols array<string>, positions array<array<double>>, moved int, nearest double"


def gaussian(*key: object) -> np.ndarray:
    """Three normal numbers from a hash of the key."""
    a, b = draws(*key, n=6).reshape(2, 3)
    return np.sqrt(-2 * np.log1p(-a)) * np.cos(2 * np.pi * b)


def displaced(bases: DataFrame, stds: list[float], d_min: float | None = 1.2, tries: int = 50, seed: int = 0) -> DataFrame:
    """A structure for each base (structure_index, symbols, positions, cell) and each step of a ladder of displacements.

    Every atom in turn is moved by normal numbers of the step's deviation. With ``d_min`` a move must keep that distance from
    all other atoms' nearest images, or be no nearer than the atom was before; it is drawn ``tries`` times, and the atom
    stays if none fits (``moved`` counts the others). ``nearest`` is the smallest distance in the outcome, null for a
    single atom. Flat cells, and structures without atoms or with a null in them, come back as they are with 0 moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base in batch.to_pylist():
                whole = base["positions"] and base["cell"] and not any(x is None for p in [*base["positions"], *base["cell"]] for x in (p or [None]))
                cell = np.array(base["cell"], np.float64) if whole else np.zeros((3, 3))
                sound = bool(whole) and abs(np.linalg.det(cell)) > 1e-12
                for step, std in enumerate(stds):
                    if not sound:
                        rows.append((base["structure_index"], step, std, base["symbols"], base["positions"], 0, None))
                        continue
                    inverse, positions, moved = np.linalg.inv(cell), np.array(base["positions"], np.float64), 0
                    for k in range(len(positions)):
                        others = np.delete(positions, k, axis=0)
                        least = np.inf if d_min is None else min(d_min**2, nearest_squared(others, positions[k], cell, inverse))
                        for t in range(tries if d_min is not None else 1):
                            place = positions[k] + std * gaussian(seed, base["structure_index"], step, k, t)
                            if d_min is None or nearest_squared(others, place, cell, inverse) >= least:
                                positions[k], moved = place, moved + 1
                                break
                    apart = [nearest_squared(np.delete(positions, k, axis=0), p, cell, inverse) for k, p in enumerate(positions)]
                    rows.append((base["structure_index"], step, std, base["symbols"], positions.tolist(), moved, float(np.sqrt(min(apart))) if len(positions) > 1 else None))
            columns = list(zip(*rows, strict=True)) or [()] * len(_MOVED)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MOVED, strict=True)], schema=_MOVED)

    return _dealt(bases.select(F.col("structure_index").cast("bigint").alias("structure_index"), "symbols", "positions", "cell")).mapInArrow(run, _MOVED_DDL)


def random_solutions(sites: DataFrame, counts: DataFrame, variants: int, seed: int = 0) -> DataFrame:
    """structure_index, variant, site, element: each structure's sites (structure_index, site) filled ``variants`` times with
    its elements' counts (structure_index, element, n) in the order of a hash of structure, site and variant.

    Sites beyond the counts get the last element. The counts meet the sites as one small array for each structure.
    """
    before = Window.partitionBy("structure_index").orderBy("element").rowsBetween(Window.unboundedPreceding, 0)
    blocks = counts.withColumn("high", F.sum("n").over(before)).groupBy("structure_index").agg(F.array_sort(F.collect_list(F.struct("high", "element"))).alias("blocks"))
    every = sites.select("structure_index", "site").withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    key = F.md5(F.concat_ws("|", "structure_index", "site", "variant", F.lit(seed)))
    placed = every.withColumn("r", F.row_number().over(Window.partitionBy("structure_index", "variant").orderBy(key, "site")))
    fits = F.filter("blocks", lambda b: F.col("r") <= b["high"])
    element = F.coalesce(F.get(fits, F.lit(0))["element"], F.element_at("blocks", -1)["element"])
    return placed.join(blocks, "structure_index").select("structure_index", "variant", "site", element.alias("element"))


def shell_counts(positions: np.ndarray, cell: np.ndarray, cutoff: float, tolerance: float = 1e-3) -> np.ndarray:
    """(shells, n, n): how many images of atom j lie in each shell of equal distances around atom i, up to the cutoff."""
    inverse = np.linalg.inv(cell)
    reach = np.ceil(cutoff * np.sqrt((inverse**2).sum(axis=0))).astype(int)
    f = positions @ inverse
    apart = f[None] - f[:, None]
    apart -= np.floor(apart)
    found, shifts = [], np.array(list(np.ndindex(*(2 * reach + 2))))
    many = max(1, 100_000 // max(1, apart.size))
    for at in range(0, len(shifts), many):  # many shifts at once, as far as they take little memory
        d = np.sqrt((((apart + shifts[at : at + many, None, None] - reach - 1) @ cell) ** 2).sum(axis=3))
        t, i, j = np.nonzero((d <= cutoff) & (d > tolerance))
        found.append(np.stack([d[t, i, j], i, j], axis=1))
    every = np.concatenate(found)
    every = every[np.argsort(every[:, 0], kind="stable")]
    shell = np.cumsum(np.diff(every[:, 0], prepend=every[:1, 0]) > tolerance)
    out = np.zeros((int(shell[-1]) + 1 if len(shell) else 0, len(positions), len(positions)), np.int64)
    np.add.at(out, (shell, every[:, 1].astype(int), every[:, 2].astype(int)), 1)
    return out


def quasi_random(structures: DataFrame, cutoff: float = 6.0, steps: int = 5000, seed: int = 0) -> DataFrame:
    """structure_index, symbols, before, after, swaps: each structure's elements put on its sites so that its pairs come as
    often as at random.

    ``structures`` (structure_index, symbols, positions, cell) have the composition already. For each shell of distances up
    to ``cutoff`` the pairs of elements are compared with their expectation over all orders of the elements; the score is
    the sum over shells of the summed differences over the shell's pairs. In each of ``steps`` two sites are drawn by a
    hash, and their elements change places if that lowers the score. Structures of one element, flat cells and those
    without pairs come back as they are.
    """

    def score(c: np.ndarray, e: np.ndarray, total: np.ndarray) -> float:
        return float((np.abs(c - e).sum(axis=(1, 2)) / total).sum())

    def arranged(index: int, symbols: list[str], positions: np.ndarray, cell: np.ndarray) -> tuple[list[str], float, float, int]:
        names, kind = np.unique(symbols, return_inverse=True)
        if len(names) < 2 or abs(np.linalg.det(cell)) < 1e-12:
            return symbols, 0.0, 0.0, 0
        s, n = shell_counts(positions, cell, cutoff), len(symbols)
        if not len(s):
            return symbols, 0.0, 0.0, 0
        x = np.eye(len(names), dtype=np.int64)[kind]
        own, total = np.trace(s, axis1=1, axis2=2), s.sum(axis=(1, 2))
        each = x.sum(axis=0)
        expected = (total - own)[:, None, None] * (np.outer(each, each) - np.diag(each)) / (n * (n - 1)) + own[:, None, None] * np.diag(each) / n
        m = s @ x
        c = x.T @ m
        first = now = score(c, expected, total)
        done = 0
        for step in range(steps):
            i, j = (draws(seed, index, "swap", step, n=2) * n).astype(int)
            if kind[i] == kind[j]:
                continue
            d = x[j] - x[i]
            half = d[:, None] * (m[:, i] - m[:, j])[:, None]
            changed = c + half + half.transpose(0, 2, 1) + d[:, None] * d * (s[:, i, i] - s[:, i, j] - s[:, j, i] + s[:, j, j])[:, None, None]
            new = score(changed, expected, total)
            if new < now - 1e-12:
                m, c, now, done = m + (s[:, :, i] - s[:, :, j])[:, :, None] * d, changed, new, done + 1
                kind[[i, j]], x[[i, j]] = kind[[j, i]], x[[j, i]]
        return names[kind].tolist(), first, now, done

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["structure_index"], *arranged(r["structure_index"], r["symbols"], np.array(r["positions"], np.float64).reshape(-1, 3), np.array(r["cell"], np.float64))) for r in batch.to_pylist()]
            kinds = (("structure_index", pa.int64()), ("symbols", pa.list_(pa.string())), ("before", pa.float64()), ("after", pa.float64()), ("swaps", pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[c for c, _ in kinds])

    there = structures.where(F.col("symbols").isNotNull() & F.col("positions").isNotNull() & F.col("cell").isNotNull())
    return _dealt(there.select(F.col("structure_index").cast("bigint").alias("structure_index"), "symbols", "positions", "cell")).mapInArrow(run, "structure_index bigint, symbols array<string>, before double, after double, swaps int")


def first_of_composition(structures: DataFrame, n: int) -> DataFrame:
    """The first ``n`` (composition, lattice order, variant) of each composition: the cap counts over all lattices together."""
    w = Window.partitionBy("composition").orderBy("lattice", "variant")
    return structures.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")
