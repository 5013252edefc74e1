"""Canonical texts and hashes of structures."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` worked out once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _triples(v: np.ndarray) -> list[str]:
    return [f"{x:.14f} {y:.14f} {z:.14f}" for x, y, z in zip(v[0::3], v[1::3], v[2::3], strict=False)]


@F.pandas_udf(T.StringType())
def _cell_lines(cells: pd.Series) -> pd.Series:
    """Nine numbers as three lines, rounded from their exact binary value: the JVM rounds their shortest decimal form,
    which gives another last digit for some, hence the Arrow function."""
    return pd.Series([None if v is None else "\n".join(_triples(v)) for v in cells], dtype=object)


@F.pandas_udf(T.StringType())
def _atom_lines(symbols: pd.Series, positions: pd.Series) -> pd.Series:
    """Atoms by element, in input order within one."""
    out = []
    for s, v in zip(symbols, positions, strict=True):
        lines = None if s is None or v is None else [f"{e} {p}" for e, p in zip(s, _triples(v), strict=False)]
        out.append(None if lines is None else "\n".join(lines[k] for k in sorted(range(len(lines)), key=lambda k: s[k])))
    return pd.Series(out, dtype=object)


def canonical_text(symbols: Column, positions: Column, cell: Column, pbc: Column) -> Column:
    """A version line, periodicity, cell rows and atoms: by element, in input order within one, 14 decimals, a line end last.

    Positions are shares of the cell's vectors; ``scaled`` makes them from Cartesian ones.
    """
    periodic = F.array_join(F.transform(pbc, lambda b: b.cast("int").cast("string")), " ")
    # The layout of the text, line by line; hashes of other tools depend on it.
    lines = [F.lit("structure-v1"), F.concat(F.lit("pbc "), periodic), F.lit("cell"), _cell_lines(F.flatten(cell)), F.lit("atoms"), _atom_lines(symbols, F.flatten(positions)), F.lit("")]
    return F.concat_ws("\n", *lines)


def structure_hash(symbols: Column, positions: Column, cell: Column, pbc: Column) -> Column:
    return F.sha2(canonical_text(symbols, positions, cell, pbc).cast("binary"), 256)


def position_key(formula: Column, positions: Column) -> Column:
    """A coarse key: formula and positions to six decimals."""
    return F.md5(F.concat_ws("|", formula, F.array_join(F.transform(positions, lambda p: F.array_join(F.transform(p, lambda x: F.format_string("%.6f", x)), " ")), ";")).cast("binary"))


def determinant(m: Column) -> Column:
    """Of a nested 3 x 3 array."""
    a = [[m[i][j] for j in range(3)] for i in range(3)]
    return a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1]) - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0]) + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0])


def inverse(m: Column) -> Column:
    """Of a nested 3 x 3 array, in closed form; null if the determinant is below 1e-15 in size."""

    def minor(a: Column, d: Column, i: int, j: int) -> Column:
        r, c = [k for k in range(3) if k != j], [k for k in range(3) if k != i]
        x = a[r[0]][c[0]] * a[r[1]][c[1]] - a[r[0]][c[1]] * a[r[1]][c[0]]
        return (x if (i + j) % 2 == 0 else -x) / d

    def made(a: Column, d: Column) -> Column:
        return F.when(F.abs(d) >= 1e-15, F.array(*[F.array(*[minor(a, d, i, j) for j in range(3)]) for i in range(3)]))

    return let(m, lambda a: let(determinant(a), lambda d: made(a, d)))


def times(v: Column, m: Column) -> Column:
    """Row vector times matrix."""
    return F.array(*[v[0] * m[0][j] + v[1] * m[1][j] + v[2] * m[2][j] for j in range(3)])


def product(a: Column, b: Column) -> Column:
    """Matrix product of two nested 3 x 3 arrays; null if either is."""
    return let(a, lambda x: let(b, lambda y: F.when(x.isNotNull() & y.isNotNull(), F.array(*[times(x[i], y) for i in range(3)]))))


def scaled(positions: Column, cell: Column) -> Column:
    """Cartesian positions as shares of the cell's vectors, not wrapped; null for a flat cell.

    Work them out in a stage before ``structure_hash`` (before a grouping, say): Spark does not find an Arrow function whose
    input has a lambda in a lambda.
    """
    return let(inverse(cell), lambda inv: F.when(inv.isNotNull(), F.transform(positions, lambda p: times(p, inv))))


def kpoint_mesh(cell: Column, spacing: Column) -> Column:
    """Divisions along each reciprocal axis: ceil(2 pi |b| / spacing), 1 at least. ``irreducible_kpoints`` uses symmetry."""

    def one(inv: Column, j: int) -> Column:
        length = F.sqrt(inv[0][j] * inv[0][j] + inv[1][j] * inv[1][j] + inv[2][j] * inv[2][j])
        return F.greatest(F.lit(1), F.ceil(F.lit(2 * math.pi) * length / spacing)).cast("int")

    return let(inverse(cell), lambda inv: F.when(inv.isNotNull(), F.array(*[one(inv, j) for j in range(3)])))


def replicates(cell: Column, cutoff: Column) -> Column:
    """Repeats along each axis for twice the cutoff: by the diagonal, or by the row's length where that is about 0."""

    def one(i: int) -> Column:
        length = F.sqrt(sum((cell[i][j] * cell[i][j] for j in range(3)), F.lit(0.0)))
        span = F.when(F.abs(cell[i][i]) > 1e-12, F.abs(cell[i][i])).otherwise(length)
        return F.greatest(F.lit(1), F.ceil(2 * cutoff / span)).cast("int")

    return F.array(*[one(i) for i in range(3)])


#: Relative difference of lengths, and difference of shares of the cell's vectors, up to which they are equal.
SYMMETRY = 1e-5


def lattice_rotations(cell: np.ndarray, tolerance: float = SYMMETRY) -> np.ndarray:
    """Integer matrices W (of components up to 2) that keep the metric: x -> W x of shares of the cell's row vectors."""
    g = cell @ cell.T
    r = np.arange(-2, 3)
    every = np.stack(np.meshgrid(r, r, r, indexing="ij"), axis=-1).reshape(-1, 3)
    lengths = np.einsum("ki,ij,kj->k", every, g, every)
    limit = tolerance * np.abs(np.diag(g)).max()
    first, second, third = (every[np.abs(lengths - g[k, k]) <= limit] for k in range(3))
    dots = first @ g @ second.T
    out = []
    for i, j in zip(*np.nonzero(np.abs(dots - g[0, 1]) <= limit), strict=True):
        a, b = first[i], second[j]
        fit = (np.abs(third @ g @ a - g[0, 2]) <= limit) & (np.abs(third @ g @ b - g[1, 2]) <= limit)
        out += [np.stack([a, b, c], axis=1) for c in third[fit]]  # images of the vectors are columns
    return np.array([w for w in out if abs(round(np.linalg.det(w))) == 1])


def crystal_rotations(cell: np.ndarray, sites: np.ndarray, symbols: list[str], tolerance: float = 1e-4) -> np.ndarray:
    """Those of ``lattice_rotations`` that map the atoms (shares of the cell's vectors) onto atoms of their kind, with a shift."""
    names = np.array(symbols)
    kinds, counts = np.unique(names, return_counts=True)
    rare = np.flatnonzero(names == kinds[counts.argmin()])

    def maps(w: np.ndarray) -> bool:
        turned = sites @ w.T
        for target in rare:
            moved = turned + (sites[target] - turned[rare[0]])
            d = moved[:, None] - sites[None]
            near = (np.abs(d - np.rint(d)).max(axis=2) <= tolerance) & (names[:, None] == names[None])
            if near.any(axis=1).all():
                return True
        return False

    return np.array([w for w in lattice_rotations(cell) if maps(w)])


def irreducible_points(rotations: np.ndarray, mesh: list[int], gamma: bool = True) -> int:
    """Points of a mesh of reciprocal space that neither the rotations nor the reversal of time map onto each other."""
    n = np.array(mesh)
    shift = 0 if gamma else 1
    address = np.stack(np.meshgrid(*[np.arange(x) for x in n], indexing="ij"), axis=-1).reshape(-1, 3)
    twice = 2 * address + shift  # in units of 1 / (2 n)
    label, whole = np.arange(len(address)), np.prod(n)
    images = []
    for w in np.concatenate([rotations, -rotations]):
        # k' = W^T k, in units of 1 / (2 n): exact if it divides.
        top = (twice * (whole // n)) @ w
        index, rest = np.divmod(top * n, whole)
        index -= shift
        ok = (rest == 0).all(axis=1) & (index % 2 == 0).all(axis=1)
        to = (index // 2) % n
        images.append((np.flatnonzero(ok), np.ravel_multi_index(to[ok].T, n)))
    while True:
        before = label.copy()
        for a, b in images:
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        if (label == before).all():
            return len(np.unique(label))


def irreducible_kpoints(cell: Column, positions: Column, symbols: Column, mesh: Column, gamma: bool = True) -> Column:
    """How many k-points of the mesh are left by the crystal's symmetry; null for a flat cell, without atoms or without a
    mesh. ``positions`` are Cartesian. The mesh holds no more points than one task can (a row's own work)."""

    def one(c, p, s, m) -> int | None:
        if c is None or p is None or s is None or m is None or not len(p) or len(p) != len(s):
            return None
        cell = np.array([list(x) for x in c], np.float64)
        if abs(np.linalg.det(cell)) < 1e-12:
            return None
        sites = np.array([list(x) for x in p], np.float64) @ np.linalg.inv(cell)
        return irreducible_points(crystal_rotations(cell, sites, list(s)), [int(x) for x in m], gamma)

    @F.pandas_udf("int")
    def run(c: pd.Series, p: pd.Series, s: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([one(*x) for x in zip(c, p, s, m, strict=True)], dtype="Int32")

    return run(cell, positions, symbols, mesh)
