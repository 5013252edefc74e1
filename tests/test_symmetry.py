"""Symmetry: operations of CIF files, and k-points that symmetry leaves."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.functions import structure as S
from ferrolite.operators import defects
from ferrolite.sources import structures as R

SQUARE = ["x,y,z", "-x,-y,z", "1/2-y,1/2+x,1/2+z", "1/2+y,1/2-x,1/2+z", "1/2-x,1/2+y,1/2-z", "1/2+x,1/2-y,1/2-z", "y,x,-z", "-y,-x,-z"]
RUTILE = SQUARE + ["-x,-y,-z", "x,y,-z", "1/2+y,1/2-x,1/2-z", "1/2-y,1/2+x,1/2-z", "1/2+x,1/2-y,1/2+z", "1/2-x,1/2+y,1/2+z", "-y,-x,z", "y,x,z"]


def cif(cell, operations, sites, group=None):
    lengths = "\n".join(f"_cell_length_{x} {v}" for x, v in zip("abc", cell[:3], strict=True))
    angles = "\n".join(f"_cell_angle_{x} {v}" for x, v in zip(("alpha", "beta", "gamma"), cell[3:], strict=True))
    name = f"_symmetry_space_group_name_H-M '{group}'\n" if group else ""
    loop = "loop_\n_symmetry_equiv_pos_site_id\n_symmetry_equiv_pos_as_xyz\n" + "".join(f"{k + 1} '{o}'\n" for k, o in enumerate(operations)) if operations else ""
    atoms = "".join(f"{s}{k} {s} {' '.join(map(str, p))}\n" for k, (s, p) in enumerate(sites))
    return f"data_x\n{name}{lengths}\n{angles}\n{loop}loop_\n_atom_site_label\n_atom_site_type_symbol\n_atom_site_fract_x\n_atom_site_fract_y\n_atom_site_fract_z\n{atoms}"


def test_operations():
    m, t = R.parse_operation("'1/2 - y, x-y+0.25 ,-z'")
    assert m.tolist() == [[0, -1, 0], [1, -1, 0], [0, 0, -1]] and t.tolist() == [0.5, 0.25, 0.0]
    for bad in ("x,y", "x,y,w", "x,y,", "x y,y,z", "1//2,y,z"):
        with pytest.raises(ValueError):
            R.parse_operation(bad)


def test_known_crystals():
    """Rutile has two metal atoms and four of oxygen; a body-centred cell two, on a special position as on a general one."""
    symbols, positions, _, _, _, problems = R.parse_cif(cif((4.6, 4.6, 2.96, 90, 90, 90), RUTILE, [("Ti", (0, 0, 0)), ("O", (0.3053, 0.3053, 0))], "P 42/m n m"))
    assert problems == [] and symbols == ["Ti"] * 2 + ["O"] * 4
    want = [(0, 0, 0), (0.5, 0.5, 0.5), (0.3053, 0.3053, 0), (0.6947, 0.6947, 0), (0.1947, 0.8053, 0.5), (0.8053, 0.1947, 0.5)]
    got = np.array(positions) / [4.6, 4.6, 2.96]
    assert sorted(map(tuple, np.round(got, 4).tolist())) == sorted(tuple(map(float, w)) for w in want)
    body = ["x,y,z", "x+1/2,y+1/2,z+1/2"]
    assert R.parse_cif(cif((3.2, 3.2, 3.2, 90, 90, 90), body, [("W", (0, 0, 0))]))[0] == ["W", "W"]
    # Thirds are written with few digits, and images still coincide.
    three = ["x,y,z", "-y,x-y,z", "y-x,-x,z"]
    assert len(R.parse_cif(cif((3, 3, 5, 90, 90, 120), three, [("Mg", (0.3333, 0.6667, 0.25)), ("Mg", (0.1, 0, 0))]))[0]) == 4
    assert R.parse_cif(cif((3, 3, 3, 90, 90, 90), [], [("W", (0, 0, 0))], "P 1"))[5] == []
    assert R.parse_cif(cif((3, 3, 3, 90, 90, 90), [], [("W", (0, 0, 0))], "F m -3 m"))[5] == ["no symmetry operations for F m -3 m"]
    assert R.parse_cif(cif((3, 3, 3, 90, 90, 90), ["x,y"], [("W", (0, 0, 0))]))[5] == ["symmetry operations can't be read"]


def test_displaced_structures(spark):
    """Draws are normal and the same in any order of rows; moves keep the distance, and atoms without room stay."""
    cell = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.5, 4.0]]
    places = [[x, y, z] for x in (0.0, 2.0) for y in (0.0, 2.0) for z in (0.0, 2.0)]
    rows = [(k, ["W"] * 8, places, cell) for k in range(60)] + [(90, ["W"], [[0.0] * 3], cell), (91, [], [], cell), (92, ["W"], [[0.0] * 3], [[0.0] * 3] * 3), (93, ["W"], [None], cell), (94, None, None, None)]
    df = spark.createDataFrame(rows, "structure_index bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>")
    read = lambda x: {(r["structure_index"], r["rattle_index"]): r for r in x.collect()}
    got = read(defects.displaced(df, [0.02, 0.2], 1.9))
    assert len(got) == 130 and got == read(defects.displaced(df.repartition(7), [0.02, 0.2], 1.9))
    for (k, step), r in got.items():
        if k >= 90:
            assert r["nearest"] is None and r["moved"] == (1 if k == 90 else 0)
            continue
        p, inv = np.array(r["positions"]), np.linalg.inv(cell)
        f = (p[:, None] - p[None]) @ inv
        d = np.sqrt((((f - np.rint(f)) @ np.array(cell)) ** 2).sum(axis=2)) + 99 * np.eye(8)
        assert r["nearest"] == pytest.approx(d.min()) and d.min() >= 1.9 - 1e-9 and (step or r["moved"] == 8)
    assert sum(r["moved"] for (k, s), r in got.items() if s == 1 and k < 60) < 480  # there is no room for all
    free = read(defects.displaced(df, [0.3], None))
    d = np.concatenate([np.array(free[k, 0]["positions"]) - places for k in range(60)]).ravel()
    assert abs(d.mean()) < 0.03 and abs(d.std() - 0.3) < 0.02


def test_shells_of_a_cubic_cell():
    """A simple cube of one atom: 6, 12, 8, 6 images in the first four shells, also in a doubled cell."""
    one = defects.shell_counts(np.zeros((1, 3)), 3.0 * np.eye(3), 6.01)
    assert one[:, 0, 0].tolist() == [6, 12, 8, 6]
    places = np.array([[0, 0, 0], [3.0, 0, 0]])
    two = defects.shell_counts(places, np.diag([6.0, 3.0, 3.0]), 6.01)
    assert two.sum(axis=2).tolist() == [[6, 6], [12, 12], [8, 8], [6, 6]] and (two == two.transpose(0, 2, 1)).all()


def test_quasi_random_structures(spark):
    """Elements in halves of a box become mixed; counts stay, and the score is the one of a plain count of pairs."""
    places = [[2.0 * x, 2.0 * y, 2.0 * z] for x in range(4) for y in range(4) for z in range(2)]
    cell = [[8.0, 0.0, 0.0], [0.0, 8.0, 0.0], [0.0, 0.0, 4.0]]
    halves = ["W"] * 16 + ["Cr"] * 10 + ["Y"] * 6
    df = spark.createDataFrame([(1, halves, places, cell), (2, ["W"] * 32, places, cell), (3, halves, places, [[0.0] * 3] * 3), (4, None, places, cell)], "structure_index bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>")
    got = {r["structure_index"]: r for r in defects.quasi_random(df, 3.0, 400).collect()}
    assert set(got) == {1, 2, 3} and got[2]["swaps"] == got[3]["swaps"] == 0 and got[3]["symbols"] == halves
    r = got[1]
    assert sorted(r["symbols"]) == sorted(halves) and r["after"] < 0.4 * r["before"] and r["swaps"] > 3

    def plain(symbols):
        s, n, out = defects.shell_counts(np.array(places), np.array(cell), 3.0), len(symbols), 0.0
        for shell in s:
            for a in set(symbols):
                for b in set(symbols):
                    na, nb, same = symbols.count(a), symbols.count(b), a == b
                    mine = sum(int(shell[i, j]) for i in range(n) for j in range(n) if symbols[i] == a and symbols[j] == b)
                    want = (shell.sum() - np.trace(shell)) * (na * nb - same * na) / (n * (n - 1)) + np.trace(shell) * same * na / n
                    out += abs(mine - want) / shell.sum()
        return out

    assert plain(halves) == pytest.approx(r["before"]) and plain(r["symbols"]) == pytest.approx(r["after"])


HEX = [[1.0, 0.0, 0.0], [-0.5, 3**0.5 / 2, 0.0], [0.0, 0.0, 1.6]]
CELLS = {
    "simple": ([[1.0, 0, 0], [0, 1, 0], [0, 0, 1]], 48, 10), "face": ([[0, 0.5, 0.5], [0.5, 0, 0.5], [0.5, 0.5, 0]], 48, 8), "body": ([[-0.5, 0.5, 0.5], [0.5, -0.5, 0.5], [0.5, 0.5, -0.5]], 48, 8),
    "hexagonal": (HEX, 24, 12), "triclinic": ([[1.0, 0.1, 0.2], [0, 1.3, 0.15], [0, 0, 1.7]], 2, 36),
}


@pytest.mark.parametrize("name", sorted(CELLS))
def test_lattices(name):
    """Orders of the point groups, and points of a centred 4 x 4 x 4 mesh that they leave."""
    cell, order, points = CELLS[name]
    w = S.lattice_rotations(np.array(cell, float))
    assert len(w) == order and S.irreducible_points(w, [4, 4, 4]) == points


def test_atoms_lower_symmetry(spark):
    """A second atom of another kind at a general place leaves reversal only; one on an axis leaves the axis."""
    cube = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
    rows = [
        (1, cube, [[0.0] * 3], ["W"], [4, 4, 4]), (2, cube, [[0.0] * 3, [0.4, 1.1, 1.7]], ["W", "C"], [4, 4, 4]), (3, cube, [[0.0] * 3, [0.0, 0.0, 1.0]], ["W", "C"], [4, 4, 4]),
        (4, cube, [[0.0] * 3, [2.0, 2.0, 2.0]], ["W", "W"], [4, 4, 4]), (5, cube, [], [], [4, 4, 4]), (6, [[0.0] * 3] * 3, [[0.0] * 3], ["W"], [4, 4, 4]), (7, cube, [[0.0] * 3], ["W"], None), (8, cube, [[0.0] * 3], ["W"], [2, 3, 4]),
    ]
    df = spark.createDataFrame(rows, "id int, cell array<array<double>>, p array<array<double>>, s array<string>, mesh array<int>")
    got = {r["id"]: r["n"] for r in df.select("id", S.irreducible_kpoints(F.col("cell"), F.col("p"), F.col("s"), F.col("mesh")).alias("n")).collect()}
    assert got == {1: 10, 2: 36, 3: 18, 4: 10, 5: None, 6: None, 7: None, 8: 10}  # a mesh that is less symmetric: some points meet still
    assert S.irreducible_points(S.lattice_rotations(np.array(cube)), [4, 4, 4], gamma=False) == 4
