"""Extended XYZ and POSCAR: frames to rows and back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.sources.texts import files

FRAME = (
    "path string, frame bigint, first_line bigint, symbols array<string>, positions array<array<double>>, cell array<array<double>>, pbc array<boolean>, "
    "info map<string,string>, problems array<string>"
)
_PAIR = re.compile(r"""([A-Za-z_][\w.-]*)\s*=\s*("[^"]*"|\{[^}]*\}|\S+)""")


def split_frames(text: str) -> Iterator[tuple[int, int, str, list[str], str | None]]:
    """(frame, first line from 1, header, atom lines, problem): blank lines between frames are skipped.

    A line where a number of atoms should be, or a frame that is cut off, is a problem and ends the file.
    """
    lines = text.splitlines()
    at = frame = 0
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        first = at + 1
        try:
            n = int(lines[at].strip())
        except ValueError:
            yield frame, first, "", [], f"frame {frame}, line {first}: no number of atoms"
            return
        body = lines[at + 2 : at + 2 + n]
        if n < 0 or at + 1 >= len(lines) or len(body) < n:
            yield frame, first, "", [], f"frame {frame}, line {first}: cut off"
            return
        yield frame, first, lines[at + 1], body, None
        at += 2 + n
        frame += 1


def parse_frame(header: str, body: list[str]) -> tuple[list[str], list[list[float]], list[list[float]] | None, list[bool], dict[str, str], list[str]]:
    """Symbols, positions, cell, periodicity, other keys, problems."""
    info = {k: v.strip('"{}') for k, v in _PAIR.findall(header)}
    problems = []
    cell = None
    lattice = info.pop("Lattice", None)
    if lattice is None:
        problems.append("no Lattice")
    else:
        tokens = lattice.split()
        try:
            numbers = [float(x) for x in tokens]
            if len(numbers) == 9:
                cell = [numbers[k : k + 3] for k in (0, 3, 6)]
            else:
                problems.append(f"Lattice has {len(numbers)} numbers")
        except ValueError:
            problems.append("Lattice is not numeric")
    pbc = [x.upper().startswith("T") for x in info.pop("pbc", "T T T" if cell else "F F F").split()]
    column = {"species": 0, "pos": 1}
    at = 0
    properties = info.pop("Properties", "species:S:1:pos:R:3").split(":")
    for name, _, width in zip(properties[0::3], properties[1::3], properties[2::3], strict=False):
        column[name] = at
        at += int(width) if width.isdigit() else 1
    symbols, positions = [], []
    for k, line in enumerate(body):
        parts = line.split()
        try:
            positions.append([float(x) for x in parts[column["pos"] : column["pos"] + 3]])
            symbols.append(parts[column["species"]])
            if len(positions[-1]) < 3:
                raise ValueError
        except (ValueError, IndexError):
            problems.append(f"atom {k} can't be read")
            return [], [], cell, pbc, info, problems
    return symbols, positions, cell, pbc, info, problems


def read_xyz(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row for each frame; frames with ``problems`` stay, so that nothing is lost silently.

    A file is one task's work: frames have no separator at which a file could be split.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                rows: list[tuple] = []
                for frame, line, header, body, problem in split_frames(text):
                    parsed = ([], [], None, [], {}, [problem]) if problem else parse_frame(header, body)
                    rows.append((path, frame, line, *parsed))
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=_COLUMNS)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=_COLUMNS)

    return files(spark, paths).select("path", "text").mapInPandas(run, FRAME)


_COLUMNS = ["path", "frame", "first_line", "symbols", "positions", "cell", "pbc", "info", "problems"]


def _numbers(xs: Column, pattern: str) -> Column:
    return F.array_join(F.transform(F.flatten(xs), lambda x: F.format_string(pattern, x)), " ")


def training_frame(energy: Column, pbc: Column, lattice: Column, species: Column, positions: Column, forces: Column, virial: Column) -> Column:
    """Text of one training frame; the virial is left out where it is null."""
    periodic = F.array_join(F.transform(pbc, lambda b: F.when(b, "T").otherwise("F")), " ")
    header = F.concat(
        F.format_string("energy=%.10f", energy), F.lit(' pbc="'), periodic, F.lit('" Lattice="'), _numbers(lattice, "%.10f"), F.lit('" Properties=species:S:1:pos:R:3:force:R:3'),
        F.coalesce(F.concat(F.lit(' virial="'), _numbers(virial, "%.10f"), F.lit('"')), F.lit("")),
    )
    zipped = F.arrays_zip(species.alias("s"), positions.alias("p"), forces.alias("f"))
    lines = F.transform(zipped, lambda a: F.format_string("%3s" + "%15.10f" * 6, a["s"], *[a["p"][i] for i in range(3)], *[a["f"][i] for i in range(3)]))
    return F.concat_ws("\n", F.size(species).cast("string"), header, F.array_join(lines, "\n"))


def structure_frame(symbols: Column, positions: Column, cell: Column, pbc: Column, info: Column) -> Column:
    """Text of one frame; the map's keys follow in order."""
    periodic = F.array_join(F.transform(pbc, lambda b: F.when(b, "T").otherwise("F")), " ")
    extra = F.array_join(F.transform(F.array_sort(F.map_entries(info)), lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), e["value"], F.lit('"'))), "")
    header = F.concat(F.lit('Lattice="'), _numbers(cell, "%.10f"), F.lit('" Properties=species:S:1:pos:R:3 pbc="'), periodic, F.lit('"'), F.coalesce(extra, F.lit("")))
    lines = F.transform(F.arrays_zip(symbols.alias("s"), positions.alias("p")), lambda a: F.format_string("%-2s" + " %16.10f" * 3, a["s"], *[a["p"][i] for i in range(3)]))
    return F.concat_ws("\n", F.size(symbols).cast("string"), header, F.array_join(lines, "\n"))


def write_frames(frames: DataFrame, path: str, column: str = "frame", mode: str = "overwrite") -> None:
    """Write a column of frame texts as text files."""
    frames.select(F.col(column).alias("value")).write.mode(mode).text(path)


def poscar_text(comment: Column, symbols: Column, positions: Column, cell: Column) -> Column:
    """Cartesian POSCAR with atoms by element, in input order within one."""
    atoms = F.array_sort(F.transform(F.arrays_zip(symbols.alias("s"), positions.alias("p")), lambda a, i: F.struct(a["s"].alias("s"), i.alias("i"), a["p"].alias("p"))))
    kinds = F.array_sort(F.array_distinct(symbols))
    counts = F.transform(kinds, lambda k: F.size(F.filter(symbols, lambda s: s == k)).cast("string"))

    def row(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda x: F.format_string("%20.14f", x)), "")

    return F.concat_ws(
        "\n", comment, F.lit("1.0"), F.array_join(F.transform(cell, row), "\n"), F.array_join(kinds, " "), F.array_join(counts, " "), F.lit("Cartesian"),
        F.array_join(F.transform(atoms, lambda a: row(a["p"])), "\n"), F.lit(""),
    )


def parse_poscar(text: Column) -> Column:
    """struct(symbols, positions (Cartesian), cell, problem) of a POSCAR with an element line.

    The problem names what is wrong: too few lines, a scale of zero or less, no element line.
    """
    lines = F.split(text, "\n")

    def numbers(line: Column) -> Column:
        return F.transform(F.filter(F.split(F.trim(line), r"\s+"), lambda x: x != ""), lambda x: x.try_cast("double"))

    scale = F.try_element_at(lines, F.lit(2)).try_cast("double")
    rows = F.transform(F.slice(lines, 3, 3), lambda x: F.slice(numbers(x), 1, 3))
    cell = F.transform(rows, lambda r: F.transform(r, lambda x: x * scale))
    kinds = F.filter(F.split(F.trim(F.try_element_at(lines, F.lit(6))), r"\s+"), lambda x: x != "")
    counts = F.filter(F.split(F.trim(F.try_element_at(lines, F.lit(7))), r"\s+"), lambda x: x != "")
    counts = F.transform(counts, lambda x: x.try_cast("int"))
    symbols = F.flatten(F.transform(F.arrays_zip(kinds.alias("k"), counts.alias("n")), lambda a: F.array_repeat(a["k"], F.coalesce(a["n"], F.lit(0)))))
    selective = F.lower(F.substring(F.trim(F.coalesce(F.try_element_at(lines, F.lit(8)), F.lit(""))), 1, 1)) == "s"
    mode = F.lower(F.substring(F.trim(F.coalesce(F.try_element_at(lines, F.when(selective, 9).otherwise(8)), F.lit(""))), 1, 1))
    raw = F.transform(F.slice(lines, F.when(selective, 10).otherwise(9), F.greatest(F.size(symbols), F.lit(0))), lambda x: F.slice(numbers(x), 1, 3))
    cartesian = F.transform(
        raw,
        lambda p: F.when(mode.isin("c", "k"), F.transform(p, lambda x: x * scale)).otherwise(F.array(*[p[0] * cell[0][j] + p[1] * cell[1][j] + p[2] * cell[2][j] for j in range(3)])),
    )
    problem = (
        F.when(F.size(F.filter(lines, lambda x: F.trim(x) != "")) < 8, "fewer than 8 lines")
        .when(F.coalesce(scale, F.lit(0.0)) <= 0, "scale is not positive")
        .when(F.get(kinds, F.lit(0)).try_cast("int").isNotNull(), "no element line")
        .when(F.size(symbols) != F.size(raw), "atoms are missing")
    )
    return F.when(
        problem.isNull(), F.struct(symbols.alias("symbols"), cartesian.alias("positions"), cell.alias("cell"), F.lit(None).cast("string").alias("problem"))
    ).otherwise(F.struct(F.lit(None).cast("array<string>").alias("symbols"), F.lit(None).cast("array<array<double>>").alias("positions"), F.lit(None).cast("array<array<double>>").alias("cell"), problem.alias("problem")))
