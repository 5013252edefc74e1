"""Expressions over log, settings and template texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the log format.
LOOP = r"LOOP:\s+cpu time\s+[0-9.]+:\s+real time\s+([0-9.]+)"
KPOINTS = r"Found\s+([0-9]+)\s+irreducible k-points"
ELECTRONS = r"NELECT\s*=\s*([0-9.]+)"
RANKS = r"running\s+([0-9]+)\s+mpi-ranks"
CORES = r"running on\s+([0-9]+)\s+total cores"
STRESS = r"in kB\s+(-?[0-9.]+)\s+(-?[0-9.]+)\s+(-?[0-9.]+)\s+(-?[0-9.]+)\s+(-?[0-9.]+)\s+(-?[0-9.]+)"
_NUMBER = r"([-+]?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)"
_ROW = r"[^\n0-9+-]*" + r"[^\n0-9+-]+".join([_NUMBER] * 3) + r"[^\n]*"
STRESS_BLOCK = r"STRESS\s+in cartesian coordinates \(kB\)" + (r"\n\s+" + r"\s+".join([r"([-.\d]+)"] * 3)) * 3
STRESS_LOOSE = r"(?im)^(?=[^\n]*STRESS)(?=[^\n]*KB)[^\n]*\n(?:[^\n]*\n){0,4}?" + r"\n(?:[^\n]*\n){0,2}?".join([_ROW] * 3)
STRESS_LINE = r"(?im)^(?=[^\n]*STRESS)(?=[^\n]*KB)[^\n]*?" + r"[^\n0-9+-]+".join([_NUMBER] * 6) + r"[^\n0-9]*$"
KB_A3_PER_EV = 1602.17663
COMPLETE = "General timing|Voluntary context switches"


def _some(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def once(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of ``value``, which is worked out a single time however often ``made`` names it."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def loop_times(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(LOOP), F.lit(1)), lambda x: x.cast("double"))


def mean_loop_time(text: Column) -> Column:
    """Mean of all matches, 0 without any."""
    t = loop_times(text)
    return F.when(F.size(t) > 0, F.aggregate(t, F.lit(0.0), lambda s, x: s + x) / F.size(t)).otherwise(F.lit(0.0))


def ranks(text: Column) -> Column:
    return F.coalesce(_some(text, RANKS), _some(text, CORES)).cast("int")


def kpoints(text: Column) -> Column:
    return _some(text, KPOINTS).cast("int")


def electrons(text: Column) -> Column:
    return F.floor(_some(text, ELECTRONS).cast("double")).cast("int")


def stress_matrix_gpa(text: Column) -> Column:
    """Nine numbers, row-major, in GPa: of the last block of three rows under its header, of the last header that has
    three rows of numbers in the lines after it, or of the last line of six components; null without any."""

    def last(pattern: str, n: int) -> tuple[Column, list[Column]]:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.size(found) > 0, [F.regexp_extract(F.element_at(found, -1), pattern, k).try_cast("double") * 0.1 for k in range(1, n + 1)]

    (is_block, block), (is_loose, loose), (is_line, line), (is_short, short) = last(STRESS_BLOCK, 9), last(STRESS_LOOSE, 9), last(STRESS_LINE, 6), last(STRESS, 6)

    def six(v: list[Column]) -> Column:  # xx yy zz xy yz zx
        return F.array(v[0], v[3], v[5], v[3], v[1], v[4], v[5], v[4], v[2])

    return F.when(is_block, F.array(*block)).when(is_loose, F.array(*loose)).when(is_line, six(line)).when(is_short, six(short))


def stress_gpa(text: Column) -> Column:
    """xx yy zz yz xz xy in GPa; see ``stress_matrix_gpa``."""
    m = stress_matrix_gpa(text)
    return F.when(m.isNotNull(), F.array(m[0], m[4], m[8], (m[5] + m[7]) / 2, (m[2] + m[6]) / 2, (m[1] + m[3]) / 2))


def virial(stress_kb: Column, volume: Column) -> Column:
    """Minus stress times volume, in eV, of nine numbers in kB and a volume in cubic angstrom."""
    return F.transform(stress_kb, lambda x: -x * volume / F.lit(KB_A3_PER_EV))


def is_complete(text: Column, window: int = 50_000) -> Column:
    """Whether the last ``window`` characters hold a mark of normal completion."""
    return F.coalesce(F.right(text, F.lit(window)).rlike(COMPLETE), F.lit(False))


def without_resources(text: Column) -> Column:
    """Settings text without NCORE and KPAR lines, trailing blanks off every line, one line end last."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"\s+$", ""))
    kept = F.filter(lines, lambda x: ~x.rlike(r"^\s*(?i:NCORE|KPAR)\s*="))
    return F.concat(F.regexp_replace(F.array_join(kept, "\n"), r"\s+$", ""), F.lit("\n"))


def settings_hash(text: Column) -> Column:
    return F.sha2(without_resources(text).cast("binary"), 256)


def with_defaults(text: Column, defaults: list[tuple[str, str]]) -> Column:
    """Each default appended as a line unless its key is set already (whatever its case)."""
    out = F.regexp_replace(text, r"\s+$", "")
    for key, value in defaults:
        out = F.when(text.rlike(rf"(?im)^\s*{key}\s*="), out).otherwise(F.concat(out, F.lit(f"\n{key} = {value}")))
    return F.concat(out, F.lit("\n"))


def overridden(text: Column, values: list[tuple[str, str]]) -> Column:
    """The keys' values replaced where they are set, appended otherwise."""
    out = text
    for key, value in values:
        line = rf"(?im)^[ \t]*{key}[ \t]*=.*$"
        out = F.when(out.rlike(line), F.regexp_replace(out, line, f"{key} = {value}")).otherwise(F.concat(F.regexp_replace(out, r"\s+$", ""), F.lit(f"\n{key} = {value}\n")))
    return out


def settings_map(text: Column) -> Column:
    """KEY to value; # and ! begin comments, keys in upper case, the last setting of a key wins."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"[#!].*$", ""))
    halves = F.transform(F.filter(lines, lambda x: x.contains("=")), lambda x: F.split(x, "=", 2))
    pairs = F.array_sort(F.transform(halves, lambda h, i: F.struct(F.upper(F.trim(h[0])).alias("key"), i.alias("at"), F.trim(h[1]).alias("value"))))
    # In the order of keys and lines the last setting of a key is the one before another key.
    last = once(pairs, lambda s: F.filter(s, lambda p, i: F.coalesce(F.get(s, i + 1)["key"] != p["key"], F.lit(True))))
    listed = F.array_sort(F.transform(last, lambda p: F.struct(p["at"].alias("at"), p["key"].alias("key"), p["value"].alias("value"))))
    return F.map_from_entries(F.transform(listed, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))


def lint(settings: Column) -> Column:
    """Warnings about settings that do not suit stress calculations at fixed cells."""

    def warnings(found: Column) -> Column:
        nsw, ibrion, isif, isym = [F.try_element_at(found, F.lit(k)).try_cast("int") for k in ("NSW", "IBRION", "ISIF", "ISYM")]
        return F.array_compact(
            F.array(
                F.when(nsw > 0, "NSW > 0: ions move"), F.when(ibrion != -1, "IBRION is not -1"), F.when(isif >= 3, "ISIF >= 3: the cell relaxes").when(isif < 2, "ISIF < 2: no stress"), F.when(isym != 0, "ISYM is not 0"),
            )
        )

    return once(settings, warnings)


def error_class(log: Column) -> Column:
    """The first rule that fits the log; its last non-empty line otherwise."""
    low = F.lower(log)
    lines = F.filter(F.split(log, "\n"), lambda x: F.trim(x) != "")
    return (
        F.when(low.contains("cuda") & low.contains("error"), "cuda error")
        .when(low.contains("out of memory") | low.contains("oom"), "out of memory")
        .when(low.contains("segmentation fault"), "segmentation fault")
        .when(low.contains("killed"), "killed")
        .otherwise(F.when(F.size(lines) > 0, F.trim(F.element_at(lines, -1))).otherwise("unknown"))
    )


def seconds(walltime: Column, default: int = 10_800) -> Column:
    """H:M:S as seconds; anything else is the default."""
    ok = walltime.rlike(r"^\d+:\d+:\d+$")
    part = F.split(walltime, ":")
    return F.when(ok, part[0].try_cast("int") * 3600 + part[1].try_cast("int") * 60 + part[2].try_cast("int")).otherwise(F.lit(default))


def walltime(s: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), (F.floor(s / 60) % 60).cast("int"), (s % 60).cast("int"))


def coerced(text: Column) -> Column:
    """struct(kind, b, i, d, s): the value as a boolean, a whole number, a number or a string, in this order."""
    t = F.trim(text)
    low = F.lower(t)
    is_bool = low.isin("true", "false")
    i, d = F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    kind = F.when(is_bool, "bool").when(i.isNotNull(), "int").when(d.isNotNull(), "float").otherwise("string")
    return F.struct(kind.alias("kind"), F.when(is_bool, low == "true").alias("b"), i.alias("i"), F.when(i.isNull(), d).alias("d"), F.when(kind == "string", t).alias("s"))


def listed(text: Column) -> Column:
    """Comma-separated items, blanks around them off, empty ones out."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def element_list(text: Column) -> Column:
    """Items of a comma-separated list as chemical symbols: the first letter large, the others small."""
    return F.transform(listed(text), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 10))))


def job_path(path: Column) -> Column:
    """struct(project, dataset, selected_index) of .../projects/P/.../D/struct_NNNN."""
    p = r"projects/([^/]+)/(?:.*/)?([^/]+)/struct_(\d+)"
    return F.struct(_some(path, p).alias("project"), F.nullif(F.regexp_extract(path, p, 2), F.lit("")).alias("dataset"), F.nullif(F.regexp_extract(path, p, 3), F.lit("")).cast("bigint").alias("selected_index"))


def first_number_sum(text: Column, line: int) -> Column:
    """Sum of the whole numbers on a line (from 0)."""
    return F.aggregate(F.filter(F.split(F.trim(F.get(F.split(text, "\n"), F.lit(line))), r"\s+"), lambda x: x != ""), F.lit(0), lambda s, x: s + F.coalesce(x.try_cast("int"), F.lit(0)))
