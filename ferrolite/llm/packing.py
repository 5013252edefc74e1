"""Operator 8: packing of token sequences by non-negative least squares over shallow length combinations.

A document of n ids gives n // 2048 full windows, one body (the rest down to a multiple of 64) and one tail of under
64 ids. Combinations of up to four body lengths that fill a window exactly are enumerated; least squares with
non-negative counts fits them to the histogram of body lengths; the counts are rounded so that no length is used
more often than it occurs. Bodies that are left over, then all tails, are packed greedily: laid end to end and cut
at window bounds. Which window a piece goes to is arithmetic on its rank among the pieces of its length, and ranks
and places are prefix sums of per-partition totals, so no task sees more than its own partition.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import as_text, only, stash, tuned
from ferrolite.llm.tokens import tokenizer

WINDOW, UNIT, DEPTH = 2048, 64, 4
#: The id that ends every document.
END = 1


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All falling tuples of 2 to ``depth`` lengths that add up to ``units``."""
    out = []
    for k in range(2, depth + 1):
        for head in combinations_with_replacement(range(units - 1, 0, -1), k - 1):
            last = units - sum(head)
            if 0 < last <= head[-1]:
                out.append((*head, last))
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least ||a x - b||, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, on = np.zeros(n), np.zeros(n, bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(6 * n):
        slope = a.T @ (b - a @ x)
        slope[on] = -np.inf
        k = int(slope.argmax())
        if on.all() or slope[k] <= 1e-9 * scale:
            break
        on[k] = True
        while True:
            s = np.zeros(n)
            s[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if s[on].min() > 0:
                x = s
                break
            bad = on & (s <= 0)
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            on &= x > 1e-12 * scale
            x[~on] = 0
            if not on.any():
                break
    return x


def repeats(histogram: np.ndarray, combos: list[tuple[int, ...]]) -> np.ndarray:
    """Whole numbers of repeats of each combination that the histogram (pieces of each length) allows."""
    a = np.zeros((len(histogram), len(combos)))
    for c, combo in enumerate(combos):
        for u in combo:
            a[u, c] += 1
    x = np.floor(nnls(a, histogram.astype(float)) + 1e-6).astype(np.int64)
    need = a.astype(np.int64)
    # Least squares can ask for more of a length than there is.
    for u in range(len(histogram)):
        for c in sorted(np.flatnonzero(need[u]), key=lambda c: -x[c]):
            over = int((need[u] * x).sum() - histogram[u])
            if over <= 0:
                break
            x[c] -= min(x[c], -(-over // need[u, c]))
    # What rounding has left goes to whole combinations, short ones first.
    left = histogram - need @ x
    for c in range(len(combos)):
        used = need[:, c] > 0
        more = int((left[used] // need[used, c]).min())
        if more > 0:
            x[c] += more
            left = left - more * need[:, c]
    return x


_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "at")]
    + [("bin", pa.int32()), ("nth", pa.int64()), ("tail", pa.binary()), ("crcs", pa.list_(pa.int64()))]
)
_PIECES_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, at bigint, bin int, nth bigint, tail binary, crcs array<bigint>"


def cut(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of every document: full windows (bin 32), bodies (bin: units) and tails (bin 0), ranked within each
    partition and bin. Bodies carry a checksum for each unit and tails their ids, for a later cut."""
    tuned(docs.sparkSession)
    full = WINDOW // UNIT
    end = struct.pack("<I", END)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        part, at = TaskContext.get().partitionId(), 0
        seen = [0] * (full + 1)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_text(batch.column("text")), strict=True):
                ids = tok.ids(text.as_py()) + end
                n = len(ids) // 4
                places = [*range(0, n - n % WINDOW, WINDOW)]
                body = n % WINDOW // UNIT
                pieces = [(s, WINDOW, full) for s in places]
                if body:
                    pieces.append((n - n % WINDOW, body * UNIT, body))
                if n % UNIT:
                    pieces.append((n - n % UNIT, n % UNIT, 0))
                for s, size, kind in pieces:
                    data = ids[4 * s : 4 * (s + size)]
                    crcs = [zlib.crc32(data[k : k + 4 * UNIT]) for k in range(0, len(data), 4 * UNIT)] if 0 < kind < full else None
                    rows.append((doc_id, s, size, zlib.crc32(data), n, part, at, kind, seen[kind], None if kind else data, crcs))
                    seen[kind] += 1
                    at += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(_PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, _PIECES_DDL)


def _unit_shift() -> list[int]:
    """For each bit of a checksum, what it becomes when one unit of zero bytes follows (checksums are linear)."""
    zeros = b"\0" * (4 * UNIT)
    base = zlib.crc32(zeros, 0)
    return [zlib.crc32(zeros, 1 << k) ^ base for k in range(32)]


def _joined(crcs: list[int]) -> int:
    """The checksum of units laid end to end, from theirs."""
    shift, out = _unit_shift(), 0
    for k, c in enumerate(crcs):
        moved = 0
        if k:
            for bit in range(32):
                if out >> bit & 1:
                    moved ^= shift[bit]
        out = moved ^ c if k else c
    return out


def _part_crc(tail: pd.Series, crcs: pd.Series, skip: pd.Series, take: pd.Series) -> pd.Series:
    """Checksum of ``take`` ids after ``skip`` of a tail or of a body (there in whole units)."""
    out = []
    for t, c, s, n in zip(tail, crcs, skip, take, strict=True):
        out.append(zlib.crc32(t[4 * s : 4 * (s + n)]) if t is not None else _joined([int(x) for x in c[s // UNIT : (s + n) // UNIT]]))
    return pd.Series(out, dtype="int64")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece of each row's text.

    ``path`` is the tokenizer file. A null or empty text is the end id alone. Windows are filled without gaps; only
    the last one may be short. Repeated rows are packed like others, null ids stay null, and no rows give no pieces.
    """
    spark = docs.sparkSession
    full = WINDOW // UNIT
    pieces = stash(cut(docs, path))
    counts = stash(pieces.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n")))  # 33 rows for each partition at most
    found = np.zeros(full + 1, np.int64)
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # 33 rows
        found[r["bin"]] = r["n"]

    combos = combinations(full)
    bodies = found.copy()
    bodies[[0, full]] = 0
    x = repeats(bodies, combos)
    # For each bin: ranks [low, high) go to windows base + (rank - low) // times, at place + (rank - low) % times * length.
    plan = [(full, 0, int(found[full]), 0, 1, 0)]
    base, used = int(found[full]), np.zeros(full + 1, np.int64)
    for combo, n in zip(combos, x.tolist(), strict=True):
        if n:
            for u in dict.fromkeys(combo):
                times = combo.count(u)
                place = sum(v for v in combo if v > u) * UNIT
                plan.append((u, int(used[u]), int(used[u]) + n * times, base, times, place))
                used[u] += n * times
            base += n
    used[full] = found[full]
    plan_df = F.broadcast(spark.createDataFrame(plan, "bin int, low bigint, high bigint, base bigint, times int, place bigint"))  # under 1500 rows
    used_df = F.broadcast(spark.createDataFrame([(k, int(n)) for k, n in enumerate(used)], "bin int, used bigint"))

    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = pieces.join(offsets, ["part", "bin"]).withColumn("rank", F.col("nth") + F.col("ahead")).join(used_df, "bin")
    fitted = ranked.where("rank < used").join(plan_df, "bin").where("rank >= low and rank < high")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    fitted = fitted.select(
        *columns,
        (F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("times"))).alias("sequence_id"),
        (F.col("place") + (F.col("rank") - F.col("low")) % F.col("times") * F.col("length")).alias("offset"),
    )

    # The rest end to end: bodies first, so that they are cut between units, then tails.
    rest = ranked.where("rank >= used").withColumn("stream", (F.col("bin") == 0).cast("int"))
    totals = rest.groupBy("stream", "part").agg(F.sum("length").alias("n"))  # two rows for each partition
    ahead = totals.select("stream", "part", F.coalesce(F.sum("n").over(Window.orderBy("stream", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("stream", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    laid = rest.withColumn("upto", F.sum("length").over(inside)).join(ahead, ["stream", "part"])
    laid = laid.withColumn("pos", F.col("before") + F.col("upto") - F.col("length"))
    room = WINDOW - F.col("pos") % WINDOW
    window, place = (base + F.floor(F.col("pos") / WINDOW)), F.col("pos") % WINDOW
    whole = laid.where(F.col("length") <= room).select(*columns, window.alias("sequence_id"), place.alias("offset"))
    halves = laid.where(F.col("length") > room).withColumn("room", room).withColumn("second", F.explode(F.array(F.lit(0), F.lit(1))))
    skip = F.when(F.col("second") == 1, F.col("room")).otherwise(F.lit(0))
    take = F.when(F.col("second") == 1, F.col("length") - F.col("room")).otherwise(F.col("room"))
    halves = halves.withColumn("skip", skip.cast("bigint")).withColumn("take", take.cast("bigint"))
    crc = F.pandas_udf(_part_crc, "bigint")("tail", "crcs", "skip", "take")
    halves = halves.select(
        "doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("take").alias("length"), crc.alias("ids_crc32"), "doc_tokens",
        (window + F.col("second")).alias("sequence_id"), F.when(F.col("second") == 1, F.lit(0)).otherwise(place).cast("bigint").alias("offset"),
    )
    return fitted.union(whole).union(halves)
