"""Distances in descriptor space: nearest neighbours between and within sets, extremes and standardisation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolite.operators import ranks
from ferrolite.sources.scratch import stash

#: Rows of one side of a block pair, and rows of a block that meet the other block at once.
BLOCK, ROWS = 4096, 256


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def _blocks(rows: DataFrame, n: int, other: int, own: str, theirs: str) -> DataFrame:
    """Rows in ``n`` blocks by a hash of the id, each repeated for every one of the ``other`` blocks."""
    block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own)
    return rows.select("id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(theirs))


def _least(itself: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(probe: pd.DataFrame, build: pd.DataFrame) -> pd.DataFrame:
        if not len(probe) or not len(build):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "d": pd.Series([], dtype=object)})
        b, ids = np.array(build["v"].tolist(), np.float64), build["id"].to_numpy()
        p, own = np.array(probe["v"].tolist(), np.float64), probe["id"].to_numpy()
        out, positive = np.empty(len(p)), np.empty(len(p))
        squares = (b * b).sum(axis=1)
        for at in range(0, len(p), ROWS):
            some = p[at : at + ROWS]
            mine = (some * some).sum(axis=1)
            # Products show which rows may be the nearest, up to what rounding can hide; these are measured exactly.
            near = mine[:, None] + squares - 2 * (some @ b.T)
            slack = 1e-13 * (b.shape[1] + 8) * (mine + squares.max(initial=0)) + 1e-20
            same = own[at : at + ROWS, None] == ids if itself else None
            if itself:
                near[same] = np.inf
            least = np.where(near > 4 * slack[:, None], near, np.inf).min(axis=1)
            maybe = ~(near > np.maximum(4 * slack, least + 2 * slack)[:, None])
            for k, v in enumerate(some):
                hit = np.flatnonzero(maybe[k])
                d = np.sqrt(((b[hit] - v) ** 2).sum(axis=1))
                if itself:
                    d[same[k, hit]] = np.inf
                out[at + k], positive[at + k] = d.min(initial=np.inf), np.where(d > 1e-12, d, np.inf).min(initial=np.inf)
        return pd.DataFrame({"id": probe["id"].to_numpy(), "d": list(np.stack([out, positive], axis=1))})

    return run


def nearest_by_grid(probe: DataFrame, build: DataFrame, itself: bool = False, block: int = BLOCK) -> DataFrame:
    """``nearest`` of usable vectors without an index: all blocks of both sides meet."""
    n, m = [max(1, -(-x.count() // block)) for x in (probe, build)]
    left, right = _blocks(probe, n, m, "i", "j"), _blocks(build, m, n, "j", "i")
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(_least(itself), "id bigint, d array<double>")
    least = found.groupBy("id").agg(F.min(F.col("d")[0]).alias("d"), F.min(F.col("d")[1]).alias("pd"))
    inf = F.lit(float("inf"))
    return probe.select("id").join(least, "id", "left").select("id", F.coalesce("d", inf).alias("distance"), F.coalesce("pd", inf).alias("positive_distance"))


def usable(v: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(ok, F.lit(False))


#: Pivots of the index, its blocks, and build blocks that a probe block meets first.
PIVOTS, BLOCKS, HOME = 512, 200_000, 3
#: Bytes of a block's vectors at most, full blocks and bytes of a part of a table, pairs of rows that are measured at once.
BLOCK_BYTES, PART_BLOCKS, PART_BYTES, MEASURED = 1 << 23, 16, 1 << 25, 1 << 14


def _placed(rows: DataFrame, pivots: np.ndarray, count: int, block: int) -> DataFrame:
    """block, c, a, b, apart, ids, v: blocks of rows beside one pivot, whose distances from it follow one another, each as one
    row: its pivot, the least and largest distance from it, that pivot's distances from all, and the block's ids and vectors."""
    squares = (pivots * pivots).sum(axis=1)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v = batch.column("v").flatten().to_numpy().reshape(len(batch), -1)
            c = (squares - 2 * (v @ pivots.T)).argmin(axis=1).astype(np.int32)  # any pivot would do, its distance is exact
            r = np.sqrt(((v - pivots[c]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(c), pa.array(r)], names=["id", "v", "c", "r"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def one() -> pa.RecordBatch:
            c, r = held[0][0], np.concatenate([x[1] for x in held])
            apart = np.sqrt(((pivots - pivots[c]) ** 2).sum(axis=1))
            ids, v = (np.concatenate([x[k] for x in held]).tobytes() for k in (2, 3))
            cols = [pa.array([c], pa.int32()), pa.array([r.min()]), pa.array([r.max()]), pa.array([apart.tolist()], pa.list_(pa.float64())), pa.array([ids], pa.binary()), pa.array([v], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names=["c", "a", "b", "apart", "ids", "v"])

        for batch in batches:
            if not len(batch):
                continue
            ids, c, r = (batch.column(n).to_numpy() for n in ("id", "c", "r"))
            v = batch.column("v").flatten().to_numpy().reshape(len(batch), -1)
            most = min(block, max(1, BLOCK_BYTES // max(8, 8 * v.shape[1])))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1, [len(c)]]).tolist()
            for at, end in zip(edges[:-1], edges[1:], strict=True):
                if held and held[0][0] != c[at]:
                    yield one()
                    size = 0
                while at < end:
                    to = min(end, at + most - size)
                    held.append((int(c[at]), r[at:to].copy(), ids[at:to].copy(), v[at:to].copy()))
                    size, at = size + to - at, to
                    if size == most:
                        yield one()
                        size = 0
        if held:
            yield one()

    order = ["c", "r", "id"]
    near = rows.mapInArrow(beside, "id bigint, v array<double>, c int, r double")
    # Parts of a bounded size; of a small table as many as keep all cores busy, as each meets each.
    busy = math.ceil(3 * rows.sparkSession.sparkContext.defaultParallelism**0.5)
    parts = max(-(-count // (PART_BLOCKS * block)), -(-count * 8 * pivots.shape[1] // PART_BYTES), min(-(-count // block), busy))
    dealt = near.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = dealt.mapInArrow(gathered, "c int, a double, b double, apart array<double>, ids binary, v binary")
    return stash(blocks.select(F.monotonically_increasing_id().alias("block"), "*"))


def _homes(probes: DataFrame, builds: list, pivots: np.ndarray) -> DataFrame:
    """block, home: the ``HOME`` build blocks whose lower bounds, and then pivots, are nearest to each probe block (block, c, a, b)."""
    names = np.array([r["block"] for r in builds], np.int64)
    c, a, b = np.array([r["c"] for r in builds], np.int64), np.array([r["a"] for r in builds]), np.array([r["b"] for r in builds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for cp, ap, bp in zip(*[batch.column(n).to_pylist() for n in ("c", "a", "b")], strict=True):
                d = np.sqrt(((pivots - pivots[cp]) ** 2).sum(axis=1))[c]
                bound = np.maximum(np.maximum(d - bp - b, 0), np.maximum(a - d - bp, ap - d - b))
                found.append(names[np.lexsort((d, bound))[:HOME]].tolist())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(found, pa.list_(pa.int64()))], names=["block", "home"])

    return stash(probes.select("block", "c", "a", "b").mapInArrow(run, "block bigint, home array<bigint>"))


def _lower(a: np.ndarray, b: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray, itself: bool, of_a: np.ndarray, of_b: np.ndarray | None) -> None:
    """Bring the least and the least positive distance of each row of ``a``, ``of_a`` (2, rows), down to those from the rows
    of ``b``; and ``of_b`` to those from ``a``, if given. Products show which pairs may matter, up to what rounding can hide;
    these are measured exactly."""
    mine, squares = (a * a).sum(axis=1), (b * b).sum(axis=1)
    unit = 1e-13 * (b.shape[1] + 8)
    known = bool(np.isfinite(mine.max() + squares.max()))
    left = np.concatenate([-2 * a, mine[:, None], np.ones((len(a), 1))], axis=1)
    right = np.ascontiguousarray(np.concatenate([b, np.ones((len(b), 1)), squares[:, None]], axis=1).T)
    shared = np.isin(a_ids, b_ids) if itself else np.zeros(len(a), bool)

    def measure(i: np.ndarray, j: np.ndarray, out: np.ndarray, by: np.ndarray) -> None:
        for at in range(0, len(i), MEASURED):
            ii, jj, to = i[at : at + MEASURED], j[at : at + MEASURED], by[at : at + MEASURED]
            d = np.sqrt(((b[jj] - a[ii]) ** 2).sum(axis=1))
            if itself:
                d[a_ids[ii] == b_ids[jj]] = np.inf
            np.minimum.at(out[0], to, d)
            np.minimum.at(out[1], to, np.where(d > 1e-12, d, np.inf))

    def look(near: np.ndarray, least: np.ndarray, slack: np.ndarray, so_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``near`` that hold what may be nearest, and the places there."""
        positive, low = least, np.flatnonzero(least <= 4 * slack)
        if len(low):
            positive, part = least.copy(), near[low]
            positive[low] = np.where(part > 4 * slack[low, None], part, np.inf).min(axis=1)
        limit = np.maximum(4 * slack, np.minimum(positive, so_far * so_far * (1 + 1e-12)) + 2 * slack)
        hit = np.flatnonzero(least <= limit)
        return hit, *np.nonzero(near[hit] <= limit[hit, None])

    for at in range(0, len(a), ROWS):
        rows = slice(at, at + ROWS)
        near = left[rows] @ right if known else np.zeros((len(left[rows]), len(b)))  # beyond the range of numbers: measure all
        some = np.flatnonzero(shared[rows])
        if len(some):
            near[some] = np.where(a_ids[at + some, None] == b_ids, np.inf, near[some])
        hit, i, j = look(near, near.min(axis=1), unit * (mine[rows] + squares.max()) + 1e-20, of_a[1, rows])
        i = at + hit[i]
        measure(i, j, of_a, i)
        if of_b is not None:
            hit, j, i = look(near.T, near.min(axis=0), unit * (squares + mine.max()) + 1e-20, of_b[1])
            j = hit[j]
            measure(at + i, j, of_b, j)


def _met(left: DataFrame, right: DataFrame, meet: Column, itself: bool, both: bool) -> DataFrame:
    """block, id, d, pd: how far the rows of blocks that ``meet`` are from each other, the least of each task. Parts of the tables are
    read by the tasks that need them; no copy of a block is shuffled. With ``both`` each pair of blocks lowers both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k in range(len(batch)):
                p, q = batch.column("p_block")[k].as_py(), batch.column("q_block")[k].as_py()
                ids = [np.frombuffer(batch.column(n)[k].as_buffer(), np.int64) for n in ("p_ids", "q_ids")]
                a, b = (np.frombuffer(batch.column(n)[k].as_buffer(), np.float64).reshape(len(i), -1) for n, i in zip(("p_v", "q_v"), ids, strict=True))
                for block, i in zip((p, q) if both else (p,), ids, strict=False):
                    if block not in held:
                        held[block] = i.copy(), np.full((2, len(i)), np.inf)
                _lower(a, b, *ids, itself, held[p][1], held[q][1] if both and p != q else None)
        for p, (i, d) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), p)), pa.array(i), pa.array(d[0]), pa.array(d[1])], names=["block", "id", "d", "pd"])

    wanted = ["block", "ids", "v"]
    pairs = left.join(right.hint("shuffle_replicate_nl"), meet).select(*[f"{side}_{n}" for side in "pq" for n in wanted])
    return stash(pairs.mapInArrow(run, "block bigint, id bigint, d double, pd double"))


def nearest(probe: DataFrame, build: DataFrame, itself: bool = False, block: int = BLOCK, report: dict | None = None) -> DataFrame:
    """id, distance, positive_distance of each ``probe`` row to the nearest ``build`` row (and to the nearest one further
    than 1e-12): both have id and v (array<double>).

    Rows are placed beside the nearest of up to ``PIVOTS`` rows of ``build`` and cut into blocks by their distance from
    it. A probe block meets a few build blocks first; then, with the largest distance that its rows have by then, those
    that the triangle inequality does not rule out. Blocks are single rows of a table, and each part of one table meets each
    part of the other where a task reads them: no vector is copied for a pair. A set meets itself once for both sides.
    ``report`` gets the numbers of ``block_pairs`` and of those ``visited``. With ``itself`` a row is not compared
    with its own id. Infinite where nothing is to compare with; null for a vector that is null or holds null or
    non-finite components, which is compared with nothing.
    """
    ok = usable(F.col("v"))
    left = stash(probe.where(ok).select(F.col("id").cast("bigint").alias("id"), "v"))
    right = left if build is probe else stash(build.where(ok).select(F.col("id").cast("bigint").alias("id"), "v"))
    n, m = left.count(), right.count()
    block = max(block, -(-max(n, m) // BLOCKS))
    found, both = None, right is left
    if n and m and max(n, m) <= block:  # one block of each: nothing to rule out
        grid = nearest_by_grid(left, right, itself, block)
        found = grid.select("id", F.col("distance").alias("d"), F.col("positive_distance").alias("pd"))
        if report is not None:
            report |= {"block_pairs": 1, "visited": 1}
    elif n and m:
        wanted = min(PIVOTS, 2 * -(-m // block)) if m > block else 1
        pivots = np.array([r["v"] for r in right.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()], np.float64)
        mine, theirs = _placed(left, pivots, n, block), None
        theirs = mine if both else _placed(right, pivots, m, block)
        builds = theirs.select("block", "c", "a", "b").collect()  # BLOCKS and PIVOTS at most
        home = F.broadcast(_homes(mine, builds, pivots))  # and here
        named = mine.join(home, "block")

        def sides(p: DataFrame, q: DataFrame) -> tuple[DataFrame, DataFrame]:
            return p.toDF(*[f"p_{n}" for n in p.columns]), q.toDF(*[f"q_{n}" for n in q.columns])

        first = F.array_contains("p_home", F.col("q_block"))
        once = F.lit(True)
        if both:
            first, once = first | F.array_contains("q_home", F.col("p_block")), F.col("p_block") <= F.col("q_block")
        left_, right_ = sides(named, named if both else theirs)
        found = _met(left_, right_, first & once, itself, both)
        later = F.lit(False)
        if len(builds) > HOME:
            far = found.groupBy("block", "id").agg(F.min("pd").alias("pd")).groupBy("block").agg(F.max("pd").alias("reach"))
            reached = named.join(F.broadcast(stash(far)), "block")  # each block has met its home
            left_, right_ = sides(reached, reached if both else theirs)
            # By the triangle inequality no two rows of the blocks are nearer than this.
            d = F.get("p_apart", F.col("q_c"))
            bound = F.greatest(F.lit(0.0), d - F.col("p_b") - F.col("q_b"), F.col("q_a") - d - F.col("p_b"), F.col("p_a") - d - F.col("q_b"))
            limit = F.greatest("p_reach", "q_reach") if both else F.col("p_reach")
            later = ~first & once & (F.nanvl(bound, F.lit(0.0)) * (1 - 1e-9) - 1e-12 <= limit)
            found = found.union(_met(left_, right_, later, itself, both))
        if report is not None:
            p, q = (x.drop("p_ids", "p_v", "q_ids", "q_v") for x in (left_, right_))
            report |= {"block_pairs": p.crossJoin(q).where(once).count(), "visited": p.crossJoin(q).where((first & once) | later).count()}
    inf = F.lit(float("inf"))
    if found is None:
        least = left.select("id", inf.alias("d"), inf.alias("pd")).limit(0)
    else:
        least = found.groupBy("id").agg(F.min("d").alias("d"), F.min("pd").alias("pd"))
    return probe.select("id", ok.alias("ok")).join(least, "id", "left").select("id", F.when(F.col("ok"), F.coalesce("d", inf)).alias("distance"), F.when(F.col("ok"), F.coalesce("pd", inf)).alias("positive_distance"))


def nearest_values(probe: DataFrame, build: DataFrame, value: str, kind: str, within: float = 1e-6, block: int = BLOCK) -> DataFrame:
    """id, d, ``value``: for each ``probe`` row (id, v) and block of ``build`` rows (v and ``value``) those at the block's
    smallest distance, up to ``within`` more; blocks meet as in ``nearest``."""
    n, m = [max(1, -(-x.count() // block)) for x in (probe, build)]
    left = _blocks(probe, n, m, "i", "j")
    right = build.select("v", F.col(value), F.pmod(F.xxhash64("v"), F.lit(m)).cast("int").alias("j"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))

    def run(probe: pd.DataFrame, build: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"id": [], "d": [], value: []}
        if len(build):
            b, values = np.array(build["v"].tolist(), np.float64), build[value].tolist()
            for i, v in zip(probe["id"], probe["v"], strict=True):
                d = np.sqrt(((b - np.asarray(v, np.float64)) ** 2).sum(axis=1))
                for k in np.flatnonzero(d <= d.min() + within).tolist():
                    out["id"].append(i)
                    out["d"].append(d[k])
                    out[value].append(values[k])
        return pd.DataFrame(out)

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(run, f"id bigint, d double, {value} {kind}")


def summary(distances: DataFrame, digits: int = 9) -> DataFrame:
    """One row: count, min, mean, exact p50, p95, p99, max of ``distance``. Percentiles are those of ``ranks``; all of
    them are null without distances."""
    d = F.col("distance")
    held = stash(distances.select(d))
    spots = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    stats = held.agg(F.count(d).alias("n"), F.min(d).alias("min"), F.avg(d).alias("mean"), F.max(d).alias("max"))
    both = stats.join(F.broadcast(ranks.percentiles(held, "distance", spots)), F.lit(True), "left")  # one row
    return both.select("n", *[F.round(c, digits).alias(f"nn_{c}") for c in ("min", "mean", *spots, "max")])


def farthest(distances: DataFrame, target: int, factor: float) -> DataFrame:
    """The max(target, int(n * factor)) rows of largest distance, ties to the smaller id, without a sort."""
    held = stash(distances)
    return ranks.largest(held, max(target, int(held.count() * factor)))


def zscored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with each column less its mean over its population deviation (0 counts as 1): one pass for the moments."""
    moments = rows.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns])
    z = {f"{c}_z": (F.col(c) - F.col(f"{c}_mean")) / F.when(F.col(f"{c}_sd") == 0, 1.0).otherwise(F.col(f"{c}_sd")) for c in columns}
    return rows.crossJoin(F.broadcast(moments)).select(*rows.columns, *[v.alias(k) for k, v in z.items()])  # one row
