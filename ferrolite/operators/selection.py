"""Farthest-point selection, plain and with a reward for sparse compositions, and the split that follows from it."""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolite.operators import ranks
from ferrolite.operators.distance import farthest, nearest, usable
from ferrolite.sources.scratch import stash

#: Farthest rows that the driver sees in a round (their vectors are sent to it), and rounds after which lineage is cut.
CANDIDATES, CUT = 2048, 8
#: Picks that a round of the composition-aware fill foresees, rows whose place one of its steps may ask for, rows that
#: foresee places (their vectors are sent to the driver once), rows that a task has at least and looks at together,
#: and how far beyond the first rows, in parts of their number, a round looks for rows that come among them.
STEPS, MARKS, SAMPLE, TASK_ROWS, REACH = 256, 64, 16_384, 2048, 1.5


def farthest_points(rows: DataFrame, k: int | None, min_distance: float = 0.0, anchors: DataFrame | None = None, first: int | None = None) -> DataFrame:
    """pick (from 1), id, distance: greedy farthest-point sampling over ``rows`` (id, v array<double>).

    Without ``anchors`` the row ``first``, or else the smallest id, is first; then always the row farthest from all
    picks, ties to the smaller id, until ``k`` rows are picked or the farthest is closer than ``min_distance``; with
    null for ``k`` only the distance ends it. A round sends the ``CANDIDATES`` farthest rows to the driver. As distances
    only fall, the best of them is the next pick for as long as it comes before the last of them as that was sent; then
    one pass over the rows updates their distance to the new picks. The rows stay where they are. Rows without an id, and
    vectors that are null or hold null or non-finite components, take no part.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    picks: list[tuple[int, int, float]] = []
    if anchors is not None:
        state = rows.join(anchors.select("id"), "id", "left_anti").join(nearest(rows, rows.join(anchors.select("id"), "id", "left_semi")).select("id", F.col("distance").alias("d")), "id")
    else:
        state = rows.withColumn("d", F.lit(float("inf")))
    held = state.select("id", "v", "d").persist(StorageLevel.MEMORY_AND_DISK)
    rounds = 0
    while k is None or len(picks) < k:
        left = held.where(F.col("d") >= min_distance)
        top = left.select("id", "d").orderBy(F.desc("d"), "id").limit(CANDIDATES).collect()
        if not top:
            break
        last = top[-1]
        near = left.where((F.col("d") > last["d"]) | ((F.col("d") == last["d"]) & (F.col("id") <= last["id"])))
        if first is not None and not picks:
            near = held.where(F.col("id") == first)
        found = near.collect()
        ids, v, d = np.array([r["id"] for r in found]), np.array([r["v"] for r in found], np.float64), np.array([r["d"] for r in found])
        new = []
        while len(ids) and (k is None or len(picks) < k):
            best = np.lexsort((ids, -d))[0]
            asked = first is not None and not picks
            if d[best] < min_distance or (not asked and len(top) == CANDIDATES and (-d[best], ids[best]) > (-last["d"], last["id"])):
                break
            picks.append((len(picks) + 1, int(ids[best]), float(d[best])))
            new.append(v[best])
            d = np.minimum(d, np.sqrt(((v - v[best]) ** 2).sum(axis=1)))
            d[best] = -1.0
            if asked:
                break
        if not new:
            break
        after = _approached(held, np.array(new), [p[1] for p in picks[-len(new) :]]).persist(StorageLevel.MEMORY_AND_DISK)
        rounds += 1
        if rounds % CUT == 0:
            cut = stash(after)
            after.unpersist()
            after = cut.persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
        held.unpersist()
        held = after
    held.unpersist()
    return spark.createDataFrame(picks, "pick int, id bigint, distance double")


def _approached(held: DataFrame, points: np.ndarray, ids: list[int]) -> DataFrame:
    """``held`` (id, v, d) with d no larger than the distance to the points, and -1 for the rows that they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v, d = batch.column("v").flatten().to_numpy().reshape(len(batch), -1), batch.column("d").to_numpy().copy()
            for p in points:
                np.minimum(d, np.sqrt(((v - p) ** 2).sum(axis=1)), out=d)
            d[np.isin(batch.column("id").to_numpy(), ids)] = -1.0
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(d)], names=["id", "v", "d"])

    return held.mapInArrow(run, held.schema)


def count_at(picks: DataFrame, distances: list[float]) -> DataFrame:
    """min_distance, n: how many rows farthest-point sampling picks at each stop distance.

    The distances of the picks do not rise, so one run answers for every distance that it reached.
    """
    stops = picks.sparkSession.createDataFrame([(float(d),) for d in distances], "min_distance double")
    return stops.join(picks, F.col("distance") >= F.col("min_distance"), "left").groupBy("min_distance").agg(F.count("pick").alias("n"))


def distance_for(picks: list[float], target: int, tolerance: int, rounds: int = 30) -> float:
    """The stop distance that the search by doubling and bisection ends with, its counts read off the picks' distances.

    It starts at 0.01 and doubles until at most ``target`` rows are picked, then halves the interval from 0 until the
    count is within ``tolerance``; the last distance with at most ``target`` rows otherwise.
    """
    if target < 1:
        raise ValueError("target must be 1 or more")
    falling = np.array(picks)

    def count(d: float) -> int:
        return int((falling >= d).sum())

    high = 0.01
    while count(high) > target:
        high *= 2
    low, best = 0.0, high
    if target - count(high) <= tolerance:
        best = high
    for _ in range(rounds):
        middle = (low + high) / 2
        n = count(middle)
        if n <= target:
            best = high = middle
        else:
            low = middle
        if abs(n - target) <= tolerance:
            return middle
    return best


def target_picks(rows: DataFrame, target: int, tolerance: int, first: int | None = None) -> DataFrame:
    """The picks (pick, id, distance) at the stop distance that the search for ``target`` rows ends with.

    The search asks only whether a count exceeds ``target`` and whether it is within ``tolerance``, so a run of one pick
    more than both answers it as a longer one would.
    """
    run = farthest_points(rows, target + tolerance + 1, first=first)
    stop = distance_for([r["distance"] for r in run.select("distance").collect()], target, tolerance)
    return run.where(F.col("distance") >= stop)


def train_test(rows: DataFrame, anchors: DataFrame, target_train: int, target_test: int, tolerance: int = 50, pool_factor: float = 0.5) -> DataFrame:
    """id, split of ``rows`` (id, v array<double>): train, test or unselected.

    Training rows are the ``anchors`` (id) and a farthest-point selection of the others that fills ``target_train``; all
    rows if they are not more. Test rows come from the pool of max(``target_test``, n * ``pool_factor``) left rows that
    are farthest from the training rows, by a selection that starts with the farthest; all left rows if they are not more.
    """
    anchors = anchors.select("id").distinct()
    n, fixed = rows.count(), anchors.count()
    if fixed > target_train:
        raise ValueError(f"{fixed} anchors exceed the target of {target_train} training rows")
    if target_train >= n:
        return rows.select("id", F.lit("train").alias("split"))
    train = anchors
    if fixed < target_train:
        train = train.union(target_picks(rows.join(anchors, "id", "left_anti"), target_train - fixed, tolerance).select("id"))
    left = rows.join(F.broadcast(train), "id", "left_anti")  # train: at most the target and the tolerance
    m = left.count()
    test = left.select("id")
    if target_test < m:
        found = nearest(left, rows.join(F.broadcast(train), "id", "left_semi").select(F.col("id").alias("id"), F.col("v").alias("v"))).persist(StorageLevel.MEMORY_AND_DISK)
        pool = farthest(found, target_test, pool_factor).persist(StorageLevel.MEMORY_AND_DISK)
        start = found.orderBy(F.desc("distance"), "id").first()["id"]
        test = target_picks(left.join(pool.select("id"), "id", "left_semi"), target_test, tolerance, start).select("id")
        pool.unpersist()
        found.unpersist()
    return split_labels(rows, [("train", train), ("test", test)])


def composition_aware_points(
    rows: DataFrame, target: int, frontier: float, anchors: DataFrame | None = None, ternary_weight: float = 1.0, totals: tuple[int, int] = (20, 190), floor: float = 0.9, steps: int = STEPS
) -> DataFrame:
    """pick, id: the composition-aware fill over rows (id, v array<double>, bins array<struct<subset:string, bin:string,
    ternary:boolean>>) that stay in Spark; ``anchors`` (id; without any the smallest id) are taken first.

    In each step the rows are ordered by distance to the chosen ones; of the first max(1, ceil(``frontier`` * n)) those
    at no distance are left out if others remain, and so are those below ``floor`` of the largest distance; the row whose
    bins are the emptiest is taken, then the farther one, then the smaller id.

    A round foresees up to ``steps`` picks on a bounded list of rows, the farthest ones and those of the emptiest bins, and on a sample that tells how many rows are ahead of one. It then
    certifies them all in one pass over the rows: with the picks foreseen, each task returns for every step the farthest
    row of each reward that can be taken (a row with a farther one of a larger reward can't) and how many of its rows
    come before those that the step compares. The picks that this confirms are taken, and so is the right one of the
    first step that was foreseen wrongly. So a round takes one pick at least, and as many as were foreseen while the list
    holds what matters. Rows without an id and unusable vectors take no part.
    """
    spark = rows.sparkSession
    whole = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).select("id", "v", "bins", F.to_json("bins").alias("kind"), F.lit(float("inf")).alias("d"))
    left = whole.count()
    parts = max(1, min(-(-left // TASK_ROWS), 2 * spark.sparkContext.defaultParallelism))
    held = whole.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    start = held.join(anchors.select("id").distinct(), "id", "left_semi") if anchors is not None else held
    first = start.select("id", "v", "bins").orderBy("id").limit(target if anchors is not None else 1).collect()  # target rows at most
    if not first and anchors is not None:
        first = held.select("id", "v", "bins").orderBy("id").limit(1).collect()
    picks = [(int(r["id"]), np.array(r["v"], np.float64), r["bins"]) for r in first[:target]]
    sample = _Sample(held.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow(), left <= SAMPLE)
    left, fresh, rounds = left - len(picks), list(picks), 0
    rewards = _Rewards(ternary_weight, totals)
    for _, _, bins in picks:
        rewards.count(bins)
    while len(picks) < target and left > 0:
        after = held.mapInArrow(_moved(fresh), held.schema)
        rounds += 1
        after = (stash(after) if rounds % CUT == 0 else after).persist(StorageLevel.MEMORY_AND_DISK)
        sample.move(fresh)
        (low,) = sample.reached(REACH * frontier * left)
        known, counts = _candidates(after, sample.edges(), low, rewards.copy(), parts)
        sample.weigh(counts)
        held.unpersist()
        held = after
        wides = [max(1, math.ceil(frontier * (left - t))) for t in range(min(steps, target - len(picks), left))]
        plan, marks = _foreseen(known, sample.copy(), rewards.copy(), wides, left, floor)
        found = held.mapInArrow(_certified(plan, marks, rewards.copy()), _FOUND)
        found = found.groupBy("step", "reward", "mark").agg(F.max(F.struct("d", (-F.col("id")).alias("m"))).alias("x"), F.sum("n").alias("n"))
        found = found.select("step", "reward", "mark", "x.d", (-F.col("x.m")).alias("id"), "n").toArrow().to_pylist()
        bests: dict[int, list[tuple[float, float, int]]] = {}
        aheads: dict[int, list[tuple[float, int, int]]] = {}
        for r in found:
            if r["mark"] is None:
                bests.setdefault(r["step"], []).append((-r["reward"], -r["d"], r["id"]))
            else:
                aheads.setdefault(r["step"], []).append((*marks[r["step"]][r["mark"]], r["n"]))
        fresh = []
        for t, wide in enumerate(wides[: max(1, len(plan))]):
            best = sorted(bests.get(t, []))
            chosen = _chosen(best, lambda d, i, a=aheads.get(t, []), w=wide: _place(a, d, i, w), wide, left - t, floor)
            if chosen is None and t == 0:  # a row that wasn't foreseen: one more pass counts what is before it
                every = [(-d, i) for _, d, i in best]
                exact = {every[r["mark"]]: r["n"] for r in held.mapInArrow(_certified([], [every], rewards.copy()), _FOUND).where("mark is not null").groupBy("mark").agg(F.sum("n").alias("n")).collect()}
                chosen = _chosen(best, lambda d, i, e=exact: e[d, i], wide, left, floor)
            if chosen is None:
                break
            row = known.get(chosen)
            if row is None:
                r = held.where(F.col("id") == chosen).select("v", "bins").first()
                row = (np.array(r["v"], np.float64), r["bins"])
            fresh.append((chosen, *row))
            rewards.count(row[1])
            if not plan or chosen != plan[t][0]:
                break
        picks += fresh
        left -= len(fresh)
    held.unpersist()
    return spark.createDataFrame([(k + 1, i) for k, (i, _, _) in enumerate(picks)], "pick int, id bigint")


_FOUND = "step int, reward double, mark bigint, id bigint, d double, n bigint"


def _chosen(best: list[tuple[float, float, int]], ahead: Callable[[float, int], int | None], wide: int, left: int, floor: float) -> int | None:
    """The id that is taken among the farthest rows of each reward, sorted (-reward, -d, id); null if it takes a count
    of rows ahead that is not known."""
    if not best:
        return None
    best = _not_beaten(best)
    farthest_row = min((d, i) for _, d, i in best)
    most = -farthest_row[0]
    if most > 1e-12:
        best = [b for b in best if -b[1] >= floor * most]
    for _, d, i in best:
        if wide >= left or len(best) == 1 or (d, i) == farthest_row:
            return i
        n = ahead(-d, i)
        if n is None:
            return None
        if n < wide:
            return i
    return None


def _place(marks: list[tuple[float, int, int]], d: float, i: int, wide: int) -> int | None:
    """How many rows are ahead of the row, as far as the counts n at the ``marks`` (d, id, n) tell on which side of ``wide``
    it is; null if they don't."""
    least = max((n for x, j, n in marks if (-x, j) <= (-d, i)), default=0)
    most = min((n for x, j, n in marks if (-x, j) >= (-d, i)), default=None)
    if least >= wide:
        return least
    return most if most is not None and most < wide else None


def _not_beaten(best: list[tuple[float, float, int]]) -> list[tuple[float, float, int]]:
    """Without the rows that are nearer than one of a larger reward: where such a row may be taken, so may the other."""
    out, most = [], -1.0
    for b in best:
        if -b[1] >= most:
            out.append(b)
            most = -b[1]
    return out


def _matrix(rows: pa.Table) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in rows.column("v").chunks] or [np.zeros(0)]).reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list, pa.Table]]:
    """ids, vectors, distances, kinds (numbers), the bins of each kind, and the rows, of ``TASK_ROWS`` rows or so at a time."""

    def arrays(some: list[pa.RecordBatch]):
        table = pa.Table.from_batches(some).combine_chunks()
        names = table.column("kind").combine_chunks().dictionary_encode()
        names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
        kind = names.indices.to_numpy().astype(np.int64)
        bins = table.column("bins").take(pa.array(np.unique(kind, return_index=True)[1])).to_pylist()
        return table.column("id").to_numpy(), _matrix(table), table.column("d").to_numpy().copy(), kind, bins, table

    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch)
        if size >= TASK_ROWS:
            yield arrays(held)
            held, size = [], 0
    if held:
        yield arrays(held)


def _candidates(held: DataFrame, edges: np.ndarray, low: float, rewards: _Rewards, parts: int) -> tuple[_Known, np.ndarray]:
    """The farthest rows of the tasks, and the farthest one of each set of bins, the emptiest first, and others of it that
    are no nearer than ``low``, ``CANDIDATES`` of both in all; and how many rows are in each of the intervals of distances that end at
    the ``edges``."""
    most = max(1, CANDIDATES // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, counts = [], np.zeros(len(edges) + 1, np.int64)
        for ids, _, d, kind, bins, table in _gathered(batches):
            there = np.flatnonzero(d >= 0)
            counts += np.bincount(np.searchsorted(edges, d[there]), minlength=len(counts))
            r = _Table(bins, rewards).rewards()[kind]
            # The farthest row of each kind first, kinds by reward; then the next one of each.
            order = there[np.lexsort((ids[there], -d[there], kind[there]))]
            first = np.flatnonzero(np.diff(kind[order], prepend=-1))
            nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
            near = (nth == 0) | (d[order] >= low)
            order, nth = order[near], nth[near]
            some = np.unique(np.concatenate([there[np.lexsort((ids[there], -d[there]))[:most]], order[np.lexsort((-d[order], -r[order], nth))[:most]]]))
            place = np.zeros(len(ids), np.int64)
            place[order] = nth
            kept.append((d[some], r[some], place[some], table.take(pa.array(some)).select(["id", "v", "bins", "d"])))
            if len(kept) > 1:  # as many as one part of the rows has
                d, r, nth = (np.concatenate([k[c] for k in kept]) for c in range(3))
                table = pa.concat_tables([k[3] for k in kept])
                some = np.unique(np.concatenate([np.argsort(-d, kind="stable")[:most], np.lexsort((-d, -r, nth))[:most]]))
                kept = [(d[some], r[some], nth[some], table.take(pa.array(some)))]
        if kept:
            table = kept[0][3].combine_chunks()
            n = pa.ListArray.from_arrays(pa.array([0, len(counts), *[len(counts)] * (len(table) - 1)][: len(table) + 1], pa.int32()), pa.array(counts))
            if len(table):
                yield pa.RecordBatch.from_arrays([*[table.column(c).combine_chunks() for c in ("id", "v", "bins", "d")], n], names=["id", "v", "bins", "d", "counts"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema if f.name != "kind")
    got = held.mapInArrow(run, f"{ddl}, counts array<bigint>").toArrow()
    counts = np.zeros(len(edges) + 1, np.int64)
    for n in got.column("counts").to_pylist():
        if n:
            counts += np.array(n)
    return _Known(got.column("id").to_pylist(), _matrix(got), got.column("bins").to_pylist(), got.column("d").to_numpy()), counts


class _Known(dict):
    """Candidates (vector, bins) by id; ``ids``, ``v``, ``d`` have them as arrays, as the round begins."""

    def __init__(self, ids: list[int], v: np.ndarray, bins: list, d: np.ndarray) -> None:
        super().__init__({i: (x, b) for i, x, b in zip(ids, v, bins, strict=True)})
        self.ids, self.v, self.bins, self.d = np.array(ids, np.int64), v, bins, d.copy()


class _Sample:
    """Rows of the smallest hashes, which foresee how many rows are farther than a distance: each stands for as many as
    were counted about its own distance when the round began."""

    def __init__(self, rows: pa.Table, whole: bool) -> None:
        self.whole = whole
        self.ids, self.v = rows.column("id").to_numpy(), _matrix(rows)
        self.squares, self.d, self.weight = (self.v**2).sum(axis=1), np.full(len(self.ids), np.inf), np.ones(len(self.ids))

    def copy(self) -> _Sample:
        out = copy.copy(self)
        out.d = self.d.copy()
        return out

    def move(self, fresh: list[tuple]) -> None:
        for i, p, _ in fresh:
            near = np.sqrt(np.maximum(self.squares + (p * p).sum() - 2 * (self.v @ p), 0))
            np.minimum(self.d, near, out=self.d, where=self.d >= 0)
            self.d[self.ids == i] = -1.0

    def edges(self) -> np.ndarray:
        return np.unique(np.sort(self.d[self.d >= 0])[3::4])

    def reached(self, *counts: float) -> list[float]:
        """Distances that about so many rows reach."""
        if self.whole:
            at = np.minimum(np.array(counts, np.int64), len(self.d) - 1)
            return (-np.partition(-self.d, at)[at]).tolist()
        order = np.argsort(-self.d)
        at = np.searchsorted(np.cumsum(self.weight[order]), counts)
        return self.d[order[np.minimum(at, len(order) - 1)]].tolist()

    def weigh(self, counts: np.ndarray) -> None:
        if self.whole:
            return
        there = self.d >= 0
        at = np.searchsorted(self.edges(), self.d[there])
        self.weight = np.zeros(len(self.d))
        self.weight[there] = (counts / np.maximum(1, np.bincount(at, minlength=len(counts))))[at]

    def ahead(self, x: float) -> float:
        return float(np.count_nonzero(self.d > x) if self.whole else self.weight[self.d > x].sum())


def _foreseen(known: _Known, sample: _Sample, rewards: _Rewards, wides: list[int], left: int, floor: float) -> tuple[list, list]:
    """The picks (id, v, bins) that the fill would make if the candidates were all rows that can be taken, and for each
    step the (d, id) of the rows whose place it asks for."""
    ids, v, d = known.ids, known.v, known.d
    names = [tuple((b["subset"], b["bin"], b["ternary"]) for b in x) for x in known.bins]
    place = {n: k for k, n in enumerate(dict.fromkeys(names))}
    kind = np.array([place[n] for n in names], np.int64)
    table = _Table([known.bins[k] for k in np.unique(kind, return_index=True)[1].tolist()], rewards)
    plan, marks = [], []
    for t, wide in enumerate(wides):
        best = _farthest_of_each(table.rewards(), kind, d, ids)
        asked: list[tuple[float, int]] = []

        def ahead(x: float, i: int) -> int:
            asked.append((x, i))
            return int(sample.ahead(x + 1e-12))

        chosen = _chosen(best, ahead, wide, left - t, floor)
        if chosen is None or len(asked) > MARKS:
            break
        after = [(-x, i) for _, x, i in _not_beaten(best) if (-x, i) not in asked]
        plan.append((chosen, *known[chosen]))
        border = [(x, -1) for x in sample.reached(wide * 0.99 - 2, wide - 1, wide, wide * 1.01 + 2)]  # tells of rows that are not asked for
        marks.append(asked + after[: MARKS - len(asked)] + border)
        _near(d, v, plan[-1][1])
        d[ids == chosen] = -1.0
        sample.move(plan[-1:])
        table.count(known[chosen][1])
    return plan, marks


def _farthest_of_each(rewards: np.ndarray, kind: np.ndarray, d: np.ndarray, ids: np.ndarray) -> list[tuple[float, float, int]]:
    """(-reward, -d, id) of the farthest row of each reward (given for each kind), ties to the smaller id, sorted; rows
    with d < 0 are out, and so are those that are beaten."""
    values, of_kind = np.unique(rewards, return_inverse=True)
    of_row = of_kind[kind]
    most = np.full(len(values), -1.0)
    np.maximum.at(most, of_row, d)
    best: dict[int, int] = {}
    for k in np.flatnonzero((d >= 0) & (d == most[of_row])).tolist():
        best[int(of_row[k])] = min(best.get(int(of_row[k]), int(ids[k])), int(ids[k]))
    return _not_beaten(sorted((-float(values[c]), -float(most[c]), i) for c, i in best.items()))


def _near(d: np.ndarray, v: np.ndarray, p: np.ndarray) -> None:
    """``d`` no larger than the distance to ``p``, but for picked rows; in parts that fit a cache."""
    for at in range(0, len(d), 512):
        some = d[at : at + 512]
        np.minimum(some, np.sqrt(((v[at : at + 512] - p) ** 2).sum(axis=1)), out=some, where=some >= 0)


def _certified(plan: list, marks: list, rewards: _Rewards):
    """For every step of the plan the farthest row of each reward (mark null), and the number of rows before each mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[float, tuple[float, int]]] = [{} for _ in range(max(1, len(plan)))]
        ahead = [[0] * len(m) for m in marks]
        for ids, v, d, kind, bins, _ in _gathered(batches):
            table = _Table(bins, rewards)
            for t, mine in enumerate(best):
                for reward, far, i in _farthest_of_each(table.rewards(), kind, d, ids):
                    mine[-reward] = max(mine.get(-reward, (-1.0, 0)), (-far, -i))
                for k, (x, i) in enumerate(marks[t] if t < len(marks) else []):
                    ahead[t][k] += int(((d > x) | ((d == x) & (ids < i))).sum())
                if t + 1 < len(best):
                    _near(d, v, plan[t][1])
                    d[ids == plan[t][0]] = -1.0
                    table.count(plan[t][2])
        rows = [(t, r, None, -m, x, 0) for t, mine in enumerate(best) for r, (x, m) in mine.items()]
        rows += [(t, None, k, 0, x, n) for t, m in enumerate(marks) for k, ((x, _), n) in enumerate(zip(m, ahead[t], strict=True))]
        kinds = (("step", pa.int32()), ("reward", pa.float64()), ("mark", pa.int64()), ("id", pa.int64()), ("d", pa.float64()), ("n", pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])

    return run


class _Rewards:
    """How often bins, and subsets in all, are chosen so far; a row's reward is the mean emptiness of its bins."""

    def __init__(self, ternary_weight: float, totals: tuple[int, int], tally: dict[tuple, int] | None = None, sums: dict[str, int] | None = None) -> None:
        self.ternary_weight, self.totals, self.tally, self.sums = ternary_weight, totals, tally or {}, sums or {}

    def copy(self) -> _Rewards:
        return _Rewards(self.ternary_weight, self.totals, dict(self.tally), dict(self.sums))

    def count(self, bins: list) -> None:
        """One more chosen row."""
        for b in bins:
            self.tally[b["subset"], b["bin"]] = self.tally.get((b["subset"], b["bin"]), 0) + 1
            self.sums[b["subset"]] = self.sums.get(b["subset"], 0) + 1


class _Table:
    """The rewards of many sets of bins at once, with counts of its own that go on from those given."""

    def __init__(self, kinds: list[list], rewards: _Rewards) -> None:
        cells: dict[tuple, int] = {}
        self.bins: dict[tuple, int] = {}
        self.subsets: dict[str, int] = {}
        of_kind = [[cells.setdefault((b["subset"], b["bin"], b["ternary"]), len(cells)) for b in x] for x in kinds]
        self.bin = np.array([self.bins.setdefault(c[:2], len(self.bins)) for c in cells], np.int64)
        self.subset = np.array([self.subsets.setdefault(c[0], len(self.subsets)) for c in cells], np.int64)
        self.cells = np.array([rewards.totals[c[2]] for c in cells], np.int64)
        self.tally = np.array([rewards.tally.get(b, 0) for b in self.bins], np.int64)
        self.sums = np.array([rewards.sums.get(s, 0) for s in self.subsets], np.int64)
        weights = [max(0.0, rewards.ternary_weight if c[2] else 1.0) for c in cells]
        self.columns = []  # the first bin of each kind, the second one and so on
        for k in range(max((len(x) for x in of_kind), default=0)):
            have = [k < len(x) for x in of_kind]
            self.columns.append((np.array([x[k] if h else 0 for x, h in zip(of_kind, have, strict=True)]), np.array([weights[x[k]] if h else 0.0 for x, h in zip(of_kind, have, strict=True)])))
        self.weight = sum((w for _, w in self.columns), np.zeros(len(kinds)))

    def count(self, bins: list) -> None:
        for b in bins:
            if (b["subset"], b["bin"]) in self.bins:
                self.tally[self.bins[b["subset"], b["bin"]]] += 1
            if b["subset"] in self.subsets:
                self.sums[self.subsets[b["subset"]]] += 1

    def rewards(self) -> np.ndarray:
        """Of each set of bins."""
        goal = np.maximum(1, self.sums[self.subset] // self.cells + 1) if len(self.cells) else np.zeros(0)
        empty = np.maximum(0, goal - self.tally[self.bin]) / goal if len(self.cells) else goal
        total = np.zeros(len(self.weight))
        for cell, weight in self.columns:
            total += weight * empty[cell]
        return np.divide(total, self.weight, out=np.zeros(len(total)), where=self.weight > 0)


def _moved(fresh: list[tuple]):
    """Distances after the fresh picks; -1 for the picked rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, d = batch.column("id").to_numpy(), batch.column("d").to_numpy().copy()
            v = batch.column("v").flatten().to_numpy().reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))
            for _, p, _ in fresh:
                _near(d, v, p)
            d[np.isin(ids, [i for i, _, _ in fresh])] = -1.0
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "v", "bins", "kind")], pa.array(d)], names=["id", "v", "bins", "kind", "d"])

    return run


def attempt_schedule(frontier: float, ternary_weight: float, retries: int) -> list[tuple[float, float]]:
    """(frontier, ternary weight) of each attempt: as asked, half and twice the frontier within bounds, twice the weight."""
    every = [(frontier, ternary_weight), (max(0.05, frontier / 2), ternary_weight), (min(0.25, frontier * 2), ternary_weight), (frontier, ternary_weight * 2)]
    return every[: max(1, retries)]


def attempt_metrics(rows: DataFrame, picks: DataFrame, number: int, totals: tuple[int, int] = (20, 190)) -> dict:
    """What an attempt is judged by: the mean over the picks' subsets of the share of the subset's ``totals`` bins that
    they occupy and of the entropy over them (1 if all are equally full), for two and three elements; and nearest
    distances among the picks."""
    mine = rows.join(picks.select("id"), "id", "left_semi")
    cells = mine.select(F.explode("bins").alias("b")).groupBy(F.col("b.ternary").alias("t"), F.col("b.subset").alias("s"), "b.bin").agg(F.count(F.lit(1)).alias("n"))
    total = F.when(F.col("t"), totals[1]).otherwise(totals[0]).cast("double")
    # Of n_1 .. n_k that sum to N the entropy is ln N - sum(n ln n) / N.
    entropy = F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln("n")) / F.sum("n")
    each = cells.groupBy("t", "s").agg((F.count(F.lit(1)) / total).alias("occupied"), (entropy / F.ln(F.greatest(total, F.lit(2.0)))).alias("even"))
    means = {r["t"]: r for r in each.groupBy("t").agg(F.avg("occupied").alias("occupied"), F.avg("even").alias("even")).collect()}
    out: dict = {"attempt_number": number}
    for t, name in ((False, "binary"), (True, "ternary")):
        out[f"{name}_occupied_bin_fraction"] = means[t]["occupied"] if t in means else 0.0
        out[f"{name}_normalized_entropy"] = means[t]["even"] if t in means else 0.0
    same = mine.select("id", "v")
    d = nearest(same, same, itself=True).agg(F.min("distance").alias("a"), F.min("positive_distance").alias("b"), F.avg("distance").alias("c")).first()
    return out | {"train_min_dist": d["a"], "train_positive_min_dist": d["b"], "train_mean_nn_dist": d["c"]}


def composition_aware_training(rows: DataFrame, target: int, frontier: float, retries: int = 4, anchors: DataFrame | None = None, ternary_weight: float = 1.0, floor: float = 0.9) -> DataFrame:
    """pick, id of the best attempt of the schedule. ``frontier`` and ``floor`` must lie in (0, 1], the weight must not be
    negative, and there is one attempt at least."""
    if not (0 < frontier <= 1 and 0 < floor <= 1 and ternary_weight >= 0 and retries >= 1):
        raise ValueError("settings of the composition-aware selection are out of range")
    picks, metrics = [], []
    for k, (f, w) in enumerate(attempt_schedule(frontier, ternary_weight, retries)):
        picks.append(composition_aware_points(rows, target, f, anchors, w))
        metrics.append(attempt_metrics(rows, picks[-1], k))
    return picks[best_attempt(metrics, floor)]


def best_attempt(attempts: list[dict], floor: float) -> int:
    """attempt_number of the winner: the first one always counts, a retry only if neither its smallest distance (the
    positive one, if that is larger) nor its mean falls below ``floor`` of the first one's. The best score wins, then
    the larger smallest distance (zero included), the larger mean, the earlier attempt; differences up to 1e-12 are none."""

    def least(a: dict) -> float:
        return max(a["train_positive_min_dist"], a["train_min_dist"])

    def score(a: dict) -> float:
        # The weights of the score.
        return (
            0.35 * a["binary_occupied_bin_fraction"] + 0.20 * a["binary_normalized_entropy"] + 0.30 * a["ternary_occupied_bin_fraction"] + 0.15 * a["ternary_normalized_entropy"]
        )

    first = attempts[0]
    best = first
    for a in attempts[1:]:
        if least(a) < floor * least(first) or a["train_mean_nn_dist"] < floor * first["train_mean_nn_dist"]:
            continue
        for mine, other in ((score(a), score(best)), (a["train_min_dist"], best["train_min_dist"]), (a["train_mean_nn_dist"], best["train_mean_nn_dist"]), (-a["attempt_number"], -best["attempt_number"])):
            if abs(mine - other) > 1e-12:
                best = a if mine > other else best
                break
    return best["attempt_number"]


def random_split(rows: DataFrame, share: float = 0.7, seed: int = 42) -> DataFrame:
    """id, split: exactly max(1, round(``share`` * n)) rows are train, the others test, in the order of a hash of id and seed.

    The last row of the training set is found by ranks, so that nothing is sorted; halves are rounded to even.
    """
    at = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(seed))), 1, 8), 16, 10).cast("double")
    held = stash(rows.select("id", (-at).alias("distance")))
    train = ranks.largest(held, max(1, round(share * held.count())))
    return split_labels(rows, [("test", held), ("train", train)])


def split_labels(rows: DataFrame, layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """``rows`` (id) with ``split``: the last of the layers (name, ids) that has the id, or unselected."""
    out = rows.select("id").withColumn("split", F.lit("unselected"))
    for name, ids in layers:
        mark = ids.select("id").distinct().withColumn("_in", F.lit(True))
        out = out.join(mark, "id", "left").select("id", F.when(F.col("_in"), F.lit(name)).otherwise(F.col("split")).alias("split"))
    return out
