"""Operator 12: similarity join on n-gram sets by size-banded tiles with hashed bitmaps.

1. One pass over the texts makes, for each document, the size of its set of 3-word shingles, a fingerprint, a hashed
   bitmap as wide as the set is large, and the set's prefix: so many of its smallest hashes that two linked sets have one
   of these in common. Documents with equal sets become one node.
2. Shingles that stand in many prefixes come last in the order of hashes, the same for all documents, and the prefixes
   that hold any are made again: tiles stay small although passages are shared.
3. A tile has the nodes with one prefix shingle whose sizes lie in one band or the one below; sizes of linked sets lie
   in one band or in neighbouring ones. Each tile links its nodes to its smallest one first. Bit counts of the two bitmaps
   bound the overlap from above; pairs whose bound is high enough are confirmed by the exact intersection of sorted arrays.
4. Tiles that still hold several components are compared in blocks, across components only; of the pairs that the bound
   lets through, those that join what is apart make families, in which all links that are missing lie. Families are
   tiled by bands again, now with the sets themselves: wider bitmaps, then exact intersections, across components only.
   So no tile is cut short, and none is expanded into all its links.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolite.llm import words as W
from ferrolite.llm.common import as_text, only, slices, spread_join, stash, tuned
from ferrolite.llm.components import components

WIDTH = 3
#: Least and largest bits of a bitmap.
LEAST_BITS, MOST_BITS = 64, 1 << 15
#: Prefixes that a shingle may be in before it is a frequent one; frequent ones are HOT_MOST at most (8 bytes each).
HOT_FROM, HOT_MOST = 256, 1 << 20
#: Nodes of one block of a tile, with bitmaps and with whole sets.
BLOCK, SET_BLOCK = 2048, 512
#: Pairs that one copy of a node's text serves, and nodes up to which their keys are broadcast.
COPY_PAIRS, BROADCAST_ROWS = 4096, 200_000

TEXT_PASS = 1 << 20


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """Elements of a set of ``size`` of which a linked set must hold one: all but as many as they share at least, and one."""
    return size - -(-percent * size // 100) + 1


def bits(size: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, int(size) - 1).bit_length()))


def bitmap(ordered: np.ndarray) -> np.ndarray:
    """64-bit words; a set's hash is the bit of its low bits, so that halves laid over each other are the narrower bitmap."""
    n = bits(len(ordered))
    out = np.zeros(n, np.uint8)
    out[(ordered & np.uint64(n - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    for x in W.shingles(W.words(texts), width):
        yield np.unique(x) if len(x) > 1 else x


def _prefix(s: np.ndarray, percent: int, hot: np.ndarray) -> np.ndarray:
    """The first elements of a sorted set in the order (frequent, hash)."""
    n = int(prefix_length(np.int64(len(s)), percent)) if len(s) else 0
    if not len(hot):
        return s[:n]
    late = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
    return np.concatenate([s[~late][:n], s[late][: max(0, n - int((~late).sum()))]])


_SIGNED = pa.schema([(c, pa.int64()) for c in ("doc_id", "h", "n", "f1", "f2")] + [("bitmap", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])
_SIGNED_DDL = "doc_id bigint, h bigint, n bigint, f1 bigint, f2 bigint, bitmap array<bigint>, prefix array<bigint>"


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sign(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for at, texts in slices(as_text(batch.column("text")), TEXT_PASS):
                sizes, f1, f2, maps, prefixes = [], [], [], [], []
                for s in sets(texts, width):
                    sizes.append(len(s))
                    f1.append(int(W.mix(s.sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0)
                    f2.append(int(W.mix((s * (s >> np.uint64(7))).sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0)
                    maps.append(bitmap(s) if len(s) else none)
                    prefixes.append(_prefix(s, percent, none))
                numbers = [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (sizes, f1, f2)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, len(texts)) for c in ("doc_id", "h")] + [*numbers, _lists(maps), _lists(prefixes)], schema=_SIGNED)

    return run


def _again(percent: int, width: int, hot: list[int]):
    keys = np.sort(np.array(hot, dtype=np.int64).view(np.uint64))
    schema = pa.schema([("node", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(as_text(batch.column("text")), TEXT_PASS):
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(texts)), _lists([_prefix(s, percent, keys) for s in sets(texts, width)])], schema=schema)

    return run


def _texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text for each of the ``wanted`` nodes (column node), once."""
    keys = stash(nodes.select("node", "doc_id", "h").join(wanted.select("node").distinct(), "node", "left_semi"))
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = docs.join(F.broadcast(keys) if few else keys, ["doc_id", "h"])
    return stash(found.groupBy("node").agg(F.first("text").alias("text")))


def _confirm(percent: int, width: int):
    """Over rows sorted by (u, copy), the text of ``u`` before the texts that are compared with it: the linked pairs."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            out = []
            for first, texts in slices(as_text(batch.column("text")), TEXT_PASS):
                for k, s in enumerate(sets(texts, width), first):
                    if vs[k] is None:
                        at, own = us[k], s
                    elif us[k] == at:
                        both = len(np.intersect1d(own, s, assume_unique=True))
                        if both and 100 * both >= percent * (len(own) + len(s) - both):
                            out.append((us[k], vs[k]))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(2)], schema=schema)

    return run


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Of the different (u, v) pairs of nodes those that are linked, by exact intersections of their sorted sets.

    The text of ``v`` is sent to each pair, the text of ``u`` once for each ``COPY_PAIRS`` of its pairs.
    """
    texts = _texts_of(pairs.select(F.col("u").alias("node")).union(pairs.select("v")), nodes, docs)
    copies = pairs.groupBy("u").agg((F.floor((F.count(F.lit(1)) - 1) / F.lit(COPY_PAIRS)) + 1).cast("int").alias("copies"))
    left = copies.join(texts.withColumnRenamed("node", "u"), "u").select("u", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), F.lit(None).cast("bigint").alias("v"), "text")
    many = stash(copies.where("copies > 1"))
    if many.take(1):  # a frequent u has over COPY_PAIRS pairs, so that these are few
        dealt = pairs.join(F.broadcast(many) if many.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else many, "u", "left")
        dealt = dealt.select("u", "v", (F.pmod(F.xxhash64("v"), F.coalesce("copies", F.lit(1))) + 1).cast("int").alias("copy"))
    else:
        dealt = pairs.select("u", "v", F.lit(1).alias("copy"))
    right = dealt.join(texts.withColumnRenamed("node", "v"), "v").select("u", "copy", "v", "text")
    both = left.union(right).repartition("u", "copy").sortWithinPartitions("u", "copy", F.col("v").asc_nulls_first())
    return stash(both.select("u", "v", "text").mapInArrow(_confirm(percent, width), "u bigint, v bigint"))


def overlap_bound(n_a: Column, a: Column, n_b: Column, b: Column) -> Column:
    """The most that two sets can share: a bit that only one bitmap has stands for an element that the other set lacks.
    One bitmap may be twice as wide as the other, which the sizes of linked sets are never beyond."""

    def fold(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(x)

    def alone(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, x: s + x)

    x, y = fold(a, b), fold(b, a)
    return F.least(n_a - alone(x, y), n_b - alone(y, x))


def enough(bound: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return F.lit(100) * bound >= F.lit(percent) * (n_a + n_b - bound)


class _Union:
    """Which of a tile's nodes are taken to be joined, by their components' numbers."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


_PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _by_tile(compare: Callable[[list[np.ndarray], dict[str, np.ndarray], np.ndarray], list[tuple[int, int]]], lists: str):
    """Hands whole tiles of rows sorted by (tile, i, j) on: their bounds, the columns and the edges of the column ``lists``."""
    names = ("tile", "i", "j", "node", "component", "guest", "n", "blk")

    def tiles(table: pa.RecordBatch, ends: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """Rows of tiles that are complete, and the rest."""
        keys = [table.column(c).to_numpy() for c in names[:3]]
        last = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) if len(table) else []
        cut = len(table) if ends else int(last[-1]) + 1 if len(last) else 0
        return table.slice(0, cut), table.slice(cut)

    def found(table: pa.RecordBatch) -> pa.RecordBatch:
        columns = {c: table.column(c).to_numpy(zero_copy_only=False) for c in names}
        column = table.column(lists)
        values, edges = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy().astype(np.int64)
        keys = [columns[c] for c in names[:3]]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])) if len(table) else np.zeros(0, np.int64)
        pairs = sorted(set(compare(np.append(starts, len(table)), columns, values, edges)))
        return pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs], pa.int64()) for c in range(2)], schema=_PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            done, left = tiles(batch, False)
            if not len(done):
                rest.append(batch)
                continue
            yield found(pa.concat_batches([*rest, done]))
            rest = [pa.concat_batches([left])] if len(left) else []
        if rest:
            yield found(pa.concat_batches(rest))

    return run


def _alone(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x & ~y).sum(axis=-1, dtype=np.int64)


def _bound(n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``overlap_bound`` of rows of bitmaps of one width."""
    return np.minimum(n - _alone(x, y), m - _alone(y, x))


def _near(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets of these sizes can be linked."""
    return np.minimum(n, m) * 100 >= percent * np.maximum(n, m)


#: Nodes of a tile up to which all its pairs are laid out at once.
FEW = 48


def _candidates(percent: int):
    """For every tile pairs of nodes of different components whose overlap can be enough, one only if the pairs before it
    do not join its nodes. Pairs of two nodes of the lower band are left to the tile in which this is the upper one."""

    def compare(bounds: np.ndarray, c: dict[str, np.ndarray], values: np.ndarray, edges: np.ndarray) -> list[tuple[int, int]]:
        sizes = np.diff(bounds)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in np.unique(sizes[(sizes > 1) & (sizes <= FEW)]).tolist():
            one, two = np.triu_indices(size, 1)
            first = bounds[:-1][sizes == size]
            left.append((first[:, None] + one).ravel())
            right.append((first[:, None] + two).ravel())
        hits = _passing(np.concatenate(left), np.concatenate(right), c, values, edges, percent)
        out = []
        for k in np.flatnonzero(sizes > FEW).tolist():
            out += _forest(np.arange(bounds[k], bounds[k + 1]), c, values, edges, percent)
        unions: dict[int, _Union] = {}
        tile_of = np.searchsorted(bounds, [a for a, _ in hits], side="right") if hits else []
        for t, (a, b) in zip(tile_of, hits, strict=True):
            if unions.setdefault(int(t), _Union()).join(int(c["component"][a]), int(c["component"][b])):
                u, v = int(c["node"][a]), int(c["node"][b])
                out.append((min(u, v), max(u, v)))
        return out

    return compare


def _forest(rows: np.ndarray, c: dict[str, np.ndarray], values: np.ndarray, edges: np.ndarray, percent: int, sets: bool = False) -> list[tuple[int, int]]:
    """Of one large tile's rows: pairs across components that can be linked, each joining what those before it leave apart.

    The lists are bitmaps, or else sets: then bitmaps of 16 bits for each element are made of them, and what these let
    through is confirmed by the intersection of the sorted arrays. Joined rows are compared with each other no more.
    """
    n, guest, blk = (c[k][rows] for k in ("n", "guest", "blk"))
    i, j = c["i"][rows[0]], c["j"][rows[0]]
    own = [values[edges[r] : edges[r + 1]] for r in rows.tolist()]
    if sets:
        width = min(1 << max(6, int(16 * n.max()).bit_length()), MOST_BITS * 16)
        maps = np.zeros((len(rows), width // 64), np.uint64)
        for k, s in enumerate(own):
            bit = np.zeros(width, np.uint8)
            bit[(s & np.uint64(width - 1)).astype(np.int64)] = 1
            maps[k] = np.packbits(bit, bitorder="little").view(np.uint64)
    else:
        width = min(len(s) for s in own)
        maps = np.array([np.bitwise_or.reduce(s.reshape(-1, width), axis=0) for s in own])
    comp = np.unique(c["component"][rows], return_inverse=True)[1]
    step = max(1, (1 << 20) // maps.shape[1])
    cols, out = np.flatnonzero(blk == j), []
    for r in np.flatnonzero(blk == i).tolist():
        there = cols[(comp[cols] != comp[r]) & ~(guest[cols] & guest[r]) & _near(n[cols], n[r], percent)]
        if i == j:
            there = there[there > r]
        for at in range(0, len(there), step):
            some = there[at : at + step]
            bound = _bound(n[some], maps[some], n[r], maps[r])
            some = some[100 * bound >= percent * (n[some] + n[r] - bound)]
            while len(some := some[comp[some] != comp[r]]):
                k, some = int(some[0]), some[1:]
                if sets:
                    both = len(np.intersect1d(own[r], own[k], assume_unique=True))
                    if 100 * both < percent * (n[r] + n[k] - both):
                        continue
                u, v = int(c["node"][rows[r]]), int(c["node"][rows[k]])
                out.append((min(u, v), max(u, v)))
                comp[comp == comp[k]] = comp[r]
    return out


def _passing(left: np.ndarray, right: np.ndarray, c: dict[str, np.ndarray], values: np.ndarray, edges: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Of pairs of rows those of different blocks of their tile, or of its one block, that can be linked."""
    if not len(left):
        return []
    i, j, blk = c["i"][left], c["j"][left], c["blk"]
    apart = (i == j) | (blk[left] != blk[right])
    ok = apart & (c["component"][left] != c["component"][right]) & ~(c["guest"][left] & c["guest"][right]) & _near(c["n"][left], c["n"][right], percent)
    left, right = left[ok], right[ok]
    widths = np.diff(edges)
    out: list[tuple[int, int]] = []
    both = widths[left] * (1 << 32) + widths[right]
    for key in np.unique(both).tolist():
        w, z = key >> 32, key & (2**32 - 1)
        width = min(w, z)
        for at in range(0, len(here := np.flatnonzero(both == key)), step := max(1, (1 << 18) // width)):
            a, b = left[here[at : at + step]], right[here[at : at + step]]
            x = np.bitwise_or.reduce(values[edges[a][:, None] + np.arange(w)].reshape(len(a), -1, width), axis=1)
            y = np.bitwise_or.reduce(values[edges[b][:, None] + np.arange(z)].reshape(len(b), -1, width), axis=1)
            bound = _bound(c["n"][a], x, c["n"][b], y)
            fit = 100 * bound >= percent * (c["n"][a] + c["n"][b] - bound)
            out += zip(a[fit].tolist(), b[fit].tolist(), strict=True)
    return out


def _linked(percent: int):
    """For every tile links between nodes of different components, as many as join what belongs together; the lists are sets."""

    def compare(bounds: np.ndarray, c: dict[str, np.ndarray], values: np.ndarray, edges: np.ndarray) -> list[tuple[int, int]]:
        tiles = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        return [pair for a, b in tiles for pair in _forest(np.arange(a, b), c, values, edges, percent, True)]

    return compare


def _dealt(rows: DataFrame, lists: str, block: int) -> DataFrame:
    """Tiles (tile, node, component, guest, n, ``lists`` and the tile's ``nodes``) cut into pairs of blocks (i, j)."""
    blocks = F.ceil(F.col("nodes") / F.lit(block)).cast("int")
    blk = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("blk", blk).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("tile", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "node", "component", "guest", "n", "blk", lists)
    keys = ["tile", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node")


def _mixed(tiles: DataFrame, reached: DataFrame) -> DataFrame:
    """tile, node, guest, n, component, nodes of the tiles (tile, node, guest, n) whose nodes are in several components."""
    placed = tiles.select("tile", "node", "guest", F.col("n").alias("size")).join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("tile").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b").select("tile", "n")
    return spread_join(placed, stash(several), "tile").withColumnRenamed("n", "nodes").withColumnRenamed("size", "n")


def _banded(rows: DataFrame, percent: int, *key: str) -> DataFrame:
    """A row for the tile of its band and one, as a guest, for the next band's. A band is a little wider than the ratio of
    linked sizes, so that rounding moves no link beyond the next band."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent / 100 - 0.01))).cast("bigint")
    return rows.withColumn("up", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        F.xxhash64(*key, band + F.col("up")).alias("tile"), "node", "n", (F.col("up") == 1).alias("guest"), *[c for c in rows.columns if c not in ("node", "n", *key)]
    )


_SET_DDL = "node bigint, set array<bigint>"


def _sets_of(width: int):
    schema = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(as_text(batch.column("text")), TEXT_PASS):
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(texts)), _lists(list(sets(texts, width)))], schema=schema)

    return run


def join(docs: DataFrame, percent: int = 90, width: int = WIDTH, hot_from: int = HOT_FROM) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of distinct ``width``-word shingles
    (A-Z lower-cased; a text with fewer words is one shingle; a null, empty or blank text has none and is linked with
    nothing). ``component_id`` is the smallest id reachable by links, the document's own included. No link is missed.
    Rows that share an id are documents of their own unless their texts are linked; rows without an id take no part
    and have no component. Sets are those of 64-bit hashes of shingles, and sets with equal size and two equal sums over
    them count as equal. ``percent`` must be over 50. Links between copies are not counted: only as many are confirmed as join what belongs together.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and 100 at most")
    spark = docs.sparkSession
    tuned(spark)
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    signed = stash(rows.mapInArrow(_sign(percent, width), _SIGNED_DDL))
    with_set = signed.where("n > 0 and doc_id is not null")

    # Equal sets are one node with a number of its own.
    nodes = with_set.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "h")).alias("least"))
    nodes = stash(nodes.select("f1", "f2", "n", "least.doc_id", "least.h", F.monotonically_increasing_id().alias("node")))
    reps = with_set.join(nodes.select("doc_id", "h", "f1", "f2", "n", "node"), ["doc_id", "h", "f1", "f2", "n"]).dropDuplicates(["node"])
    reps = stash(reps.select("node", F.col("n"), "bitmap", "prefix"))

    # Frequent shingles come last in the order of every document.
    keyed = reps.select("node", F.posexplode("prefix").alias("at", "key"))
    counts = stash(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = counts.where(F.col("n") > max(hot_from, total // HOT_MOST)).select("key")
    frequent = [r["key"] for r in hot.collect()]  # HOT_MOST at most
    if frequent:
        touched = stash(keyed.join(F.broadcast(hot), "key", "left_semi").select("node").distinct())
        changed = _texts_of(touched, nodes, rows).mapInArrow(_again(percent, width, frequent), "node bigint, prefix array<bigint>")
        changed = stash(changed.select("node", F.posexplode("prefix").alias("at", "key")))
        keyed = stash(keyed.join(touched, "node", "left_anti").union(changed))
        counts = stash(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))

    # Tiles: a node is at home in the tile of its band, and a guest in the next one's. A guest is the smaller of two sets,
    # which share so much of it that a shorter prefix does; tiles without a node at home have nothing to compare.
    shared = spread_join(keyed, counts, "key").drop("n").join(reps.select("node", "n"), "node")
    least_shared = F.call_function("div", 2 * percent * F.col("n") + (99 + percent), F.lit(100 + percent).cast("bigint"))
    tiles = _banded(shared, percent, "key").where(~F.col("guest") | (F.col("at") <= F.col("n") - least_shared)).drop("at")
    pivots = tiles.groupBy("tile").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"), F.max(~F.col("guest")).alias("home"))
    pivots = stash(pivots.where("last > pivot and home").drop("last", "home"))
    tiles = stash(spread_join(tiles.withColumnRenamed("n", "size"), pivots, "tile").withColumnRenamed("n", "nodes").withColumnRenamed("size", "n"))

    stars = tiles.where("node > pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    for end in ("u", "v"):
        stars = stars.join(reps.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bitmap").alias(f"b_{end}")), end)
    fits = F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent
    stars = stars.where(fits).where(enough(overlap_bound(F.col("n_u"), F.col("b_u"), F.col("n_v"), F.col("b_v")), F.col("n_u"), F.col("n_v"), percent))
    links = confirmed(stash(stars.select("u", "v")), nodes, rows, percent, width)
    reached = components(links)

    # What is left: tiles with nodes of several components. Pairs that bounds let through make families, which hold all
    # links that are missing yet; there sets themselves are compared, each node's once for each block and band.
    rest = _mixed(tiles, reached).join(reps.select("node", "bitmap"), "node")
    pairs = stash(_dealt(rest, "bitmap", BLOCK).mapInArrow(_by_tile(_candidates(percent), "bitmap"), "u bigint, v bigint").distinct())
    if pairs.take(1):
        families = components(links.union(pairs)).withColumnRenamed("component", "family")
        open_ = families.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = stash(open_.groupBy("family").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b").select("family", "n"))
        mine = stash(spread_join(open_.select("node", "family"), several, "family").drop("n").join(reps.select("node", "n"), "node"))
        banded = _banded(mine, percent, "family")
        pivoted = stash(banded.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.max(~F.col("guest")).alias("home")).where("n > 1 and home").drop("home"))
        banded = stash(spread_join(banded.withColumnRenamed("n", "size"), pivoted, "tile").drop("n").withColumnRenamed("size", "n"))
        wanted = stash(_texts_of(mine, nodes, rows).mapInArrow(_sets_of(width), _SET_DDL))
        more = _dealt(_mixed(banded, reached).join(wanted, "node"), "set", SET_BLOCK).mapInArrow(_by_tile(_linked(percent), "set"), "u bigint, v bigint").distinct()
        reached = components(links.union(stash(more)))

    place = nodes.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = place.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = place.join(least, "component").select("f1", "f2", "n", "component_id")
    own = signed.select("doc_id", "n", "f1", "f2")
    linked = own.where("n > 0 and doc_id is not null").join(classes, ["f1", "f2", "n"])
    alone = own.where("not (n > 0 and doc_id is not null)").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).union(alone.select(*columns))
