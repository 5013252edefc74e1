"""Operator 6: near-duplicate documents by b-bit MinHash, with every link confirmed on the full shingle sets.

1. One pass over the texts makes, for each document, the size and a 128-bit fingerprint of its set of 5-word shingles,
   ``PERMS`` minima, of which the low ``BITS`` bits are packed as the signature, and ``BANDS`` band keys, each a hash
   of ``PERMS / BANDS`` full minima.
2. Documents with equal sets become one node, named by the smallest id; only nodes go on.
3. Each band bucket links its nodes to its smallest node: at most as many pairs as the bucket has nodes. A pair whose
   collision-corrected estimate (bit counts of the packed signatures) lies far under the threshold is put aside;
   the others are confirmed on full sets and joined into components.
4. Buckets that still hold nodes of several components are compared in blocks, but only across components. Their
   nodes get a second, longer signature, and only pairs that its estimate lets through are emitted; these are
   confirmed as well. So no bucket is cut short, and none is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolite.llm import words as W
from ferrolite.llm.common import as_text, frequent_from, only, sifted, slices, spread_join, stash, tuned
from ferrolite.llm.components import components

PERMS, BANDS, BITS = 128, 32, 4
ROWS = PERMS // BANDS
#: Minima and bits of the second signature.
MORE_PERMS, MORE_BITS = 2048, 2
#: Standard errors that an estimate may lie under the threshold before the pair is put aside.
SLACK = 4.5
#: Buckets of up to this many nodes are paired by a join, larger ones in blocks of about BLOCK nodes.
SMALL, BLOCK = 12, 4096

_rng = np.random.Generator(np.random.PCG64(77003))
_A = _rng.integers(0, 2**31, MORE_PERMS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, MORE_PERMS, dtype=np.uint32)


def least_estimate(threshold: float, perms: int = PERMS, bits: int = BITS) -> float:
    """The smallest corrected estimate with which a pair is still confirmed on full sets."""
    c = 2.0**-bits
    e = threshold + (1 - threshold) * c
    return threshold - SLACK * (e * (1 - e) / perms) ** 0.5 / (1 - c)


def minima(sets: np.ndarray, bounds: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """Minima (uint32) of each non-empty run of hashes: shape (runs, perms)."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((perms, len(bounds)), np.uint32)
    v = np.empty_like(x)
    for j in range(perms):
        np.multiply(x, _A[j], out=v)
        v += _B[j]
        out[j] = np.minimum.reduceat(v, bounds)
    return out.T


def packed(mins: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of each minimum, 64 / bits of them in a word: shape (documents, words)."""
    low = (mins & np.uint32(2**bits - 1)).astype(np.uint64).reshape(len(mins), mins.shape[1] * bits // 64, 64 // bits)
    return np.bitwise_or.reduce(low << (np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits)), axis=2)


def band_keys(mins: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; its number takes part."""
    rows = mins.reshape(len(mins), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        out = W.mix(out * np.uint64(0xD1342543DE82EF95) + rows[:, :, k])
    return out


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    return [np.unique(x) if len(x) > 1 else x for x in W.shingles(W.words(texts))]


SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sig", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)
SIGNED_DDL = "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sig array<bigint>, bands array<bigint>"


def _lists(rows: np.ndarray, has: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    ends = np.concatenate([[0], np.cumsum(np.where(has, width, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1).view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for at, texts in slices(as_text(batch.column("text"))):
            sets = shingle_sets(texts)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            has = sizes > 0
            f1, f2 = sizes.copy(), sizes.copy()
            mins = np.zeros((0, PERMS), np.uint32)
            if has.any():
                flat = np.concatenate(sets)
                bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])[has]
                f1[has] = W.mix(np.add.reduceat(flat, bounds)).view(np.int64)
                f2[has] = W.mix(np.add.reduceat(flat * (flat >> np.uint64(7)), bounds)).view(np.int64)
                mins = minima(flat, bounds)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(texts)), pa.array(sizes), pa.array(f1), pa.array(f2), _lists(packed(mins), has), _lists(band_keys(mins), has)], schema=SIGNED
            )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fingerprint (f1, f2), packed signature and band keys of each document."""
    tuned(docs.sparkSession)
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_sign, SIGNED_DDL)


def _sign_more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("sig", pa.list_(pa.int64()))])
    for batch in batches:
        for at, texts in slices(as_text(batch.column("text")), 1 << 18):
            sets = shingle_sets(texts)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            has = sizes > 0
            mins = np.zeros((0, MORE_PERMS), np.uint32)
            if has.any():
                mins = minima(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]])[has], MORE_PERMS)
            rows = _lists(packed(mins, MORE_BITS), has)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), rows], schema=schema).filter(pa.array(has))


def estimate(a: str, b: str, perms: int = PERMS, bits: int = BITS) -> Column:
    """Similarity from two packed signatures: equal minima by bit counts, less the share that agrees by chance."""
    ones = sum(1 << (k * bits) for k in range(64 // bits))
    ones -= (ones >> 63) << 64

    def differ(x: Column, y: Column) -> Column:
        z, s = x.bitwiseXOR(y), 1
        while s < bits:
            z, s = z.bitwiseOR(F.shiftrightunsigned(z, s)), 2 * s
        return F.bit_count(z.bitwiseAND(F.lit(ones)))

    count = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda n, x: n + x)
    c = 2.0**-bits
    return (F.lit(1.0) - count / F.lit(float(perms)) - F.lit(c)) / F.lit(1 - c)


def _linked(a: pd.Series, b: pd.Series, percent: pd.Series) -> pd.Series:
    """100 * intersection >= percent * union, on full sets; sides that repeat within a batch are shingled once."""
    known: dict[str, np.ndarray] = {}
    new = list(dict.fromkeys([x for s in (a, b) for x in s]))
    for at, piece in slices(pa.array(new, pa.string())):
        for k, s in enumerate(shingle_sets(piece)):
            known[new[at + k]] = s
    out = []
    for x, y, p in zip(a, b, percent, strict=True):
        s, t = known[x], known[y]
        both = len(np.intersect1d(s, t, assume_unique=True))
        out.append(bool(both) and 100 * both >= int(p) * (len(s) + len(t) - both))
    return pd.Series(out, dtype=bool)


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the (u, v) pairs those whose documents are linked.

    The pairs of a frequent ``u`` are dealt over several copies of its text; only those ids and their numbers of copies
    are broadcast, ``HOT_KEYS`` at most.
    """
    counts = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    most = frequent_from(size["n"] or 0)
    # Most texts are in no pair: these stay where they are.
    left = sifted(texts, pairs.select("u"), "doc_id").select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    right = sifted(texts, pairs.select("v"), "doc_id").select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    if (size["most"] or 0) <= most:
        both = pairs.join(left, "u").join(right, "v")
    else:
        hot = F.broadcast(stash(counts.where(F.col("n") > most).select("u", F.ceil(F.col("n") / most).cast("int").alias("copies"))))
        left = left.join(hot, "u", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1))))).drop("copies")
        dealt = pairs.join(hot, "u", "left").withColumn("copy", (F.pmod(F.xxhash64("v"), F.coalesce("copies", F.lit(1))) + 1).cast("int")).drop("copies")
        both = dealt.join(left, ["u", "copy"]).join(right, "v")
    return both.where(F.pandas_udf(_linked, "boolean")("text_u", "text_v", F.lit(percent))).select("u", "v").distinct()


def _across(threshold: float, bits: int = MORE_BITS):
    """Within one block pair: pairs of nodes of different components whose estimate is high enough.

    A pair that shares several buckets is emitted in the one of the first band only.
    """
    c = 2.0**-bits
    ones = np.uint64(sum(1 << (k * bits) for k in range(64 // bits)))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        node, comp, blk = pdf["node"].to_numpy(), pdf["component"].to_numpy(), pdf["blk"].to_numpy()
        i, j, key = int(pdf["i"].iat[0]), int(pdf["j"].iat[0]), int(pdf["key"].iat[0])
        bands = np.array(pdf["bands"].tolist(), dtype=np.int64)
        sig = np.array(pdf["sig"].tolist(), dtype=np.int64).view(np.uint64)
        most = (1 - threshold * (1 - c) - c) * sig.shape[1] * 64 / bits
        rows, cols = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in rows.tolist():
            ok = comp[cols] != comp[r]
            if i == j:
                ok &= node[cols] > node[r]
            there = cols[ok]
            x, s = sig[there] ^ sig[r], 1
            while s < bits:
                x |= x >> np.uint64(s)
                s *= 2
            there = there[np.bitwise_count(x & ones).sum(axis=1, dtype=np.int64) <= most]
            hit = node[there[bands[r][(bands[there] == bands[r]).argmax(axis=1)] == key]]
            us.append(np.minimum(hit, node[r]))
            vs.append(np.maximum(hit, node[r]))
        return pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return compare


def _mended(rest: DataFrame, reps: DataFrame, texts: DataFrame, links: DataFrame, reached: DataFrame, percent: int) -> DataFrame:
    """The components with the links that are found within buckets of several components (``rest``)."""
    high = least_estimate(percent / 100, MORE_PERMS, MORE_BITS)
    asked = stash(rest.select(F.col("node").alias("doc_id")).distinct())
    wanted = sifted(texts, asked, "doc_id").join(asked, "doc_id", "left_semi")
    longer = stash(wanted.mapInArrow(_sign_more, "node bigint, sig array<bigint>"))
    x = rest.where(F.col("n") <= SMALL)
    y = x.select("key", F.col("node").alias("v"), F.col("component").alias("cv"))
    few = x.select("key", F.col("node").alias("u"), F.col("component").alias("cu")).join(y, "key").where("u < v and cu <> cv").select("u", "v").distinct()
    few = few.join(longer.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u").join(longer.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v")
    few = few.where(estimate("su", "sv", MORE_PERMS, MORE_BITS) >= high).select("u", "v")
    big = rest.where(F.col("n") > SMALL).join(longer, "node").join(reps.select("node", "bands"), "node").withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int"))
    big = big.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    dealt = big.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "key", "node", "component", "sig", "bands", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")
    )
    many = dealt.groupBy("key", "i", "j").applyInPandas(_across(high), "u bigint, v bigint")
    more = stash(_confirmed(stash(few.union(many).distinct()), texts, percent))
    return components(links.union(more)) if more.take(1) else reached


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of distinct 5-word shingles
    (A-Z lower-cased; a text with fewer words is one shingle; a null, empty or blank text has none and is linked with
    nothing). ``component_id`` is the smallest id reachable over links, the document's own included; ``kept`` tells
    whether it is the document's own. Rows that share an id count as one document for links; each row's class follows
    its own text. A row without an id takes no part: null component, kept. Links are found through ``BANDS`` bands of
    ``ROWS`` minima: a pair at the threshold of 0.75 is missed with a chance of about 5e-6. Sets are those of 64-bit hashes
    of shingles, and sets with equal size and two equal sums over them count as equal. A text of any length is one set.
    """
    spark = docs.sparkSession
    low = least_estimate(percent / 100)
    signed = stash(signatures(docs))
    with_set = signed.where("n_shingles > 0 and doc_id is not null")

    # Equal sets are one node.
    nodes = with_set.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node"))
    nodes = stash(nodes)
    reps = with_set.select(F.col("doc_id").alias("node"), "f1", "f2", "n_shingles", "sig", "bands").join(nodes, ["node", "f1", "f2", "n_shingles"], "left_semi")
    reps = reps.select("node", "sig", "bands")
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    keyed = reps.select("node", F.explode("bands").alias("key"))
    pivots = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n")).where("last > pivot")
    members = stash(spread_join(keyed, stash(pivots.select("key", "pivot", "n")), "key"))  # buckets of one node are gone
    sigs = reps.select("node", "sig")
    stars = members.where("node > pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    stars = stars.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u").join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v")
    stars = stash(stars.where(estimate("su", "sv") >= low).select("u", "v").distinct())
    links = stash(_confirmed(stars, texts, percent))
    reached = components(links)

    # What is left: buckets with nodes of several components.
    placed = members.where("n > 2").join(reached, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b")
    rest = stash(spread_join(placed, stash(mixed.select("key", "n")), "key"))
    final = _mended(rest, reps, texts, links, reached, percent) if rest.take(1) else reached

    # From nodes back to rows.
    classes = nodes.join(final, "node", "left").select("f1", "f2", "n_shingles", F.coalesce("component", "node").alias("component"))
    own = signed.select("doc_id", "n_shingles", "f1", "f2")
    linked = own.where("n_shingles > 0 and doc_id is not null").join(classes, ["f1", "f2", "n_shingles"])
    alone = own.where("not (n_shingles > 0 and doc_id is not null)").withColumn("component", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept")]
    return linked.select(*columns).union(alone.select(*columns))
