"""Operator 2: a quality classifier, a byte-level convolutional network in numpy.

Each byte has a learned vector; learned filters over ``WIDTH`` consecutive bytes give one response per filter and
position. The text is covered by overlapping chunks; a chunk's features are the filters' maxima in it. Mean,
maximum and minimum of these over the chunks go into one logistic unit. A filter's response is a sum of table look-ups, one for
each of its bytes, so that scoring needs no matrix product per position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolite.llm import words as W
from ferrolite.llm.common import as_text, chosen_texts, only, slices, smallest, stash, tuned

WIDTH, FILTERS, VECTOR = 5, 16, 8
#: Chunks of 512 bytes that begin every 256 bytes: four blocks of which two are shared with the next chunk.
BLOCK, BLOCKS, STEP = 128, 4, 2
CHUNK = BLOCK * BLOCKS
#: Bytes whose filter responses are held at once.
PASS = 1 << 18
#: Labelled documents of each class to learn from at most and their bytes, and random chunks of a long one in an epoch.
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_CHUNKS, EPOCHS = 1200, 32 << 20, 8, 8


@dataclass
class Network:
    """Tables (WIDTH, 256, FILTERS), filter offsets, and the logistic unit over means, maxima and minima."""

    tables: np.ndarray
    offset: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text of a null-free array."""
        raw, offsets = W.raw(texts)
        sizes = np.diff(offsets)
        # Each text is followed by WIDTH - 1 zero bytes, so that every byte begins one window; an empty text is one zero byte.
        full = np.maximum(sizes, 1)
        ends = np.cumsum(full + (WIDTH - 1))
        starts = ends - full - (WIDTH - 1)
        buf = np.zeros((int(ends[-1]) if len(ends) else 0) + WIDTH - 1, np.uint8)
        for a, b, s in zip(offsets[:-1].tolist(), offsets[1:].tolist(), starts.tolist(), strict=True):
            buf[s : s + b - a] = raw[a:b]
        # Maxima of blocks, then of chunks, then mean, maximum and minimum over the chunks.
        blocks = -(-full // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        nth = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
        begin = np.repeat(starts, blocks) + nth * BLOCK
        end = np.minimum(begin + BLOCK, np.repeat(starts + full, blocks))
        # Blocks are pooled in passes, within a text as well: responses of one pass are held at a time.
        tops = np.empty((len(begin), FILTERS), np.float32)
        at = 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + PASS, side="right")))
            low, n = int(begin[at]), int(end[to - 1] - begin[at])
            part = buf[low : low + n + WIDTH - 1]
            response = self.tables[0][part[:n]]
            for k in range(1, WIDTH):
                response += self.tables[k][part[k : n + k]]
            edges = np.empty(2 * (to - at), np.int64)
            edges[0::2], edges[1::2] = begin[at:to] - low, end[at:to] - low
            tops[at:to] = np.maximum.reduceat(response, edges[:-1], axis=0)[0::2]
            at = to
        chunks = np.maximum(1, -(-(blocks - BLOCKS) // STEP) + 1)
        cfirst = np.concatenate([[0], np.cumsum(chunks)])
        cnth = np.arange(cfirst[-1]) - np.repeat(cfirst[:-1], chunks)
        cbegin, last = np.repeat(first[:-1], chunks) + cnth * STEP, np.repeat(first[1:], chunks) - 1
        pooled = tops[cbegin]
        for k in range(1, BLOCKS):
            np.maximum(pooled, tops[np.minimum(cbegin + k, last)], out=pooled)
        pooled = np.maximum(pooled + self.offset, 0)
        mean = np.add.reduceat(pooled, cfirst[:-1], axis=0) / chunks[:, None]
        top = np.maximum.reduceat(pooled, cfirst[:-1], axis=0)
        low = np.minimum.reduceat(pooled, cfirst[:-1], axis=0)
        logit = np.concatenate([mean, top, low], axis=1).astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _chunks_of(texts: list[bytes], draw: np.random.Generator, most: int = SAMPLE_CHUNKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All chunks of each text, or ``most`` at random places all over it where it has more: bytes, lengths, and the text
    of each."""
    x, sizes, of = [], [], []
    for d, t in enumerate(texts):
        last = max(0, len(t) - CHUNK)
        places = range(0, last + 1, STEP * BLOCK) if last <= (most - 1) * STEP * BLOCK else draw.integers(0, last + 1, most).tolist()
        for p in places:
            part = t[p : p + CHUNK]
            x.append(np.frombuffer(part.ljust(CHUNK + WIDTH - 1, b"\0"), np.uint8))
            sizes.append(max(1, len(part)))
            of.append(d)
    return np.array(x), np.array(sizes), np.array(of)


def train(texts: list[bytes], labels: list[int], shift: float = 0.0, seed: int = 2, chunks: int = SAMPLE_CHUNKS) -> Network:
    """Fit the network by Adam on the logistic loss; ``shift`` is added to the log odds in the end."""
    draw = np.random.Generator(np.random.PCG64(seed))
    vectors = draw.normal(0, 0.5, (256, VECTOR))
    kernels = draw.normal(0, 0.4, (WIDTH, VECTOR, FILTERS))
    p = [vectors, kernels, np.zeros(FILTERS), draw.normal(0, 0.2, 3 * FILTERS), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    y, order, step, size = np.array(labels, float), np.arange(len(texts)), 0, 48
    for epoch in range(EPOCHS if len(texts) else 0):
        draw.shuffle(order)
        rate = 0.02 * (1 - epoch / EPOCHS) + 0.002
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            x, sizes, of = _chunks_of([texts[r] for r in rows], draw, chunks)
            tables = np.einsum("be,kef->kbf", p[0], p[1]).astype(np.float32)
            response = tables[0][x[:, :CHUNK]]
            for k in range(1, WIDTH):
                response += tables[k][x[:, k : CHUNK + k]]
            response[np.arange(CHUNK)[None, :] >= sizes[:, None]] = -1e9
            place = response.argmax(axis=1)
            pooled = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0, :] + p[2]
            on = pooled > 0
            pooled = np.where(on, pooled, 0)
            count = np.bincount(of, minlength=len(rows))
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
            mean = np.add.reduceat(pooled, first, axis=0) / count[:, None]
            top = np.maximum.reduceat(pooled, first, axis=0)
            low = np.minimum.reduceat(pooled, first, axis=0)
            features = np.concatenate([mean, top, low], axis=1)
            logit = features @ p[3] + p[4][0]
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            back = error[:, None] * p[3][None, :]
            g = (back[:, :FILTERS] / count[:, None])[of] + np.where(pooled == top[of], back[of][:, FILTERS : 2 * FILTERS], 0)
            g += np.where(pooled == low[of], back[of][:, 2 * FILTERS :], 0)
            g = np.where(on, g, 0)
            dt = np.zeros((WIDTH, 256, FILTERS))
            f = np.broadcast_to(np.arange(FILTERS), place.shape)
            for k in range(WIDTH):
                np.add.at(dt[k], (np.take_along_axis(x, place + k, axis=1), f), g)
            grads = [np.einsum("kbf,kef->be", dt, p[1]), np.einsum("be,kbf->kef", p[0], dt), g.sum(axis=0), features.T @ error + 1e-4 * p[3], np.array([error.sum()])]
            step += 1
            for a, d, mm, vv in zip(p, grads, m, v, strict=True):
                mm += 0.1 * (d - mm)
                vv += 0.01 * (d * d - vv)
                a -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
    tables = np.einsum("be,kef->kbf", p[0], p[1]).astype(np.float32)
    return Network(tables, p[2].astype(np.float32), p[3], float(p[4][0]) + shift)


def fit(
    docs: DataFrame, labels: DataFrame, train_rows: Column, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, chunks: int = SAMPLE_CHUNKS
) -> Network:
    """Learn from the rows of ``labels`` (doc_id, quality 0 or 1) where ``train_rows``, a condition on doc_id, holds.

    Of each class ``sample_docs`` labelled documents, those with the smallest hashed ids, are used, up to ``sample_bytes``
    of whole texts; repeated rows count once. In an epoch a text is seen in all its chunks, a longer one in ``chunks``
    random ones of all of it, drawn anew each time. The classes' true shares enter as a shift of the log odds. Without
    labelled documents of both classes every score is 0.5.
    """
    known = only(labels, "doc_id", "quality").where(train_rows & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.join(only(docs, "doc_id"), "doc_id", "left_semi").distinct()
    share = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = stash(smallest(known, sample_docs, "quality"))
    rows = chosen_texts(docs, chosen, sample_docs, sample_bytes, "quality").select("quality", F.xxhash64("doc_id").alias("h"), "text").collect()
    rows = sorted(rows, key=lambda r: (r["h"], r["text"] or ""))
    n = {k: sum(r["quality"] == k for r in rows) for k in (0, 1)}
    if not n[0] or not n[1]:
        return Network(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(3 * FILTERS), 0.0)
    shift = float(np.log(share[1] / share[0]) - np.log(n[1] / n[0]))
    return train([(r["text"] or "").encode() for r in rows], [r["quality"] for r in rows], shift, chunks=chunks)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text.

    A null text counts as an empty one and gets the score of a single zero byte. Rows are scored one by one: repeated
    rows, null ids and extra columns change nothing. Filter responses are held for ``PASS`` bytes at a time, in a text of
    any length.
    """
    held = tuned(docs.sparkSession).sparkContext.broadcast(network)  # some tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [held.value.scores(piece) for _, piece in slices(as_text(batch.column("text")), 1 << 18)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else np.zeros(0))], schema=_SCHEMA)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, network: Network, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, as they are, whose score is ``least`` or more."""
    held = tuned(docs.sparkSession).sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [held.value.scores(piece) for _, piece in slices(as_text(batch.column("text")), 1 << 18)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= least))

    return docs.mapInArrow(run, docs.schema)
