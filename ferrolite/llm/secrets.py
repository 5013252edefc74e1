"""Operator 9: secrets in texts, by fixed patterns and by character Markov models.

The patterns find what is marked as a secret. The Markov models find what only looks like one: runs of key
characters whose transitions are likelier in random strings than in ordinary identifiers, by log-likelihood ratio.
Both models are trained from labelled samples.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolite.llm import words as W
from ferrolite.llm.common import as_text, chosen_texts, only, slices, smallest, stash, tuned

# The marked kinds, in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ of 16 characters or more
KINDS = ("assign", "access", "hex", "markov")
_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

#: Shortest run that the models judge, fewest different characters in it, and the ratio (in nats) from which it is a secret.
RUN, DISTINCT, RATIO = 20, 8, 18.0
#: Documents whose ordinary words the models learn from at most, and their bytes.
SAMPLE_DOCS, SAMPLE_BYTES = 400, 8 << 20

_CHARS = string.ascii_letters + string.digits + "+/=_-"
_CLASS = np.full(256, -1, dtype=np.int16)
_CLASS[np.frombuffer(_CHARS.encode(), np.uint8)] = np.arange(len(_CHARS))
_IN_RUN = _CLASS >= 0
_TOKEN = re.compile(r"[A-Za-z0-9+/=_-]{6,}")


def random_strings(count: int = 1500, seed: int = 9) -> list[str]:
    """Labelled samples of secrets: random strings over the alphabets that keys are written in."""
    draw = random.Random(seed)
    letters = string.ascii_letters + string.digits
    alphabets = (letters, letters + "+/", letters + "_-", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, string.hexdigits.upper()[:10] + "ABCDEF")
    return ["".join(draw.choices(alphabets[k % len(alphabets)], k=draw.randint(20, 48))) for k in range(count)]


def identifiers(count: int = 1500, seed: int = 10) -> list[str]:
    """Labelled samples of ordinary identifiers: compound names in the usual styles, dates, versions and numbers."""
    # Parts of common names.
    parts = (
        "get set is has user name file path data value index count list item node table column row key type id code size time date start end first last "
        "next read write open close create update delete insert select load save parse format print log error debug info test config option param "
        "result response request server client http url page image text string number int float bool array map hash queue stack tree graph edge "
        "window frame event handler manager service factory builder util helper base main core common shared local global public private static"
    ).split()
    draw = random.Random(seed)
    out = []
    for k in range(count):
        p = draw.choices(parts, k=draw.randint(2, 5))
        style = k % 6
        if style == 0:
            out.append("_".join(p))
        elif style == 1:
            out.append(p[0] + "".join(x.title() for x in p[1:]))
        elif style == 2:
            out.append("_".join(p).upper())
        elif style == 3:
            out.append("-".join(p) + f"-{draw.randint(1, 99)}")
        elif style == 4:
            out.append("/".join(p))
        else:
            out.append(f"{draw.randint(1990, 2030)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}_{''.join(p)}")
    return out


def ordinary_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> list[str]:
    """Labelled samples of ordinary strings: the words of ``sample_docs`` documents, those with the smallest hashed ids,
    up to ``sample_bytes`` of whole texts.

    What the patterns mark and what mixes digits with letters is left out. Words are made different in Spark.
    """
    ids = stash(smallest(docs, sample_docs))
    texts = chosen_texts(docs, ids, sample_docs, sample_bytes)
    found = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Za-z0-9+/=_-]{6,})"), F.lit(1)))).alias("w")
    words = sorted(r["w"] for r in texts.select(found).distinct().collect())
    return [w for w in words if not HEX.search(w) and not ACCESS.search(w) and (w.isdigit() or not any(c.isdigit() for c in w))]


class Markov:
    """Log-likelihood ratio of character transitions, random strings against ordinary ones."""

    def __init__(self, secret: Iterable[str], ordinary: Iterable[str], smooth: float = 0.5) -> None:
        self.ratio = self._table(secret, smooth) - self._table(ordinary, smooth)

    @staticmethod
    def _table(samples: Iterable[str], smooth: float) -> np.ndarray:
        n = len(_CHARS)
        counts = np.full((n, n), smooth)
        for s in samples:
            x = _CLASS[np.frombuffer(s.encode(), np.uint8)]
            x = x[x >= 0]
            np.add.at(counts, (x[:-1], x[1:]), 1)
        return np.log(counts / counts.sum(axis=1, keepdims=True))

    def runs(self, buf: np.ndarray, offsets: np.ndarray, run: int = RUN, least: float = RATIO) -> tuple[np.ndarray, np.ndarray]:
        """Byte bounds of the runs of key characters, of ``run`` or more, whose ratio is ``least`` or more."""
        starts, ends = W.spans(buf, offsets, _IN_RUN[buf])
        long = ends - starts >= run
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return starts, ends
        keep = np.zeros(len(starts), bool)
        for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            x = _CLASS[buf[a:b]]
            keep[k] = self.ratio[x[:-1], x[1:]].sum() >= least and len(np.unique(x)) >= DISTINCT
        return starts[keep], ends[keep]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Markov:
    """Both models from labelled samples; the ordinary words come from a bounded sample of ``docs``."""
    return Markov(random_strings(), identifiers() + ordinary_words(docs, sample_docs))


def marked(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in code points of what the patterns find, in order."""
    out = []
    low = text.encode().lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2])) if len(out) > 1 else out


def found_in(texts: pa.Array, model: Markov) -> Iterator[list[tuple[int, int, int]]]:
    """Spans of each text of a null-free array; what the models add lies outside of what the patterns find."""
    for _, piece in slices(texts):
        buf, offsets = W.raw(piece)
        starts, ends = model.runs(buf, offsets)
        of = np.searchsorted(offsets, starts, side="right") - 1
        more: dict[int, list[tuple[int, int]]] = {}
        for d, a, b in zip(of.tolist(), starts.tolist(), ends.tolist(), strict=True):
            more.setdefault(d, []).append((a - int(offsets[d]), b - int(offsets[d])))
        for d, x in enumerate(piece):
            text = x.as_py()
            spans = marked(text)
            if d in more:
                data = text.encode()
                base = list(spans)
                for a, b in more[d]:
                    start = len(data[:a].decode())
                    end = start + b - a  # the run is ASCII
                    if all(end <= s or start >= e for s, e, _ in base):
                        spans.append((start, end, 3))
                spans.sort(key=lambda s: (s[0], s[2]))
            yield spans


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])


def scan(docs: DataFrame, model: Markov) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> for each row: code points, end exclusive, by start and kind.

    Kinds are assign, access, hex (the patterns) and markov (the models). Every whole text is scanned, row by row, so
    repeated rows, null ids and extra columns change nothing. A null or empty text has no spans. A bad pattern match
    that is too short is dropped, and what follows it is searched from its end on.
    """
    held = tuned(docs.sparkSession).sparkContext.broadcast(model)  # one table of 67 x 67 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans] for spans in found_in(as_text(batch.column("text")), held.value)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SCHEMA.field("spans").type)], schema=_SCHEMA)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, model: Markov, mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every found span of ``text`` (overlapping ones as one) replaced by ``mark``.

    Other columns stay as they are, but for ``n_chars``, if there is one, where the text has changed. No row is dropped.
    """
    held = tuned(docs.sparkSession).sparkContext.broadcast(model)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, b, _ in spans:
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            new = [None if not t.is_valid else clean(t.as_py(), s) if s else t.as_py() for t, s in zip(column, found_in(as_text(column), held.value), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if f.name == "text" else batch.column(k) for k, f in enumerate(batch.schema)], names=batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.contains("text", F.lit(mark)), changed).otherwise(F.col("n_chars")))
    return out
