"""Operator 3: documents that hold benchmark items, re-parameterised ones included, by template windows.

A text becomes a sequence of template tokens: words in lower case, and the placeholders <num>, <unit> (a unit of
measure after a number) and <name> (a capitalised word inside a sentence); names with blanks between them, and numbers
joined by one sign (3.5, 12:30), are one slot. Windows of ``WIDTH`` tokens of the documents are hash-joined with those
of the benchmark. Matched windows on one diagonal (equal distance of their places) count if their slots are consistent:
every value of the item stands for one value of the document throughout.

Every text is read three times: with all placeholders; with names as plain words, since capitals can change; and word
for word, where numbers stand for themselves. A document holds an item if enough of the item's windows are matched in
one of the first two, or if it repeats ``VERBATIM`` consecutive ones (all, if the item has fewer) word for word. What is
repeated word for word needs no slots, so a value changed elsewhere, or a list number put before the item, takes nothing from it.

Document windows are tested against a Bloom filter of bounded size before the join, so only candidates are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolite.llm import words as W
from ferrolite.llm.common import as_text, only, slices, stash, tuned

WIDTH = 8
#: Share of an item's windows that must be matched consistently, and plain words that a window needs.
COVERAGE, PLAIN = 0.5, 3
#: Consecutive windows word for word (13 tokens in a row) that are enough by themselves.
VERBATIM = 6
#: Readings of a text, and the fewest tokens of an item without plain words that is looked for word for word.
NAMES, NUMBERS, LITERAL = READINGS = (2, 1, 0)
LEAST_LITERAL = 4
#: Bytes of a text beyond which it is read in overlapping pieces.
LONG = 1 << 20
#: Bits of the filter for each benchmark window, and at most. Beyond that the filter lets more through to the join.
BITS_EACH, BITS_MOST = 32, 1 << 27
#: Benchmark windows up to which the join broadcasts them (under 100 bytes each); beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000

# Units that count as such after a number.
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mile miles mi ft feet foot inch inches yard yards l ml liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents usd eur gbp mph kmh kph w kw v a hz khz mhz ghz degrees degree celsius fahrenheit"
).split()

_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = _LOWER[128:] = True
#: Bytes after which, with one blank, a sentence goes on.
_GOES_ON = _ALPHA | _DIGIT
_GOES_ON[np.frombuffer(b",;'\"()-", np.uint8)] = True

NUM, UNIT, NAME = np.uint64(11), np.uint64(12), np.uint64(13)


def _unit_hashes() -> np.ndarray:
    texts = pa.array(UNITS)
    return np.unique(W.words(texts).hashes)


class Templates:
    """Template tokens of a batch: hash, byte bounds, kind (0 for a plain word), and bounds of each text."""

    def __init__(self, texts: pa.Array, reading: int = NAMES) -> None:
        self.reading = reading
        raw, offsets = W.raw(texts)
        buf = W.LOWER[raw]
        # Two-byte Latin capitals (0xC3 0x80-0x9E) in lower case as well.
        if len(buf) > 1:
            cap = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)
            buf[1:][cap] += 0x20
        a0, a1 = W.spans(raw, offsets, _ALPHA[raw])
        d0, d1 = W.spans(raw, offsets, _DIGIT[raw])
        starts, ends = np.concatenate([a0, d0]), np.concatenate([a1, d1])
        kind = np.zeros(len(starts), np.uint64)
        kind[len(a0) :] = NUM
        if reading == LITERAL:
            kind[:] = 0
        order = np.argsort(starts, kind="stable")
        starts, ends, kind = starts[order], ends[order], kind[order]
        hashes = W.run_hashes(buf, starts, ends)
        self.digits = _DIGIT[raw[starts]] if len(starts) else np.zeros(0, bool)
        if len(starts) and reading != LITERAL:
            if reading == NAMES:
                # A title-case word after one blank in a sentence is a name.
                title = np.flatnonzero(_UPPER[raw[starts]] & (ends - starts > 1) & (kind == 0))
                title = title[_LOWER[raw[starts[title] + 1]]]
                first = offsets[np.searchsorted(offsets, starts[title], side="right") - 1]
                inside = title[starts[title] - first >= 2]
                inside = inside[(raw[starts[inside] - 1] == 32) & _GOES_ON[raw[starts[inside] - 2]]]
                kind[inside] = NAME
            same = np.searchsorted(offsets, starts, side="right")
            after = np.flatnonzero((kind[1:] != NUM) & (kind[:-1] == NUM) & (same[1:] == same[:-1])) + 1
            kind[after[np.isin(hashes[after], _unit_hashes())]] = UNIT
            keep = np.ones(len(starts), bool)
            joined = (kind[1:] == kind[:-1]) & (kind[1:] > 0) & (same[1:] == same[:-1])
            # Numbers are one only with a single sign between them: blanks part them, a list number and a count say.
            joined &= (kind[1:] != NUM) | ((starts[1:] == ends[:-1] + 1) & ~W.IS_SPACE[raw[ends[:-1]]]) | (starts[1:] == ends[:-1])
            keep[1:] = ~joined
            # A slot reaches to the end of its last token.
            head = np.flatnonzero(keep)
            ends = ends[np.append(head[1:], len(starts)) - 1]
            starts, kind, hashes, self.digits = starts[head], kind[head], hashes[head], self.digits[head]
        hashes = np.where(kind > 0, kind, hashes)
        self.buf, self.starts, self.ends, self.kind, self.hashes = buf, starts, ends, kind, hashes
        self.bounds = np.searchsorted(starts, offsets)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of windows with enough plain words (or, word for word, enough tokens) in one text: first token, text, hash."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64)
        at = np.arange(n)
        text = np.searchsorted(self.bounds, at, side="right") - 1
        ok = at + width <= self.bounds[text + 1]
        if self.reading != LITERAL or width < LEAST_LITERAL:
            plain = np.concatenate([[0], np.cumsum((self.kind == 0) & ~self.digits)])
            ok &= plain[width:] - plain[:n] >= min(PLAIN, width)
        return at[ok], text[ok], W.mix(W.windows(self.hashes, width)[ok] + np.uint64(width + 64 * self.reading))

    def slots(self, at: int, width: int) -> list[str]:
        """Values of the window's slots, each with its kind."""
        return [
            f"{int(self.kind[k])}:{self.buf[self.starts[k] : self.ends[k]].tobytes().decode('utf-8', 'replace')}" for k in range(at, at + width) if self.kind[k]
        ]


def pieces(buf: np.ndarray, size: int = LONG // 2) -> Iterator[tuple[pa.Array, int]]:
    """A long text's bytes as overlapping pieces, with the number of bytes up to the next piece's begin.

    Cuts lie at a blank between two words in small letters, where no placeholder can reach across, or, where there is
    none within a piece, at its last white space; only a run without white space of a piece's length is cut itself. The
    overlap holds ``WIDTH`` tokens more, so that every window lies in the piece in which it begins.
    """

    def cut(at: int) -> int:
        """The last good place to begin a piece in the piece's second half up to ``at``."""
        if at >= len(buf):
            return len(buf)
        low = at - size // 2
        x = buf[low : at + 1]
        small = (x >= 97) & (x <= 122)
        good = np.flatnonzero((x[2:-1] == 32) & small[:-3] & small[1:-2] & small[3:]) + 2
        if not len(good):
            good = np.flatnonzero(W.IS_SPACE[x])
        return low + int(good[-1]) + 1 if len(good) else at

    begin = 0
    while begin < len(buf):
        end = cut(begin + size)
        more = buf[end : end + (1 << 16)]
        inside = _ALPHA[more] | _DIGIT[more]
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) if len(more) else more
        reach = end + (int(ends[16 * WIDTH]) + 1 if len(ends) > 16 * WIDTH else len(more))
        yield pa.array([buf[begin:reach].tobytes()], pa.binary()).view(pa.string()), end - begin
        begin = end


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & np.uint64(bits - 1)).astype(np.int64), ((hashes >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, reading, ipos, width, hash, islots, windows (of the item in that reading).

    An item shorter than ``WIDTH`` is one window. The reading takes part in the hash.
    """
    schema = pa.schema(
        [("item_id", pa.int64()), ("reading", pa.int32()), ("ipos", pa.int64()), ("width", pa.int32()), ("hash", pa.int64()), ("islots", pa.list_(pa.string())), ("windows", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for first, texts in slices(as_text(batch.column("text")), 1 << 19):
                rows = []
                for t in (Templates(texts, reading) for reading in READINGS):
                    sizes = np.diff(t.bounds)
                    for width in np.unique(np.minimum(sizes, WIDTH)).tolist():
                        if not width:
                            continue
                        at, text, hashes = t.windows(width)
                        mine = np.minimum(sizes[text], WIDTH) == width
                        count = np.bincount(text[mine], minlength=len(texts))
                        for a, d, h in zip(at[mine].tolist(), text[mine].tolist(), hashes[mine].view(np.int64).tolist(), strict=True):
                            rows.append((ids[first + d], t.reading, a - int(t.bounds[d]), width, h, t.slots(a, width), int(count[d])))
                columns = list(zip(*rows, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = only(benchmark, "item_id", "text").where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    return rows.mapInArrow(run, "item_id bigint, reading int, ipos bigint, width int, hash bigint, islots array<string>, windows bigint")


def _filter_bits(items: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of the window hashes, built on the executors; what is collected has a fixed largest size."""
    bits = 1 << 10
    while bits < min(BITS_MOST, count * BITS_EACH):
        bits *= 2
    h = F.col("hash")
    probes = F.explode(F.array(h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))).alias("bit")
    words = items.select(probes).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    table = words.toArrow()  # one row for each 64 bits at most
    out = np.zeros(bits // 64, np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def candidate_windows(docs: DataFrame, bloom: np.ndarray, widths: list[int]) -> DataFrame:
    """doc_id, row (a hash that tells rows of one id apart), dpos, hash, dslots of the windows that pass the filter."""
    held = tuned(docs.sparkSession).sparkContext.broadcast(np.packbits(bloom))  # BITS_MOST bits at most
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("dpos", pa.int64()), ("hash", pa.int64()), ("dslots", pa.list_(pa.string()))])
    bits = len(bloom)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = held.value

        def has(p: np.ndarray) -> np.ndarray:
            return (packed[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0

        def found(t: Templates, ids: list, keys: list, own: int | None = None, before: int = 0) -> list[tuple]:
            """Windows that begin before byte ``own``; ``before`` tokens of the text come before the piece."""
            rows = []
            for width in widths:
                at, text, hashes = t.windows(width)
                p, q = _probes(hashes, bits)
                hit = np.flatnonzero(has(p))
                hit = hit[has(q[hit])]
                for k in hit.tolist():
                    d, a = int(text[k]), int(at[k])
                    if own is None or t.starts[a] < own:
                        rows.append((ids[d], keys[d], before + a - int(t.bounds[d]), int(hashes[k].view(np.int64)), t.slots(a, width)))
            return rows

        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for first, texts in slices(as_text(batch.column("text")), 1 << 19):
                mine = ids[first : first + len(texts)], keys[first : first + len(texts)]
                if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > LONG:
                    before = dict.fromkeys(READINGS, 0)
                    for piece, own in pieces(W.raw(texts)[0]):
                        rows = []
                        for reading in READINGS:
                            t = Templates(piece, reading)
                            rows += found(t, *mine, own, before[reading])
                            before[reading] += int(np.searchsorted(t.starts, own))
                        if rows:
                            yield batch_of(rows)
                    continue
                rows = [r for reading in READINGS for r in found(Templates(texts, reading), *mine)]
                if rows:
                    yield batch_of(rows)

    rows = only(docs, "doc_id", "text").where("text is not null")
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(run, "doc_id bigint, row bigint, dpos bigint, hash bigint, dslots array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, row, item_id, matched, windows, coverage, exact: one row for each document and item that it holds.

    ``matched`` counts different windows of the item on consistent diagonals, ``coverage`` is their share (of the reading
    in which it is largest), ``exact`` tells whether they are matched word for word. A diagonal on which one value of the
    item would stand for two is another question and does not count, but for what it repeats word for word. Rows of
    ``docs`` with the same id and text give one result; ``row`` is the text's hash. Null or empty texts hold nothing, an
    item without windows is held by nothing; null doc ids stay null. Ties do not arise: every item that is held is
    returned. An empty benchmark gives no rows. A text of any length is read whole, a longer one than ``LONG`` bytes in
    overlapping pieces. Items with equal texts are joined as one; windows that many items share are as many rows as there
    are documents that hold them and items, which adaptive execution splits where one hash has most of them.
    """
    texts = only(benchmark, "item_id", "text").where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    members = stash(texts.select("item_id", F.sha2("text", 256).alias("key")).distinct())
    heads = members.groupBy("key").agg(F.min("item_id").alias("first"))
    once = texts.join(heads.select(F.col("first").alias("item_id")), "item_id", "left_semi").distinct()
    items = stash(item_windows(once))
    shape = items.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()  # WIDTH rows at most
    count = sum(r["n"] for r in shape)
    found = candidate_windows(docs, _filter_bits(items, count), sorted(r["width"] for r in shape))
    side = items.select("item_id", "reading", "ipos", "hash", "islots", "windows")
    joined = found.join(F.broadcast(side) if count <= BROADCAST_ROWS else side, "hash")
    pairs = F.zip_with("islots", "dslots", lambda i, d: F.struct(i.alias("i"), d.alias("d")))
    lines = joined.groupBy("doc_id", "row", "item_id", "reading", "windows", (F.col("dpos") - F.col("ipos")).alias("diagonal")).agg(
        F.collect_set("ipos").alias("at"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    lines = lines.where(F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))) == F.size("pairs"))
    # Places are whole numbers without repeats: so many in a row begin where the one that far on is that much larger.
    lines = lines.withColumn("at", F.array_sort("at"))
    more = (F.least(F.lit(VERBATIM), F.col("windows")) - 1).cast("int")
    in_a_row = F.exists(F.transform("at", lambda x, n: F.get("at", n + more) - x), lambda x: F.coalesce(x == more, F.lit(False)))
    held = lines.groupBy("doc_id", "row", "item_id", "reading", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("bigint").alias("matched"), F.bool_or((F.col("reading") == LITERAL) & in_a_row).alias("verbatim")
    )
    held = held.withColumn("coverage", F.col("matched") / F.col("windows")).where(((F.col("reading") != LITERAL) & (F.col("coverage") >= coverage)) | F.col("verbatim"))
    best = F.max(F.struct("coverage", (F.col("reading") == LITERAL).alias("exact"), "matched", "windows")).alias("best")
    held = held.groupBy("doc_id", "row", F.col("item_id").alias("first")).agg(best)
    return held.join(heads, "first").join(members, "key").select("doc_id", "row", "item_id", "best.matched", "best.windows", "best.coverage", "best.exact")


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, as they are, whose text holds no benchmark item."""
    bad = stash(matches(docs, benchmark, coverage).select(F.col("doc_id").alias("_bad_id"), F.col("row").alias("_bad_row")).distinct())
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_row"])
    return docs.join(bad, same, "left_anti")
