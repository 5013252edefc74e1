"""Operator 1: language identification by compression.

A raw-content zstandard dictionary is made for each language from a bounded sample of labelled texts, which are read
whole: it holds the words that stand in the most of them, the commonest last, where references to them are shortest. A
text, reduced to its lower-case letters, is cut into chunks; every chunk is compressed once with each dictionary, and
the language with the fewest bytes in total wins; a narrow margin over the next one rejects the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import as_text, chosen_texts, only, smallest, stash, tuned

UNKNOWN = "und"
#: Labelled documents of each language that a dictionary is made of and their bytes at most, and its own bytes at most.
SAMPLE_DOCS, SAMPLE_BYTES, DICT_BYTES = 600, 8 << 20, 48 << 10
CHUNK = 512
MARGIN = 0.01
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters with single blanks between them: what the languages differ in."""
    return _OTHER.sub(" ", text.lower())


def fit_dictionaries(docs: DataFrame, train: Column, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """For each non-null ``lang`` among the rows where ``train`` holds, the content of its dictionary.

    The sample is the ``sample_docs`` documents of the language with the smallest hashed ids, up to ``sample_bytes`` of
    whole texts. Their words are counted in Spark, once for each text; what is collected is one dictionary's words.
    """
    labelled = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = only(labelled, "doc_id", "lang", "text")
    ids = stash(smallest(labelled, sample_docs, "lang"))
    texts = chosen_texts(labelled, ids, sample_docs, sample_bytes, "lang")
    words = F.explode(F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")), " "))).alias("word")
    counts = texts.select("lang", words).where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    upto = F.sum(F.octet_length("word") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumn("nth", F.row_number().over(order)).withColumn("upto", upto).where(F.col("upto") <= dict_bytes).select("lang", "nth", "word").collect()
    found: dict[str, list[str]] = {r["lang"]: [] for r in ids.select("lang").distinct().collect()}
    for r in sorted(rows, key=lambda r: (r["lang"], -r["nth"])):
        found[r["lang"]].append(r["word"])
    return {k: (" ".join(v) + " ").encode() for k, v in found.items()}


class Compressors:
    """One compressor for each language; its dictionary is digested once."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.names = sorted(dictionaries)
        self.coders = []
        for name in self.names:
            data = dictionaries[name] if len(dictionaries[name]) >= 8 else b" " * 8
            params = zstandard.ZstdCompressionParameters.from_level(
                5, dict_size=len(data), source_size=CHUNK, min_match=4, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0
            )
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def sizes(self, text: str) -> list[int]:
        """Bytes of the whole text with each dictionary, summed over its chunks."""
        data = letters(text).encode()
        parts = [data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
        return [sum(len(c(part)) for part in parts) for c in self.coders]


def judge(names: list[str], sizes: list[int], margin: float) -> tuple[str, float, float, bool]:
    """Best language, a score from 0 to 1 (soft minimum of the sizes), relative margin, rejected or not."""
    order = sorted(range(len(names)), key=lambda k: (sizes[k], names[k]))
    best = sizes[order[0]]
    gap = (sizes[order[1]] - best) / max(1, sizes[order[1]]) if len(order) > 1 else 1.0
    score = 1 / sum(math.exp(-min(60.0, 0.7 * (s - best))) for s in sizes)
    return names[order[0]], score, gap, gap < margin


SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_best", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_())])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_best, score, margin, rejected, and lang_pred (``und`` where rejected) for each row of ``docs``.

    Every whole text is compressed, in chunks of ``CHUNK`` bytes, so memory does not follow its length. A null text,
    one without any letter, and any text if there are no dictionaries, is ``und`` with score 0 and not rejected by margin. Equal
    sizes go to the smaller name (with margin 0, hence rejected). Rows are judged one by one: repeated rows, null ids
    and extra columns change nothing.
    """
    spark = tuned(docs.sparkSession)
    held = spark.sparkContext.broadcast(dictionaries)  # DICT_BYTES for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = Compressors(held.value)
        for batch in batches:
            out = []
            for x in as_text(batch.column("text")):
                text = x.as_py()
                if not coders.names or not _LETTER.search(text):
                    out.append((UNKNOWN, 0.0, 0.0, False))
                else:
                    out.append(judge(coders.names, coders.sizes(text), margin))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(columns, list(SCHEMA)[1:], strict=True)]], schema=SCHEMA)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    judged = rows.mapInArrow(run, "doc_id bigint, lang_best string, score double, margin double, rejected boolean")
    return judged.withColumn("lang_pred", F.when(F.col("rejected"), F.lit(UNKNOWN)).otherwise(F.col("lang_best")))
