"""From raw documents to packed sequences: five stages, each written as a table and read again before the next.

Each stage works on all that its predecessor kept, and takes (spark, docs, sf_dir).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.llm import decontaminate, neardup, packing, quality, secrets
from ferrolite.llm.common import fold, only, stash
from ferrolite.llm.tokens import vocabulary

#: A document goes if its probability of label 1 is below this; one of exactly this stays.
LEAST_QUALITY = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it learns from the labelled documents of its own training fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels, fold(F.col("doc_id"), 3) != 1), LEAST_QUALITY)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id, and one row of it.

    Rows with equal id and text are one document, and rows of one id with different texts are several; a row without
    id is kept.
    """
    # Ids that rows share are counted first, so that texts of unique ids are not moved.
    h = F.xxhash64("text")
    known = only(docs, "doc_id", "text").where("doc_id is not null")
    repeated = known.groupBy(F.col("doc_id").alias("_again")).agg(F.count(F.lit(1)).alias("n"), (F.min(h) < F.max(h)).alias("several")).where("n > 1")
    repeated = stash(repeated)
    if repeated.where("several").take(1):
        # Each text of an id gets a number of its own, in the order of the ids.
        places = stash(known.select("doc_id", h.alias("h")).distinct().orderBy("doc_id", "h").withColumn("place", F.monotonically_increasing_id()))
        numbered = stash(known.withColumn("h", h).join(places, ["doc_id", "h"]).select(F.col("place").alias("doc_id"), "text"))
        gone = neardup.near_duplicates(numbered).where("not kept").select(F.col("doc_id").alias("place")).distinct()
        gone = stash(places.join(gone, "place").select(F.col("doc_id").alias("_gone"), F.col("h").alias("_gone_text")))
        left = docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_text"]), "left_anti")
    else:
        gone = stash(neardup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct())
        left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    if not repeated.take(1):
        return left
    again = left["doc_id"] == repeated["_again"]
    return left.join(repeated, again, "left_anti").union(left.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; all documents stay."""
    return secrets.redact(docs, secrets.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark_items),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

#: A learned classifier is among the stages, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; between them the rows are a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs)
    return docs
