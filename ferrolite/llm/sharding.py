"""Operator 10: contiguous shards of nearly equal bytes, by global prefix sums from per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import only, stash

OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, overhead: int = OVERHEAD) -> DataFrame:
    """Cut the documents, ordered by id, at equal targets of bytes.

    Returns doc_id, size, text_crc32, shard, slot. A document's size is its UTF-8 bytes plus ``overhead``; it goes to
    the shard in whose span of the byte line the middle of the document lies, so that a shard's bytes differ from the
    mean by at most one document's size. ``slot`` counts from 0 in each shard in document order.

    Only ids, sizes and checksums are moved, never texts: rows are dealt by ranges of (doc_id, checksum, size), each
    range is sorted and summed alone, and what joins the ranges is one total for each of them. Repeated rows are dealt
    like others, and a key that holds a third of the rows is split by checksum and size first; equal rows are
    interchangeable. A null text has no bytes (size ``overhead``, checksum of the empty text); null ids come first.
    No rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = only(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + F.lit(overhead).cast("bigint")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Equal rows would all fall in one range; a random salt only decides between interchangeable rows.
    key = [F.col("doc_id"), F.col("text_crc32"), F.col("size"), F.col("salt")]
    ranged = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*key).sortWithinPartitions(*key)
    ranged = stash(ranged.select("doc_id", "size", "text_crc32", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    total = totals.agg(F.sum("bytes").alias("total")).first()["total"] or 1
    inside = Window.partitionBy("part").orderBy("at")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "part")  # one row for each range: as many as shuffle partitions
    )
    middle = (F.col("bytes_before") + F.col("upto")) * 2 - F.col("size")
    shard = F.least(F.floor(middle.cast("double") * shards / F.lit(2.0 * total)), F.lit(shards - 1)).cast("int")
    placed = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("rank"))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(  # one row for each shard
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
