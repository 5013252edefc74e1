"""What the operators of this subpackage share: scratch tables, row batches, folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch. Texts can be long, so that the default of 10,000 is too many.
ROWS_PER_BATCH = 1024
#: Bytes of text that one numpy pass handles at most (a longer text is one pass alone).
BYTES_PER_PASS = 2 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small; everything else is left as the session has it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session without that setting gets a temporary folder; on a cluster the warehouse, which is
    shared as well, stands in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        root = tempfile.gettempdir() if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/ferrolite-{uuid.uuid4().hex}"


def stash(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete the table behind a ``stash`` that is no longer read."""
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Keys that are looked up in every task at most, and rows of a key below which it is never one of them.
HOT_KEYS, HOT_ROWS = 20_000, 512


def frequent_from(total: int, least: int | None = None) -> int:
    """Rows of a key, of ``total`` rows, beyond which it is a frequent one; such keys are ``HOT_KEYS`` at most."""
    return max(HOT_ROWS if least is None else least, total // HOT_KEYS)


def spread_join(rows: DataFrame, one: DataFrame, on: str, least: int | None = None) -> DataFrame:
    """``rows`` joined with ``one``, which has one row for each of their keys, with ``n``, how often ``rows`` has the key.

    Rows of a frequent key stay where they are: keys with more than ``least`` rows (``HOT_ROWS``) and more than a ``HOT_KEYS``-th
    of all are ``HOT_KEYS`` at most and are broadcast; only the others' rows are shuffled. So no task gets all rows of one key.
    """
    size = one.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    most = frequent_from(size["n"] or 0, least)
    if (size["most"] or 0) <= most:
        return rows.join(one, on)
    hot = one.where(F.col("n") > most)
    cold = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(one.where(F.col("n") <= most), on)
    return rows.join(F.broadcast(hot), on).unionByName(cold)


#: Bits of the filter that ``sifted`` broadcasts: at most, and for each id; a row of the broadcast table holds 64 of them.
SIEVE_MOST, SIEVE_EACH = 1 << 24, 16


def sifted(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """The ``rows`` whose ``on`` may be among ``ids`` (one column of numbers): all that are, and few others.

    Ids set one bit each of a filter of bounded size that is broadcast, so that a join with ``ids`` that follows moves little
    of a table with long rows. With more ids than the filter is made for, more rows pass, and none is lost.
    """
    n, bits = ids.count(), 1 << 10
    while bits < min(SIEVE_MOST, n * SIEVE_EACH):
        bits *= 2

    bit = F.xxhash64(F.col(ids.columns[0]).cast("bigint")).bitwiseAND(F.lit(bits - 1))
    one = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    sieve = ids.select(bit.alias("_bit")).select(F.shiftright("_bit", 6).alias("_word"), one.alias("_one")).groupBy("_word").agg(F.bit_or("_one").alias("_bits"))
    sieve = F.broadcast(stash(sieve))  # a row for each 64 bits at most
    probed = rows.withColumn("_bit", F.xxhash64(F.col(on).cast("bigint")).bitwiseAND(F.lit(bits - 1)))
    hit = (F.shiftright(probed["_bit"], 6) == sieve["_word"]) & (one.bitwiseAND(sieve["_bits"]) != 0)
    return probed.join(sieve, hit, "left_semi").drop("_bit")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; extra ones may have any names, clashing ones included."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id's decimal text modulo k; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(k)


def smallest(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """The ``n`` different ids (column doc_id) with the smallest hashes, in each group of equal ``by`` values if given.

    Groups' sizes are estimated first, and hashes beyond what about four times ``n`` ids reach are left out before
    anything is moved: what is sorted has a bounded size, however many rows and tasks there are. ``by`` must have few
    values. Null ids are left out.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    ids = only(rows, "doc_id", *by).where(F.col("doc_id").isNotNull())
    counts = ids.groupBy(*by).agg(F.approx_count_distinct("doc_id").alias("ids"))
    reach = (F.lit(4.0 * n + 64) / F.greatest(F.col("ids"), F.lit(1)) * F.lit(2.0**63)).alias("reach")
    reach_of = F.broadcast(counts.select(*by, reach))  # a row for each group
    near = ids.join(reach_of, list(by)) if by else ids.withColumn("reach", F.lit(counts.select(reach).first()["reach"]))
    near = near.where(place.cast("double") <= F.col("reach")).select("doc_id", *by).distinct()
    order = [place, F.col("doc_id")]
    if not by:
        return near.orderBy(*order).limit(n)
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("nth") <= n).select("doc_id", *by)


def chosen_texts(docs: DataFrame, ids: DataFrame, n: int, most_bytes: int, *by: str) -> DataFrame:
    """doc_id, text, h (the text's hash) and ``by``: different texts of ``docs`` with the ids of ``ids`` (doc_id, ``by``), in
    each group ``n`` at most and, in the order of their ids' hashes, as many as fit into ``most_bytes`` together.

    Repeated rows are one. Only numbers of the chosen rows are collected, never texts; ``by`` must have few values.
    """
    h = F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")
    place = F.xxhash64("doc_id")
    mine = only(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id")  # n ids for each group at most
    sizes = mine.select("doc_id", h, F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"), *by).distinct()
    nth = F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(place, "doc_id", "h"))
    rows = sizes.withColumn("nth", nth).where(F.col("nth") <= n).collect()
    kept, used = [], {}
    for r in sorted(rows, key=lambda r: (r["nth"], *[str(r[b]) for b in by])):
        group = tuple(r[b] for b in by)
        if used.get(group, 0) + r["size"] <= most_bytes:
            used[group] = used.get(group, 0) + r["size"]
            kept.append((r["doc_id"], r["h"], *group))
    schema = T.StructType([sizes.schema["doc_id"], T.StructField("h", T.LongType()), *[sizes.schema[b] for b in by]])
    marks = docs.sparkSession.createDataFrame(kept, schema)
    return only(docs, "doc_id", "text").withColumn("h", h).join(F.broadcast(marks), ["doc_id", "h"]).dropDuplicates(["doc_id", "h", *by])


def slices(texts: pa.Array, limit: int = BYTES_PER_PASS) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive pieces of a string array of about ``limit`` bytes, with their first position."""
    import numpy as np

    n = len(texts)
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def as_text(column: pa.Array) -> pa.Array:
    """A plain string array without nulls (a null text is an empty one)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column
