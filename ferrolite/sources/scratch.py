"""Tables that cut lineage, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below ``spark.checkpoint.dir`` and read it back.

    Only a local session without that setting gets a temporary folder; on a cluster the warehouse stands in.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        root = tempfile.gettempdir() if master == "local" or master.startswith("local[") else spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/ferrolite-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
