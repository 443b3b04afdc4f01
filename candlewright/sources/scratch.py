"""Intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, set here only where it is unset: a temporary folder in a local session, else one in the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        local = spark.sparkContext.master.startswith("local")
        found = "file://" + tempfile.mkdtemp(prefix="candlewright-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_candlewright"
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settled(df: DataFrame, name: str = "candles") -> DataFrame:
    """``df`` written and read again: a plan that uses it several times scans it instead of computing it anew."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
