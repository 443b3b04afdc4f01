"""What the operators share: the tables, the shared folder, and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The letters that ASCII lower-casing changes.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, set here only where it is unset.

    Unset, it becomes a temporary folder if driver and executors are one process, else a folder of the warehouse, which
    they share as well.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.startswith("local"):
            found = "file://" + tempfile.mkdtemp(prefix="candlewright-")
        else:
            found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_candlewright"
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation of what came before.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path, partitionBy=list(partition_by) or None, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written table that no later plan reads, through Hadoop's file system interface."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned and no later plan reads."""
    for df in tables:
        if df.inputFiles():
            drop_path(df.sparkSession, path_of(df))


def path_of(df: DataFrame) -> str:
    """The folder of a table that ``written`` returned, without the folders of its partitions."""
    return re.sub(r"(/[^/=]+=[^/]*)*/[^/]*$", "", df.inputFiles()[0])


def ascii_lower(col):
    """Lower-case A-Z only. Spark's ``lower`` does just that to ASCII, and faster than ``translate``."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Spark hand texts to Python in Arrow batches of ``size``, if the session sets no size of its own.

    By default a batch is up to 64 MB, so all texts of a task are one: a buffer in the JVM, its copy in the worker and the
    strings made of it are there at once, for each core.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, size)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staying(docs: DataFrame, decisions: DataFrame, key, small: int = 250_000) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, key, kept) keep, with all their columns, dropped row by row.

    A row is known by its doc_id (null included) and ``key``, a text column computed from its text: an id that comes
    again with another text is another row. Of kept rows that agree in both, one stays: the least as JSON. Decisions
    that drop nothing and repeat nothing leave ``docs`` as it is. Up to ``small`` decided keys (of 80 bytes) are
    broadcast; more are joined by shuffle.
    """
    decided = decisions.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    decided = written(decided.filter("NOT kept OR n > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_decided"), F.col("kept").alias("_kept")), "decided")
    side = F.broadcast(decided) if decided.count() <= small else decided.hint("shuffle_merge")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("_doc"), key.alias("_key"))
    same = rows["_doc"].eqNullSafe(side["_id"]) & (rows["_key"] == side["_decided"])
    met = rows.join(side, same, "left").filter("_kept IS NULL OR _kept")
    once = met.filter("_kept").groupBy("_doc", "_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return met.filter("_kept IS NULL").select("_row.*").unionByName(once.select("_row.*"))
