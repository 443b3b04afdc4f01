"""What lies in a candle store: partitions by name, their identity, hashes, folders that do not belong, and symbols' metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.sources.candles import MINUTES, CandleError, Timeframe

#: What a perpetual's metadata must say.
EXPECTED = {"contractType": "PERPETUAL", "quoteAsset": "USDT", "marginAsset": "USDT"}
TRADING = "TRADING"


def partitions(spark: SparkSession, base: str, timeframe: str) -> DataFrame:
    """One row per file of a store: its key columns (null if its path lacks them), path and bytes. Only names are listed, no rows are read."""
    keys = Timeframe(timeframe).partitioned_by
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base).select("path", F.col("length").alias("bytes"))
    found = {k: F.regexp_extract("path", rf"/{k}=([^/]+)/", 1) for k in keys}
    return listed.select(*(F.when(v != "", v if k == "symbol" else v.cast("int")).alias(k) for k, v in found.items()), "path", "bytes")


def resolve(spark: SparkSession, base: str, timeframe: str, symbols: list[str], start: str, end: str) -> DataFrame:
    """The files of [start, end): those of the symbols whose month (or year) meets it. A symbol without any is an error."""
    files = partitions(spark, base, timeframe).filter(F.col("symbol").isin(symbols))
    have = {r["symbol"] for r in files.select("symbol").distinct().collect()}
    if set(symbols) - have:
        raise CandleError(f"no partition of {sorted(set(symbols) - have)}")
    if "month" in files.columns:
        month = F.col("year") * 12 + F.col("month")
        lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
        return files.filter((month >= F.year(lo) * 12 + F.month(lo)) & (month <= F.year(hi) * 12 + F.month(hi)))
    return files.filter(F.col("year").between(int(start[:4]), int(end[:4])))


def identity(spark: SparkSession, base: str, timeframe: str) -> DataFrame:
    """Rows whose symbol or time do not belong to the partition they lie in: one row per partition with a count, none if all is well.

    The symbol of a row is its folder's, so its other key, the time, is compared with the folder's year and month.
    """
    keys = Timeframe(timeframe).partitioned_by
    rows = spark.read.parquet(base)
    wrong = F.year("open_time") != F.col("year")
    if "month" in keys:
        wrong = wrong | (F.month("open_time") != F.col("month"))
    return rows.filter(F.coalesce(wrong, F.lit(True))).groupBy(*keys).agg(F.count(F.lit(1)).alias("misplaced"))


def source_hashes(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, sha256) of files, hashed where they are read. ``files`` has a row per file of one read, so their names are few enough to list."""
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "path string, sha256 string")
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files (path, sha256) that differ between two listings: path, status gone, new or changed. None if a source was left alone."""
    both = before.withColumnRenamed("sha256", "old").join(after.withColumnRenamed("sha256", "new"), "path", "full")
    status = F.when(F.col("new").isNull(), "gone").when(F.col("old").isNull(), "new").when(F.col("old") != F.col("new"), "changed")
    return both.select("path", status.alias("status")).filter("status IS NOT NULL")


def sibling_scope(spark: SparkSession, names: list[str], own: str) -> DataFrame:
    """Folders beside a derived timeframe: name, whether it is a timeframe, and whether it is the builder's own. An unknown ``own`` is an error."""
    Timeframe(own)
    rows = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    return rows.select("name", F.col("name").isin(*MINUTES).alias("approved"), (F.col("name") == own).alias("own"))


def validate_symbols(spark: SparkSession, info: DataFrame, symbols: list[str]) -> DataFrame:
    """Metadata of symbols (columns symbol, contractType, quoteAsset, marginAsset, status, onboardDate) against EXPECTED.

    One row per asked symbol: validated, problems (empty if none), warnings, onboard_time. One that is not listed is not
    valid; one that does not trade only gets a warning.
    """
    asked = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    both = asked.join(info.withColumn("_listed", F.lit(True)), "symbol", "left")
    wrong = [F.when(~F.col(k).eqNullSafe(F.lit(v)), F.concat(F.lit(f"{k}="), F.coalesce(k, F.lit("none")), F.lit(f", expected {v}"))) for k, v in EXPECTED.items()]
    problems = F.when(F.col("_listed").isNull(), F.array(F.lit("not listed"))).otherwise(F.array_compact(F.array(*wrong)))
    idle = F.when(F.col("_listed") & ~F.col("status").eqNullSafe(F.lit(TRADING)), F.concat(F.lit("status is "), F.coalesce("status", F.lit("none"))))
    onboard = F.timestamp_millis(F.expr("try_cast(onboardDate AS BIGINT)"))
    return both.select("symbol", (F.size(problems) == 0).alias("validated"), problems.alias("problems"), F.array_compact(F.array(idle)).alias("warnings"), onboard.alias("onboard_time"))
