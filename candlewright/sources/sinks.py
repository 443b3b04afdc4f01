"""Writing candle tables: staged and checked before they are published, skipped if equal, never overwritten unasked."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.operators.access import defects, fingerprint
from candlewright.sources.candles import CandleError, Timeframe

FAULTS = ("nulls", "duplicates", "gaps", "off_grid", "bad_ohlc", "negative")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise CandleError(f"cannot move {source} to {target}")


def faults(candles: DataFrame, timeframe: str) -> list[str]:
    """Symbols with a defect, and which; nothing if the table is sound."""
    bad = F.lit(False)
    for c in FAULTS:
        bad = bad | (F.col(c) > 0)
    return [f"{r['symbol']}: " + ", ".join(f"{c} {r[c]}" for c in FAULTS if r[c]) for r in defects(candles, timeframe).filter(bad).limit(20).collect()]


def write_partitioned(candles: DataFrame, path: str, timeframe: str, mode: str = "errorifexists") -> None:
    """Hive layout by symbol, year and, below one day, month; rows of a partition in time order, zstd."""
    keys = Timeframe(timeframe).partitioned_by
    rows = candles.withColumns({"year": F.year("open_time"), "month": F.month("open_time")})
    rows = rows if "month" in keys else rows.drop("month")
    rows.repartition(*keys).sortWithinPartitions(*keys, "open_time").write.mode(mode).partitionBy(*keys).parquet(path, compression="zstd")


def read_partitioned(spark: SparkSession, path: str, symbols: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Candles of [start, end); years and months prune partitions, open_time is pushed to the scan. A symbol without a partition is an error,
    which the folders' names tell."""
    df = spark.read.parquet(path)
    if symbols is not None:
        missing = [s for s in symbols if not exists(spark, f"{path}/symbol={s}")]
        if missing:
            raise CandleError(f"no partition of {sorted(missing)}")
        df = df.filter(F.col("symbol").isin(symbols))
    month = (lambda year, month: year * 12 + month) if "month" in df.columns else (lambda year, month: year)
    own = month(F.col("year"), F.col("month")) if "month" in df.columns else F.col("year")
    if start is not None:
        df = df.filter((own >= month(int(start[:4]), int(start[5:7] or 1))) & (F.col("open_time") >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        df = df.filter((own <= month(int(end[:4]), int(end[5:7] or 12))) & (F.col("open_time") < F.lit(end).cast("timestamp_ntz")))
    return df.drop("year", "month")


def publish(candles: DataFrame, path: str, timeframe: str, check: Callable[[DataFrame], list[str]] | None = None) -> str:
    """Write to a staging folder, validate what was written, then rename. Returns "created" or "equal".

    If the target holds the same rows already it is left alone; if it holds others, the staged table moves to quarantine beside
    it and the call fails.
    """
    spark = candles.sparkSession
    staged = f"{path}._staged-{uuid.uuid4().hex}"
    write_partitioned(candles, staged, timeframe)
    back = read_partitioned(spark, staged)
    wrong = (check or (lambda df: faults(df, timeframe)))(back)
    if wrong:
        quarantine(spark, staged, path, wrong)
        raise CandleError(f"not published: {wrong[:3]}")
    if not exists(spark, path):
        move(spark, staged, path)
        return "created"
    old, new = fingerprint(read_partitioned(spark, path)), fingerprint(back)
    if old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty():
        fs, p = _fs(spark, staged)
        fs.delete(p, True)
        return "equal"
    quarantine(spark, staged, path, ["conflicts with what is published"])
    raise CandleError(f"{path} holds other rows")


def quarantine(spark: SparkSession, staged: str, path: str, reasons: list[str]) -> str:
    """Keep a refused table and why as ``<path>._quarantine/<id>`` with a reasons folder."""
    to = f"{path}._quarantine/{uuid.uuid4().hex}"
    move(spark, staged, f"{to}/table")
    spark.createDataFrame([(r,) for r in reasons], "reason string").coalesce(1).write.text(f"{to}/reasons")
    return to


def next_revision(names: list[str], stem: str, extension: str = "parquet") -> str:
    """``stem_revNN.ext`` one above the greatest there is; gaps are not filled."""
    found = [int(m[1]) for n in names if (m := re.fullmatch(rf"{re.escape(stem)}_rev(\d+)(?:\.{re.escape(extension)})?", n))]
    return f"{stem}_rev{max(found, default=0) + 1:02d}.{extension}"


def write_sheets(sheets: dict[str, DataFrame], folder: str, stem: str) -> str:
    """Every named result as a Parquet table under a new revision folder; earlier revisions stay."""
    spark = next(iter(sheets.values())).sparkSession
    fs, p = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    name = next_revision(names, stem)
    for sheet, df in sheets.items():
        df.write.parquet(f"{folder}/{name}/{sheet}", compression="zstd")
    return f"{folder}/{name}"


def report(spark: SparkSession, values: dict, path: str) -> None:
    """A small JSON report as one text file in a folder."""
    spark.createDataFrame([(json.dumps(values, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
