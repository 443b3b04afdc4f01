"""Resampling: complete buckets only, folding, agreement of timeframes, conservation of sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.sources.candles import CandleError, Timeframe, bucket, close_time


def fold(candles: DataFrame, to: str, on_incomplete: str = "drop", child: str | None = None) -> DataFrame:
    """Candles of a coarser timeframe from finer ones (columns as candles_from_ticks gives them).

    A bucket is complete if every child's start is there once, on the grid, and every child is sound (high and low bound open and
    close, volume not negative). ``on_incomplete``: "drop" such buckets, "flag" them (column ``complete``), or "fail" if any.
    Open and close come from the first and last child; volume and trades are exact sums.
    """
    source = Timeframe(child) if child else Timeframe(candles.select("timeframe").first()[0])
    target = Timeframe(to)
    if target.minutes % source.minutes or target.minutes <= source.minutes:
        raise CandleError(f"{source.name} does not fold to {to}")
    need = target.minutes // source.minutes
    step = F.floor((F.unix_micros(F.col("open_time").cast("timestamp")) % (target.millis * 1000)) / (source.millis * 1000))
    on_grid = F.unix_micros(F.col("open_time").cast("timestamp")) % (source.millis * 1000) == 0
    sound = (F.col("high") >= F.greatest("open", "close")) & (F.col("low") <= F.least("open", "close")) & (F.col("volume") >= 0) & on_grid
    # one bit for each child that is there: all are, once each, if the count and the set agree
    out = candles.groupBy("symbol", bucket("open_time", target.minutes).cast("timestamp_ntz").alias("bucket")).agg(
        F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_time").alias("close"), F.sum("volume").cast("decimal(28,8)").alias("volume"), F.sum("trades").alias("trades"),
        F.count(F.lit(1)).alias("children"), F.size(F.collect_set(step)).alias("steps"), F.bool_and(sound).alias("sound"),
    )
    out = out.withColumnRenamed("bucket", "open_time").withColumn("complete", (F.col("children") == need) & (F.col("steps") == need) & F.col("sound"))
    columns = ["symbol", F.lit(to).alias("timeframe"), "open_time", close_time(target), "open", "high", "low", "close", "volume", "trades"]
    if on_incomplete == "flag":
        return out.select(*columns, "children", "complete")
    if on_incomplete == "fail":
        ok = F.assert_true(F.col("complete"), F.concat(F.lit("incomplete bucket "), F.col("symbol"), F.lit(" "), F.col("open_time").cast("string")))
        return out.withColumn("trades", F.when(ok.isNull(), F.col("trades"))).select(*columns)
    return out.filter("complete").select(*columns)


FIELDS = ["open", "high", "low", "close", "volume", "trades"]


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of one timeframe compared by (symbol, open_time): a row with a count for each field and for one-sided rows."""
    left = a.select("symbol", "open_time", F.struct(*FIELDS).alias("a"))
    right = b.select("symbol", "open_time", F.struct(*FIELDS).alias("b"))
    both = left.join(right, ["symbol", "open_time"], "full")
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.agg(
        F.count(F.lit(1)).alias("buckets"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"),
        *(F.count_if(there & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(f"{c}_differs") for c in FIELDS),
    )


def agreement(tables: dict[str, DataFrame]) -> DataFrame:
    """Every finer timeframe folded to every coarser one and compared: child, parent and the counts of disagreements."""
    names = sorted(tables, key=lambda n: Timeframe(n).minutes)
    out = None
    for i, fine in enumerate(names):
        for coarse in names[i + 1 :]:
            row = disagreements(fold(tables[fine], coarse, child=fine), tables[coarse]).select(F.lit(fine).alias("child"), F.lit(coarse).alias("parent"), "*")
            out = row if out is None else out.unionByName(row)
    if out is None:
        raise CandleError("agreement needs two timeframes")
    return out


def conservation(source: DataFrame, derived: DataFrame) -> DataFrame:
    """Volume and trades of both by symbol, year and month with totals (rollup), and whether they are equal."""
    keys = [F.year("open_time").alias("year"), F.month("open_time").alias("month")]
    sums = lambda df, p: df.rollup("symbol", *keys).agg(F.sum("volume").alias(f"{p}_volume"), F.sum("trades").alias(f"{p}_trades"))
    a, b = sums(source, "source"), sums(derived, "derived")
    same = a["symbol"].eqNullSafe(b["symbol"]) & a["year"].eqNullSafe(b["year"]) & a["month"].eqNullSafe(b["month"])
    equal = F.col("source_volume").eqNullSafe(F.col("derived_volume")) & F.col("source_trades").eqNullSafe(F.col("derived_trades"))
    return a.join(b, same, "full").select(F.coalesce(a["symbol"], b["symbol"]).alias("symbol"), F.coalesce(a["year"], b["year"]).alias("year"), F.coalesce(a["month"], b["month"]).alias("month"), "source_volume", "derived_volume", "source_trades", "derived_trades", equal.alias("conserved"))


def consumption(source: DataFrame, derived: DataFrame, to: str) -> DataFrame:
    """How many source rows a derived table used: consumed, omitted (their bucket is not there)."""
    parents = derived.select("symbol", F.col("open_time").alias("bucket"), F.lit(True).alias("used"))
    rows = source.withColumn("bucket", bucket("open_time", Timeframe(to).minutes).cast("timestamp_ntz")).join(parents, ["symbol", "bucket"], "left")
    return rows.groupBy("symbol").agg(F.count("used").alias("consumed"), F.count_if(F.col("used").isNull()).alias("omitted"))
