"""Rolling features of numbered candles (column ``row`` from 0 in each symbol and timeframe)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators.access import SERIES

def series(*order: str):
    return Window.partitionBy(*SERIES).orderBy(*(order or ("row",)))


def with_true_range(candles: DataFrame) -> DataFrame:
    return candles.withColumn("tr", bars.true_range(F.lag("close").over(series())).cast("double"))


def with_atr(candles: DataFrame, length: int = 14) -> DataFrame:
    """Wilder's ATR: null before row length - 1, the mean of the first ``length`` true ranges there, then (prev * (length - 1) + tr) / length.

    With q = (length - 1) / length the recursion is a weighted sum: q^(i - j) x_j over the rows j up to i, where x is the
    seed and then tr / length. A series is cut into pieces of so many rows that q to that power is below 1e-34: in a
    piece the sum is a running one, and of what went before only the last value of the piece before counts. So pieces
    are sorted and summed apart, and the values that pieces hand on are a table of one row per piece.
    """
    if length == 1:
        return with_true_range(candles).withColumn("atr", F.col("tr"))
    q = (length - 1) / length
    piece = max(length, math.ceil(80 / -math.log(q)))
    key = [*SERIES, "_piece"]
    place = F.col("row") - F.col("_piece") * piece
    rows = candles.withColumn("_piece", F.floor(F.col("row") / piece).cast("bigint"))
    own = Window.partitionBy(*key).orderBy("row")
    last = rows.groupBy(*key).agg(F.max_by("close", "row").alias("_ended")).withColumn("_piece", F.col("_piece") + 1)
    rows = rows.join(last, key, "left").withColumn("tr", bars.true_range(F.coalesce(F.lag("close").over(own), F.col("_ended"))).cast("double"))
    seed = F.sum(F.when(F.col("row") < length, F.col("tr"))).over(own) / length
    share = F.when(F.col("row") >= length, F.col("tr") / length).when(F.col("row") == length - 1, seed).otherwise(0.0)
    power = lambda n: F.pow(F.lit(q), n.cast("double"))
    rows = rows.withColumn("_share", share).withColumn("_own", power(place) * F.sum(F.col("_share") / power(place)).over(own))
    handed = rows.groupBy(*key).agg(F.max_by("_own", "row").alias("_before")).withColumn("_piece", F.col("_piece") + 1)
    out = rows.join(handed, key, "left")
    value = F.col("_own") + F.coalesce(F.col("_before") * power(place + 1), F.lit(0.0))
    return out.withColumn("atr", F.when(F.col("row") >= length - 1, value)).drop("_piece", "_ended", "_share", "_own", "_before")


def exact_median(values: Column) -> Column:
    """Median of an array; of an even number the mean of the middle two; null if empty."""
    s, n = F.array_sort(values), F.size(values)
    lo, hi = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
    return F.when(n > 0, (F.get(s, lo - 1) + F.get(s, hi - 1)) / 2)


def mad(values: Column) -> Column:
    """Median absolute deviation from the median."""
    m = exact_median(values)
    return exact_median(F.transform(values, lambda x: F.abs(x - m)))


def with_rolling(candles: DataFrame, lookback: int = 20, volume_rows: int = 50) -> DataFrame:
    """Of the ``lookback`` rows before each: median and mean body (of those there are), highest and lowest close (only if all are
    there); and the mean volume of ``volume_rows`` rows before (only if all are there)."""
    past, long = series().rowsBetween(-lookback, -1), series().rowsBetween(-volume_rows, -1)
    body = bars.body()
    full = F.count(F.lit(1)).over(past) == lookback
    return candles.withColumns(
        {
            "median_body": exact_median(F.collect_list(body.cast("double")).over(past)),
            "mean_body": F.avg(body.cast("double")).over(past),
            "highest_close": F.when(full, F.max("close").over(past)),
            "lowest_close": F.when(full, F.min("close").over(past)),
            "mean_volume": F.when(F.count(F.lit(1)).over(long) == volume_rows, F.avg(F.col("volume").cast("double")).over(long)),
        }
    )


def with_suffix_extremes(candles: DataFrame) -> DataFrame:
    """Highest high and lowest low of strictly later rows; null on the last."""
    later = series(F.desc("row")).rowsBetween(Window.unboundedPreceding, -1)  # running extremes of the reversed series
    return candles.withColumns({"later_high": F.max("high").over(later), "later_low": F.min("low").over(later)})


def pivots(candles: DataFrame, left: int = 3, right: int = 3) -> DataFrame:
    """Bars above all of ``left`` before and not below any of ``right`` after (lows mirrored), confirmed at row + right.

    Columns: SERIES, side, row, open_time, price, confirmed_row. Bars without ``left`` or ``right`` neighbours are none.
    """
    before, after = series().rowsBetween(-left, -1), series().rowsBetween(1, right)
    there = (F.count(F.lit(1)).over(before) == left) & (F.count(F.lit(1)).over(after) == right)
    marked = candles.withColumns(
        {
            "_h": there & (F.max("high").over(before) < F.col("high")) & (F.max("high").over(after) <= F.col("high")),
            "_l": there & (F.min("low").over(before) > F.col("low")) & (F.min("low").over(after) >= F.col("low")),
        }
    )
    sides = F.array(F.when(F.col("_h"), F.struct(F.lit("HIGH").alias("side"), F.col("high").alias("price"))), F.when(F.col("_l"), F.struct(F.lit("LOW").alias("side"), F.col("low").alias("price"))))
    return marked.select(*SERIES, "row", "open_time", F.explode(F.array_compact(sides)).alias("p")).select(*SERIES, "p.side", "row", "open_time", "p.price", (F.col("row") + right).alias("confirmed_row"))


def average_rank_percentile(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """(average rank - 1) / (n - 1) in each group; 1 for a group of one."""
    group = Window.partitionBy(*by)
    rank = F.rank().over(group.orderBy(value)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, value)) - 1) / 2
    n = F.count(F.lit(1)).over(group)
    return df.withColumn(name, F.when(n == 1, F.lit(1.0)).otherwise((rank - 1) / (n - 1)))


def leg_statistics(candles: DataFrame, by: list[str]) -> DataFrame:
    """Of candles grouped into legs: slope of close over row, efficiency, VWAP, path length, realised volatility, mean close location."""
    w = Window.partitionBy(*by).orderBy("row")
    close = F.col("close").cast("double")
    step = close - F.lag(close).over(w)
    typical = (F.col("high") + F.col("low") + F.col("close")).cast("double") / 3
    span = (F.col("high") - F.col("low")).cast("double")
    rows = candles.withColumns({"_c": close, "_d": step, "_r": F.log(close / F.lag(close).over(w)), "_tp": typical * F.col("volume").cast("double"), "_loc": F.when(span > 0, (close - F.col("low").cast("double")) / span)})
    moved = F.abs(F.max_by("_c", "row") - F.min_by("_c", "row"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.regr_slope(F.col("_c"), F.col("row").cast("double")).alias("slope"),
        F.when(F.sum(F.abs("_d")) > 0, moved / F.sum(F.abs("_d"))).alias("efficiency"),
        F.coalesce(F.sum(F.abs("_d")), F.lit(0.0)).alias("path"),
        F.when(F.sum("volume") > 0, F.sum("_tp") / F.sum("volume").cast("double")).alias("vwap"),
        F.stddev_pop("_r").alias("volatility"),
        F.avg("_loc").alias("close_location"),
    )
