"""Loading ranges: half-open selection, warm-up, as-of alignment, data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.sources.candles import CandleError, Timeframe

SERIES = ["symbol", "timeframe"]


def in_time(*keys: str):
    return Window.partitionBy(*(keys or SERIES)).orderBy("open_time")


def number_rows(candles: DataFrame) -> DataFrame:
    """With ``row``, counted from 0 in each symbol and timeframe.

    Months are numbered apart; a month begins behind the rows of the months before it, whose counts are a small table.
    """
    dated = candles.withColumn("_month", F.trunc("open_time", "month"))
    counts = dated.groupBy(*SERIES, "_month").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*SERIES).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*SERIES, "_month").orderBy("open_time"))
    return dated.withColumn("row", own).join(offsets, [*SERIES, "_month"]).withColumn("row", (F.col("row") + F.col("_offset") - 1).cast("int")).select(*candles.columns, "row")


def at(time: str):
    return F.lit(time).cast("timestamp_ntz")


def load(candles: DataFrame, start: str, end: str, columns: list[str] | None = None, warmup: int = 0, strict: bool = True, precision: str = "exact") -> DataFrame:
    """Candles with open_time in [start, end), after exactly ``warmup`` closed ones before it, with ``is_warmup``.

    Too few warm-up candles for a symbol is an error if ``strict``. ``columns`` projects (unknown names are errors; symbol,
    timeframe, times and is_warmup stay). precision "analysis" casts decimals to double and refuses values that are not finite.
    """
    if not at_order(start, end):
        raise CandleError("end must be after start")
    unknown = sorted(set(columns or ()) - set(candles.columns))
    if unknown:
        raise CandleError(f"unknown columns {unknown}")
    trade = candles.filter((F.col("open_time") >= at(start)) & (F.col("open_time") < at(end))).withColumn("is_warmup", F.lit(False))
    out = trade
    if warmup:
        before = candles.filter(F.col("close_time") < at(start))
        # the last ``warmup`` rows of each series: group limit keeps partial results small before the shuffle
        back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("open_time")))
        early = before.withColumn("_back", back).filter(F.col("_back") <= warmup).drop("_back").withColumn("is_warmup", F.lit(True))
        out = early.unionByName(trade)
        if strict:
            # only the warm-up rows are counted; the counts are a row per series
            counts = early.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("_n"))
            n = F.coalesce("_n", F.lit(0))
            short = F.assert_true(n == warmup, F.concat(F.lit("warm-up rows of "), F.col("symbol"), F.lit(": "), n.cast("string")))
            out = out.join(counts, SERIES, "left").withColumn("is_warmup", F.when(short.isNull(), F.col("is_warmup"))).drop("_n")
    if columns is not None:
        fixed = [*SERIES, "open_time", "close_time"]
        out = out.select(*fixed, *(c for c in columns if c not in fixed), "is_warmup")
    if precision == "analysis":
        out = to_double(out)
    elif precision != "exact":
        raise CandleError(f"unknown precision {precision!r}")
    return out


def at_order(start: str, end: str) -> bool:
    return start < end


def to_double(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def as_of(base: DataFrame, higher: DataFrame, name: str, clock: str = "close", carry: list[str] | None = None) -> DataFrame:
    """The last candle of ``higher`` that is closed when each base candle closes (clock "close") or opens ("open").

    Adds ``<name>_idx`` (its row from 0 in its series, -1 if none is closed) and ``<name>_<column>`` for ``carry``. Both sides are
    united and a running last value is taken in time order, so there is one shuffle on symbol and no join; at equal times
    the higher candle comes first and is visible.
    """
    if clock not in ("open", "close"):
        raise CandleError(f"unknown clock {clock!r}")
    carry = carry or []
    own = base.columns
    seen = higher.select("symbol", F.col("close_time").alias("_at"), F.struct((F.row_number().over(in_time("symbol")) - 1).alias("idx"), *carry).alias("_high"))
    rows = base.select("symbol", F.col(f"{clock}_time").alias("_at"), F.struct(*own).alias("_base"))
    both = seen.withColumn("_order", F.lit(0)).unionByName(rows.withColumn("_order", F.lit(1)), allowMissingColumns=True)
    running = Window.partitionBy("symbol").orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_seen", F.last("_high", ignorenulls=True).over(running)).filter("_order = 1")
    return found.select("_base.*", F.coalesce(F.col("_seen.idx"), F.lit(-1)).alias(f"{name}_idx"), *(F.col(f"_seen.{c}").alias(f"{name}_{c}") for c in carry))


def look_back(higher: DataFrame, anchors: DataFrame, end: str, rows: int) -> DataFrame:
    """Candles of a coarser timeframe before ``end``, from the last ``rows`` that closed before each symbol's anchor (symbol, anchor) on."""
    near = higher.filter(F.col("open_time") < at(end)).join(F.broadcast(anchors), "symbol")  # one anchor per symbol
    closed = F.col("close_time") < F.col("anchor")
    back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("open_time")))
    early = near.filter(closed).withColumn("_back", back).filter(F.col("_back") <= rows).drop("_back")
    return early.unionByName(near.filter(~closed)).drop("anchor")


def load_slices(tables: dict[str, DataFrame], base: str, start: str, end: str, warmup: dict[str, int] | None = None, strict: bool = True) -> dict[str, DataFrame]:
    """A slice per timeframe: the base's range behind its warm-up, and of the others what that may look at.

    A coarser slice begins with its own warm-up, one candle at least, of those closed before the base's first candle; fewer, if
    there are no more. None may be finer than the base.
    """
    warmup = warmup or {}
    finer = [t for t in tables if Timeframe(t).minutes < Timeframe(base).minutes]
    if base not in tables or finer:
        raise CandleError(f"base {base} missing or coarser than {finer}")
    if set(warmup) - set(tables):
        raise CandleError(f"warm-up of {sorted(set(warmup) - set(tables))}, which are not asked for")
    out = {base: load(tables[base], start, end, warmup=warmup.get(base, 0), strict=strict)}
    anchors = out[base].groupBy("symbol").agg(F.min("open_time").alias("anchor"))
    for name in tables:
        if name != base:
            out[name] = look_back(tables[name], anchors, end, max(1, warmup.get(name, 0)))
    return out


def load_multi(tables: dict[str, DataFrame], base: str, start: str, end: str, warmup: int | dict[str, int] = 0, clock: str = "close") -> DataFrame:
    """The base's slice with an index column for every other timeframe: the row of its slice, from 0, that is closed then."""
    slices = load_slices(tables, base, start, end, warmup if isinstance(warmup, dict) else {base: warmup})
    out = slices[base]
    for name in sorted((t for t in tables if t != base), key=lambda t: Timeframe(t).minutes):
        out = as_of(out, slices[name], f"tf_{name}", clock)
    return out


def as_of_defects(aligned: DataFrame, higher: DataFrame, name: str, clock: str = "close") -> DataFrame:
    """Counts that must be 0: look-ahead, skipped (a later candle was closed already), backward steps, out of range."""
    rows = higher.select("symbol", (F.row_number().over(in_time("symbol")) - 1).alias("i"), "close_time", F.lead("close_time").over(in_time("symbol")).alias("next_close"))
    first = rows.filter("i = 0").select("symbol", F.col("close_time").alias("first_close"))
    idx, when = F.col(f"{name}_idx"), F.col(f"{clock}_time")
    r = rows.withColumnsRenamed({"close_time": "high_close", "i": "_i"}).withColumn("i", F.col("_i"))
    j = aligned.withColumn("_i", idx).join(r, ["symbol", "_i"], "left").join(first, "symbol", "left")
    step = idx - F.lag(idx).over(Window.partitionBy("symbol").orderBy("open_time"))
    return j.withColumn("step", step).agg(
        F.count_if(F.col("high_close") > when).alias("look_ahead"),
        F.count_if((F.col("next_close") <= when) | ((idx == -1) & (F.col("first_close") <= when))).alias("skipped"),
        F.count_if(F.col("step") < 0).alias("backward"),
        F.count_if((idx >= 0) & F.col("i").isNull() | (idx < -1)).alias("out_of_range"),
    )


def defects(candles: DataFrame, timeframe: str) -> DataFrame:
    """One row per symbol with its rows and a count of each defect: nulls, duplicates, disorder of the grid, gaps, OHLC, negatives."""
    tf = Timeframe(timeframe)
    gap = F.unix_micros(F.col("open_time").cast("timestamp")) - F.unix_micros(F.lag("open_time").over(in_time("symbol")).cast("timestamp"))
    values = ["open", "high", "low", "close", "volume", "trades"]
    null = F.lit(False)
    for c in values:
        null = null | F.col(c).isNull()
    return candles.withColumn("_gap", gap).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(null).alias("nulls"),
        F.count_if(F.col("_gap") == 0).alias("duplicates"),
        F.count_if(F.col("_gap") > tf.millis * 1000).alias("gaps"),
        F.sum(F.when(F.col("_gap") > tf.millis * 1000, F.floor(F.col("_gap") / (tf.millis * 1000)) - 1).otherwise(0)).cast("bigint").alias("missing"),
        F.count_if(F.unix_micros(F.col("open_time").cast("timestamp")) % (tf.millis * 1000) != 0).alias("off_grid"),
        F.count_if((F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close"))).alias("bad_ohlc"),
        F.count_if((F.col("volume") < 0) | (F.col("trades") < 0)).alias("negative"),
    )


def gap_ranges(candles: DataFrame, timeframe: str) -> DataFrame:
    """Missing stretches between candles: symbol, first and last missing open_time, and how many."""
    tf = Timeframe(timeframe)
    step = F.expr(f"INTERVAL '{tf.minutes}' MINUTE")
    after = F.lead("open_time").over(in_time("symbol"))
    missing = (F.unix_micros(F.col("_next").cast("timestamp")) - F.unix_micros(F.col("open_time").cast("timestamp"))) / (tf.millis * 1000) - 1
    return candles.withColumn("_next", after).filter(F.col("_next") > F.col("open_time") + step).select("symbol", (F.col("open_time") + step).alias("gap_start"), (F.col("_next") - step).alias("gap_end"), missing.cast("bigint").alias("missing"))


def islands(candles: DataFrame, timeframe: str) -> DataFrame:
    """Unbroken runs of candles: symbol, start, end, rows."""
    tf = Timeframe(timeframe)
    k = F.unix_micros(F.col("open_time").cast("timestamp")) / (tf.millis * 1000) - F.row_number().over(in_time("symbol"))
    return candles.withColumn("_run", k).groupBy("symbol", "_run").agg(F.min("open_time").alias("run_start"), F.max("open_time").alias("run_end"), F.count(F.lit(1)).alias("rows")).drop("_run")


def fingerprint(candles: DataFrame) -> DataFrame:
    """Rows and content of each symbol: the SHA-256 of the digests of its months in order, each over its candles in order.

    A candle is a line of open_time in microseconds and its values in 1e-8, parted by "|"; months and lines end in a line feed.
    """
    micros = F.unix_micros(F.col("open_time").cast("timestamp"))
    values = [(F.col(c).cast("decimal(28,8)") * 100_000_000).cast("decimal(38,0)").cast("string") for c in ("open", "high", "low", "close", "volume")]
    line = F.concat_ws("|", micros.cast("string"), *values, F.col("trades").cast("string"))
    months = candles.groupBy("symbol", F.trunc("open_time", "month").alias("month")).agg(F.count(F.lit(1)).alias("rows"), digest_in_order(micros, line))
    return months.groupBy("symbol").agg(F.sum("rows").alias("rows"), digest_in_order(F.col("month"), F.col("content")))


def digest_in_order(order, text):
    lines = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.sha2(F.concat(F.array_join(F.transform(lines, lambda x: x["t"]), "\n"), F.lit("\n")), 256).alias("content")
