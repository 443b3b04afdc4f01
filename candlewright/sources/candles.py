"""Candle schemas, timeframes, and readers that give candles."""

from __future__ import annotations

import io
import zipfile
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.bars import PRICE

#: Minutes of each timeframe, and the columns of candle tables.
MINUTES = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "4h": 240, "1d": 1440}
ANALYTICAL = (
    "symbol string, open_time timestamp, open decimal(38,8), high decimal(38,8), low decimal(38,8), close decimal(38,8), volume decimal(38,8), close_time timestamp, "
    "quote_asset_volume decimal(38,8), number_of_trades bigint, taker_buy_base_asset_volume decimal(38,8), taker_buy_quote_asset_volume decimal(38,8), source_candle_count smallint"
)
RENAMED = {"quote_volume": "quote_asset_volume", "count": "number_of_trades", "taker_buy_volume": "taker_buy_base_asset_volume", "taker_buy_quote_volume": "taker_buy_quote_asset_volume"}
KLINE = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore"]
SUMS = ["volume", "quote_asset_volume", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume"]


class CandleError(ValueError):
    """A request or a table breaks a rule of candles."""


@dataclass(frozen=True)
class Timeframe:
    name: str

    def __post_init__(self):
        if self.name not in MINUTES:
            raise CandleError(f"unknown timeframe {self.name!r}")

    @property
    def minutes(self) -> int:
        return MINUTES[self.name]

    @property
    def millis(self) -> int:
        return self.minutes * 60_000

    @property
    def per_day(self) -> int:
        return 1440 // self.minutes

    @property
    def partitioned_by(self) -> list[str]:
        return ["symbol", "year"] if self.name == "1d" else ["symbol", "year", "month"]


def require_symbols(wanted: list[str], allowed: list[str]) -> list[str]:
    """The wanted symbols, each once, in order; an unknown or path-like one is an error."""
    for s in wanted:
        if s not in allowed or not s.isalnum():
            raise CandleError(f"unknown symbol {s!r}")
    return list(dict.fromkeys(wanted))


def bucket(ts, minutes: int):
    """Start of the UTC bucket of a timestamp_ntz."""
    return F.window(ts, f"{minutes} minutes")["start"]


def candles_from_ticks(ticks: DataFrame, timeframe: str, symbol="symbol", time: str = "ts", value: str = "value") -> DataFrame:
    """OHLCV of (symbol, ts, value) rows per bucket; open and close are the values of first and last time, ties by value.

    Columns: symbol, timeframe, open_time, close_time, open, high, low, close, volume, trades. Times are timestamp_ntz. Rows
    with a null time or value do not count. One partial aggregation before one shuffle on (symbol, bucket).
    """
    tf = Timeframe(timeframe)
    rows = ticks.select(F.col(symbol).alias("symbol"), F.col(time).cast("timestamp_ntz").alias("t"), F.col(value).cast(PRICE).alias("v")).dropna(subset=["t", "v"])
    out = rows.groupBy("symbol", bucket("t", tf.minutes).cast("timestamp_ntz").alias("open_time")).agg(
        F.min_by("v", F.struct("t", "v")).alias("open"), F.max("v").alias("high"), F.min("v").alias("low"), F.max_by("v", F.struct("t", "v")).alias("close"), F.sum("v").alias("volume"), F.count(F.lit(1)).alias("trades")
    )
    return out.select("symbol", F.lit(tf.name).alias("timeframe"), "open_time", close_time(tf), "open", "high", "low", "close", F.col("volume").cast("decimal(28,8)").alias("volume"), "trades")


def close_time(tf: Timeframe):
    return (F.col("open_time") + F.expr(f"INTERVAL '{tf.minutes}' MINUTE") - F.expr("INTERVAL '0.001' SECOND")).alias("close_time")


def to_analytical(canonical: DataFrame) -> DataFrame:
    """Canonical 1m rows under their analytical names, with source_candle_count 1."""
    return canonical.withColumnsRenamed(RENAMED).withColumn("source_candle_count", F.lit(1).cast("smallint")).drop("interval", "ignore")


def parse_klines(raw: DataFrame, symbol: str | None = None) -> DataFrame:
    """Typed klines with a ``defect`` for each row from string columns named as in KLINE.

    Epochs are milliseconds, or microseconds, which must end 000 (open) and 999 (close); close is open + 59,999 ms; prices have
    8 decimals at most. A header row has the defect "header".
    """
    text = lambda c: F.trim(F.col(c))
    micro = F.length(text("open_time")) > 14
    open_raw, close_raw = text("open_time").try_cast("bigint"), text("close_time").try_cast("bigint")
    millis = lambda x: F.when(micro, F.floor(x / 1000)).otherwise(x).cast("bigint")
    numbers = {c: text(c).try_cast("decimal(38,8)") for c in ("open", "high", "low", "close", "volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")}
    precise = F.lit(True)
    for c in numbers:
        precise = precise & text(c).rlike(r"^-?\d+(\.\d{1,8}0*)?$")
    o, h, l, c = (numbers[x] for x in ("open", "high", "low", "close"))
    defect = (
        F.when(text("open_time") == "open_time", "header")
        .when(open_raw.isNull() | close_raw.isNull(), "time")
        .when(micro & ((open_raw % 1000 != 0) | (close_raw % 1000 != 999)), "unit")
        .when(~precise | text("count").try_cast("bigint").isNull(), "number")
        .when(millis(open_raw) % 60_000 != 0, "grid")
        .when(millis(close_raw) != millis(open_raw) + 59_999, "close_time")
        .when((h < F.greatest(o, c)) | (l > F.least(o, c)) | (h < l), "ohlc")
        .when(F.least(*[numbers[x] for x in ("volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")]) < 0, "negative")
    )
    named = [F.lit(symbol).alias("symbol")] if symbol is not None else [F.col("symbol")]
    return raw.select(*named, F.timestamp_millis(millis(open_raw)).alias("open_time"), *(numbers[x].alias(x) for x in ("open", "high", "low", "close", "volume")), F.timestamp_millis(millis(close_raw)).alias("close_time"), numbers["quote_volume"].alias("quote_volume"), text("count").try_cast("bigint").alias("count"), numbers["taker_buy_volume"].alias("taker_buy_volume"), numbers["taker_buy_quote_volume"].alias("taker_buy_quote_volume"), defect.alias("defect"))


def read_kline_csv(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    return parse_klines(spark.read.schema(", ".join(f"{c} string" for c in KLINE)).csv(path), symbol)


def read_kline_zips(spark: SparkSession, path: str) -> DataFrame:
    """Klines of zip archives, one CSV member each; the symbol is the file name up to the first dash.

    An archive fits a task's memory (a month of minutes is about 2 MB).
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stem = name.rsplit("/", 1)[-1].removesuffix(".zip")
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    if z.namelist() != [f"{stem}.csv"]:
                        raise CandleError(f"{name}: members {z.namelist()}")
                    table = pa.csv.read_csv(io.BytesIO(z.read(f"{stem}.csv")), read_options=pa.csv.ReadOptions(column_names=KLINE), convert_options=pa.csv.ConvertOptions(column_types=dict.fromkeys(KLINE, pa.string())))
                for part in table.to_batches(max_chunksize=50_000):
                    yield pa.RecordBatch.from_arrays([pa.array([stem.split("-")[0]] * part.num_rows), *part.columns], names=["symbol", *KLINE])

    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "symbol string, " + ", ".join(f"{c} string" for c in KLINE))
    return parse_klines(raw)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of files, hashed where they are read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_checksums(files: DataFrame, sums: DataFrame) -> DataFrame:
    """Files against checksum lines (``value``: "<sha256>  <name>"): name, status ok, differs, no_checksum or no_file."""
    told = sums.select(F.lower(F.regexp_extract("value", r"^\s*([0-9A-Fa-f]{64})\s+\*?(\S+)\s*$", 1)).alias("told"), F.regexp_extract("value", r"^\s*([0-9A-Fa-f]{64})\s+\*?(\S+)\s*$", 2).alias("name")).filter("told <> ''")
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "sha256")
    status = F.when(F.col("sha256").isNull(), "no_file").when(F.col("told").isNull(), "no_checksum").when(F.col("sha256") == F.col("told"), "ok").otherwise("differs")
    return have.join(told, "name", "full").select("name", status.alias("status"))


def plan_archives(spark: SparkSession, symbols: list[str], start: str, end: str) -> DataFrame:
    """(symbol, kind, period, unit) for [start, end): a monthly archive for each whole month, daily ones for the rest.

    Spot archives count in milliseconds before 2025 and in microseconds from then on.
    """
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day")
    months = days.groupBy(F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.collect_list("day").alias("days"))
    whole = F.col("n") == F.dayofmonth(F.last_day("month"))
    periods = months.select(F.when(whole, "monthly").otherwise("daily").alias("kind"), F.explode(F.when(whole, F.array("month")).otherwise(F.col("days"))).alias("day"))
    unit = F.when(F.col("day") < F.lit("2025-01-01").cast("date"), "ms").otherwise("us")
    names = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    return names.select("symbol", F.lit(1).alias("one")).join(periods.withColumn("one", F.lit(1)), "one").select("symbol", "kind", F.when(F.col("kind") == "monthly", F.date_format("day", "yyyy-MM")).otherwise(F.date_format("day", "yyyy-MM-dd")).alias("period"), unit.alias("unit"))


def inventory(spark: SparkSession, base: str, timeframe: str, symbols: list[str], start: str, end: str) -> DataFrame:
    """Expected against present partitions: key columns, files, rows and status ok, missing or unexpected."""
    tf = Timeframe(timeframe)
    keys = tf.partitioned_by
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day")
    names = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    wanted = days.select(F.year("day").alias("year"), F.month("day").alias("month")).distinct().crossJoin(F.broadcast(names)).select(*keys).distinct()  # calendar x symbols
    have = spark.read.parquet(base).select(*keys, F.input_file_name().alias("file")).groupBy(*keys).agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("rows"))
    both = wanted.withColumn("wanted", F.lit(True)).join(have, keys, "full")
    status = F.when(F.col("wanted").isNull(), "unexpected").when(F.col("rows").isNull(), "missing").otherwise("ok")
    return both.select(*keys, "files", "rows", status.alias("status"))
