"""Candles from a stream of ticks: one row per bucket, once the watermark has passed it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.bars import PRICE
from candlewright.sources.candles import Timeframe


def stream_ticks(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """A stream of (symbol, ts, value) from a folder of event files, as they arrive."""
    schema = spark.read.parquet(path).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return events.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "value")


def stream_candles(ticks: DataFrame, timeframe: str, late: str = "10 minutes", need: int | None = None) -> DataFrame:
    """OHLCV per symbol and bucket in append mode: a bucket comes when the watermark (``late`` behind the latest tick) passes its
    end, later ticks of it are dropped. With ``need``, buckets of another number of ticks are not emitted."""
    tf = Timeframe(timeframe)
    v = F.col("value").cast(PRICE)
    out = ticks.withWatermark("ts", late).groupBy("symbol", F.window("ts", f"{tf.minutes} minutes").alias("w")).agg(
        F.min_by(v, "ts").alias("open"), F.max(v).alias("high"), F.min(v).alias("low"), F.max_by(v, "ts").alias("close"), F.sum(v).alias("volume"), F.count(F.lit(1)).alias("trades")
    )
    out = out if need is None else out.filter(F.col("trades") == need)
    return out.select("symbol", F.lit(tf.name).alias("timeframe"), F.col("w.start").alias("open_time"), (F.col("w.end") - F.expr("INTERVAL '0.001' SECOND")).alias("close_time"), "open", "high", "low", "close", "volume", "trades")


def run_available(candles: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, appending finished buckets to a Parquet folder; exactly once across restarts."""
    candles.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
