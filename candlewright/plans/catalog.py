"""The registered queries over candles built from the ``events`` table.

The global series has the symbol ALL; the per-symbol series take event_type as symbol. Decimals are shown as doubles and
counts as bigint, so that results compare with SQL of other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions import bars
from candlewright.operators import access, audits, features, open_liquidity, order_block, price_touch, primary_range, resample, special_swings, swings
from candlewright.operators.crossing import first_reaches
from candlewright.plans.sql import ORACLES
from candlewright.sources import candles
from candlewright.sources.scratch import settled

START, END = "2024-01-10", "2024-01-20"


def ticks(spark: SparkSession, sf: str, by_type: bool = False) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select((F.col("event_type") if by_type else F.lit("ALL")).alias("symbol"), "ts", "value")


def candle(spark: SparkSession, sf: str, timeframe: str, by_type: bool = False) -> DataFrame:
    return candles.candles_from_ticks(ticks(spark, sf, by_type), timeframe)


def numbered(spark: SparkSession, sf: str, timeframe: str, by_type: bool = False) -> DataFrame:
    return settled(access.number_rows(candle(spark, sf, timeframe, by_type)))


def several(spark: SparkSession, sf: str, by_type: bool = False) -> DataFrame:
    out = numbered(spark, sf, "1h", by_type)
    for tf in ("4h", "1d"):
        out = out.unionByName(numbered(spark, sf, tf, by_type))
    return out


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, structs and arrays dropped."""
    cast = {c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")} | {c: F.col(c).cast("bigint") for c, t in df.dtypes if t in ("int", "smallint")}
    return df.withColumns(cast).drop(*(c for c, t in df.dtypes if t.startswith(("array", "struct"))))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in names})


def bar_shapes(spark, sf):
    c = candle(spark, sf, "1h")
    return c.select("open_time", bars.direction().alias("direction"), bars.body_low().alias("body_low"), bars.body_high().alias("body_high"), bars.body().alias("body"), bars.upper_wick().alias("upper_wick"), bars.lower_wick().alias("lower_wick"), bars.month_key().alias("month"), bars.quarter_key().alias("quarter"), bars.week_key().alias("week"))


def touched(spark, sf):
    rows = several(spark, sf)
    return price_touch.level_stats(price_touch.touches(rows, price_touch.peaks(rows))).select("timeframe", "bin", "touches", "episodes", "close_inside", "body", "wick", "dates", "weeks", "months", "quarters", "years", "first_touch", "last_touch", "n_open_inside", "n_crosses", "n_from_above", "n_from_below", "n_bullish", "n_bearish", "n_doji", "engagement", "persistence")


def accepted(spark, sf):
    return price_touch.analyse(several(spark, sf))["accepted"].select("timeframe", "id", "rank", "center", "touches", "touches_pct", "episodes_pct", "months_pct", "engagement_pct", "first_eligible")


def liquidity_groups(spark, sf):
    return open_liquidity.hierarchy(open_liquidity.ranked_open(open_liquidity.candidates(several(spark, sf))))


def lived(spark, sf):
    rows = numbered(spark, sf, "4h", True)
    return order_block.lifecycle(rows, order_block.blocks(rows))


def special(search, timeframe, by_type=True):
    def run(spark, sf):
        found = search(numbered(spark, sf, timeframe, by_type))
        return found.select("symbol", "side", "row", "k", "kind", "reason", "price", "plateau_start", "plateau_end", "open_percent", "close_percent", "close_row")

    return run


def outcomes(search, timeframe, by_type=True):
    def run(spark, sf):
        return special_swings.suppress(special_swings.families(search(numbered(spark, sf, timeframe, by_type)))).select("symbol", "side", "row", "close_row", "price", "event_id", "family", "outcome")

    return run


def flattened(rows):
    """Prices of the random series pressed into a band of a tenth, so that the range detector's own limits apply."""
    price = lambda c: (F.col(c) / 50 + 100).cast("decimal(18,8)")
    return rows.withColumns({c: price(c) for c in ("open", "high", "low", "close")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ohlcv_1h": lambda s, d: candle(s, d, "1h"),
    "ohlcv_4h_by_symbol": lambda s, d: candle(s, d, "4h", True),
    "ohlcv_1d": lambda s, d: candle(s, d, "1d"),
    "fold_1h_4h": lambda s, d: resample.fold(candle(s, d, "1h"), "4h", child="1h"),
    "fold_flags_by_symbol": lambda s, d: resample.fold(candle(s, d, "1h", True), "4h", "flag", child="1h"),
    "timeframe_agreement": lambda s, d: resample.agreement({t: candle(s, d, t) for t in ("1h", "4h", "1d")}),
    "conservation": lambda s, d: resample.conservation(candle(s, d, "1h", True), candle(s, d, "1d", True)),
    "consumption": lambda s, d: resample.consumption(candle(s, d, "1h", True), resample.fold(candle(s, d, "1h", True), "4h", child="1h"), "4h"),
    "defect_counts": lambda s, d: access.defects(candle(s, d, "1h", True), "1h"),
    "gap_ranges": lambda s, d: access.gap_ranges(candle(s, d, "1h", True), "1h"),
    "coverage_islands": lambda s, d: access.islands(candle(s, d, "1h", True), "1h"),
    "content_fingerprint": lambda s, d: access.fingerprint(candle(s, d, "1h", True)),
    "archive_plan": lambda s, d: candles.plan_archives(s, ["BTCUSDT", "ETHUSDT"], "2024-12-01", "2025-02-11"),
    "range_half_open": lambda s, d: access.load(candle(s, d, "1h"), START, END, ["close", "volume"]),
    "range_warmup_100": lambda s, d: access.load(candle(s, d, "1h"), START, END, warmup=100, precision="analysis"),
    "asof_1h_4h_close": lambda s, d: access.as_of(candle(s, d, "1h"), candle(s, d, "4h"), "h4", "close", ["close", "open_time"]),
    "asof_1h_1d_open": lambda s, d: access.as_of(candle(s, d, "1h", True), candle(s, d, "1d", True), "d1", "open", ["high"]),
    "multi_timeframe": lambda s, d: access.load_multi({t: candle(s, d, t) for t in ("1h", "4h", "1d")}, "1h", START, END, warmup=10),
    "asof_defects": lambda s, d: access.as_of_defects(access.as_of(candle(s, d, "1h"), candle(s, d, "4h"), "h4"), candle(s, d, "4h"), "h4"),
    "bar_shapes": bar_shapes,
    "true_range_atr14": lambda s, d: rounded(features.with_atr(numbered(s, d, "1h")), "tr", "atr").select("row", "tr", "atr"),
    "rolling_bodies": lambda s, d: rounded(features.with_rolling(numbered(s, d, "1h")), "median_body", "mean_body", "highest_close", "lowest_close", "mean_volume").select("row", "median_body", "mean_body", "highest_close", "lowest_close", "mean_volume"),
    "pivots_3_3": lambda s, d: features.pivots(numbered(s, d, "1h", True)),
    "suffix_extremes": lambda s, d: features.with_suffix_extremes(numbered(s, d, "1h")).select("row", "later_high", "later_low"),
    "rank_percentiles": lambda s, d: rounded(features.average_rank_percentile(numbered(s, d, "4h", True), "trades", ["symbol"], "pct"), "pct").select("symbol", "row", "trades", "pct"),
    "leg_statistics": lambda s, d: rounded(features.leg_statistics(numbered(s, d, "1h", True).withColumn("day", F.to_date("open_time")), ["symbol", "day"]), "slope", "efficiency", "path", "vwap", "volatility", "close_location"),
    "first_reaches": lambda s, d: first_reaches(numbered(s, d, "1h")).select("row", "reach_high", "reach_low", "close_reach_high", "close_reach_low"),
    "open_liquidity": lambda s, d: open_liquidity.candidates(several(s, d)).select("timeframe", "side", "row", "price", "status", "mitigation_row", "close_row", "origin", "future_bars", "mechanism", "penetration", "chain_position", "chain_length", "chain_previous", "chain_next", "near_miss"),
    "open_liquidity_ranks": lambda s, d: rounded(open_liquidity.ranked_open(open_liquidity.candidates(several(s, d))), "distance_percent").select("timeframe", "side", "row", "price", "distance", "distance_percent", "rank_nearest", "rank_oldest", "rank_newest", "rank_observed", "observation"),
    "open_liquidity_months": lambda s, d: open_liquidity.monthly_origins(open_liquidity.candidates(several(s, d))),
    "open_liquidity_mechanisms": lambda s, d: open_liquidity.mechanism_counts(open_liquidity.candidates(several(s, d))),
    "open_liquidity_groups": liquidity_groups,
    "order_block_pairs": lambda s, d: order_block.pairs(numbered(s, d, "4h", True)).select("symbol", "row", "side", "disposition", "moved"),
    "order_blocks": lambda s, d: rounded(order_block.blocks(numbered(s, d, "4h", True)), "displacement_percent", "impulse_to_median", "impulse_to_origin", "quality").select("symbol", "side", "row", "zone_lower", "zone_upper", "displacement_percent", "impulse_to_median", "impulse_to_origin", "structure_break", "quality", "quality_label"),
    "order_block_lifecycle": lambda s, d: lived(s, d).select("symbol", "side", "block_row", "status", "gap_row", "touch_row", "midpoint_row", "full_row", "invalid_row", "wick_only_row", "later_bars", "touch_bars", "touch_episodes", "excursion_before", "excursion_after"),
    "order_block_events": lambda s, d: order_block.events(lived(s, d)),
    "order_block_clusters": lambda s, d: order_block.clusters(order_block.blocks(numbered(s, d, "4h", True), "200.00")).select("symbol", "row", "zone_lower", "zone_upper", "cluster", "cluster_size"),
    "touch_density": lambda s, d: price_touch.density(several(s, d)).filter("touches > 0"),
    "touch_peaks": lambda s, d: price_touch.peaks(several(s, d)),
    "touch_levels": touched,
    "touch_accepted": accepted,
    "touch_groups": lambda s, d: price_touch.analyse(several(s, d))["groups"],
    "special_30m": special(special_swings.search_30m, "30m", False),
    "special_30m_outcomes": outcomes(special_swings.search_30m, "30m", False),
    "special_4h": special(special_swings.search_4h, "4h"),
    "special_4h_outcomes": outcomes(special_swings.search_4h, "4h"),
    "swing_formations": lambda s, d: swings.formations(numbered(s, d, "4h", True)).select("symbol", "side", "row", "length", "label", "extreme_row", "price", "close_row"),
    "swing_emissions": lambda s, d: swings.emitted(swings.formations(numbered(s, d, "1h"))).drop("open_time", "plateau_start", "off_centre"),
    "swings": lambda s, d: swings.swings(numbered(s, d, "1h")),
    "swing_legs": lambda s, d: swings.legs(numbered(s, d, "1h"), swings.swings(numbered(s, d, "1h"))),
    "swing_forward": lambda s, d: swings.forward(numbered(s, d, "1h"), swings.swings(numbered(s, d, "1h"))),
    "open_liquidity_audit": lambda s, d: audits.open_liquidity_audit(open_liquidity.candidates(several(s, d))),
    "order_block_audit": lambda s, d: audits.order_block_audit(order_block.pairs(numbered(s, d, "4h", True)), lived(s, d)),
    "swing_audit": lambda s, d: audits.swing_audit(swings.swings(numbered(s, d, "1h"))),
    "special_audit": lambda s, d: audits.special_audit(special_swings.families(special_swings.search_4h(numbered(s, d, "4h", True)))),
    "primary_ranges": lambda s, d: primary_range.primary_ranges(flattened(numbered(s, d, "1h", True))),
    "primary_range_rejections": lambda s, d: primary_range.rejections(flattened(numbered(s, d, "1h", True))),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, f=f: plain(f(s, d))) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return ORACLES
