"""Audits of detector results: one row per check (check, failures); all failures are 0 in a sound result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.operators import open_liquidity, order_block, price_touch, swings
from candlewright.operators.access import SERIES


def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows of ``df`` that break each check; a check that is null is broken."""
    found = df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()))
    return found.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in checks))).alias("x")).select("x.*")


def together(*audits: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, audits)


def open_liquidity_audit(found: DataFrame) -> DataFrame:
    """Candidates: two per candle, status and mitigation agree, mitigation later than the origin, chains numbered without gaps."""
    mitigated = F.col("status") == open_liquidity.MITIGATED
    per_candle = found.groupBy(*SERIES, "row").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("side").alias("sides"))
    chains = found.groupBy(*SERIES, "side", "price").agg(F.count(F.lit(1)).alias("n"), F.max("chain_position").alias("last"), F.count_distinct("chain_position").alias("places"), F.count_if("chain_survivor").alias("survivors"), F.count_if(F.col("status") == open_liquidity.OPEN).alias("open"))
    return together(
        counted(found, {
            "status_known": F.col("status").isin(open_liquidity.OPEN, open_liquidity.MITIGATED, open_liquidity.TERMINAL),
            "mitigated_has_row": mitigated == F.col("mitigation_row").isNotNull(),
            "mitigated_later": F.coalesce(F.col("mitigation_row") > F.col("row"), F.lit(True)),
            "mechanism_if_mitigated": mitigated == F.col("mechanism").isNotNull(),
            "penetration_not_negative": F.coalesce(F.col("penetration") >= 0, F.lit(True)),
            "close_not_before_reach": F.coalesce(F.col("close_row") >= F.col("mitigation_row"), F.lit(True)),
            "terminal_is_last": (F.col("status") == open_liquidity.TERMINAL) == (F.col("future_bars") == 0),
        }),
        counted(per_candle, {"two_sides_per_candle": (F.col("n") == 2) & (F.col("sides") == 2)}),
        counted(chains, {"chain_numbered": (F.col("n") == F.col("last")) & (F.col("n") == F.col("places")), "one_open_per_chain": (F.col("open") <= 1) & (F.col("survivors") == F.col("open"))}),
    )


def order_block_audit(pairs: DataFrame, lived: DataFrame) -> DataFrame:
    """Pairs have a known outcome and sides agree with it; events come after the impulse and in their logical order."""
    side = F.coalesce("side", F.lit(""))
    known = [order_block.ORIGIN_DOJI, order_block.IMPULSE_DOJI, order_block.SAME_DIRECTION, *order_block.QUALIFIED.values(), *order_block.BELOW.values()]
    after = lambda name: F.coalesce(F.col(name) > F.col("impulse_row"), F.lit(True))
    follows = lambda late, early: F.coalesce(F.col(late) >= F.col(early), F.col(late).isNull())
    return together(
        counted(pairs, {"disposition_known": F.col("disposition").isin(known), "side_in_disposition": (side == "") | F.contains("disposition", side)}),
        counted(lived, {
            "zone_ordered": F.col("zone_lower") <= F.col("zone_upper"),
            **{f"{n}_after_impulse": after(n) for n in ("gap_row", "touch_row", "midpoint_row", "full_row", "invalid_row", "wick_only_row")},
            "full_not_before_midpoint": follows("full_row", "midpoint_row"),
            "invalid_not_before_full": follows("invalid_row", "full_row"),
            "episodes_within_touches": F.coalesce(F.col("touch_episodes") <= F.col("touch_bars"), F.lit(True)),
            "status_agrees": (F.col("status") == "INVALIDATED") == F.col("invalid_row").isNotNull(),
            "quality_in_range": F.col("quality").between(0, 100),
        }),
    )


def touch_audit(stats: DataFrame) -> DataFrame:
    """Levels: touch types add up, episodes and periods do not exceed touches."""
    return counted(stats, {
        "types_add_up": F.col("close_inside") + F.col("body") + F.col("wick") == F.col("touches"),
        "episodes_within_touches": F.col("episodes").between(1, F.col("touches")),
        "periods_nested": (F.col("years") <= F.col("quarters")) & (F.col("quarters") <= F.col("months")) & (F.col("months") <= F.col("dates")),
        "first_before_last": F.col("first_touch") <= F.col("last_touch"),
        "directions_add_up": F.col("n_bullish") + F.col("n_bearish") + F.col("n_doji") == F.col("touches"),
        "engagement_in_range": F.col("engagement").between(0, 1),
        "persistence_known": F.col("persistence").isin(*price_touch.PERSISTENCE),
    })


def swing_audit(found: DataFrame) -> DataFrame:
    """Swings: sides alternate, extremes lie before their confirmation, confirmations in order, distances as the level asks."""
    w = Window.partitionBy(*SERIES, "level").orderBy("sequence")
    rows = found.withColumns({"_side": F.lag("side").over(w), "_row": F.lag("row").over(w), "_price": F.lag("price").over(w), "_confirmed": F.lag("confirmed_row").over(w), "_n": F.row_number().over(w)})
    first = F.col("_side").isNull()
    internal = F.col("level") == "INTERNAL"
    least = lambda a, b: F.when(internal, a).otherwise(b)
    moved = F.when(F.col("side") == "HIGH", F.col("price") - F.col("_price")).otherwise(F.col("_price") - F.col("price"))
    return counted(rows, {
        "sequence_unbroken": F.col("sequence") == F.col("_n"),
        "sides_alternate": first | (F.col("side") != F.col("_side")),
        "confirmed_after_extreme": F.col("confirmed_row") > F.col("row"),
        "confirmed_in_order": first | (F.col("confirmed_row") >= F.col("_confirmed")),
        "spaced": first | (F.col("row") - F.col("_row") >= least(swings.INTERNAL["spacing"], swings.MAJOR["spacing"])),
        "displaced": first | (moved >= (least(swings.INTERNAL["displacement"], swings.MAJOR["displacement"]) - 1e-9) * F.col("atr")),
        "labelled": F.when(first, F.startswith("label", F.lit("FIRST_"))).otherwise(F.col("label").isNotNull()),
    })


def special_audit(found: DataFrame) -> DataFrame:
    """Special swings: one primary per event, extremes strictly between opening and close, both boundaries kept."""
    passed = found.filter("reason = 'OK'")
    per_event = passed.groupBy(*SERIES, "event_id").agg(F.count_if(F.col("family") == "PRIMARY").alias("primaries")) if "family" in found.columns else None
    rows = counted(passed, {"close_after_opening": F.col("close_row") > F.col("row"), "plateau_in_span": (F.col("plateau_start") >= F.col("row")) & (F.col("plateau_end") <= F.col("close_row")) & (F.col("plateau_start") <= F.col("plateau_end")), "boundaries_positive": (F.col("open_percent") > 0) & (F.col("close_percent") > 0)})
    return rows if per_event is None else together(rows, counted(per_event, {"one_primary_per_event": F.col("primaries") == 1}))
