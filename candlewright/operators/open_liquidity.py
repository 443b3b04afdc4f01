"""Open liquidity: which extremes of candles no later candle has reached."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators.access import SERIES
from candlewright.operators.crossing import first_reaches
from candlewright.operators.features import series, with_atr, with_suffix_extremes

OPEN, MITIGATED, TERMINAL = "OPEN_CONFIRMED_BY_LATER_OBSERVATION", "MITIGATED", "TERMINAL_NO_LATER_CANDLE"
NEAR_MISS = "0.05"
#: Hours of a candle, slots of a group from coarse to fine, and the tier of each set of slots.
HOURS = {"1h": 1, "4h": 4, "1d": 24}
SLOTS = ["1d", "4h", "1h"]
TIERS = {("1d", "4h", "1h"): 1, ("1d", "4h"): 2, ("1d", "1h"): 3, ("4h", "1h"): 4, ("1d",): 5, ("4h",): 6, ("1h",): 6}
MOST_DISTANCE, MOST_SPAN = 0.10, 0.20


def candidates(numbered: DataFrame) -> DataFrame:
    """Two rows per candle, side HIGH and LOW: price, status, mitigation, chain and distance columns."""
    base = with_suffix_extremes(with_atr(numbered)).join(first_reaches(numbered), [*SERIES, "row"])
    ends = numbered.groupBy(*SERIES).agg(F.max("row").alias("last_row"), F.max_by("close", "row").alias("final_close"))
    base = base.join(ends, SERIES)
    side = lambda name, price, later, reach, close: F.struct(F.lit(name).alias("side"), F.col(price).alias("price"), F.col(later).alias("later"), F.col(reach).alias("reach"), F.col(close).alias("close_reach"))
    both = base.select("*", F.explode(F.array(side("HIGH", "high", "later_high", "reach_high", "close_reach_high"), side("LOW", "low", "later_low", "reach_low", "close_reach_low"))).alias("c"))
    high = F.col("c.side") == "HIGH"
    wick = F.when(high, bars.upper_wick()).otherwise(bars.lower_wick())
    status = F.when(F.col("row") == F.col("last_row"), TERMINAL).when(F.col("c.reach").isNotNull(), MITIGATED).otherwise(OPEN)
    miss = F.when(high, F.col("c.price") - F.col("c.later")).otherwise(F.col("c.later") - F.col("c.price"))
    rows = both.select(
        *SERIES, "c.side", "row", "open_time", "close_time", "c.price", status.alias("status"), F.col("c.reach").alias("mitigation_row"), F.col("c.close_reach").alias("close_row"),
        F.when(wick > 0, "WICK").otherwise("BODY").alias("origin"), wick.alias("wick"), "atr", "final_close", (F.col("last_row") - F.col("row")).alias("future_bars"), (F.col("last_row") + 1).alias("all_bars"),
        ((status == OPEN) & ~bars.at_least_percent(miss, F.col("c.price"), NEAR_MISS) | ((status == OPEN) & (miss * 100 == F.col("c.price") * F.lit(NEAR_MISS).cast("decimal(8,4)")))).alias("near_miss"),
    )
    hit = numbered.select(*SERIES, F.col("row").cast("bigint").alias("mitigation_row"), F.struct("open", "high", "low", "close", "open_time").alias("m"))
    rows = rows.join(hit, [*SERIES, "mitigation_row"], "left")
    up = F.col("side") == "HIGH"
    sign = F.when(up, 1).otherwise(-1)
    beyond = lambda c: sign * (F.col(f"m.{c}") - F.col("price"))
    reach = F.when(up, F.col("m.high")).otherwise(F.col("m.low"))
    mechanism = (
        F.when(F.col("m").isNull(), None)
        .when(beyond("open") >= 0, "GAP_OPEN_AT_OR_BEYOND")
        .when(reach == F.col("price"), "EXACT_EXTREME_TOUCH")
        .when(beyond("close") >= 0, "CLOSE_AT_OR_BEYOND")
        .otherwise("WICK_REACH")
    )
    chain = Window.partitionBy(*SERIES, "side", "price")
    order = chain.orderBy("row")
    return rows.select(
        "*", mechanism.alias("mechanism"), F.when(F.col("m").isNotNull(), sign * (reach - F.col("price"))).alias("penetration"), F.col("m.open_time").alias("mitigation_time"),
        F.row_number().over(order).alias("chain_position"), F.count(F.lit(1)).over(chain).alias("chain_length"), F.lag("row").over(order).alias("chain_previous"), F.lead("row").over(order).alias("chain_next"),
        ((F.lead("row").over(order).isNull()) & (F.col("status") == OPEN)).alias("chain_survivor"),
    ).drop("m")


def observation_label(future_bars, all_bars):
    """Share of the history that has passed since: under 1, 5 and 20 percent, or more."""
    share = future_bars * 100
    return F.concat(F.when(share < all_bars, "VERY_LOW").when(share < all_bars * 5, "LOW").when(share < all_bars * 20, "MODERATE").otherwise("HIGH"), F.lit("_FUTURE_OBSERVATION"))


def ranked_open(found: DataFrame) -> DataFrame:
    """Open candidates with their distance to the series' final close and five ranks in (series, side)."""
    rows = found.filter(F.col("status") == OPEN)
    distance = F.abs(F.col("price") - F.col("final_close"))
    rows = rows.withColumns({"distance": distance, "distance_percent": (distance.cast("double") / F.col("final_close").cast("double") * 100), "distance_atr": F.when(F.col("atr") > 0, distance.cast("double") / F.col("atr")), "wick_atr": F.when(F.col("atr") > 0, F.col("wick").cast("double") / F.col("atr"))})
    side = Window.partitionBy(*SERIES, "side")
    order = lambda *keys: F.row_number().over(side.orderBy(*keys))
    wick = F.desc_nulls_last("wick_atr")
    return rows.withColumns(
        {
            "rank_nearest": order("distance", F.desc("future_bars"), wick, F.desc("open_time"), "row"),
            "rank_oldest": order("open_time", "row"),
            "rank_newest": order(F.desc("open_time"), "row"),
            "rank_wick": order(wick, "distance", "row"),
            "rank_observed": order(F.desc("future_bars"), "distance", "row"),
            "observation": observation_label(F.col("future_bars"), F.col("all_bars")),
        }
    )


def monthly_origins(found: DataFrame) -> DataFrame:
    """Candidates by series, side and month of origin with counts by status."""
    count = lambda s: F.count_if(F.col("status") == s).alias
    return found.groupBy(*SERIES, "side", bars.month_key().alias("month")).agg(F.count(F.lit(1)).alias("candidates"), count(OPEN)("open"), count(MITIGATED)("mitigated"), count(TERMINAL)("terminal"), F.count("close_row").alias("closed_beyond"))


def mechanism_counts(found: DataFrame) -> DataFrame:
    return found.filter("mechanism IS NOT NULL").groupBy(*SERIES, "side", "mechanism").count()


def relative(a: float, b: float) -> float:
    """|a - b| in percent of their midpoint; equal prices, two zeros included, are 0 apart."""
    return abs(a - b) / ((a + b) / 2) * 100 if a != b else 0.0


def attach(levels: list[dict]) -> list[list[int]]:
    """Groups of open levels of one side: indices of members, the anchor first.

    For each parent timeframe from coarse to fine, then each child timeframe below it, all parent-child pairs within
    MOST_DISTANCE percent of the anchor are taken nearest first; a pair is used if the child is free, the parent leads its
    group, the group's slot for the child's timeframe is empty and the group's span stays within MOST_SPAN percent.
    """
    leader: dict[int, int] = {}
    groups: dict[int, list[int]] = {}
    for p, parent_tf in enumerate(SLOTS):
        own = [i for i, x in enumerate(levels) if x["timeframe"] == parent_tf and i not in leader]
        for i in own:
            leader[i], groups[i] = i, [i]
        own.sort(key=lambda i: levels[i]["price"])
        for child_tf in SLOTS[p + 1 :]:
            free = sorted((i for i, x in enumerate(levels) if x["timeframe"] == child_tf and i not in leader), key=lambda i: levels[i]["price"])
            pairs, lo = [], 0
            for i in own:
                price = levels[i]["price"]
                while lo < len(free) and levels[free[lo]]["price"] < price and relative(levels[free[lo]]["price"], price) > MOST_DISTANCE:
                    lo += 1
                k = lo
                while k < len(free) and (levels[free[k]]["price"] <= price or relative(levels[free[k]]["price"], price) <= MOST_DISTANCE):
                    if relative(levels[free[k]]["price"], price) <= MOST_DISTANCE:
                        pairs.append((relative(levels[free[k]]["price"], price), levels[i]["id"], levels[free[k]]["id"], i, free[k]))
                    k += 1
            for _, _, _, i, j in sorted(pairs):
                members = groups[i]
                prices = [levels[m]["price"] for m in members] + [levels[j]["price"]]
                if j in leader or any(levels[m]["timeframe"] == child_tf for m in members) or relative(min(prices), max(prices)) > MOST_SPAN:
                    continue
                members.append(j)
                leader[j] = i
    return list(groups.values())


def hierarchy(ranked: DataFrame) -> DataFrame:
    """Groups of open levels across timeframes, one row per group, ranked in (symbol, side).

    The distance is measured to the final close of the finest timeframe there is. Greedy choice is sequential, so each (symbol,
    side) is one task over its open levels only.
    """
    rows = ranked.select("symbol", "side", "timeframe", F.concat_ws("-", "timeframe", "side", F.lpad(F.col("row").cast("string"), 8, "0")).alias("id"), F.col("price").cast("double").alias("price"), F.col("final_close").cast("double").alias("final_close"), "future_bars", F.unix_micros(F.col("open_time").cast("timestamp")).alias("opened"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = pdf.sort_values("id").to_dict("records")
        finest = min(levels, key=lambda x: HOURS[x["timeframe"]])["final_close"]
        out = []
        for members in attach(levels):
            group = [levels[m] for m in members]
            slots = tuple(s for s in SLOTS if any(x["timeframe"] == s for x in group))
            prices = sorted(x["price"] for x in group)
            mid = (prices[0] + prices[-1]) / 2
            out.append({"tier": TIERS[slots], "slots": ",".join(slots), "members": ",".join(x["id"] for x in group), "price": mid, "span_percent": relative(prices[0], prices[-1]), "distance": abs(mid - finest), "observed_hours": max(x["future_bars"] * HOURS[x["timeframe"]] for x in group), "oldest": min(x["opened"] for x in group)})
        out.sort(key=lambda g: (g["tier"], g["distance"], -g["observed_hours"], g["oldest"], g["price"]))
        frame = pd.DataFrame(out, columns=["tier", "slots", "members", "price", "span_percent", "distance", "observed_hours", "oldest"])
        frame.insert(0, "rank", range(1, len(frame) + 1))
        frame.insert(0, "side", pdf["side"].iloc[0])
        frame.insert(0, "symbol", pdf["symbol"].iloc[0])
        return frame

    return rows.groupBy("symbol", "side").applyInPandas(build, "symbol string, side string, rank bigint, tier bigint, slots string, members string, price double, span_percent double, distance double, observed_hours bigint, oldest bigint")
