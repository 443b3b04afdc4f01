"""Price levels by how often candles touch them, and their hierarchy across timeframes.

Densities come from interval end points: a candle adds +1 at its first bin and -1 behind its last, and a running sum over bins
gives the counts. Work is a few rows per candle, however many bins its range spans.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators.access import SERIES
from candlewright.operators.features import average_rank_percentile, series

#: Grid ratio, half-width of a zone, neighbourhood of a peak, and minima by timeframe.
RATIO, HALF_ZONE, PEAK_REACH, NEAR = 1.001, 0.001, 5, 0.50
MIN_TOUCHES, MIN_EPISODES, MIN_DATES = {"1h": 40, "4h": 20, "1d": 10}, 3, 3
STEP = math.log(RATIO)
WEIGHTS = {"1d": 4, "4h": 2, "1h": 1}
COARSE = 256


def power(k: Column) -> Column:
    return F.pow(F.lit(RATIO), k)


def first_bin(price: Column) -> Column:
    """Least k whose upper edge 1.001^(k + 1/2) is at or above a price; the logarithm's guess is tested one bin around."""
    k = F.floor(F.log(price) / STEP - 0.5) - 1
    fits = lambda j: power(k + j + 0.5) >= price
    return F.when(fits(0), k).when(fits(1), k + 1).when(fits(2), k + 2).otherwise(k + 3).cast("bigint")


def last_bin(price: Column) -> Column:
    """Greatest k whose lower edge 1.001^(k - 1/2) is at or below a price."""
    k = F.floor(F.log(price) / STEP + 0.5) + 2
    fits = lambda j: power(k - j - 0.5) <= price
    return F.when(fits(0), k).when(fits(1), k - 1).when(fits(2), k - 2).otherwise(k - 3).cast("bigint")


def binned(numbered: DataFrame) -> DataFrame:
    price = lambda c: F.col(c).cast("double")
    return numbered.withColumns({"klo": first_bin(price("low")), "khi": last_bin(price("high")), "kclose_lo": first_bin(price("close")), "kclose_hi": last_bin(price("close"))})


def spread(intervals: DataFrame, name: str) -> DataFrame:
    """End points of intervals (lo, hi) as (bin, name: +1 or -1)."""
    ends = F.array(F.struct(F.col("lo").alias("bin"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("bin"), F.lit(-1).alias("d")))
    return intervals.filter("lo <= hi").select(*SERIES, F.explode(ends).alias("e")).select(*SERIES, "e.bin", F.col("e.d").alias(name))


def density(numbered: DataFrame) -> DataFrame:
    """Per bin of the grid: touches, episodes (touches whose row before does not touch), close_inside, months, smoothed."""
    rows = binned(numbered)
    w = series()
    plo, phi = F.lag("klo").over(w), F.lag("khi").over(w)
    # bins of a candle that the row before does not touch: below it, and above it
    new = rows.withColumns({"plo": plo, "phi": phi}).select(
        *SERIES, F.explode(F.when(F.col("plo").isNull(), F.array(F.struct(F.col("klo").alias("lo"), F.col("khi").alias("hi")))).otherwise(
            F.array(F.struct(F.col("klo").alias("lo"), F.least("khi", F.col("plo") - 1).alias("hi")), F.struct(F.greatest("klo", F.col("phi") + 1).alias("lo"), F.col("khi").alias("hi"))))).alias("i")
    ).select(*SERIES, "i.lo", "i.hi")
    month = Window.partitionBy(*SERIES, "month").orderBy("klo", "khi")
    in_month = rows.withColumn("month", bars.month_key()).withColumn("reach", F.max("khi").over(month.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = in_month.select(*SERIES, F.greatest("klo", F.coalesce(F.col("reach") + 1, "klo")).alias("lo"), F.col("khi").alias("hi"))
    parts = [
        spread(rows.select(*SERIES, F.col("klo").alias("lo"), F.col("khi").alias("hi")), "touches"),
        spread(new, "episodes"),
        spread(rows.select(*SERIES, F.col("kclose_lo").alias("lo"), F.col("kclose_hi").alias("hi")), "close_inside"),
        spread(fresh, "months"),
    ]
    names = ["touches", "episodes", "close_inside", "months"]
    deltas = parts[0]
    for p in parts[1:]:
        deltas = deltas.unionByName(p, allowMissingColumns=True)
    deltas = deltas.groupBy(*SERIES, "bin").agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    ends = rows.groupBy(*SERIES).agg((F.min("klo") - 2).alias("k0"), (F.max("khi") + 2).alias("k1"))
    # the timeframes of a symbol share one grid
    shared = Window.partitionBy("symbol")
    ends = ends.withColumns({"k0": F.min("k0").over(shared), "k1": F.max("k1").over(shared)})
    grid = ends.select(*SERIES, F.explode(F.sequence("k0", "k1")).alias("bin"))
    over = Window.partitionBy(*SERIES).orderBy("bin")
    dense = grid.join(deltas, [*SERIES, "bin"], "left").select(*SERIES, "bin", *(F.sum(F.coalesce(F.col(n), F.lit(0))).over(over).alias(n) for n in names))
    side = lambda f: F.coalesce(f("touches").over(over), F.lit(0)) * 0.25
    return dense.withColumn("smoothed", side(F.lag) + F.col("touches") * 0.5 + side(F.lead))


def peaks(numbered: DataFrame) -> DataFrame:
    """Bins whose smoothed density no bin within 5 exceeds; ties fall to more touches, episodes, months, closes inside, the
    earlier first touch, the lower bin. Columns: bin, center, zone_lower, zone_upper and the density's."""
    dense = density(numbered).filter("touches > 0")
    reach = Window.partitionBy(*SERIES).orderBy("bin").rangeBetween(-PEAK_REACH, PEAK_REACH)
    key = F.struct("smoothed", "touches", "episodes", "months", "close_inside")
    best = dense.withColumn("key", key).withColumn("top", F.max("key").over(reach)).filter("key = top").drop("top")
    # bins around with the same key contend; only where there are several does the first touch decide
    around = best.select(*SERIES, F.col("bin").alias("peak"), "key", F.explode(F.sequence(F.col("bin") - PEAK_REACH, F.col("bin") + PEAK_REACH)).alias("bin"))
    rivals = around.join(dense.select(*SERIES, "bin", key.alias("own")), [*SERIES, "bin"]).filter("own = key").select(*SERIES, "peak", "bin")
    several = rivals.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*SERIES, "peak"))).filter("n > 1")
    rows = binned(numbered).select(*SERIES, "klo", "khi", F.col("row").alias("first"))
    spans = rows.withColumn("part", F.explode(F.sequence(F.floor(F.col("klo") / COARSE), F.floor(F.col("khi") / COARSE))))
    tied = several.select(*SERIES, "bin", F.floor(F.col("bin") / COARSE).alias("part")).distinct()
    first = tied.join(spans, [*SERIES, "part"]).filter("bin BETWEEN klo AND khi").groupBy(*SERIES, "bin").agg(F.min("first").alias("first"))
    lost = several.join(first, [*SERIES, "bin"]).groupBy(*SERIES, "peak").agg(F.min(F.struct("first", "bin")).alias("w")).filter("w.bin <> peak").select(*SERIES, F.col("peak").alias("bin"))
    kept = best.join(lost, [*SERIES, "bin"], "left_anti")
    center = power(F.col("bin"))
    return kept.select(*SERIES, "bin", center.alias("center"), (center * (1 - HALF_ZONE)).alias("zone_lower"), (center * (1 + HALF_ZONE)).alias("zone_upper"), "touches", "episodes", "months", "close_inside", "smoothed")


def touches(numbered: DataFrame, zones: DataFrame) -> DataFrame:
    """Every candle in every zone (bin, zone_lower, zone_upper) it touches, with type, flags and whether an episode begins.

    Candles meet zones through coarse ranges of bins; a zone lies in one, so a pair is found once.
    """
    rows = binned(numbered.withColumn("before", F.lag("close").over(series())))
    part = F.explode(F.sequence(F.floor((F.col("klo") - 2) / COARSE), F.floor((F.col("khi") + 2) / COARSE)))
    z = zones.select(*SERIES, "bin", "zone_lower", "zone_upper", F.floor(F.col("bin") / COARSE).alias("part"))
    lo, hi = F.col("zone_lower"), F.col("zone_upper")
    met = rows.withColumn("part", part).join(z, [*SERIES, "part"]).filter(bars.touches(lo, hi))
    last = F.lag("row").over(Window.partitionBy(*SERIES, "bin").orderBy("row"))
    return met.select(*SERIES, "bin", "row", "open_time", "close_time", bars.touch_type(lo, hi).alias("touch_type"), *(v.alias(k) for k, v in bars.interaction_flags(lo, hi, F.col("before")).items())).withColumn("episode_start", F.coalesce(last != F.col("row") - 1, F.lit(True)))


#: Labels of how touches spread over time, in the order of their rules.
PERSISTENCE = ["RECENT_OR_EMERGING", "FREQUENT_BUT_CONCENTRATED", "FREQUENT_AND_PERSISTENT", "INFREQUENT_BUT_PERSISTENT"]


def level_stats(met: DataFrame) -> DataFrame:
    """Exact statistics of each zone's touches."""
    count = lambda t: F.count_if(F.col("touch_type") == t)
    by_month = met.groupBy(*SERIES, "bin", bars.month_key().alias("month")).agg(F.count(F.lit(1)).alias("n")).groupBy(*SERIES, "bin").agg(F.max("n").alias("busiest_month"))
    out = met.groupBy(*SERIES, "bin").agg(
        F.count(F.lit(1)).alias("touches"), F.count_if("episode_start").alias("episodes"), count("CLOSE_INSIDE").alias("close_inside"), count("BODY").alias("body"), count("WICK").alias("wick"),
        F.count_distinct(F.to_date("open_time")).alias("dates"), F.count_distinct(bars.week_key()).alias("weeks"), F.count_distinct(bars.month_key()).alias("months"), F.count_distinct(bars.quarter_key()).alias("quarters"), F.count_distinct(F.year("open_time")).alias("years"),
        F.min("open_time").alias("first_touch"), F.max("open_time").alias("last_touch"),
        *(F.count_if(f).alias(f"n_{f}") for f in ("open_inside", "crosses", "from_above", "from_below", "bullish", "bearish", "doji")),
    ).join(by_month, [*SERIES, "bin"])
    share = F.col("busiest_month") / F.col("touches")
    days = F.datediff("last_touch", "first_touch")
    label = F.when((F.col("months") <= 2) | (days < 60), PERSISTENCE[0]).when(share >= 0.45, PERSISTENCE[1]).when((F.col("months") >= 6) & (share <= 0.35), PERSISTENCE[2]).otherwise(PERSISTENCE[3])
    return out.withColumns({"engagement": (F.col("close_inside") + F.col("body")) / F.col("touches"), "busiest_share": share, "persistence": label})


def episode_gaps(met: DataFrame) -> DataFrame:
    """Rows between the starts of consecutive episodes of a zone: mean and median."""
    starts = met.filter("episode_start").withColumn("gap", F.col("row") - F.lag("row").over(Window.partitionBy(*SERIES, "bin").orderBy("row")))
    return starts.groupBy(*SERIES, "bin").agg(F.avg("gap").alias("gap_mean"), F.median("gap").alias("gap_median"))


def minimum(table: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for tf, n in table.items():
        out = F.when(F.col("timeframe") == tf, n).otherwise(out)
    return out


def qualified(stats: DataFrame, minima: dict[str, int] | None = None) -> DataFrame:
    """With ``reasons`` (what falls short) and ``qualifies``."""
    least = F.coalesce(minimum(minima or MIN_TOUCHES), F.lit(1))
    reasons = F.array_compact(F.array(F.when(F.col("touches") < least, "TOUCHES"), F.when(F.col("episodes") < MIN_EPISODES, "EPISODES"), F.when(F.col("dates") < MIN_DATES, "DATES")))
    return stats.withColumn("reasons", reasons).withColumn("qualifies", F.size(reasons) == 0)


def first_eligible(met: DataFrame, minima: dict[str, int] | None = None) -> DataFrame:
    """close_time of the touch at which all minima are first met; zones that never meet them have no row."""
    w = Window.partitionBy(*SERIES, "bin").orderBy("row")
    day = F.row_number().over(Window.partitionBy(*SERIES, "bin", F.to_date("open_time")).orderBy("row")) == 1
    run = met.withColumn("_new_day", day).withColumns({"n": F.row_number().over(w), "e": F.sum(F.col("episode_start").cast("int")).over(w), "d": F.sum(F.col("_new_day").cast("int")).over(w)})
    least = F.coalesce(minimum(minima or MIN_TOUCHES), F.lit(1))
    return run.filter((F.col("n") >= least) & (F.col("e") >= MIN_EPISODES) & (F.col("d") >= MIN_DATES)).groupBy(*SERIES, "bin").agg(F.min("close_time").alias("first_eligible"))


def suppressed(levels: DataFrame) -> DataFrame:
    """Levels with ``accepted`` and ``suppressed_by`` (bin of the first accepted stronger level nearer than NEAR percent).

    Greedy by touches, episodes, months, closes inside, bin; sequential over the levels of a series, which are few.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values(["touches", "episodes", "months", "close_inside", "bin"], ascending=[False, False, False, False, True])
        taken: list[tuple[float, int]] = []
        by = {}
        for k, c in zip(order["bin"], order["center"]):
            by[k] = next((b for x, b in taken if abs(x - c) / ((x + c) / 2) * 100 < NEAR), None)
            if by[k] is None:
                taken.append((c, k))
        out = pdf[[*SERIES, "bin"]].copy()
        out["suppressed_by"] = pd.array([by[k] for k in pdf["bin"]], dtype="Int64")
        out["accepted"] = out["suppressed_by"].isna()
        return out

    picked = levels.select(*SERIES, "bin", "center", "touches", "episodes", "months", "close_inside").groupBy(*SERIES).applyInPandas(pick, "symbol string, timeframe string, bin bigint, suppressed_by bigint, accepted boolean")
    return levels.join(picked, [*SERIES, "bin"])


def analyse(numbered: DataFrame, minima: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """peaks, touches, levels (statistics, acceptance, qualification, percentiles, ranks) and groups."""
    found = peaks(numbered)
    met = touches(numbered, found)
    stats = level_stats(met).join(found.select(*SERIES, "bin", "center", "zone_lower", "zone_upper"), [*SERIES, "bin"])
    levels = qualified(suppressed(stats), minima).join(first_eligible(met, minima), [*SERIES, "bin"], "left")
    good = levels.filter("accepted AND qualifies")
    for c in ("touches", "episodes", "months", "engagement"):
        good = average_rank_percentile(good, c, SERIES, f"{c}_pct")
    order = Window.partitionBy(*SERIES).orderBy(F.desc("touches"), F.desc("episodes"), F.desc("months"), F.desc("close_inside"), "bin")
    by_price = Window.partitionBy(*SERIES).orderBy("center")
    good = good.withColumns({"rank": F.row_number().over(order), "id": F.concat_ws("-", "timeframe", F.lpad(F.row_number().over(by_price).cast("string"), 6, "0"))})
    return {"peaks": found, "touches": met, "levels": levels, "accepted": good, "groups": hierarchy(good)}


def grouped(levels: list[dict]) -> list[dict]:
    """Groups {anchor, members by timeframe, prices}. Each free child, coarse to fine, takes the first parent, in order of
    (timeframe, distance, touch percentile, episode percentile, id), whose zone it overlaps or is within 0.30 percent of, if
    the group's prices then span at most 0.60 percent. A second child of a timeframe replaces the first in ``members`` while
    both prices stay in ``prices``."""
    order = ["1d", "4h", "1h"]
    relative = lambda a, b: abs(a - b) / ((a + b) / 2) * 100
    groups: list[dict] = []
    for tf in order:
        own = sorted((x for x in levels if x["timeframe"] == tf), key=lambda x: x["id"])
        parents = list(groups)
        for x in own:
            near = []
            for g in parents:
                a = g["anchor"]
                overlap = a["zone_lower"] <= x["zone_upper"] and x["zone_lower"] <= a["zone_upper"]
                distance = relative(a["center"], x["center"])
                if overlap or distance <= 0.30:
                    near.append((order.index(a["timeframe"]), distance, -a["touches_pct"], -a["episodes_pct"], a["id"], g))
            for *_, g in sorted(near, key=lambda t: t[:5]):
                prices = [*g["prices"], x["center"]]
                if relative(min(prices), max(prices)) <= 0.60:
                    g["members"][tf], g["prices"] = x, prices
                    break
            else:
                groups.append({"anchor": x, "members": {tf: x}, "prices": [x["center"]]})
    return groups


def hierarchy(good: DataFrame) -> DataFrame:
    """One row per group, ranked per symbol by tier, then score 100 (.60 touch + .20 episode + .15 months + .05 engagement),
    each a mean of percentiles weighted 4 / 2 / 1 by timeframe. Sequential over the accepted levels of a symbol."""
    from candlewright.operators.open_liquidity import TIERS

    keep = ["symbol", "timeframe", "id", "center", "zone_lower", "zone_upper", "touches_pct", "episodes_pct", "months_pct", "engagement_pct", "episodes"]
    times = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("first_touch", "last_touch", "first_eligible")]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for g in grouped(pdf.to_dict("records")):
            tfs = [t for t in WEIGHTS if t in g["members"]]
            ms = [g["members"][t] for t in tfs]
            total = sum(WEIGHTS[t] for t in tfs)
            mean = lambda c: sum(WEIGHTS[t] * m[c] for t, m in zip(tfs, ms)) / total  # noqa: B023, E731
            score = 100 * (0.60 * mean("touches_pct") + 0.20 * mean("episodes_pct") + 0.15 * mean("months_pct") + 0.05 * mean("engagement_pct"))
            out.append({"tier": TIERS[tuple(tfs)], "score": score, "slots": ",".join(tfs), "members": ",".join(m["id"] for m in ms), "price": (min(g["prices"]) + max(g["prices"])) / 2, "visits": int(ms[-1]["episodes"]), "first_touch": min(m["first_touch"] for m in ms), "last_touch": max(m["last_touch"] for m in ms), "first_eligible": max(m["first_eligible"] for m in ms)})
        out.sort(key=lambda r: (r["tier"], -r["score"], r["price"]))
        frame = pd.DataFrame(out, columns=["tier", "score", "slots", "members", "price", "visits", "first_touch", "last_touch", "first_eligible"])
        frame.insert(0, "rank", range(1, len(frame) + 1))
        frame.insert(0, "symbol", pdf["symbol"].iloc[0])
        return frame

    schema = "symbol string, rank bigint, tier bigint, score double, slots string, members string, price double, visits bigint, first_touch bigint, last_touch bigint, first_eligible bigint"
    return good.select(*keep, *times).groupBy("symbol").applyInPandas(build, schema)
