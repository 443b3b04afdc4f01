"""Bounded open/close swings: an opening candle, a binding close within a few candles, and an extreme between them.

LOW swings are HIGH swings of negated prices, so both sides share every expression.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators.access import SERIES
from candlewright.operators.features import series


def signed(row: Column, up: Column) -> Column:
    """A candle as its side sees it: prices negated, high and low exchanged for LOW."""
    pick = lambda a, b: F.when(up, row[a]).otherwise(-row[b])
    return F.struct(pick("open", "open").alias("o"), pick("high", "low").alias("h"), pick("low", "high").alias("l"), pick("close", "close").alias("c"))


def openings(numbered: DataFrame, reach: int) -> DataFrame:
    """Candles with their side (HIGH if bullish, LOW if bearish; dojis go), their signed self ``b`` and up to ``reach`` signed later ones ``f``."""
    candle = F.struct("open", "high", "low", "close")
    ahead = F.collect_list(candle).over(series().rowsBetween(1, reach))
    rows = numbered.withColumns({"_f": ahead, "side": F.when(F.col("close") > F.col("open"), "HIGH").when(F.col("close") < F.col("open"), "LOW")}).filter("side IS NOT NULL")
    up = F.col("side") == "HIGH"
    return rows.select(*SERIES, "row", "open_time", "side", signed(candle, up).alias("b"), F.transform("_f", lambda x: signed(x, up)).alias("f"))


def enough(distance: Column, reference: Column, percent: str) -> Column:
    return bars.at_least_percent(distance, F.abs(reference), percent)


def interior(k: Column) -> Column:
    """Candles strictly between the opening and offset k."""
    return F.slice("f", 1, k - 1)


def extreme_fields(swings: DataFrame) -> DataFrame:
    """The interior extreme of (f, k): price and its last plateau as rows."""
    highs = F.transform(interior(F.col("k")), lambda x: x["h"])
    with_peak = swings.withColumn("peak", F.array_max(highs)).withColumn("_hit", F.transform(highs, lambda h: h == F.col("peak")))
    last = F.col("k") - F.array_position(F.reverse("_hit"), True).cast("int")
    before = F.reverse(F.slice("_hit", 1, F.col("_last")))
    start = F.col("_last") - F.when(F.array_position(before, False) == 0, F.size(before)).otherwise(F.array_position(before, False) - 1).cast("int") + 1
    with_last = with_peak.withColumn("_last", last).withColumn("_start", start)
    return with_last.withColumns({"plateau_start": F.col("row") + F.col("_start"), "plateau_end": F.col("row") + F.col("_last")}).drop("_hit", "_last", "_start")


def search_30m(numbered: DataFrame, percent: str = "1.00") -> DataFrame:
    """30-minute search: one row per opening that binds, with reason OK or the failed boundary.

    The close is one of the candles +7 to +10. It penetrates the opening body by a third to five thirds of it, points against
    the opening, and does not lie beyond the low of the interior reference: the pair's first candle, against the opening and
    followed by one along with it, of lowest close (last of equals), two rows before the close at the latest. The first close to
    do so binds, and then the interior extreme must stand ``percent`` off the opening's open and the close.
    """
    rows = openings(numbered, 10).withColumn("k", F.explode(F.filter(F.array(*map(F.lit, range(7, 11))), lambda k: k <= F.size("f"))))
    close = F.get("f", F.col("k") - 1)
    body = F.col("b.c") - F.col("b.o")
    depth = F.col("b.c") - F.col("z.c")
    rows = rows.withColumn("z", close).filter((depth >= 0) & (3 * depth >= body) & (3 * depth <= 5 * body) & (F.col("z.c") < F.col("z.o")))
    place = F.sequence(F.lit(0), F.col("k") - 3)  # interior offsets 1 .. k - 2, whose follower is interior too
    pair = F.filter(place, lambda i: (F.get("f", i)["c"] < F.get("f", i)["o"]) & (F.get("f", i + 1)["c"] > F.get("f", i + 1)["o"]))
    lowest = F.array_min(F.transform(pair, lambda i: F.struct(F.get("f", i)["c"].alias("c"), (-i).alias("i"))))
    rows = rows.withColumn("_ref", lowest).withColumn("reference_offset", -F.col("_ref.i") + 1)
    reference = F.get("f", F.col("reference_offset") - 1)
    rows = rows.filter(F.col("_ref").isNull() | (reference["l"] >= F.col("z.c")))
    return bound(rows.drop("_ref"), percent, "NORMAL")


def bound(rows: DataFrame, percent: str, kind: str) -> DataFrame:
    """The first binding close of each opening with its extreme and boundaries."""
    first = Window.partitionBy(*SERIES, "row").orderBy("k")
    rows = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return judged(extreme_fields(rows), percent, 2 * F.col("b.c") + F.col("b.o"), 3).withColumn("kind", F.lit(kind))


def judged(rows: DataFrame, percent: str, target: Column, parts: int) -> DataFrame:
    """With boundaries, reason, penetration, and ``completion_error``: how far, in percent, the close is from ``target`` / ``parts``, the price that it had to reach."""
    opening, closing = F.col("peak") - F.col("b.o"), F.col("peak") - F.col("z.c")
    reason = F.when(~enough(opening, F.col("b.o"), percent), "OPEN_BOUNDARY").when(~enough(closing, F.col("z.c"), percent), "CLOSE_BOUNDARY").otherwise("OK")
    of = lambda d, r: F.round(d.cast("double") / F.abs(r).cast("double") * 100, 10)
    body = F.abs(F.col("b.c") - F.col("b.o"))
    depth = F.when(body > 0, F.round((F.col("b.c") - F.col("z.c")).cast("double") / body.cast("double"), 10))
    error = of(F.abs(parts * F.col("z.c") - target), target)
    return rows.withColumns({"reason": reason, "completion_error": error, "open_percent": of(opening, F.col("b.o")), "close_percent": of(closing, F.col("z.c")), "penetration": depth, "price": F.abs("peak"), "close_row": F.col("row") + F.col("k")})


def search_4h(numbered: DataFrame, percent: str = "1.30") -> DataFrame:
    """4-hour search. If the next candle closes back at or beyond the opening's open, the swing is of kind ZERO: the two must
    point in opposite directions, the extreme is the greater of their highs, and the search ends whether it passes or not. Else
    the first close in +2 .. +6 that is a third of the body or more below its top binds."""
    rows = openings(numbered, 6).filter(F.size("f") >= 1)
    nxt = F.get("f", F.lit(0))
    full = nxt["c"] <= F.col("b.o")
    zero = rows.filter(full).withColumns({"k": F.lit(1), "z": nxt})
    peak = F.greatest(F.col("b.h"), F.col("z.h"))
    zero = zero.withColumns({"peak": peak, "plateau_start": F.when(F.col("b.h") == peak, F.col("row")).otherwise(F.col("row") + 1), "plateau_end": F.when(F.col("z.h") == peak, F.col("row") + 1).otherwise(F.col("row"))})
    zero = judged(zero, percent, F.col("b.o"), 1).withColumn("reason", F.when(F.col("z.c") >= F.col("z.o"), "DIRECTION").otherwise(F.col("reason"))).withColumn("kind", F.lit("ZERO"))
    later = rows.filter(~full).withColumn("k", F.explode(F.filter(F.array(*map(F.lit, range(2, 7))), lambda k: k <= F.size("f")))).withColumn("z", F.get("f", F.col("k") - 1))
    depth = F.col("b.c") - F.col("z.c")
    return zero.unionByName(bound(later.filter(3 * depth >= F.col("b.c") - F.col("b.o")), percent, "NORMAL"), allowMissingColumns=True)


def families(found: DataFrame) -> DataFrame:
    """Passing swings as events: of those with one side, price and plateau the first by key (length, completion error, lesser
    boundary descending, close, opening descending) is PRIMARY, the rest DERIVED."""
    rows = found.filter("reason = 'OK'").withColumn("event_id", F.concat_ws("|", "side", F.col("price").cast("string"), "plateau_start", "plateau_end"))
    key = [F.col("close_row") - F.col("row"), "completion_error", F.desc(F.least("open_percent", "close_percent")), F.col("close_row"), F.desc("row")]
    order = Window.partitionBy(*SERIES, "event_id").orderBy(*key)
    return rows.withColumn("family", F.when(F.row_number().over(order) == 1, "PRIMARY").otherwise("DERIVED")).drop("b", "f", "z", "peak")


def resolve(swings: list[dict]) -> dict[int, str]:
    """index -> KEPT, NESTED or LONGER for the primaries of one series and side.

    Swings are in one cluster if they overlap in time and one's extreme lies in the other's span. Of a cluster the first by key
    stays; a loser is NESTED if it lies strictly inside another member and does not contain the winner, else LONGER.
    """
    order = sorted(range(len(swings)), key=lambda i: swings[i]["row"])
    parent = list(range(len(swings)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    live: list[int] = []
    for i in order:
        a = swings[i]
        live = [j for j in live if swings[j]["close_row"] >= a["row"]]
        for j in live:
            b = swings[j]
            if b["row"] <= a["plateau_end"] <= b["close_row"] or a["row"] <= b["plateau_end"] <= a["close_row"]:
                parent[root(i)] = root(j)
        live.append(i)
    clusters: dict[int, list[int]] = {}
    for i in range(len(swings)):
        clusters.setdefault(root(i), []).append(i)
    out = {}
    for members in clusters.values():
        best = min(members, key=lambda i: swings[i]["key"])
        w = swings[best]
        for i in members:
            a = swings[i]
            inside = any(b["row"] <= a["row"] and a["close_row"] <= b["close_row"] and (b["row"], b["close_row"]) != (a["row"], a["close_row"]) for b in (swings[j] for j in members))
            holds = a["row"] <= w["row"] and w["close_row"] <= a["close_row"]
            out[i] = "KEPT" if i == best else "NESTED" if inside and not holds else "LONGER"
    return out


def suppress(events: DataFrame) -> DataFrame:
    """Primaries with ``outcome``; a series and side is one task over its passing swings only."""
    rows = events.filter("family = 'PRIMARY'").select(*SERIES, "side", "row", "close_row", "plateau_end", "completion_error", F.least("open_percent", "close_percent").alias("edge"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        swings = pdf.to_dict("records")
        for s in swings:
            s["key"] = (s["close_row"] - s["row"], s["completion_error"], -s["edge"], s["close_row"], -s["row"])
        outcome = resolve(swings)
        out = pdf[[*SERIES, "side", "row"]].copy()
        out["outcome"] = [outcome[i] for i in range(len(swings))]
        return out

    done = rows.groupBy(*SERIES, "side").applyInPandas(run, "symbol string, timeframe string, side string, row int, outcome string")
    return events.join(done, [*SERIES, "side", "row"], "left")


def segments(numbered: DataFrame, swings: DataFrame) -> DataFrame:
    """Highest high and lowest low before and from the plateau's end in each swing; of equals the last counts."""
    s = swings.select(*SERIES, "side", F.col("row").alias("open_row"), "close_row", "plateau_end")
    span = s.withColumn("row", F.explode(F.sequence(F.col("open_row"), F.col("close_row"))))
    joined = span.join(numbered.select(*SERIES, "row", "high", "low"), [*SERIES, "row"])
    part = F.when(F.col("row") <= F.col("plateau_end"), "BEFORE").otherwise("AFTER")
    return joined.groupBy(*SERIES, "side", "open_row", part.alias("part")).agg(F.max(F.struct("high", "row")).alias("h"), F.min(F.struct("low", (-F.col("row")).alias("r"))).alias("l")).select(*SERIES, "side", "open_row", "part", F.col("h.high").alias("high"), F.col("h.row").alias("high_row"), F.col("l.low").alias("low"), (-F.col("l.r")).alias("low_row"))
