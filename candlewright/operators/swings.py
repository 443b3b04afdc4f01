"""Hierarchical swings: formations by window functions, then causal swing engines that read one candle at a time."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators.access import SERIES
from candlewright.operators.features import series, with_atr
from candlewright.operators.special_swings import signed
from candlewright.sources.candles import CandleError

#: Formation lengths and the limits of both engines.
LENGTHS = range(5, 11)
OUTBOUND = "1.00"
INTERNAL = {"displacement": 2.0, "spacing": 6, "reversal": 1.0}
MAJOR = {"displacement": 3.0, "percent": 1.50, "spacing": 12, "prominence": 1.25, "reversal": 1.50, "reversal_percent": 0.75}
TOLERANCE = 0.05


def formations(numbered: DataFrame, percent: str = OUTBOUND) -> DataFrame:
    """Every window of 5 to 10 candles, on both sides, with the label of the first rule it fails, or VALID.

    Rules in order: the extreme is one contiguous plateau; a member of it lies in the central positions (the middle and its
    neighbours, of an even length the middle two); it is ``percent`` off the first candle's close; the last candle's range
    holds that close. The representative is the last plateau member if central, else the latest central one.
    """
    candle = F.struct("open", "high", "low", "close")
    ahead = F.collect_list(candle).over(series().rowsBetween(0, max(LENGTHS) - 1))
    rows = numbered.withColumn("_f", ahead).select(*SERIES, "row", "open_time", "_f", F.explode(F.filter(F.array(*map(F.lit, LENGTHS)), lambda n: n <= F.size("_f"))).alias("length"))
    rows = rows.select("*", F.explode(F.array(F.lit("HIGH"), F.lit("LOW"))).alias("side"))
    up = F.col("side") == "HIGH"
    rows = rows.withColumn("f", F.transform(F.slice("_f", F.lit(1), F.col("length")), lambda x: signed(x, up))).drop("_f")
    top = F.array_max(F.transform("f", lambda x: x["h"]))
    rows = rows.withColumn("peak", top).withColumn("at", F.filter(F.sequence(F.lit(1), F.col("length")), lambda i: F.get("f", i - 1)["h"] == F.col("peak")))
    n = F.col("length")
    low_c = F.when(n % 2 == 1, F.floor((n + 1) / 2) - 1).otherwise(F.floor(n / 2)).cast("int")
    high_c = F.when(n % 2 == 1, F.floor((n + 1) / 2) + 1).otherwise(F.floor(n / 2) + 1).cast("int")
    central = F.filter("at", lambda i: (i >= low_c) & (i <= high_c))
    reference, last = F.get("f", F.lit(0))["c"], F.get("f", n - 1)
    contiguous = F.array_max("at") - F.array_min("at") + 1 == F.size("at")
    label = (
        F.when(~contiguous, "BROKEN_PLATEAU")
        .when(F.size(central) == 0, "NOT_CENTRAL")
        .when(~bars.at_least_percent(F.col("peak") - reference, F.abs(reference), percent), "SMALL_OUTBOUND")
        .when(~((last["l"] <= reference) & (reference <= last["h"])), "NO_REVISIT")
        .otherwise("VALID")
    )
    chosen = F.array_max(central)
    return rows.select(*SERIES, "side", "row", "length", "open_time", label.alias("label"), (F.col("row") + chosen - 1).alias("extreme_row"), F.abs("peak").alias("price"), (F.col("row") + n - 1).alias("close_row"), (F.col("row") + F.array_min("at") - 1).alias("plateau_start"), F.abs(2 * chosen - n - 1).alias("off_centre"))


def emitted(found: DataFrame) -> DataFrame:
    """Valid formations with their causal disposition: EMITTED, INFERIOR (same side, extreme, price and close row, but longer or
    less central) or DUPLICATE (an earlier emission has the same extreme bar, or plateau, of either side)."""
    same = Window.partitionBy(*SERIES, "side", "extreme_row", "price", "close_row").orderBy("off_centre", "length", "row")
    best = found.filter("label = 'VALID'").withColumn("_best", F.row_number().over(same))
    earlier = Window.partitionBy(*SERIES, "extreme_row").orderBy("close_row", "side")
    plateau = Window.partitionBy(*SERIES, "side", "plateau_start", "price").orderBy("close_row")
    one = best.filter("_best = 1").withColumn("_again", (F.row_number().over(earlier) > 1) | (F.row_number().over(plateau) > 1))
    rest = best.filter("_best > 1").withColumn("disposition", F.lit("INFERIOR"))
    return one.withColumn("disposition", F.when(F.col("_again"), "DUPLICATE").otherwise("EMITTED")).drop("_again", "_best").unionByName(rest.drop("_best"))


MOST_CHAINED = 64


class Track:
    """Alternating swings of one level from points (side, sign, price, extreme, atr) that arrive in time.

    The *anchor* is the swing before the one that is looked for. A point is admitted if ``refusal(anchor, point)`` is None. The
    first point that some earlier one admits starts the track: of these the one that ``first`` ranks lowest becomes the anchor, and is
    not itself a swing. While a point is active, one of its side that is admitted and more extreme replaces it, and those of the
    other side are held. A confirmed point is the next anchor; of the held ones, in order, those of the wrong side and those not
    admitted go, the first that is admitted becomes active, and the ones behind it stay held.
    """

    def __init__(self, series: dict):
        self.series = series
        self.seen: list[dict] = []
        self.held: list[dict] = []
        self.swings: list[dict] = []
        self.anchor = self.active = self.wanted = None

    def offer(self, point: dict, row: int) -> None:
        if self.anchor is None:
            self.begin(point, row)
        elif self.active is None:
            if point["side"] == self.wanted and self.refusal(self.anchor, point, row) is None:
                self.active = point
        elif point["side"] != self.active["side"]:
            if self.holds(point):
                self.held.append(point)
        elif self.refusal(self.anchor, point, row) is None and point["sign"] * (point["price"] - self.active["price"]) > 0:
            self.active = point

    def begin(self, point: dict, row: int) -> None:
        fits = [p for p in self.seen if self.starts(p, point) and self.refusal(p, point, row) is None]
        self.seen.append(point)
        if fits:
            self.anchor = min(fits, key=lambda p: self.first(p, point))
            self.active, self.wanted, self.seen = point, point["side"], []

    def settle(self, row: int) -> list[dict]:
        """The points that the close of this row confirms; more than MOST_CHAINED in one row are an error."""
        done: list[dict] = []
        while len(done) < MOST_CHAINED:
            while self.active is None and self.held:
                point = self.held.pop(0)
                if point["side"] == self.wanted and self.refusal(self.anchor, point, row) is None:
                    self.active = point
            if self.active is None or not self.reversed(self.active, self.series["close"][row]):
                return done
            self.anchor = self.active | {"confirmed_row": row, "sequence": len(self.swings) + 1}
            self.wanted = "LOW" if self.anchor["side"] == "HIGH" else "HIGH"
            self.active = None
            self.swings.append(self.anchor)
            done.append(self.anchor)
        raise CandleError(f"over {MOST_CHAINED} swings confirmed in row {row}")

    def holds(self, point: dict) -> bool:
        return True

    def starts(self, earlier: dict, point: dict) -> bool:
        return True

    def first(self, earlier: dict, point: dict) -> tuple:
        raise NotImplementedError

    def refusal(self, before: dict, point: dict, row: int) -> str | None:
        """Why a point may not follow ``before``, or None."""
        raise NotImplementedError

    def reversed(self, point: dict, close: float) -> bool:
        raise NotImplementedError


def moved(before: dict, point: dict) -> float:
    return point["sign"] * (point["price"] - before["price"])


class Internal(Track):
    """Swings from formation pivots: two ATR and six bars from the anchor, confirmed by a close one ATR off the pivot. The ATR is the pivot's."""

    def holds(self, point):
        return point["atr"] > 0

    def starts(self, earlier, point):
        return earlier["side"] != point["side"]

    def first(self, earlier, point):
        return earlier["extreme"], -moved(earlier, point), earlier["order"]

    def refusal(self, before, point, row):
        if not point["atr"] > 0:
            return "ATR"
        if before["side"] == point["side"]:
            return "SIDE"
        if point["extreme"] - before["extreme"] < INTERNAL["spacing"]:
            return "SPACING"
        far = moved(before, point)
        return None if far > 0 and far >= INTERNAL["displacement"] * point["atr"] else "DISPLACEMENT"

    def reversed(self, point, close):
        level = point["price"] - point["sign"] * INTERNAL["reversal"] * point["atr"]
        return point["sign"] * (level - close) >= 0


class Major(Track):
    """Swings from internal ones: three ATR, 1.5 percent and twelve bars from the anchor, with prominence as of now; confirmed by a
    close 1.5 ATR and 0.75 percent off. The first anchor may be of either side."""

    def first(self, earlier, point):
        return earlier["confirmed_row"], earlier["sequence"]

    def refusal(self, before, point, row):
        if not point["atr"] > 0 or before["price"] <= 0:
            return "ATR"
        if point["extreme"] - before["extreme"] < MAJOR["spacing"]:
            return "SPACING"
        far = moved(before, point)
        if far <= 0 or far < MAJOR["displacement"] * point["atr"] or far * 100 < MAJOR["percent"] * before["price"]:
            return "DISPLACEMENT"
        return None if prominence(self.series, point, row) >= MAJOR["prominence"] * point["atr"] else "PROMINENCE"

    def reversed(self, point, close):
        back = point["sign"] * (point["price"] - close)
        return back >= MAJOR["reversal"] * point["atr"] and back * 100 >= MAJOR["reversal_percent"] * point["price"]


def prominence(s: dict, p: dict, t: int) -> float:
    """Two-sided topographic prominence among candles 0 .. t: the lesser of the falls on both sides before a more extreme candle."""
    tops, feet = (s["high"], s["low"]) if p["sign"] > 0 else (s["low"], s["high"])
    falls = []
    for step in (-1, 1):
        i, fall = p["extreme"] + step, 0.0
        while 0 <= i <= t and p["sign"] * (tops[i] - p["price"]) <= 0:
            fall = max(fall, p["sign"] * (p["price"] - feet[i]))
            i += step
        falls.append(fall)
    return min(falls)


def replay(s: dict, arriving: dict[int, list[dict]]) -> tuple[Internal, Major]:
    """Both tracks of one series; pivots arrive at the close of the candle that completes their formation, by extreme, then side."""
    internal, major = Internal(s), Major(s)
    for row in range(len(s["close"])):
        for order, point in enumerate(sorted(arriving.get(row, ()), key=lambda p: (p["extreme"], p["side"]))):
            internal.offer(point | {"order": (row, order)}, row)
        for swing in internal.settle(row):
            major.offer(swing, row)
        major.settle(row)
    return internal, major


def labelled(found: list[dict], level: str) -> list[dict]:
    """With the structure label against the last swing of the side; within TOLERANCE ATR prices are equal."""
    last: dict[str, float] = {}
    out = []
    for x in found:
        high, tolerance = x["side"] == "HIGH", TOLERANCE * x["atr"]
        if x["side"] not in last:
            label = f"FIRST_{level}_{x['side']}"
        elif x["price"] > last[x["side"]] + tolerance:
            label = "HH" if high else "HL"
        elif x["price"] < last[x["side"]] - tolerance:
            label = "LH" if high else "LL"
        else:
            label = "EH" if high else "EL"
        last[x["side"]] = x["price"]
        out.append(x | {"label": label})
    return out


def swings(numbered: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Confirmed swings: level INTERNAL or MAJOR, sequence, side, extreme row, price, ATR, confirming row and structure label.

    The engines carry state from candle to candle, so a series is one task; a prefix of a series gives a prefix of its swings.
    """
    pivots = emitted(formations(numbered) if found is None else found).filter("disposition = 'EMITTED'").select(*SERIES, "side", F.col("extreme_row").alias("row"), "close_row", F.col("price").cast("double").alias("price"))
    rows = with_atr(numbered).select(*SERIES, "row", *(F.col(c).cast("double").alias(c) for c in ("high", "low", "close")), "atr")
    both = rows.withColumn("kind", F.lit("bar")).unionByName(pivots.withColumn("kind", F.lit("pivot")), allowMissingColumns=True)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bars_ = pdf[pdf["kind"] == "bar"].sort_values("row")
        s = {c: bars_[c].tolist() for c in ("high", "low", "close", "atr")}
        arriving: dict[int, list[dict]] = {}
        for p in pdf[pdf["kind"] == "pivot"].sort_values(["close_row", "row", "side"]).to_dict("records"):
            e, t = int(p["row"]), int(p["close_row"])
            atr = s["atr"][e] if s["atr"][e] == s["atr"][e] else s["atr"][t]
            arriving.setdefault(t, []).append({"side": p["side"], "sign": 1 if p["side"] == "HIGH" else -1, "price": p["price"], "extreme": e, "atr": atr})
        tracks = zip(("INTERNAL", "MAJOR"), replay(s, arriving))
        out = [(level, x["sequence"], x["side"], x["extreme"], x["price"], x["atr"], x["confirmed_row"], x["label"]) for level, track in tracks for x in labelled(track.swings, level)]
        frame = pd.DataFrame(out, columns=["level", "sequence", "side", "row", "price", "atr", "confirmed_row", "label"])
        frame.insert(0, "timeframe", pdf["timeframe"].iloc[0])
        frame.insert(0, "symbol", pdf["symbol"].iloc[0])
        return frame

    return both.groupBy(*SERIES).applyInPandas(run, "symbol string, timeframe string, level string, sequence bigint, side string, row bigint, price double, atr double, confirmed_row bigint, label string")


def legs(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """Legs between consecutive swings of a level: amplitude, bars, pullback, and the statistics of their candles."""
    from candlewright.operators.features import leg_statistics

    w = Window.partitionBy(*SERIES, "level").orderBy("sequence")
    ends = found.withColumns({"from_row": F.lag("row").over(w), "from_price": F.lag("price").over(w)}).filter("from_row IS NOT NULL AND from_row < row")
    span = ends.select(*SERIES, "level", "sequence", "side", F.explode(F.sequence("from_row", "row")).alias("row"))
    inside = span.join(numbered.withColumn("row", F.col("row").cast("bigint")), [*SERIES, "row"])
    stats = leg_statistics(inside, [*SERIES, "level", "sequence"])
    leg = Window.partitionBy(*SERIES, "level", "sequence").orderBy("row")
    up = F.col("side") == "HIGH"
    back = F.when(up, F.max("high").over(leg) - F.col("low")).otherwise(F.col("high") - F.min("low").over(leg))
    pull = inside.withColumn("_back", back.cast("double")).groupBy(*SERIES, "level", "sequence").agg(F.max("_back").alias("pullback"))
    return ends.select(*SERIES, "level", "sequence", "side", "from_row", "row", F.abs(F.col("price") - F.col("from_price")).alias("amplitude"), (F.col("row") - F.col("from_row")).alias("bars"), "atr").join(stats, [*SERIES, "level", "sequence"]).join(pull, [*SERIES, "level", "sequence"])


def forward(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """After each swing's confirmation until the next swing of its level: greatest excursion away, retests, first close beyond."""
    w = Window.partitionBy(*SERIES, "level").orderBy("sequence")
    spans = found.withColumn("until", F.lead("confirmed_row").over(w))
    last = numbered.groupBy(*SERIES).agg(F.max("row").cast("bigint").alias("last_row"))
    spans = spans.join(last, SERIES).withColumn("until", F.coalesce("until", "last_row")).filter("until > confirmed_row")
    each = spans.select(*SERIES, "level", "sequence", "side", "price", F.explode(F.sequence(F.col("confirmed_row") + 1, F.col("until"))).alias("row"))
    met = each.join(numbered.select(*SERIES, F.col("row").cast("bigint").alias("row"), *(F.col(c).cast("double").alias(c) for c in ("high", "low", "close"))), [*SERIES, "row"])
    up = F.col("side") == "HIGH"
    return met.groupBy(*SERIES, "level", "sequence").agg(
        F.max(F.when(up, F.col("price") - F.col("low")).otherwise(F.col("high") - F.col("price"))).alias("excursion"),
        F.count_if((F.col("low") <= F.col("price")) & (F.col("high") >= F.col("price"))).alias("retests"),
        F.min(F.when(F.when(up, F.col("close") > F.col("price")).otherwise(F.col("close") < F.col("price")), F.col("row"))).alias("first_close_beyond"),
    )
