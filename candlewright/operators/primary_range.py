"""Primary ranges: horizontal bands that price keeps returning to, found from pivots as they are confirmed.

A candidate is a cluster of high pivots and one of low pivots. Its measures are asked for many windows of one series, so sums
over closes are kept as running totals (``Series``) and a window costs a few array operations.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.operators.access import SERIES
from candlewright.operators.features import pivots, with_atr

#: Limits of the hard filters, of merging, and of what is reported.
LIMITS = {
    "cluster_atr": 0.25, "cluster_gap": 1440, "bars": 500, "expiry": 2160, "visits": 2, "anchor_rows": 30, "inside": 0.97, "drift": 0.35, "efficiency": 0.30, "crossings": 2, "width_atr": 2.0, "width_percent": 13.0,
    "cadence": 6, "away_wick": 1.0, "away_close": 0.5, "strong": 0.50, "normal": 0.25, "report": 60.0, "same_overlap": 0.70, "same_atr": 0.50, "merge_gap": 6, "merge_atr": 0.25,
}
#: Weights of the quality score, what counts as full marks, and the labels.
WEIGHTS = {"containment": 0.30, "touches": 0.20, "oscillation": 0.15, "flatness": 0.15, "duration": 0.10, "boundary": 0.10}
FULL = {"touches": 4, "oscillation": 6, "duration": 168}
LABELS = [(85, "Very High Quality"), (70, "High Quality"), (60, "Moderate Quality"), (0, "Low Quality")]
#: Failures in the order in which the first one names a rejection.
REASONS = ["duration", "upper_touches", "lower_touches", "upper_pair", "lower_pair", "containment", "slope", "efficiency", "eq", "width", "width_pct", "causality", "expired", "invalidated"]


class Series:
    """Arrays of one series with the running totals that windows are measured by. A missing ATR is NaN."""

    def __init__(self, high, low, close, atr):
        self.high, self.low, self.close, self.atr = (np.asarray(x, float) for x in (high, low, close, atr))
        self.n = len(self.close)
        total = lambda x: np.concatenate([[0.0], np.cumsum(x)])
        # sums about the mean lose fewer digits
        centred = self.close - (self.close.mean() if self.n else 0.0)
        self.sum_y, self.sum_xy = total(centred), total(np.arange(self.n) * centred)
        self.path = total(np.abs(np.diff(self.close, prepend=self.close[:1])))

    def slope(self, s: int, e: int) -> float:
        """Of the regression line of the closes over their number."""
        n = e - s + 1
        if n < 2:
            return 0.0
        sum_y = self.sum_y[e + 1] - self.sum_y[s]
        sum_xy = self.sum_xy[e + 1] - self.sum_xy[s] - s * sum_y
        return float((sum_xy - (n - 1) / 2 * sum_y) * 12 / (n * (n * n - 1.0)))

    def efficiency(self, s: int, e: int) -> float:
        path = self.path[e + 1] - self.path[s + 1]
        return float(abs(self.close[e] - self.close[s]) / path) if path else 0.0

    def atr_or_zero(self, i: int) -> float:
        return float(self.atr[i]) if self.atr[i] == self.atr[i] else 0.0


def clusters(points: list[dict], limits: dict) -> list[list[dict]]:
    """Pivots of one side in the order of their rows; each joins the newest cluster whose median it is near."""
    out: list[list[dict]] = []
    for p in points:
        for c in reversed(out):
            if p["row"] - c[-1]["row"] <= limits["cluster_gap"] and abs(p["price"] - median(x["price"] for x in c)) <= limits["cluster_atr"] * p["atr"]:
                c.append(p)
                break
        else:
            out.append([p])
    return out


def left(s: Series, a: int, b: int, sign: int, boundary: float, limits: dict) -> bool:
    """Whether price moved away from a boundary (sign 1: upper) strictly between rows a and b."""
    rows = slice(a + 1, b)
    atr = s.atr[rows]
    atr = np.where(atr > 0, atr, s.atr[b])  # NaN where neither is known, which compares as False
    nearest = (s.high if sign > 0 else s.low)[rows]
    return bool(np.any((sign * (boundary - nearest) > limits["away_wick"] * atr) | (sign * (boundary - s.close[rows]) >= limits["away_close"] * atr)))


def visits(s: Series, points: list[dict], lo: int, hi: int, known: int, sign: int, boundary: float, limits: dict) -> list[dict]:
    """Pivots in rows lo .. hi, confirmed by ``known``, near the boundary, that begin a visit: price moved away since the pivot before."""
    out: list[dict] = []
    last = None
    for p in points:
        if not (lo <= p["row"] <= hi and p["confirmed"] <= known):
            continue
        atr = s.atr[p["row"]] if s.atr[p["row"]] == s.atr[p["row"]] else p["atr"]
        if not atr > 0 or abs(p["price"] - boundary) > limits["cluster_atr"] * atr:
            continue
        if last is None or left(s, last, p["row"], sign, boundary, limits):
            out.append(p | {"tolerance": limits["cluster_atr"] * atr})
        last = p["row"]
    return out


def anchors(events: list[dict], least: int) -> tuple[dict, dict] | None:
    """The pair at least ``least`` rows apart whose second is confirmed first; of equals the earliest first."""
    pairs = [(b["confirmed"], a["row"], k, m) for m, b in enumerate(events) for k, a in enumerate(events[:m]) if b["row"] - a["row"] >= least]
    if not pairs:
        return None
    _, _, k, m = min(pairs)
    return events[k], events[m]


@dataclass
class Measure:
    """A window against a band: its visits, its measures and what fails."""

    upper: list[dict]
    lower: list[dict]
    upper_pair: tuple | None
    lower_pair: tuple | None
    values: dict
    fails: list[str]


def measure(s: Series, points: dict, lo: int, hi: int, top: float, bottom: float, known: int, limits: dict, whole: bool = True) -> Measure:
    """Without ``whole`` the dearer measures are left out where a cheap filter fails already."""
    upper, lower = visits(s, points["HIGH"], lo, hi, known, 1, top, limits), visits(s, points["LOW"], lo, hi, known, -1, bottom, limits)
    pairs = anchors(upper, limits["anchor_rows"]), anchors(lower, limits["anchor_rows"])
    width, middle, bars = top - bottom, (top + bottom) / 2, hi - lo + 1
    percent = width / middle * 100 if middle else 0.0
    cheap = {
        "duration": bars < limits["bars"], "upper_touches": len(upper) < limits["visits"], "lower_touches": len(lower) < limits["visits"], "upper_pair": pairs[0] is None, "lower_pair": pairs[1] is None,
        "causality": bars < limits["bars"] or any(p is None or p[1]["confirmed"] > known for p in pairs), "width_pct": percent > limits["width_percent"],
    }
    fails = [k for k, bad in cheap.items() if bad]
    if fails and not whole:
        return Measure(upper, lower, *pairs, {}, fails)
    close, atr = s.close[lo : hi + 1], s.atr[lo : hi + 1]
    atr = atr[atr == atr]
    typical = float(np.median(atr)) if len(atr) else 0.0
    sides = np.sign(close - middle)
    sides = sides[sides != 0]
    values = {
        "bars": bars, "inside": float(((close >= bottom) & (close <= top)).mean()), "drift": abs(s.slope(lo, hi) * bars) / width if width else 999.0, "efficiency": s.efficiency(lo, hi),
        "crossings": int((sides[1:] != sides[:-1]).sum()), "width_atr": width / typical if typical else 0.0, "width_percent": percent, "median_atr": typical,
    }
    dear = {
        "containment": values["inside"] < limits["inside"], "slope": values["drift"] > limits["drift"], "efficiency": values["efficiency"] > limits["efficiency"],
        "eq": values["crossings"] < limits["crossings"], "width": width <= 0 or values["width_atr"] < limits["width_atr"],
    }
    return Measure(upper, lower, *pairs, values, fails + [k for k, bad in dear.items() if bad])


def beyond(s: Series, i: int, top: float, bottom: float, atrs: float) -> int:
    """1 if the close is above the band by more than so many ATR, -1 if below, else 0."""
    margin = atrs * s.atr_or_zero(i)
    return int(s.close[i] > top + margin) - int(s.close[i] < bottom - margin)


def breakout(s: Series, after: int, top: float, bottom: float, limits: dict) -> tuple[str, str, int, int] | None:
    """(direction, kind, first row, confirming row) of the first close over half an ATR beyond, or two closes over a quarter ATR beyond, from row ``after``."""
    for i in np.flatnonzero((s.close[after:] > top) | (s.close[after:] < bottom)) + after:
        i = int(i)
        strong, normal = beyond(s, i, top, bottom, limits["strong"]), beyond(s, i, top, bottom, limits["normal"])
        if strong:
            return "UP" if strong > 0 else "DOWN", "strong", i, i
        if normal and i + 1 < s.n and next_beyond(s, i, top, bottom, limits) == normal:
            return "UP" if normal > 0 else "DOWN", "normal", i, i + 1
    return None


def next_beyond(s: Series, i: int, top: float, bottom: float, limits: dict) -> int:
    """As ``beyond`` for the close after i; an ATR that is missing there is that of i."""
    margin = limits["normal"] * (s.atr_or_zero(i + 1) or s.atr_or_zero(i))
    return int(s.close[i + 1] > top + margin) - int(s.close[i + 1] < bottom - margin)


def false_breaks(s: Series, lo: int, hi: int, top: float, bottom: float, limits: dict) -> int:
    """Closes outside the band that are no breakout, up to the first that is one."""
    n = 0
    for i in np.flatnonzero((s.close[lo : hi + 1] > top) | (s.close[lo : hi + 1] < bottom)) + lo:
        i = int(i)
        normal = beyond(s, i, top, bottom, limits["normal"])
        if beyond(s, i, top, bottom, limits["strong"]) or (normal and i + 1 <= hi and next_beyond(s, i, top, bottom, limits) == normal):
            break
        n += 1
    return n


def spread(events: list[dict]) -> float:
    """Median absolute deviation of the visits' prices over their median tolerance, cut to 0 .. 1."""
    if not events:
        return 0.0
    centre = median(x["price"] for x in events)
    mad, tolerance = median(abs(x["price"] - centre) for x in events), median(x["tolerance"] for x in events)
    return min(1.0, mad / tolerance) if tolerance else float(mad > 0)


def quality(m: Measure, limits: dict) -> float:
    """0 .. 100."""
    unit = lambda x: max(0.0, min(1.0, x))
    v = m.values
    parts = {
        "containment": unit((v["inside"] - limits["inside"]) / (1 - limits["inside"])),
        "touches": sum(min(1.0, len(x) / FULL["touches"]) for x in (m.upper, m.lower)) / 2,
        "oscillation": min(1.0, v["crossings"] / FULL["oscillation"]),
        "flatness": 1 - (unit(v["drift"] / limits["drift"]) + unit(v["efficiency"] / limits["efficiency"])) / 2,
        "duration": min(1.0, v["bars"] / FULL["duration"]),
        "boundary": 1 - (spread(m.upper) + spread(m.lower)) / 2,
    }
    return 100 * sum(WEIGHTS[k] * x for k, x in parts.items())


def described(s: Series, m: Measure, lo: int, confirmed: int, hi: int, top: float, bottom: float, out: dict, limits: dict) -> dict:
    score = quality(m, limits)
    return {
        "start_row": lo, "confirmed_row": confirmed, "end_row": hi, "top": top, "bottom": bottom, "upper_touches": len(m.upper), "lower_touches": len(m.lower), "false_breaks": false_breaks(s, lo, hi, top, bottom, limits),
        "quality": score, "label": next(name for least, name in LABELS if score >= least), **out, **m.values,
    }


def ended(s: Series, points: dict, lo: int, confirmed: int, top: float, bottom: float, limits: dict) -> tuple[dict | None, Measure]:
    """A confirmed band measured again at its end, the row before its breakout or the last row; None if a filter fails there."""
    b = breakout(s, confirmed + 1, top, bottom, limits)
    hi = max(confirmed, b[2] - 1) if b else s.n - 1
    out = {"status": f"BROKEN_{b[0]}" if b else "OPEN_AT_DATASET_END", "breakout": b and b[0], "breakout_kind": b and b[1], "first_outside_row": b and b[2], "breakout_row": b and b[3]}
    m = measure(s, points, lo, hi, top, bottom, s.n - 1, limits)
    return (None if set(m.fails) - {"causality"} else described(s, m, lo, confirmed, hi, top, bottom, out, limits)), m


def joins(members: list[dict], p: dict, limits: dict) -> bool:
    return abs(p["price"] - median(x["price"] for x in members)) <= limits["cluster_atr"] * p["atr"] and p["row"] - max(x["row"] for x in members) <= limits["cluster_gap"]


def follow(s: Series, points: dict, groups: tuple[list[dict], list[dict]], limits: dict) -> tuple[dict | None, list[str]]:
    """One candidate from the row at which it can first pass until it does or expires: its range, or why there is none.

    Later pivots join as they are confirmed. It is evaluated when one joins, at its first and last row, at the row of its least
    duration, and when ``cadence`` rows have passed; once only its width has failed it waits for a pivot.
    """
    members = {"HIGH": list(groups[0]), "LOW": list(groups[1])}
    lo = min(x["row"] for side in groups for x in side)
    begin = max(lo + limits["bars"] - 1, *(x["confirmed"] for side in groups for x in side))
    end = min(s.n - 1, lo + limits["expiry"])
    later = {side: [p for p in points[side] if p["confirmed"] >= begin] for side in members}
    fails, last = None, begin - limits["cadence"]
    for row in range(begin, end + 1):
        joined = False
        for side, waiting in later.items():
            while waiting and waiting[0]["confirmed"] <= row:
                p = waiting.pop(0)
                if p["row"] >= lo and joins(members[side], p, limits):
                    members[side].append(p)
                    joined = True
        if fails is not None and "width_pct" in fails and "duration" not in fails and not joined:
            continue
        if not (joined or row in (begin, end, lo + limits["bars"] - 1) or row - last >= limits["cadence"]):
            continue
        last = row
        top, bottom = (median(x["price"] for x in members[side]) for side in ("HIGH", "LOW"))
        if top <= bottom:
            continue
        m = measure(s, points, lo, row, top, bottom, row, limits, whole=False)
        fails = m.fails
        if not fails:
            found, final = ended(s, points, lo, row, top, bottom, limits)
            return found, [] if found else [*(k for k in final.fails if k != "causality"), "invalidated"]
    return None, [*(fails or ()), "expired"]


def search(s: Series, points: dict[str, list[dict]], limits: dict) -> tuple[list[dict], dict[str, int]]:
    """Ranges of one series by start, and how many candidates were rejected by reason."""
    high, low = ([c for c in clusters(points[side], limits) if len(c) >= 2] for side in ("HIGH", "LOW"))
    found, why, seen = [], {}, set()
    for h in high:
        for l in low:
            top, bottom = (median(x["price"] for x in c) for c in (h, l))
            (h0, h1), (l0, l1) = ((min(x["row"] for x in c), max(x["row"] for x in c)) for c in (h, l))
            start = min(h0, l0)
            if top <= bottom or h1 < l0 - limits["merge_gap"] or l1 < h0 - limits["merge_gap"]:
                continue
            if max(start + limits["bars"] - 1, *(x["confirmed"] for x in (*h, *l))) >= s.n:
                continue
            key = (start, round(float(top), 2), round(float(bottom), 2))
            if key in seen:
                continue
            seen.add(key)
            one, fails = follow(s, points, (h, l), limits)
            if one:
                found.append(one)
            else:
                reason = next((k for k in REASONS if k in fails), "other")
                why[reason] = why.get(reason, 0) + 1
    found.sort(key=lambda r: (r["start_row"], r["confirmed_row"]))
    return found, why


def near(a: dict, b: dict, atrs: float) -> bool:
    unit = a["median_atr"] or b["median_atr"]
    return abs(a["top"] - b["top"]) <= atrs * unit and abs(a["bottom"] - b["bottom"]) <= atrs * unit


def nest(ranges: list[dict], limits: dict) -> None:
    """Sets ``parent`` to the shortest longer range that holds a range in time and has other bounds; None for a primary one."""
    span = lambda r: r["end_row"] - r["start_row"]
    for r in ranges:
        outer = [o for o in ranges if o is not r and o["start_row"] <= r["start_row"] and r["end_row"] <= o["end_row"] and span(r) < span(o) and not near(r, o, limits["same_atr"])]
        r["parent"] = min(outer, key=span)["id"] if outer else None


def without_duplicates(ranges: list[dict], limits: dict) -> list[dict]:
    """Of ranges that overlap by most of the shorter and have like bounds, the best stays."""
    kept: list[dict] = []
    length = lambda r: r["end_row"] - r["start_row"] + 1
    for r in sorted(ranges, key=lambda r: (-r["quality"], r["confirmed_row"], -r["bars"], r["start_row"])):
        shared = lambda k: min(r["end_row"], k["end_row"]) - max(r["start_row"], k["start_row"]) + 1  # noqa: E731, B023
        if not any(shared(k) >= limits["same_overlap"] * min(length(r), length(k)) and near(r, k, limits["same_atr"]) for k in kept):
            kept.append(r)
    return kept


def merged(s: Series, points: dict, ranges: list[dict], limits: dict) -> list[dict]:
    """Neighbours with a short gap and like bounds become one where the whole passes all filters; over again until none do."""
    kept = sorted(ranges, key=lambda r: (r["start_row"], r["confirmed_row"]))
    i = 0
    while i + 1 < len(kept):
        a, b = kept[i], kept[i + 1]
        i += 1
        if not 0 <= b["start_row"] - a["end_row"] - 1 <= limits["merge_gap"] or not near(a, b, limits["merge_atr"]):
            continue
        lo, hi = a["start_row"], max(a["end_row"], b["end_row"])
        top, bottom = (a["top"] + b["top"]) / 2, (a["bottom"] + b["bottom"]) / 2
        m = measure(s, points, lo, hi, top, bottom, hi, limits)
        if not m.fails:
            last = a if a["end_row"] >= b["end_row"] else b
            out = {k: last[k] for k in ("status", "first_outside_row", "breakout_row")} | {k: a[k] or b[k] for k in ("breakout", "breakout_kind")}
            one = described(s, m, lo, min(a["confirmed_row"], b["confirmed_row"]), hi, top, bottom, out, limits)
            kept = sorted([*kept[: i - 1], one | {"id": a["id"], "parent": None, "merged": f"{a['id']},{b['id']}"}, *kept[i + 1 :]], key=lambda r: (r["start_row"], r["confirmed_row"]))
            i = 0
    return kept


def report(s: Series, points: dict, limits: dict) -> tuple[list[dict], dict[str, int]]:
    """Every range of a series: nested ones, and primary ones after duplicates and merging, those of enough quality with a range_id."""
    found, why = search(s, points, limits)
    for i, r in enumerate(found, 1):
        r |= {"id": f"TMP{i:03d}", "merged": None}
    nest(found, limits)
    primary = merged(s, points, without_duplicates([r for r in found if r["parent"] is None], limits), limits)
    nested = [r | {"structure": "NESTED", "range_id": None} for r in found if r["parent"] is not None]
    good = sorted((r for r in primary if r["quality"] >= limits["report"]), key=lambda r: (r["start_row"], r["confirmed_row"]))
    names = {id(r): f"R{i:03d}" for i, r in enumerate(good, 1)}
    return [*(r | {"structure": "PRIMARY", "range_id": names.get(id(r))} for r in primary), *nested], why


COLUMNS = (
    "id string, range_id string, structure string, parent string, merged string, start_row bigint, confirmed_row bigint, end_row bigint, top double, bottom double, upper_touches bigint, lower_touches bigint, status string, breakout string, breakout_kind string, "
    "first_outside_row bigint, breakout_row bigint, false_breaks bigint, quality double, label string, bars bigint, inside double, drift double, efficiency double, crossings bigint, width_atr double, width_percent double, median_atr double"
)


def inputs(numbered: DataFrame) -> DataFrame:
    rows = with_atr(numbered).select(*SERIES, F.col("row").cast("bigint").alias("row"), *(F.col(c).cast("double").alias(c) for c in ("high", "low", "close")), "atr")
    marks = pivots(numbered).select(*SERIES, "side", F.col("row").cast("bigint").alias("row"), F.col("price").cast("double").alias("price"), F.col("confirmed_row").cast("bigint").alias("confirmed"))
    return rows.withColumn("kind", F.lit("bar")).unionByName(marks.withColumn("kind", F.lit("pivot")), allowMissingColumns=True)


def arrays(pdf: pd.DataFrame) -> tuple[Series, dict[str, list[dict]]]:
    bars = pdf[pdf["kind"] == "bar"].sort_values("row")
    s = Series(*(bars[c].to_numpy(float) for c in ("high", "low", "close", "atr")))
    points: dict[str, list[dict]] = {"HIGH": [], "LOW": []}
    for p in pdf[pdf["kind"] == "pivot"].sort_values("row").to_dict("records"):
        atr = float(s.atr[int(p["confirmed"])])
        if atr > 0:  # also False where there is none
            points[p["side"]].append({"row": int(p["row"]), "confirmed": int(p["confirmed"]), "price": p["price"], "atr": atr})
    return s, points


def per_series(numbered: DataFrame, columns: str, build) -> DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(build(*arrays(pdf)), columns=names)
        out = out.astype({c.split()[0]: "Int64" for c in columns.split(", ") if c.endswith("bigint")})
        out.insert(0, "timeframe", pdf["timeframe"].iloc[0])
        out.insert(0, "symbol", pdf["symbol"].iloc[0])
        return out

    return inputs(numbered).groupBy(*SERIES).applyInPandas(run, f"symbol string, timeframe string, {columns}")


def primary_ranges(numbered: DataFrame, **changes: float) -> DataFrame:
    """Ranges of each series; ``changes`` replace LIMITS. The search is sequential, so a series is one task."""
    limits = LIMITS | changes
    return per_series(numbered, COLUMNS, lambda s, points: report(s, points, limits)[0])


def rejections(numbered: DataFrame, **changes: float) -> DataFrame:
    """How many candidates of each series were rejected, by the first reason in REASONS."""
    limits = LIMITS | changes
    return per_series(numbered, "reason string, candidates bigint", lambda s, points: [{"reason": k, "candidates": n} for k, n in sorted(search(s, points, limits)[1].items())])
