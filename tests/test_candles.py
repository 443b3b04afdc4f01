import datetime as dt
import math
import random
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewright.operators import access, audits, crossing, features, open_liquidity, order_block, price_touch, primary_range, resample, special_swings, swings
from candlewright.plans.runner import Lock, Task, exit_code, run_tasks
from candlewright.sources import candles, catalog, sinks
from candlewright.streaming.candles import run_available, stream_candles, stream_ticks

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, timeframe string, open_time timestamp_ntz, close_time timestamp_ntz, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume decimal(28,8), trades bigint"


def make(spark, bars, timeframe="1h", symbol="X", start=T0):
    step = dt.timedelta(minutes=candles.MINUTES[timeframe])
    rows = [(symbol, timeframe, start + i * step, start + (i + 1) * step - dt.timedelta(milliseconds=1), *(Decimal(str(x)) for x in b), Decimal(10), 3) for i, b in enumerate(bars)]
    return spark.createDataFrame(rows, SCHEMA)


def numbered(spark, bars, timeframe="1h"):
    return access.number_rows(make(spark, bars, timeframe))


def walk(n, seed=1, price=100.0):
    r, out = random.Random(seed), []
    for _ in range(n):
        o, c = price, price + r.gauss(0, 1)
        out.append(tuple(round(x, 2) for x in (o, max(o, c) + r.random(), min(o, c) - r.random(), c)))
        price = c
    return out


def minutes(n, base=100):
    e = Decimal("0.00000001")
    return [(base + i * e, base + i * e + 1, base + i * e, base + i * e + Decimal("0.5")) for i in range(n)]


@pytest.mark.parametrize("tf", ["5m", "15m", "1h"])
def test_closed_form_bucket(spark, tf):
    n = candles.MINUTES[tf]
    row = resample.fold(make(spark, minutes(n), "1m"), tf, child="1m").collect()
    assert len(row) == 1
    r, e = row[0], Decimal("0.00000001")
    assert (r.open, r.low) == (100, 100) and r.high == 101 + (n - 1) * e and r.close == Decimal("100.5") + (n - 1) * e
    assert r.volume == 10 * n and r.trades == 3 * n and r.close_time == T0 + dt.timedelta(minutes=n) - dt.timedelta(milliseconds=1)


def test_incomplete_buckets(spark):
    good = make(spark, minutes(15), "1m")
    missing = good.filter(F.minute("open_time") != 7)
    assert resample.fold(missing, "15m", child="1m").count() == 0
    assert not resample.fold(missing, "15m", "flag", child="1m").first().complete
    with pytest.raises(Exception, match="incomplete bucket"):
        resample.fold(missing, "15m", "fail", child="1m").collect()
    twice = missing.unionByName(good.filter(F.minute("open_time") == 8))
    assert resample.fold(twice, "15m", child="1m").count() == 0
    bad = good.withColumn("high", F.when(F.minute("open_time") == 3, F.col("low") - 1).otherwise(F.col("high")).cast("decimal(18,8)"))
    assert resample.fold(bad, "15m", child="1m").count() == 0
    assert resample.fold(good.limit(0), "15m", child="1m").count() == 0


def test_fold_of_folds_equals_direct(spark):
    m = make(spark, walk(240), "1m")
    five = resample.fold(m, "5m", child="1m")
    a, b = resample.fold(resample.fold(five, "1h", child="5m"), "4h", child="1h"), resample.fold(m, "4h", child="1m")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 1
    assert all(r.source_volume == r.derived_volume and r.conserved for r in resample.conservation(m, five).collect())


def test_warmup_and_range(spark):
    c = make(spark, walk(24 * 14))
    out = access.load(c, "2024-01-06", "2024-01-13", warmup=100)
    assert out.count() == 268 and out.filter("is_warmup").agg(F.max("close_time")).first()[0] < dt.datetime(2024, 1, 6)
    with pytest.raises(Exception, match="warm-up"):
        access.load(c, "2024-01-02", "2024-01-03", warmup=100).collect()
    assert access.load(c, "2024-01-02", "2024-01-03", warmup=100, strict=False).count() == 48
    with pytest.raises(candles.CandleError):
        access.load(c, "2024-01-02", "2024-01-03", ["nope"])


def test_as_of_clock_and_no_look_ahead(spark):
    base, high = make(spark, walk(288), "5m"), make(spark, walk(6, 2), "4h")
    got = {r.open_time: r.h_idx for r in access.as_of(base, high, "h").collect()}
    at = lambda h, m: got[T0.replace(hour=h, minute=m)]
    assert at(10, 30) == 1 and at(10, 55) == 1 and at(11, 55) == 2 and at(3, 50) == -1 and at(3, 55) == 0 and at(23, 55) == 5
    changed = high.withColumn("high", F.when(F.hour("open_time") == 8, F.lit(10**6)).otherwise(F.col("high")).cast("decimal(18,8)"))
    seen = {r.open_time: r.h_high for r in access.as_of(base, changed, "h", carry=["high"]).collect()}
    assert seen[T0.replace(hour=11, minute=50)] < 10**6 == seen[T0.replace(hour=11, minute=55)]
    wrong = access.as_of(base, high, "h").withColumn("h_idx", F.col("h_idx") + 1)
    d = access.as_of_defects(wrong, high, "h").first()
    assert d.look_ahead > 0
    assert set(access.as_of_defects(access.as_of(base, high, "h"), high, "h").first()) == {0}


def test_atr_matches_recursion_and_prefix(spark):
    bars = walk(700)
    got = [r.atr for r in features.with_atr(numbered(spark, bars)).orderBy("row").collect()]
    trs = [h - l if i == 0 else max(h - l, abs(h - bars[i - 1][3]), abs(l - bars[i - 1][3])) for i, (o, h, l, c) in enumerate(bars)]
    want = sum(trs[:14]) / 14
    assert got[:13] == [None] * 13 and got[13] == pytest.approx(want, rel=1e-12)
    for i in range(14, 700):
        want = (want * 13 + trs[i]) / 14
        assert got[i] == pytest.approx(want, rel=1e-12)


def test_first_reach_matches_brute_force():
    r = random.Random(3)
    for _ in range(200):
        v = [r.randint(0, 9) for _ in range(r.randint(0, 30))]
        levels = [x + r.randint(-1, 2) for x in v]
        want = [next((j for j in range(i + 1, len(v)) if v[j] >= levels[i]), None) for i in range(len(v))]
        assert crossing.first_at_least(v, levels) == want


@pytest.mark.parametrize(
    ("bars", "status", "mechanism", "closed"),
    [
        ([(100, 110, 90, 100), (100, 109, 90, 100)], open_liquidity.OPEN, None, None),
        ([(100, 110, 90, 100), (100, 110, 90, 100)], open_liquidity.MITIGATED, "EXACT_EXTREME_TOUCH", None),
        ([(90, 100, 80, 90), (95, 101, 94, 96)], open_liquidity.MITIGATED, "WICK_REACH", None),
        ([(90, 100, 80, 90), (99, 105, 98, 102)], open_liquidity.MITIGATED, "CLOSE_AT_OR_BEYOND", 1),
        ([(90, 100, 80, 90), (101, 105, 98, 102)], open_liquidity.MITIGATED, "GAP_OPEN_AT_OR_BEYOND", 1),
    ],
)
def test_open_liquidity_rules(spark, bars, status, mechanism, closed):
    r = open_liquidity.candidates(numbered(spark, bars)).filter("side = 'HIGH' AND row = 0").first()
    assert (r.status, r.mechanism, r.close_row) == (status, mechanism, closed)


def test_order_block_edges(spark):
    c = numbered(spark, [(100, 100, 99, 99), (99, 101, 99, 101), (100, 101, 100, 101), (102, 104, 102, 104), (104, 104, 100, 100)], "4h")
    found = {r.row: (r.side, r.disposition) for r in order_block.pairs(c).collect()}
    assert found[0] == ("BULLISH", "QUALIFIED_BULLISH_ORDER_BLOCK") and found[3] == ("BEARISH", "QUALIFIED_BEARISH_ORDER_BLOCK") and found[1][1] == "REJECTED_SAME_DIRECTION"


def test_touch_episode_fixture(spark):
    touch, away = (99.95, 100.05, 99.95, 100), (90, 90.2, 90, 90.1)
    bars = [touch] * 14 + [away] * 12 + [touch] * 13 + [away] * 11 + [touch] * 13
    found = price_touch.analyse(numbered(spark, bars))["levels"]
    level = min(found.collect(), key=lambda r: abs(r.center - 100))
    assert (level.touches, level.episodes, level.dates, level.qualifies) == (40, 3, 3, True)


def test_peaks_of_density_match_brute_force(spark):
    bars = walk(60, 5, 100.0)
    rows = numbered(spark, bars)
    got = {r.bin: (r.touches, r.episodes) for r in price_touch.density(rows).filter("touches > 0").collect()}
    want = {}
    for k in range(4400, 4800):
        hit = [float(h) >= 1.001 ** (k - 0.5) and float(l) <= 1.001 ** (k + 0.5) for o, h, l, c in bars]
        if any(hit):
            want[k] = (sum(hit), sum(x and not (i and hit[i - 1]) for i, x in enumerate(hit)))
    assert got == want


def test_swings_have_no_look_ahead(spark):
    bars = walk(260, 11)
    whole = swings.swings(numbered(spark, bars)).select("level", "sequence", "row", "confirmed_row", "label").collect()
    part = swings.swings(numbered(spark, bars[:180])).select("level", "sequence", "row", "confirmed_row", "label").collect()
    assert sorted(map(tuple, part), key=str) == sorted((tuple(r) for r in whole if r.confirmed_row < 180), key=str)
    sides = [r for r in swings.swings(numbered(spark, bars)).filter("level = 'INTERNAL'").orderBy("sequence").collect()]
    assert all(a.side != b.side for a, b in zip(sides, sides[1:]))


def make_series(close, atr=4.0, high=None, low=None):
    n = len(close)
    return primary_range.Series(high or close, low or close, close, atr if isinstance(atr, list) else [atr] * n)


def test_searches_in_pieces_match_brute_force(spark):
    r = random.Random(12)
    values = {k: [r.randint(0, 40) for _ in range(500)] for k in "ab"}
    points = spark.createDataFrame([("X", "1h", k, i, v) for k, vs in values.items() for i, v in enumerate(vs)], "symbol string, timeframe string, kind string, row bigint, value bigint")
    asked = [(k, i, r.randint(-1, 499), r.randint(0, 42)) for i in range(300) for k in "ab"]
    queries = spark.createDataFrame([("X", "1h", *q) for q in asked], "symbol string, timeframe string, kind string, id bigint, after bigint, level bigint")
    want = {(k, i): next((j for j in range(a + 1, 500) if values[k][j] >= level), None) for k, i, a, level in asked}
    for piece in (4, 60, 4096):
        got = {(x.kind, x.id): x.hit for x in crossing.first_hits(points, queries, piece).collect()}
        assert got == {k: v for k, v in want.items() if v is not None}
    candles_ = spark.createDataFrame([("X", "1h", i, a, b) for i, (a, b) in enumerate(zip(values["a"], values["b"]))], "symbol string, timeframe string, row bigint, high bigint, low bigint")
    spans = [(i, lo, lo + r.randint(-1, 300)) for i, lo in enumerate(r.choices(range(400), k=80))]
    df = spark.createDataFrame([("X", "1h", i, lo, min(hi, 499)) for i, lo, hi in spans], "symbol string, timeframe string, block_id bigint, lo bigint, hi bigint")
    got = {x.block_id: (x.top, x.bottom) for x in order_block.extremes_between(candles_, df, fan=4).collect()}
    assert got == {i: (max(values["a"][lo : min(hi, 499) + 1]), min(values["b"][lo : min(hi, 499) + 1])) for i, lo, hi in spans if lo <= min(hi, 499)}


def test_atr_over_pieces_equals_the_recursion(spark):
    bars = walk(2600, 8)
    for length in (1, 2, 14):
        got = {x.row: x.atr for x in features.with_atr(numbered(spark, bars), length).collect()}
        trs, atr = [], None
        for i, (o, h, l, c) in enumerate(bars):
            h, l = float(h), float(l)
            before = float(bars[i - 1][3]) if i else None
            trs.append(h - l if before is None else max(h - l, abs(h - before), abs(l - before)))
            atr = None if i < length - 1 else sum(trs) / length if i == length - 1 else (atr * (length - 1) + trs[-1]) / length
            assert (got[i] is None) == (atr is None) and (atr is None or abs(got[i] - atr) < 1e-9)


def test_rows_are_numbered_over_months(spark):
    got = numbered(spark, walk(1600)).orderBy("open_time").select("row").collect()
    assert [x.row for x in got] == list(range(1600))


def test_range_pieces():
    pts = [{"row": r, "confirmed": r + 3, "price": 1.0, "atr": 1.0} for r in (100, 110, 125, 135)]
    a, b = primary_range.anchors(pts, 30)
    assert (a["row"], b["row"]) == (100, 135)
    found = lambda close, atr=4.0: primary_range.breakout(make_series(close, atr), 0, 100, 90, primary_range.LIMITS)
    assert found([95.0] * 5 + [102.1, 95.0]) == ("UP", "strong", 5, 5)
    assert found([95.0] * 5 + [102.0, 95.0]) is None  # exactly half an ATR is not beyond
    assert found([95.0] * 5 + [101.1, 101.2]) == ("UP", "normal", 5, 6)
    assert found([95.0] * 5 + [101.1, 101.0]) is None
    assert found([95.0] * 5 + [88.9, 88.5]) == ("DOWN", "normal", 5, 6)
    assert found([95.0, 100.01], [float("nan")] * 2) == ("UP", "strong", 1, 1)  # a missing ATR is zero
    assert round((106.5 - 93.5) / 100 * 100, 9) == 13


def test_false_breaks_end_at_a_breakout():
    count = lambda close: primary_range.false_breaks(make_series(close), 0, len(close) - 1, 100, 90, primary_range.LIMITS)
    assert count([95, 100.5, 95, 89.5, 95]) == 2
    assert count([95, 100.5, 100.5, 95, 102.5, 100.5, 95]) == 2  # what follows the strong close does not count
    assert count([95, 101.5, 101.5, 100.5]) == 0
    assert count([95, 101.5]) == 1  # no second close to make it one


def test_range_measures_match_plain_sums():
    r = random.Random(6)
    close = [100 + r.random() * 9 for _ in range(300)]
    s = make_series(close)
    for lo, hi in ((0, 299), (17, 120), (5, 6)):
        ys = close[lo : hi + 1]
        n, mx, my = len(ys), (len(ys) - 1) / 2, sum(ys) / len(ys)
        slope = sum((i - mx) * (y - my) for i, y in enumerate(ys)) / sum((i - mx) ** 2 for i in range(n))
        path = sum(abs(b - a) for a, b in zip(ys, ys[1:]))
        assert abs(s.slope(lo, hi) - slope) < 1e-9 and abs(s.efficiency(lo, hi) - abs(ys[-1] - ys[0]) / path) < 1e-9
    m = primary_range.measure(s, {"HIGH": [], "LOW": []}, 0, 299, 108.0, 101.0, 299, primary_range.LIMITS)
    above = [y > 104.5 for y in close]
    assert m.values["inside"] == sum(101 <= y <= 108 for y in close) / 300 and m.values["crossings"] == sum(a != b for a, b in zip(above, above[1:]))
    assert {"duration", "upper_touches", "lower_touches", "upper_pair", "lower_pair", "causality", "containment"} <= set(m.fails)


def test_range_quality_weights():
    events = [{"price": p, "tolerance": 1.0} for p in (100.0, 100.5, 101.0, 100.0)]
    values = {"inside": 0.985, "crossings": 3, "drift": 0.175, "efficiency": 0.15, "bars": 84}
    m = primary_range.Measure(events, events[:2], None, None, values, [])
    # half of containment, oscillation, flatness and duration; touches (1 + 1/2) / 2; deviations 1/4 (of 0, .25, .25, .75) and 1/4
    assert abs(primary_range.quality(m, primary_range.LIMITS) - 100 * (0.15 + 0.20 * 0.75 + 0.075 + 0.075 + 0.05 + 0.10 * 0.75)) < 1e-9


def test_ranges_nest_by_time_and_merge(spark):
    base = {"quality": 70.0, "bars": 600, "median_atr": 4.0, "confirmed_row": 510}
    a = base | {"id": "A", "start_row": 0, "end_row": 900, "top": 110.0, "bottom": 90.0}
    b = base | {"id": "B", "start_row": 100, "end_row": 700, "top": 130.0, "bottom": 80.0}  # wider in price, shorter in time
    c = base | {"id": "C", "start_row": 100, "end_row": 699, "top": 111.0, "bottom": 91.0, "quality": 80.0}  # like A
    ranges = [a, b, c]
    primary_range.nest(ranges, primary_range.LIMITS)
    assert [r["parent"] for r in ranges] == [None, "A", "B"]
    kept = primary_range.without_duplicates([a, c], primary_range.LIMITS)
    assert [r["id"] for r in kept] == ["C"]


def test_default_limits_find_a_range(spark):
    """700 candles that swing between 95 and 105, then a breakout: one primary range, found without look-ahead."""
    bars = []
    for i in range(760):
        wave = 100 + 4.6 * math.sin(i / 9) + 0.3 * math.sin(i * 1.7)
        bars.append((wave, wave + 0.25, wave - 0.25, wave + 0.1))
    whole = bars[:700] + [(106 + i, 107 + i, 105.5 + i, 106.5 + i) for i in range(8)]
    found = [r for r in primary_range.primary_ranges(numbered(spark, whole)).collect() if r.range_id]
    assert len(found) >= 1
    for r in found:
        assert r.structure == "PRIMARY" and r.status == "BROKEN_UP" and r.breakout_kind == "strong"
        assert r.start_row + 499 <= r.confirmed_row <= r.end_row == r.first_outside_row - 1 and r.quality >= 60
        assert r.inside >= 0.97 and r.width_percent <= 13 and r.width_atr >= 2
    part = [r for r in primary_range.primary_ranges(numbered(spark, whole[: found[0].confirmed_row + 1])).collect()]
    assert (found[0].start_row, found[0].confirmed_row) in {(r.start_row, r.confirmed_row) for r in part}
    why = {r.reason: r.candidates for r in primary_range.rejections(numbered(spark, walk(900, 3))).collect()}
    assert set(why) <= set(primary_range.REASONS) | {"other"}


def point(side, extreme, price, atr=1.0):
    return {"side": side, "sign": 1 if side == "HIGH" else -1, "price": float(price), "extreme": extreme, "atr": atr}


def track(kind, close, **more):
    return kind({"close": close, **more})


def test_internal_swing_rules():
    t = track(swings.Internal, [100.0] * 200)
    offer = lambda p, row: t.offer(p | {"order": row}, row)
    offer(point("LOW", 4, 98), 8)
    offer(point("LOW", 2, 97), 9)
    offer(point("HIGH", 12, 99.5), 15)  # 2.5 ATR from the low of row 2, 1.5 from that of row 4
    assert t.anchor["extreme"] == 2 and t.active["price"] == 99.5 and not t.swings  # the seed is not a swing
    offer(point("HIGH", 14, 99.9, atr=2.0), 16)  # more extreme, but not two of its own ATR
    assert t.active["price"] == 99.5
    offer(point("LOW", 16, 97.2), 18)  # held
    offer(point("HIGH", 17, 101), 20)
    assert t.active["price"] == 101 and len(t.held) == 1  # replacing keeps what is held
    offer(point("LOW", 24, 98.5), 26)
    offer(point("LOW", 25, 96), 27)
    t.series["close"][28] = 100.1
    assert t.settle(28) == []  # within one ATR of the pivot
    t.series["close"][29] = 100.0  # exactly one
    done = t.settle(29)
    assert [(x["side"], x["price"], x["confirmed_row"], x["sequence"]) for x in done] == [("HIGH", 101.0, 29, 1), ("LOW", 98.5, 29, 2)]
    # the low of row 16 is no six rows off; that of row 24 came next and was confirmed at once; that of row 25 was of the wrong side then
    assert t.active is None and t.held == [] and t.wanted == "HIGH"


def test_held_pivots_behind_the_next_active_one_stay_held():
    t = track(swings.Internal, [100.0] * 60)
    offer = lambda p, row: t.offer(p | {"order": row}, row)
    offer(point("LOW", 0, 90), 3)
    offer(point("HIGH", 10, 100), 13)
    for extreme, price in ((20, 97), (22, 96)):
        offer(point("LOW", extreme, price), extreme + 2)
    t.series["close"][30] = 97.5
    assert [x["price"] for x in t.settle(30)] == [100.0]
    assert t.active["price"] == 97 and [x["price"] for x in t.held] == [96]  # a later, lower one does not replace it from hold


def test_major_swing_rules():
    flat = [100.0] * 80
    high, low = [100.5] * 80, [99.5] * 80
    high[30], low[10] = 106.0, 95.0
    t = track(swings.Major, flat, high=high, low=low)
    swing = lambda p, row, n: p | {"confirmed_row": row, "sequence": n}
    t.offer(swing(point("LOW", 10, 95), 14, 1), 14)
    t.offer(swing(point("HIGH", 21, 100.4), 25, 2), 25)  # eleven rows
    assert t.anchor is None
    t.offer(swing(point("HIGH", 30, 106), 34, 3), 34)
    assert t.anchor["extreme"] == 10 and t.active["price"] == 106
    t.series["close"][40] = 104.6  # 1.4 ATR
    assert t.settle(40) == []
    t.series["close"][41] = 104.4
    assert [x["price"] for x in t.settle(41)] == [106.0]
    dull = track(swings.Major, flat, high=high, low=[105.0 if i > 10 else x for i, x in enumerate(low)])
    dull.offer(swing(point("LOW", 10, 95), 14, 1), 14)
    dull.offer(swing(point("HIGH", 30, 106), 34, 3), 34)
    assert dull.anchor is None  # a prominence of one ATR is too little


def test_too_long_a_chain_is_an_error():
    t = track(swings.Internal, [0.0] * 10)
    t.refusal = lambda a, b, row: None
    t.reversed = lambda p, close: True
    t.anchor, t.active, t.wanted = point("LOW", 0, 1), point("HIGH", 1, 2), "HIGH"
    t.held = [point("LOW" if i % 2 == 0 else "HIGH", i, i) for i in range(100)]
    with pytest.raises(candles.CandleError, match="64"):
        t.settle(5)


def test_pivots_ties(spark):
    bars = [(9.5, 10, 9, 9.5)] * 20
    bars[8] = (9.5, 12, 8, 9.5)
    found = features.pivots(numbered(spark, bars)).collect()
    assert {(r.side, r.row, r.confirmed_row) for r in found} == {("HIGH", 8, 11), ("LOW", 8, 11)}
    bars[8] = bars[0]
    bars[6] = bars[7] = (9.5, 12, 9, 9.5)
    assert [r.row for r in features.pivots(numbered(spark, bars)).filter("side = 'HIGH'").collect()] == [6]


def test_family_leader_closes_nearest_to_the_price_it_had_to_reach(spark):
    columns = "symbol string, timeframe string, side string, row int, close_row int, price decimal(18,8), plateau_start int, plateau_end int, reason string, completion_error double, open_percent double, close_percent double"
    one = lambda row, error, edge: ("ALL", "4h", "HIGH", row, row + 4, Decimal(9), 12, 12, "OK", error, edge, edge)
    found = spark.createDataFrame([one(10, 0.5, 9.0), one(11, 0.25, 2.0), one(9, 0.25, 2.5), one(8, 0.25, 2.5)], columns)
    roles = {r["row"]: r["family"] for r in special_swings.families(found).collect()}
    # equal errors fall to the greater lesser boundary, equal boundaries to the earlier close
    assert roles == {8: "PRIMARY", 9: "DERIVED", 10: "DERIVED", 11: "DERIVED"}


def test_special_swing_suppression():
    s = lambda row, close, end: {"row": row, "close_row": close, "plateau_end": end, "key": (close - row, row)}
    assert special_swings.resolve([s(0, 9, 5), s(3, 10, 5), s(20, 27, 22)]) == {0: "LONGER", 1: "KEPT", 2: "KEPT"}


def test_kline_readers(spark, tmp_path):
    ms, us = 1704067200000, 1735689600000000
    line = lambda o, c: f"{o},1.5,2.5,0.5,2.0,10,{c},20,3,4,8,0"
    text = "\n".join(["open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore", line(ms, ms + 59_999), line(us, us + 59_999_999), line(us, us + 59_999_000), line(ms + 1, ms + 60_000), line(ms, ms + 59_999).replace("2.5", "1.0")])
    (tmp_path / "a.csv").write_text(text)
    got = candles.read_kline_csv(spark, str(tmp_path / "a.csv"), "X").collect()
    assert sorted(str(r.defect) for r in got) == ["None", "None", "grid", "header", "ohlc", "unit"]
    with zipfile.ZipFile(tmp_path / "X-1m-2024-01.zip", "w") as z:
        z.writestr("X-1m-2024-01.csv", text)
    zipped = candles.read_kline_zips(spark, str(tmp_path / "*.zip"))
    assert zipped.count() == 6 and {r.symbol for r in zipped.collect()} == {"X"}
    files = candles.checksums(spark, str(tmp_path / "*.zip"))
    sums = files.select(F.concat("sha256", F.lit("  X-1m-2024-01.zip")).alias("value"))
    assert [r.status for r in candles.verify_checksums(files, sums).collect()] == ["ok"]


def test_publish_skip_conflict(spark, tmp_path):
    path = f"file://{tmp_path}/candles"
    c = make(spark, walk(48))
    assert sinks.publish(c, path, "1h") == "created" and sinks.publish(c, path, "1h") == "equal"
    with pytest.raises(candles.CandleError, match="other rows"):
        sinks.publish(make(spark, walk(48, 2)), path, "1h")
    with pytest.raises(candles.CandleError, match="gaps"):
        sinks.publish(c.filter(F.hour("open_time") != 5), path, "1h")
    assert sinks.read_partitioned(spark, path, ["X"], "2024-01-02", "2024-01-03").count() == 24
    inv = candles.inventory(spark, path, "1h", ["X", "Y"], "2024-01-01", "2024-02-01").collect()
    assert {(r.symbol, r.status) for r in inv} == {("X", "ok"), ("Y", "missing")}
    assert sinks.next_revision(["a_rev01.parquet", "a_rev07.parquet", "b_rev09.parquet"], "a") == "a_rev08.parquet"


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts")
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    run_available(stream_candles(stream_ticks(spark, f"{tmp_path}/in"), "1d"), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out")
    want = candles.candles_from_ticks(events.withColumnRenamed("event_type", "symbol"), "1d")
    both = got.select("symbol", F.col("open_time").cast("timestamp_ntz").alias("open_time"), "open", "high", "low", "close", "trades").join(want, ["symbol", "open_time", "open", "high", "low", "close", "trades"])
    assert both.count() == got.count() > 100


def test_runner(tmp_path):
    ran = []
    out = run_tasks([Task("a", lambda: ran.append(1)), Task("b", lambda: 1 / 0), Task("a", lambda: ran.append(2)), Task("c", ran.clear, enabled=False)])
    assert [o.status for o in out] == ["OK", "FAILED", "SKIPPED"] and ran == [1] and exit_code(out) == 1
    with Lock(str(tmp_path / "l")), pytest.raises(RuntimeError), Lock(str(tmp_path / "l")):
        pass
    (tmp_path / "l").write_text("999999999")
    with Lock(str(tmp_path / "l")):
        pass


def test_catalog_lists_resolves_and_checks(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    sinks.write_partitioned(make(spark, walk(24 * 70)), path, "1h")
    listed = catalog.partitions(spark, path, "1h").collect()
    assert sorted((r.symbol, r.year, r.month) for r in listed) == [("X", 2024, m) for m in (1, 2, 3)]
    files = catalog.resolve(spark, path, "1h", ["X"], "2024-02-03", "2024-02-20")
    assert [r.month for r in files.collect()] == [2]
    with pytest.raises(candles.CandleError, match="'Y'"):
        catalog.resolve(spark, path, "1h", ["X", "Y"], "2024-02-03", "2024-02-20")
    assert catalog.identity(spark, path, "1h").isEmpty()
    before = spark.createDataFrame(catalog.source_hashes(spark, catalog.partitions(spark, path, "1h")).collect())
    assert catalog.changed(before, before).isEmpty()
    march = [r.path for r in listed if r.month == 3][0]
    january = make(spark, walk(30)).drop("symbol")
    january.write.mode("append").parquet(march.rsplit("/", 1)[0])
    assert [(r.month, r.misplaced) for r in catalog.identity(spark, path, "1h").collect()] == [(3, 30)]
    after = catalog.source_hashes(spark, catalog.partitions(spark, path, "1h"))
    assert {r.status for r in catalog.changed(before, after).collect()} == {"new"}
    pruned = sinks.read_partitioned(spark, path, ["X"], "2024-02-03", "2024-02-05")
    assert pruned.count() == 48 and "month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_symbol_metadata_and_siblings(spark):
    rows = [("A", "PERPETUAL", "USDT", "USDT", "TRADING", "1569398400000"), ("B", "CURRENT_QUARTER", "USDT", "BTC", "BREAK", "x"), ("C", None, "USDT", "USDT", None, None)]
    info = spark.createDataFrame(rows, "symbol string, contractType string, quoteAsset string, marginAsset string, status string, onboardDate string")
    got = {r.symbol: r for r in catalog.validate_symbols(spark, info, ["A", "B", "C", "D"]).collect()}
    assert got["A"].validated and got["A"].warnings == [] and got["A"].onboard_time == dt.datetime(2019, 9, 25, 8)
    assert len(got["B"].problems) == 2 and len(got["B"].warnings) == 1 and got["B"].onboard_time is None
    assert not got["C"].validated and got["D"].problems == ["not listed"]
    scope = {r.name: (r.approved, r.own) for r in catalog.sibling_scope(spark, ["15m", "1h", "notes"], "1h").collect()}
    assert scope == {"15m": (True, False), "1h": (True, True), "notes": (False, False)}


def test_slices_look_back_as_far_as_asked(spark):
    bars = walk(24 * 10)
    base = make(spark, bars)
    tables = {"1h": base, "4h": resample.fold(base, "4h", child="1h"), "1d": resample.fold(base, "1d", child="1h")}
    slices = access.load_slices(tables, "1h", "2024-01-05 10:00:00", "2024-01-06 00:00:00", {"1h": 5, "4h": 3})
    span = {k: (v.count(), v.agg(F.min("open_time")).first()[0]) for k, v in slices.items()}
    assert span["1h"] == (5 + 14, dt.datetime(2024, 1, 5, 5))
    assert span["4h"][1] == dt.datetime(2024, 1, 4, 16)  # three closed before 05:00, from 16:00 on; the one that is open then follows
    assert span["1d"] == (2, dt.datetime(2024, 1, 4))
    first = access.load_multi(tables, "1h", "2024-01-05 10:00:00", "2024-01-06 00:00:00", {"1h": 5, "4h": 3}).orderBy("open_time").first()
    assert (first.tf_4h_idx, first.tf_1d_idx) == (2, 0)
    with pytest.raises(candles.CandleError, match="warm-up"):
        access.load_slices(tables, "1h", "2024-01-05", "2024-01-06", {"2h": 1})


def test_audits_see_broken_results(spark):
    rows = numbered(spark, walk(120, 4))
    found = open_liquidity.candidates(rows)
    assert {r.failures for r in audits.open_liquidity_audit(found).collect()} == {0}
    broken = found.withColumn("mitigation_row", F.when(F.col("row") == 5, 1).otherwise(F.col("mitigation_row")))
    assert any(r.failures for r in audits.open_liquidity_audit(broken).collect())
    s = swings.swings(numbered(spark, walk(400, 11)))
    assert {r.failures for r in audits.swing_audit(s).collect()} == {0}
    assert any(r.failures for r in audits.swing_audit(s.withColumn("side", F.lit("HIGH"))).collect())
    stats = price_touch.level_stats(price_touch.touches(rows, price_touch.peaks(rows)))
    assert {r.failures for r in audits.touch_audit(stats).collect()} == {0}


def test_groups_of_levels_at_price_zero(spark):
    """Three timeframes whose lowest low is zero: relative distances of zeros are 0, and the three are one group."""
    bars = [(5, 6, 4, 5), (5, 6, 0, 5), (5, 7, 3, 6), (6, 8, 5, 7)]
    rows = None
    for tf in ("1h", "4h", "1d"):
        own = numbered(spark, bars, tf)
        rows = own if rows is None else rows.unionByName(own)
    found = open_liquidity.hierarchy(open_liquidity.ranked_open(open_liquidity.candidates(rows))).filter("side = 'LOW'").orderBy("rank").collect()
    zero = [r for r in found if r.price == 0]
    assert [(r.tier, r.slots, r.span_percent, r.members) for r in zero] == [(1, "1d,4h,1h", 0.0, "1d-LOW-00000001,4h-LOW-00000001,1h-LOW-00000001")]
    assert sum(len(r.members.split(",")) for r in found) == 6


def zero_walk(n, seed):
    """Bars of whole prices between 0 and 6, many of them zero."""
    r, out = random.Random(seed), []
    for _ in range(n):
        o, c = r.choice((0, 0, 1, 2, 3, 5)), r.choice((0, 0, 1, 2, 4, 6))
        out.append((o, max(o, c) + r.choice((0, 1)), max(0, min(o, c) - r.choice((0, 1))), c))
    return out


def met_later(bars, after, lo, hi):
    """By comparison with every later candle: first touch, touches, episodes, first wick and wicks of a zone."""
    body = [max(o, c) >= lo and min(o, c) <= hi for o, _, _, c in bars]
    wick = [h >= lo and low <= hi and not b for (_, h, low, _), b in zip(bars, body)]
    later = range(after + 1, len(bars))
    touched, wicked = [i for i in later if body[i]], [i for i in later if wick[i]]
    return next(iter(touched), None), len(touched), sum(i - 1 not in touched for i in touched), next(iter(wicked), None), len(wicked)


def test_lifecycle_of_blocks_at_price_zero(spark):
    """Touches of zones and candles that reach zero count; a pair of candles from zero to zero is a block of undefined percentage."""
    bars = [*zero_walk(120, 3), (0, 2, 0, 2), (1, 1, 0, 0), *zero_walk(20, 4)]
    rows = numbered(spark, bars, "4h").localCheckpoint()
    blocks = order_block.blocks(rows)
    got = {(r.block_row, r.side): r for r in order_block.lifecycle(rows, blocks).collect()}
    assert any(r.zone_lower == 0 for r in got.values())
    assert math.isnan(got[120, "BEARISH"].displacement_percent)
    for r in got.values():
        want = met_later(bars, r.impulse_row, r.zone_lower, r.zone_upper)
        if r.later_bars:
            assert (r.touch_row, r.touch_bars, r.touch_episodes, r.wick_only_row, r.wick_only_bars) == want


@pytest.mark.parametrize(("piece", "share"), [(4, 8), (7, 1000), (1000, 1000)])
def test_touches_in_pieces_match_brute_force(spark, piece, share):
    bars = [*zero_walk(40, 5), *[(50, 51, 49, 50)] * 9, *zero_walk(30, 6)]
    rows = numbered(spark, bars, "4h").withColumn("row", F.col("row").cast("bigint")).localCheckpoint()
    r = random.Random(7)
    zones = [(i, r.randrange(len(bars)), *sorted(r.choice(((0, 0), (0, 1), (2, 3), (6, 8), (49, 50), (20, 60))))) for i in range(60)]
    b = spark.createDataFrame([("X", "4h", i, at, at + 1, Decimal(lo), Decimal(hi)) for i, at, lo, hi in zones], "symbol string, timeframe string, block_id bigint, block_row bigint, impulse_row bigint, zone_lower decimal(18,8), zone_upper decimal(18,8)")
    got = {x.block_id: (x.touch_row, x.touch_bars, x.touch_episodes, x.wick_only_row, x.wick_only_bars) for x in order_block.touches(rows, b, piece, share).collect()}
    for i, at, lo, hi in zones:
        assert got.get(i, (None, 0, 0, None, 0)) == met_later(bars, at + 1, lo, hi)


def test_events_of_blocks_at_price_zero(spark):
    """First touches and first wicks of zones that candles with a low of zero meet."""
    bars = [(10, 10, 8, 8), (8, 12, 8, 12), (12, 12, 0, 11), (9, 9, 0, 9), (7, 7, 0, 0), (20, 20, 10, 20), (0, 1, 0, 1)]
    rows = numbered(spark, bars, "4h").localCheckpoint()
    lived = order_block.lifecycle(rows, order_block.blocks(rows))
    got = [(r.event, r.row) for r in order_block.events(lived).filter("block_row = 0").orderBy("sequence").collect()]
    assert got == [("wick_only", 2), ("touch", 3), ("midpoint", 3), ("gap", 4), ("full", 4), ("invalid", 4)]
