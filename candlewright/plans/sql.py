"""SQL of the registered queries for another engine (DuckDB), written apart from the Spark plans."""

from __future__ import annotations

MINUTES = {"30m": 30, "1h": 60, "4h": 240, "1d": 1440}


def candle(timeframe: str, by_type: bool = False) -> str:
    n = MINUTES[timeframe]
    symbol = "event_type" if by_type else "'ALL'"
    return f"""(SELECT {symbol} AS symbol, '{timeframe}' AS timeframe, time_bucket(INTERVAL '{n} minutes', ts) AS open_time,
        time_bucket(INTERVAL '{n} minutes', ts) + INTERVAL '{n} minutes' - INTERVAL '1 millisecond' AS close_time,
        arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS volume, count(*) AS trades
        FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY ALL)"""


def rows(timeframe: str, by_type: bool = False) -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time) - 1 AS row FROM {candle(timeframe, by_type)})"


SEVERAL = "(" + " UNION ALL ".join(f"SELECT * FROM {rows(t)}" for t in ("1h", "4h", "1d")) + ")"

FOLD_4H = """SELECT symbol, time_bucket(INTERVAL '240 minutes', open_time) AS o, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
    arg_max(close, open_time) AS close, CAST(sum(CAST(volume AS DECIMAL(18, 2))) AS DOUBLE) AS volume, CAST(sum(trades) AS BIGINT) AS trades, count(*) AS children
    FROM {src} GROUP BY ALL"""

GAPS = f"""SELECT symbol, open_time, lead(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS nxt FROM {candle("1h", True)}"""


def exact(x: str) -> str:
    """A value of two decimals as a whole number of hundredths."""
    return f"CAST(round({x} * 100) AS BIGINT)"


#: Of each candle the first later rows that reach its extremes, by comparison with every later row.
REACHES = """SELECT a.symbol, a.timeframe, a.row,
    min(b.row) FILTER (WHERE b.high >= a.high) AS reach_high, min(b.row) FILTER (WHERE b.low <= a.low) AS reach_low,
    min(b.row) FILTER (WHERE b.close >= a.high) AS close_reach_high, min(b.row) FILTER (WHERE b.close <= a.low) AS close_reach_low
    FROM s a LEFT JOIN s b ON a.symbol = b.symbol AND a.timeframe = b.timeframe AND b.row > a.row GROUP BY ALL"""

CANDIDATES = f"""
    WITH s AS {SEVERAL}, r AS ({REACHES}),
    e AS (SELECT symbol, timeframe, max(row) AS last_row, arg_max(close, row) AS final_close, count(*) AS n FROM s GROUP BY ALL),
    two AS (SELECT s.*, 'HIGH' AS side, high AS price, reach_high AS reach, close_reach_high AS close_row, high - greatest(open, close) AS wick, 1 AS sgn FROM s JOIN r USING (symbol, timeframe, row)
        UNION ALL SELECT s.*, 'LOW', low, reach_low, close_reach_low, least(open, close) - low, -1 FROM s JOIN r USING (symbol, timeframe, row)),
    c AS (SELECT two.symbol, two.timeframe, side, two.row, two.open_time, price, sgn, reach AS mitigation_row, close_row, last_row - two.row AS future_bars, last_row + 1 AS n, final_close,
        CASE WHEN two.row = last_row THEN 'TERMINAL_NO_LATER_CANDLE' WHEN reach IS NOT NULL THEN 'MITIGATED' ELSE 'OPEN_CONFIRMED_BY_LATER_OBSERVATION' END AS status,
        CASE WHEN wick > 0 THEN 'WICK' ELSE 'BODY' END AS origin, m.open AS mo, m.close AS mc, CASE WHEN side = 'HIGH' THEN m.high ELSE m.low END AS mx,
        (SELECT CASE WHEN two.side = 'HIGH' THEN max(high) ELSE min(low) END FROM s l WHERE l.timeframe = two.timeframe AND l.row > two.row) AS later
        FROM two JOIN e USING (symbol, timeframe) LEFT JOIN s m ON m.timeframe = two.timeframe AND m.row = reach),
    found AS (SELECT *, CASE WHEN mitigation_row IS NULL THEN NULL WHEN sgn * (mo - price) >= 0 THEN 'GAP_OPEN_AT_OR_BEYOND' WHEN mx = price THEN 'EXACT_EXTREME_TOUCH' WHEN sgn * (mc - price) >= 0 THEN 'CLOSE_AT_OR_BEYOND' ELSE 'WICK_REACH' END AS mechanism,
        status LIKE 'OPEN%' AND 10000 * sgn * ({exact("price")} - {exact("later")}) <= 5 * {exact("price")} AS near_miss FROM c)"""

PAIRS = f"""SELECT *, CASE WHEN sgn > 0 THEN nc - {exact("open")} WHEN sgn < 0 THEN {exact("open")} - nc END AS moved FROM (
    SELECT *, CASE WHEN close < open AND nc > no_ THEN 1 WHEN close > open AND nc < no_ THEN -1 END AS sgn, CASE WHEN close > open THEN 1 WHEN close < open THEN -1 ELSE 0 END AS d1, CASE WHEN nc > no_ THEN 1 WHEN nc < no_ THEN -1 ELSE 0 END AS d2
    FROM (SELECT *, {exact("lead(open) OVER w")} AS no_, {exact("lead(close) OVER w")} AS nc, lead(row) OVER w AS impulse_row FROM {rows("4h", True)} WINDOW w AS (PARTITION BY symbol ORDER BY row)) WHERE nc IS NOT NULL)"""

#: One hundred times the move of an impulse against percent times the origin's open, both exact.
DISPOSITION = f"""CASE WHEN d1 = 0 THEN 'REJECTED_ORIGIN_DOJI' WHEN d2 = 0 THEN 'REJECTED_IMPULSE_DOJI' WHEN d1 = d2 THEN 'REJECTED_SAME_DIRECTION'
    WHEN d1 < 0 AND 100 * (nc - {exact("open")}) >= {{p}} * {exact("open")} THEN 'QUALIFIED_BULLISH_ORDER_BLOCK' WHEN d1 < 0 THEN 'REJECTED_BULLISH_DISPLACEMENT_BELOW_1_PERCENT'
    WHEN 100 * ({exact("open")} - nc) >= {{p}} * {exact("open")} THEN 'QUALIFIED_BEARISH_ORDER_BLOCK' ELSE 'REJECTED_BEARISH_DISPLACEMENT_BELOW_1_PERCENT' END"""


def blocks(percent: int = 1) -> str:
    return f"""(SELECT symbol, CASE WHEN sgn > 0 THEN 'BULLISH' ELSE 'BEARISH' END AS side, sgn, row AS block_row, impulse_row, least(open, close) AS lo, greatest(open, close) AS hi, moved, open, close, no_, nc
        FROM ({PAIRS}) WHERE {DISPOSITION.format(p=percent)} LIKE 'QUALIFIED%')"""


LIFE = f"""
    WITH s AS {rows("4h", True)}, b AS {blocks()},
    l AS (SELECT b.symbol, b.side, b.block_row, s.row, greatest(s.open, s.close) >= lo AND least(s.open, s.close) <= hi AS touch,
            CASE WHEN sgn > 0 THEN s.open < lo ELSE s.open > hi END AS gap,
            CASE WHEN sgn > 0 THEN 2 * {exact("least(s.open, s.close)")} <= {exact("lo")} + {exact("hi")} ELSE 2 * {exact("greatest(s.open, s.close)")} >= {exact("lo")} + {exact("hi")} END AS midpoint,
            CASE WHEN sgn > 0 THEN least(s.open, s.close) <= lo ELSE greatest(s.open, s.close) >= hi END AS full_,
            CASE WHEN sgn > 0 THEN s.close < lo ELSE s.close > hi END AS invalid, s.high >= lo AND s.low <= hi AS met,
            CASE WHEN sgn > 0 THEN {exact("s.high")} - {exact("hi")} ELSE {exact("lo")} - {exact("s.low")} END AS away
          FROM b JOIN s ON b.symbol = s.symbol AND s.row > b.impulse_row),
    t AS (SELECT *, touch AND NOT coalesce(lag(touch) OVER (PARTITION BY symbol, side, block_row ORDER BY row), false) AS starts, min(row) FILTER (WHERE touch) OVER (PARTITION BY symbol, side, block_row) AS first_touch FROM l),
    life AS (SELECT symbol, side, block_row, min(row) FILTER (WHERE gap) AS gap_row, min(row) FILTER (WHERE touch) AS touch_row, min(row) FILTER (WHERE midpoint) AS midpoint_row, min(row) FILTER (WHERE full_) AS full_row,
            min(row) FILTER (WHERE invalid) AS invalid_row, min(row) FILTER (WHERE met AND NOT touch) AS wick_only_row, count(*) AS later_bars, count(*) FILTER (WHERE touch) AS touch_bars, count(*) FILTER (WHERE starts) AS touch_episodes,
            max(away) FILTER (WHERE first_touch IS NULL OR row < first_touch) / 100.0 AS excursion_before, max(away) FILTER (WHERE row > first_touch) / 100.0 AS excursion_after FROM t GROUP BY ALL)"""

WEEK = "isoyear(open_time) || '-W' || lpad(CAST(week(open_time) AS VARCHAR), 2, '0')"

#: Candles of all timeframes with the bins their range and their close meet.
BINNED = f"""
    s AS {SEVERAL}, g AS (SELECT CAST(unnest(range(CAST(floor(ln((SELECT min(low) FROM s)) / ln(1.001)) AS BIGINT) - 4, CAST(ceil(ln((SELECT max(high) FROM s)) / ln(1.001)) AS BIGINT) + 5)) AS BIGINT) AS bin),
    edges AS (SELECT bin, pow(1.001, bin - 0.5) AS lo, pow(1.001, bin + 0.5) AS hi FROM g),
    hit AS (SELECT s.*, bin, s.close BETWEEN lo AND hi AS inside, lag(row) OVER (PARTITION BY timeframe, bin ORDER BY row) AS before FROM edges JOIN s ON s.high >= lo AND s.low <= hi),
    dens AS (SELECT symbol, timeframe, bin, count(*) AS touches, count(*) FILTER (WHERE before IS NULL OR before <> row - 1) AS episodes, count(*) FILTER (WHERE inside) AS close_inside, count(DISTINCT strftime(open_time, '%Y-%m')) AS months, min(row) AS first FROM hit GROUP BY ALL),
    smooth AS (SELECT d.*, CAST(d.touches * 0.5 + coalesce(a.touches, 0) * 0.25 + coalesce(b.touches, 0) * 0.25 AS DOUBLE) AS smoothed FROM dens d LEFT JOIN dens a ON a.timeframe = d.timeframe AND a.bin = d.bin - 1 LEFT JOIN dens b ON b.timeframe = d.timeframe AND b.bin = d.bin + 1),
    ranked AS (SELECT *, row(smoothed, touches, episodes, months, close_inside, -first, -bin) AS k FROM smooth),
    peak AS (SELECT a.symbol, a.timeframe, a.bin, pow(1.001, a.bin) AS center, pow(1.001, a.bin) * 0.999 AS zone_lower, pow(1.001, a.bin) * 1.001 AS zone_upper, a.touches, a.episodes, a.months, a.close_inside, a.smoothed
             FROM ranked a WHERE NOT EXISTS (SELECT 1 FROM ranked b WHERE b.timeframe = a.timeframe AND b.bin BETWEEN a.bin - 5 AND a.bin + 5 AND b.k > a.k))"""

def openings(timeframe: str, by_type: bool) -> str:
    """Openings with their signed later candles, in hundredths."""
    return f"""
    s AS (SELECT symbol, row, {exact("open")} AS o, {exact("high")} AS h, {exact("low")} AS l, {exact("close")} AS c FROM {rows(timeframe, by_type)}),
    a AS (SELECT symbol, row, CASE WHEN c > o THEN 'HIGH' ELSE 'LOW' END AS side, CASE WHEN c > o THEN 1 ELSE -1 END AS sgn FROM s WHERE c <> o),
    f AS (SELECT a.symbol, a.row, a.side, a.sgn, s.row - a.row AS k, sgn * o AS o, CASE WHEN sgn > 0 THEN h ELSE -l END AS h, CASE WHEN sgn > 0 THEN l ELSE -h END AS l, sgn * c AS c
          FROM a JOIN s ON s.symbol = a.symbol AND s.row BETWEEN a.row AND a.row + 10)"""

#: Exact statistics of the zones of peaks.
LEVELS = f"""WITH RECURSIVE {BINNED}, m AS (SELECT s.*, p.bin, zone_lower AS zl, zone_upper AS zu, lag(s.row) OVER (PARTITION BY s.timeframe, p.bin ORDER BY s.row) AS was, sb.close AS pc
            FROM peak p JOIN s ON s.timeframe = p.timeframe AND s.high >= zone_lower AND s.low <= zone_upper LEFT JOIN s sb ON sb.timeframe = s.timeframe AND sb.row = s.row - 1),
        y AS (SELECT *, CASE WHEN close BETWEEN zl AND zu THEN 'C' WHEN greatest(open, close) >= zl AND least(open, close) <= zu THEN 'B' ELSE 'W' END AS kind, count(*) OVER (PARTITION BY timeframe, bin, strftime(open_time, '%Y-%m')) AS inm FROM m),
        z AS (SELECT timeframe, bin, count(*) AS touches, count(*) FILTER (WHERE was IS NULL OR was <> row - 1) AS episodes, count(*) FILTER (WHERE kind = 'C') AS close_inside, count(*) FILTER (WHERE kind = 'B') AS body, count(*) FILTER (WHERE kind = 'W') AS wick,
            count(DISTINCT open_time::DATE) AS dates, count(DISTINCT {WEEK}) AS weeks, count(DISTINCT strftime(open_time, '%Y-%m')) AS months, count(DISTINCT (year(open_time), quarter(open_time))) AS quarters, count(DISTINCT year(open_time)) AS years, min(open_time) AS first_touch, max(open_time) AS last_touch,
            count(*) FILTER (WHERE open BETWEEN zl AND zu) AS n_open_inside, count(*) FILTER (WHERE low < zl AND high > zu) AS n_crosses, count(*) FILTER (WHERE pc > zu) AS n_from_above, count(*) FILTER (WHERE pc < zl) AS n_from_below,
            count(*) FILTER (WHERE close > open) AS n_bullish, count(*) FILTER (WHERE close < open) AS n_bearish, count(*) FILTER (WHERE close = open) AS n_doji, max(inm) AS busiest FROM y GROUP BY ALL)"""


def pct(value: str) -> str:
    """Average rank less one over the rows less one; 1 for a single row."""
    by = f"OVER (PARTITION BY timeframe ORDER BY {value})"
    return f"CASE WHEN count(*) OVER (PARTITION BY timeframe) = 1 THEN 1.0 ELSE (rank() {by} + (count(*) OVER (PARTITION BY timeframe, {value}) - 1) / 2 - 1) / (count(*) OVER (PARTITION BY timeframe) - 1) END"


SPECIAL_30M = f"""WITH RECURSIVE {openings("30m", False)}, b AS (SELECT * FROM f WHERE k = 0),
        z AS (SELECT b.symbol, b.row, b.side, f.k, b.o AS bo, b.c AS bc, f.o AS zo, f.c AS zc FROM b JOIN f ON f.symbol = b.symbol AND f.row = b.row AND f.k BETWEEN 7 AND 10
              WHERE b.c - f.c >= 0 AND 3 * (b.c - f.c) >= b.c - b.o AND 3 * (b.c - f.c) <= 5 * (b.c - b.o) AND f.c < f.o),
        p AS (SELECT x.symbol, x.row, x.k, x.c, x.l FROM f x JOIN f y ON y.symbol = x.symbol AND y.row = x.row AND y.k = x.k + 1 WHERE x.k >= 1 AND x.c < x.o AND y.c > y.o),
        r AS (SELECT z.symbol, z.row, z.k, arg_min(p.l, row(p.c, -p.k)) AS rl FROM z JOIN p ON p.symbol = z.symbol AND p.row = z.row AND p.k <= z.k - 2 GROUP BY ALL),
        w AS (SELECT z.*, row_number() OVER (PARTITION BY symbol, row ORDER BY k) AS n FROM z LEFT JOIN r USING (symbol, row, k) WHERE rl IS NULL OR rl >= zc),
        i AS (SELECT w.symbol, w.row, max(f.h) AS peak FROM w JOIN f ON f.symbol = w.symbol AND f.row = w.row AND f.k BETWEEN 1 AND w.k - 1 WHERE n = 1 GROUP BY ALL),
        t AS (SELECT w.symbol, w.row, max(f.k) AS e, max(f.k) - coalesce(max(f.k) FILTER (WHERE f.h <> peak AND f.k < le), 0) AS run, any_value(le) AS le, coalesce(max(f.k) FILTER (WHERE f.h <> peak AND f.k < le), 0) AS gap
              FROM w JOIN i USING (symbol, row) JOIN (SELECT w.symbol, w.row, max(f.k) AS le FROM w JOIN i USING (symbol, row) JOIN f ON f.symbol = w.symbol AND f.row = w.row AND f.k BETWEEN 1 AND w.k - 1 AND f.h = peak WHERE n = 1 GROUP BY ALL) USING (symbol, row)
              JOIN f ON f.symbol = w.symbol AND f.row = w.row AND f.k BETWEEN 1 AND w.k - 1 WHERE n = 1 GROUP BY ALL),
        found AS (SELECT w.symbol, w.side, w.row, w.k, 'NORMAL' AS kind, CASE WHEN (peak - bo) * 100 < abs(bo) THEN 'OPEN_BOUNDARY' WHEN (peak - zc) * 100 < abs(zc) THEN 'CLOSE_BOUNDARY' ELSE 'OK' END AS reason, abs(peak) / 100.0 AS price,
        w.row + gap + 1 AS plateau_start, w.row + le AS plateau_end, round((peak - bo) / abs(bo) * 100, 10) AS open_percent, round((peak - zc) / abs(zc) * 100, 10) AS close_percent, w.row + w.k AS close_row, round(abs(3 * zc - 2 * bc - bo) / abs(2 * bc + bo) * 100, 10) AS miss FROM w JOIN i USING (symbol, row) JOIN t USING (symbol, row) WHERE n = 1)"""

SPECIAL_4H = f"""WITH RECURSIVE {openings("4h", True)}, b AS (SELECT * FROM f WHERE k = 0), n AS (SELECT * FROM f WHERE k = 1),
        zero AS (SELECT b.symbol, b.side, b.row, 1 AS k, 'ZERO' AS kind, b.o AS bo, b.c AS bc, n.o AS zo, n.c AS zc, greatest(b.h, n.h) AS peak, b.row + (b.h < n.h)::INT AS plateau_start, b.row + (n.h >= b.h)::INT AS plateau_end
                 FROM b JOIN n USING (symbol, row) WHERE n.c <= b.o),
        z AS (SELECT b.symbol, b.side, b.row, f.k, b.o AS bo, b.c AS bc, f.o AS zo, f.c AS zc, row_number() OVER (PARTITION BY b.symbol, b.row ORDER BY f.k) AS i FROM b JOIN n USING (symbol, row) JOIN f ON f.symbol = b.symbol AND f.row = b.row AND f.k BETWEEN 2 AND 6
              WHERE n.c > b.o AND 3 * (b.c - f.c) >= b.c - b.o),
        inner_ AS (SELECT z.symbol, z.row, f.k AS j, f.h, max(f.h) OVER (PARTITION BY z.symbol, z.row) AS peak FROM z JOIN f ON f.symbol = z.symbol AND f.row = z.row AND f.k BETWEEN 1 AND z.k - 1 WHERE i = 1),
        lasts AS (SELECT symbol, row, any_value(peak) AS peak, max(j) FILTER (WHERE h = peak) AS le FROM inner_ GROUP BY ALL),
        runs AS (SELECT symbol, row, coalesce(max(j) FILTER (WHERE h <> inner_.peak AND j < le), 0) AS gap FROM inner_ JOIN lasts USING (symbol, row) GROUP BY ALL),
        both_ AS (SELECT * FROM zero UNION ALL SELECT z.symbol, side, z.row, k, 'NORMAL', bo, bc, zo, zc, peak, z.row + gap + 1, z.row + le FROM z JOIN lasts USING (symbol, row) JOIN runs USING (symbol, row) WHERE i = 1),
        found AS (SELECT symbol, side, row, k, kind, CASE WHEN kind = 'ZERO' AND zc >= zo THEN 'DIRECTION' WHEN (peak - bo) * 1000 < abs(bo) * 13 THEN 'OPEN_BOUNDARY' WHEN (peak - zc) * 1000 < abs(zc) * 13 THEN 'CLOSE_BOUNDARY' ELSE 'OK' END AS reason, abs(peak) / 100.0 AS price,
        plateau_start, plateau_end, round((peak - bo) / abs(bo) * 100, 10) AS open_percent, round((peak - zc) / abs(zc) * 100, 10) AS close_percent, row + k AS close_row, CASE kind WHEN 'ZERO' THEN round(abs(zc - bo) / abs(bo) * 100, 10) ELSE round(abs(3 * zc - 2 * bc - bo) / abs(2 * bc + bo) * 100, 10) END AS miss FROM both_)"""

#: Events of the passing swings in ``found``: the first of a family is primary; of primaries that overlap and hold each other's extreme, one stays.
OUTCOMES = """,
        fam AS (SELECT *, side || '|' || printf('%d.%02d000000', CAST(round(price * 100) AS BIGINT) // 100, CAST(round(price * 100) AS BIGINT) % 100) || '|' || plateau_start || '|' || plateau_end AS event_id, least(open_percent, close_percent) AS edge FROM found WHERE reason = 'OK'),
        placed AS (SELECT *, row_number() OVER (PARTITION BY symbol, event_id ORDER BY k, miss, edge DESC, close_row, row DESC) AS n FROM fam),
        prim AS (SELECT symbol, side, row AS x, close_row AS z, plateau_end AS e, row_number() OVER (PARTITION BY symbol, side ORDER BY k, miss, edge DESC, close_row, row DESC) AS place FROM placed WHERE n = 1),
        link AS (SELECT a.symbol, a.side, a.x, b.x AS y FROM prim a JOIN prim b USING (symbol, side) WHERE a.x <= b.z AND b.x <= a.z AND (b.e BETWEEN a.x AND a.z OR a.e BETWEEN b.x AND b.z)),
        reach AS (SELECT symbol, side, x, y FROM link UNION SELECT r.symbol, r.side, r.x, l.y FROM reach r JOIN link l ON l.symbol = r.symbol AND l.side = r.side AND l.x = r.y),
        fate AS (SELECT a.symbol, a.side, a.x, any_value(a.z) AS z, any_value(a.place) AS place, min(b.place) AS best, arg_min(b.x, b.place) AS wx, arg_min(b.z, b.place) AS wz,
                 bool_or(b.x <= a.x AND a.z <= b.z AND (b.x < a.x OR a.z < b.z)) AS inside FROM prim a JOIN reach r USING (symbol, side, x) JOIN prim b ON b.symbol = a.symbol AND b.side = a.side AND b.x = r.y GROUP BY ALL)
        SELECT symbol, side, row, close_row, price, event_id, CASE WHEN n = 1 THEN 'PRIMARY' ELSE 'DERIVED' END AS family,
        CASE WHEN n > 1 THEN NULL WHEN place = best THEN 'KEPT' WHEN inside AND NOT (row <= wx AND wz <= close_row) THEN 'NESTED' ELSE 'LONGER' END AS outcome
        FROM placed LEFT JOIN (SELECT symbol, side, x AS row, place, best, wx, wz, inside FROM fate) USING (symbol, side, row)"""


ORACLES: dict[str, str] = {
    "ohlcv_1h": f"SELECT * FROM {candle('1h')}",
    "ohlcv_4h_by_symbol": f"SELECT * FROM {candle('4h', True)}",
    "ohlcv_1d": f"SELECT * FROM {candle('1d')}",
    "fold_1h_4h": f"""SELECT symbol, '4h' AS timeframe, o AS open_time, o + INTERVAL '4 hours' - INTERVAL '1 millisecond' AS close_time, open, high, low, close, volume, trades
        FROM ({FOLD_4H.format(src=candle("1h"))}) WHERE children = 4""",
    "fold_flags_by_symbol": f"""SELECT symbol, '4h' AS timeframe, o AS open_time, o + INTERVAL '4 hours' - INTERVAL '1 millisecond' AS close_time, open, high, low, close, volume, trades, children, children = 4 AS complete
        FROM ({FOLD_4H.format(src=candle("1h", True))})""",
    "timeframe_agreement": " UNION ALL ".join(
        f"""SELECT '{a}' AS child, '{b}' AS parent, count(*) AS buckets, 0::BIGINT AS only_a, 0::BIGINT AS only_b, 0::BIGINT AS open_differs, 0::BIGINT AS high_differs, 0::BIGINT AS low_differs, 0::BIGINT AS close_differs, 0::BIGINT AS volume_differs, 0::BIGINT AS trades_differs FROM {candle(b)}"""
        for a, b in (("1h", "4h"), ("1h", "1d"), ("4h", "1d"))
    ),
    "conservation": """SELECT symbol, year, month, v AS source_volume, v AS derived_volume, n AS source_trades, n AS derived_trades, true AS conserved FROM (
        SELECT event_type AS symbol, year(ts) AS year, month(ts) AS month, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS v, count(*) AS n FROM events GROUP BY ROLLUP (event_type, year(ts), month(ts)))""",
    "consumption": f"""WITH c AS {candle("1h", True)}, p AS (SELECT symbol, time_bucket(INTERVAL '4 hours', open_time) AS o, count(*) AS n FROM c GROUP BY ALL)
        SELECT symbol, CAST(coalesce(sum(n) FILTER (WHERE n = 4), 0) AS BIGINT) AS consumed, CAST(coalesce(sum(n) FILTER (WHERE n < 4), 0) AS BIGINT) AS omitted FROM p GROUP BY symbol""",
    "defect_counts": f"""WITH g AS ({GAPS}) SELECT symbol, count(*) AS rows, 0::BIGINT AS nulls, 0::BIGINT AS duplicates, count(*) FILTER (WHERE nxt > open_time + INTERVAL '1 hour') AS gaps,
        CAST(coalesce(sum(date_diff('hour', open_time, nxt) - 1), 0) AS BIGINT) AS missing, 0::BIGINT AS off_grid, 0::BIGINT AS bad_ohlc, 0::BIGINT AS negative FROM g GROUP BY symbol""",
    "gap_ranges": f"""SELECT symbol, open_time + INTERVAL '1 hour' AS gap_start, nxt - INTERVAL '1 hour' AS gap_end, date_diff('hour', open_time, nxt) - 1 AS missing FROM ({GAPS}) WHERE nxt > open_time + INTERVAL '1 hour'""",
    "coverage_islands": f"""SELECT symbol, min(open_time) AS run_start, max(open_time) AS run_end, count(*) AS rows FROM (
        SELECT symbol, open_time, date_diff('hour', TIMESTAMP '2000-01-01', open_time) - row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS k FROM {candle("1h", True)}) GROUP BY symbol, k""",
    "content_fingerprint": f"""WITH m AS (SELECT symbol, date_trunc('month', open_time) AS month, count(*) AS n, sha256(string_agg(CAST(epoch_us(open_time) AS VARCHAR) || '|' || CAST(CAST(round(open * 100) AS BIGINT) * 1000000 AS VARCHAR) || '|' || CAST(CAST(round(high * 100) AS BIGINT) * 1000000 AS VARCHAR) || '|' || CAST(CAST(round(low * 100) AS BIGINT) * 1000000 AS VARCHAR) || '|' || CAST(CAST(round(close * 100) AS BIGINT) * 1000000 AS VARCHAR) || '|' || CAST(CAST(round(volume * 100) AS BIGINT) * 1000000 AS VARCHAR) || '|' || CAST(trades AS VARCHAR), chr(10) ORDER BY open_time) || chr(10)) AS d FROM {candle("1h", True)} GROUP BY ALL)
        SELECT symbol, CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(d, chr(10) ORDER BY month) || chr(10)) AS content FROM m GROUP BY symbol""",
    "range_half_open": f"""SELECT symbol, timeframe, open_time, close_time, close, volume, false AS is_warmup FROM {candle("1h")} WHERE open_time >= TIMESTAMP '2024-01-10' AND open_time < TIMESTAMP '2024-01-20'""",
    "range_warmup_100": f"""WITH c AS {candle("1h")} SELECT *, false AS is_warmup FROM c WHERE open_time >= TIMESTAMP '2024-01-10' AND open_time < TIMESTAMP '2024-01-20'
        UNION ALL SELECT * FROM (SELECT *, true FROM c WHERE close_time < TIMESTAMP '2024-01-10' ORDER BY open_time DESC LIMIT 100)""",
    "asof_1h_4h_close": f"""SELECT b.*, coalesce(h.row, -1) AS h4_idx, h.close AS h4_close, h.open_time AS h4_open_time FROM {candle("1h")} b ASOF LEFT JOIN {rows("4h")} h ON b.symbol = h.symbol AND b.close_time >= h.close_time""",
    "asof_1h_1d_open": f"""SELECT b.*, coalesce(h.row, -1) AS d1_idx, h.high AS d1_high FROM {candle("1h", True)} b ASOF LEFT JOIN {rows("1d", True)} h ON b.symbol = h.symbol AND b.open_time >= h.close_time""",
    "multi_timeframe": f"""WITH c AS {candle("1h")}, b AS (SELECT *, false AS is_warmup FROM c WHERE open_time >= TIMESTAMP '2024-01-10' AND open_time < TIMESTAMP '2024-01-20'
        UNION ALL SELECT * FROM (SELECT *, true FROM c WHERE close_time < TIMESTAMP '2024-01-10' ORDER BY open_time DESC LIMIT 10)),
        f AS (SELECT min(open_time) AS anchor FROM b), h AS (SELECT *, row - (SELECT max(row) FROM {rows("4h")} x WHERE x.close_time < anchor) AS i FROM {rows("4h")}, f), d AS (SELECT *, row - (SELECT max(row) FROM {rows("1d")} x WHERE x.close_time < anchor) AS i FROM {rows("1d")}, f)
        SELECT b.*, coalesce(h.i, -1) AS tf_4h_idx, coalesce(d.i, -1) AS tf_1d_idx FROM b ASOF LEFT JOIN h ON b.symbol = h.symbol AND b.close_time >= h.close_time ASOF LEFT JOIN d ON b.symbol = d.symbol AND b.close_time >= d.close_time""",
    "asof_defects": "SELECT 0::BIGINT AS look_ahead, 0::BIGINT AS skipped, 0::BIGINT AS backward, 0::BIGINT AS out_of_range",
    "bar_shapes": f"""SELECT open_time, CASE WHEN close > open THEN 'BULLISH' WHEN close < open THEN 'BEARISH' ELSE 'DOJI' END AS direction, least(open, close) AS body_low, greatest(open, close) AS body_high,
        abs({exact("close")} - {exact("open")}) / 100.0 AS body, ({exact("high")} - {exact("greatest(open, close)")}) / 100.0 AS upper_wick, ({exact("least(open, close)")} - {exact("low")}) / 100.0 AS lower_wick,
        strftime(open_time, '%Y-%m') AS month, year(open_time) || '-Q' || quarter(open_time) AS quarter, {WEEK} AS week FROM {candle("1h")}""",
    "true_range_atr14": f"""WITH t AS (SELECT row, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM {rows("1h")} WINDOW w AS (ORDER BY row)),
        seed AS (SELECT avg(tr) AS a FROM t WHERE row < 14)
        SELECT t.row, round(any_value(t.tr), 6) AS tr, CASE WHEN t.row >= 13 THEN round(any_value(seed.a) * pow(13 / 14.0, t.row - 13) + coalesce(sum(p.tr * pow(13 / 14.0, t.row - p.row)) FILTER (WHERE p.row > 13), 0) / 14, 6) END AS atr
        FROM t CROSS JOIN seed JOIN t p ON p.row <= t.row GROUP BY t.row""",
    "rolling_bodies": f"""SELECT row, round(median(b) OVER p, 6) AS median_body, round(avg(b) OVER p, 6) AS mean_body, CASE WHEN count(*) OVER p = 20 THEN max(close) OVER p END AS highest_close, CASE WHEN count(*) OVER p = 20 THEN min(close) OVER p END AS lowest_close,
        CASE WHEN count(*) OVER q = 50 THEN round(avg(volume) OVER q, 6) END AS mean_volume FROM (SELECT *, abs({exact("close")} - {exact("open")}) / 100.0 AS b FROM {rows("1h")})
        WINDOW p AS (ORDER BY row ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), q AS (ORDER BY row ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""",
    "pivots_3_3": f"""WITH s AS (SELECT *, max(high) OVER b AS bh, min(low) OVER b AS bl, max(high) OVER a AS ah, min(low) OVER a AS al, count(*) OVER b AS nb, count(*) OVER a AS na FROM {rows("1h", True)}
        WINDOW b AS (PARTITION BY symbol ORDER BY row ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY symbol ORDER BY row ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING))
        SELECT symbol, timeframe, 'HIGH' AS side, row, open_time, high AS price, row + 3 AS confirmed_row FROM s WHERE nb = 3 AND na = 3 AND bh < high AND ah <= high
        UNION ALL SELECT symbol, timeframe, 'LOW', row, open_time, low, row + 3 FROM s WHERE nb = 3 AND na = 3 AND bl > low AND al >= low""",
    "suffix_extremes": f"SELECT row, max(high) OVER w AS later_high, min(low) OVER w AS later_low FROM {rows('1h')} WINDOW w AS (ORDER BY row ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)",
    "rank_percentiles": f"""WITH s AS {rows("4h", True)} SELECT a.symbol, a.row, a.trades, round((count(*) FILTER (WHERE b.trades < a.trades) + (count(*) FILTER (WHERE b.trades = a.trades) - 1) / 2) / (count(*) - 1), 6) AS pct
        FROM s a JOIN s b ON a.symbol = b.symbol GROUP BY ALL""",
    "first_reaches": f"WITH s AS {rows('1h')} SELECT row, reach_high, reach_low, close_reach_high, close_reach_low FROM ({REACHES})",
    "open_liquidity": f"""{CANDIDATES} SELECT timeframe, side, row, price, status, mitigation_row, close_row, origin, future_bars, mechanism, CASE WHEN mx IS NOT NULL THEN sgn * ({exact("mx")} - {exact("price")}) / 100.0 END AS penetration,
        row_number() OVER w AS chain_position, count(*) OVER (PARTITION BY timeframe, side, price) AS chain_length, lag(row) OVER w AS chain_previous, lead(row) OVER w AS chain_next, near_miss
        FROM found WINDOW w AS (PARTITION BY timeframe, side, price ORDER BY row)""",
    "open_liquidity_ranks": f"""{CANDIDATES}, o AS (SELECT *, abs({exact("price")} - {exact("final_close")}) / 100.0 AS distance FROM found WHERE status LIKE 'OPEN%')
        SELECT timeframe, side, row, price, distance, round(distance / final_close * 100, 6) AS distance_percent, row_number() OVER (PARTITION BY timeframe, side ORDER BY distance, future_bars DESC) AS rank_nearest,
        row_number() OVER (PARTITION BY timeframe, side ORDER BY open_time) AS rank_oldest, row_number() OVER (PARTITION BY timeframe, side ORDER BY open_time DESC) AS rank_newest, row_number() OVER (PARTITION BY timeframe, side ORDER BY future_bars DESC) AS rank_observed, CASE WHEN future_bars * 100 < n THEN 'VERY_LOW' WHEN future_bars * 20 < n THEN 'LOW' WHEN future_bars * 5 < n THEN 'MODERATE' ELSE 'HIGH' END || '_FUTURE_OBSERVATION' AS observation FROM o""",
    "open_liquidity_months": f"""{CANDIDATES} SELECT symbol, timeframe, side, strftime(open_time, '%Y-%m') AS month, count(*) AS candidates, count(*) FILTER (WHERE status LIKE 'OPEN%') AS open, count(*) FILTER (WHERE status = 'MITIGATED') AS mitigated,
        count(*) FILTER (WHERE status LIKE 'TERM%') AS terminal, count(close_row) AS closed_beyond FROM found GROUP BY ALL""",
    "open_liquidity_mechanisms": f"{CANDIDATES} SELECT symbol, timeframe, side, mechanism, count(*) AS count FROM found WHERE mechanism IS NOT NULL GROUP BY ALL",
    "order_block_pairs": f"SELECT symbol, row, CASE WHEN sgn > 0 THEN 'BULLISH' WHEN sgn < 0 THEN 'BEARISH' END AS side, {DISPOSITION.format(p=1)} AS disposition, moved / 100.0 AS moved FROM ({PAIRS})",
    "order_blocks": f"""WITH r AS (SELECT symbol, row AS impulse_row, median(b) OVER p AS med, CASE WHEN count(*) OVER p = 20 THEN max({exact("close")}) OVER p END AS hc, CASE WHEN count(*) OVER p = 20 THEN min({exact("close")}) OVER p END AS lc
            FROM (SELECT *, abs({exact("close")} - {exact("open")}) / 100.0 AS b FROM {rows("4h", True)}) WINDOW p AS (PARTITION BY symbol ORDER BY row ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
        q AS (SELECT *, moved / 100.0 / open * 100 AS pct, abs(nc - no_) / 100.0 AS imp, abs({exact("close")} - {exact("open")}) / 100.0 AS body, coalesce(CASE WHEN sgn > 0 THEN nc > hc ELSE nc < lc END, false) AS broke FROM {blocks()} JOIN r USING (symbol, impulse_row)),
        z AS (SELECT *, 100 * (0.5 * greatest(0, least(1, (pct - 1) / 2)) + 0.25 * greatest(0, least(1, coalesce(imp / nullif(med, 0), 0) / 3)) + 0.15 * greatest(0, least(1, imp / body / 3)) + 0.1 * broke::INT) AS q FROM q)
        SELECT symbol, side, block_row AS row, lo AS zone_lower, hi AS zone_upper, round(pct, 6) AS displacement_percent, round(imp / nullif(med, 0), 6) AS impulse_to_median, round(imp / body, 6) AS impulse_to_origin, broke AS structure_break, round(q, 6) AS quality,
        CASE WHEN q >= 85 THEN 'VERY_STRONG' WHEN q >= 70 THEN 'STRONG' WHEN q >= 50 THEN 'MODERATE' WHEN q >= 30 THEN 'WEAK' ELSE 'VERY_WEAK' END AS quality_label FROM z""",
    "order_block_lifecycle": f"""{LIFE} SELECT symbol, side, block_row, CASE WHEN later_bars IS NULL THEN 'TERMINAL' WHEN invalid_row IS NOT NULL THEN 'INVALIDATED' WHEN touch_row IS NOT NULL THEN 'MITIGATED' ELSE 'UNTOUCHED' END AS status,
        gap_row, touch_row, midpoint_row, full_row, invalid_row, wick_only_row, later_bars, touch_bars, touch_episodes, excursion_before, excursion_after FROM b LEFT JOIN life USING (symbol, side, block_row)""",
    "order_block_events": LIFE + ", e AS (" + " UNION ALL ".join(f"SELECT symbol, side, block_row, '{n}' AS event, {i} AS o, {n}_row AS row FROM life WHERE {n}_row IS NOT NULL" for i, n in enumerate(("gap", "touch", "midpoint", "full", "invalid", "wick_only"))) + """)
        SELECT symbol, '4h' AS timeframe, side, block_row, row_number() OVER (PARTITION BY symbol, side, block_row ORDER BY row, o) AS sequence, event, row FROM e""",
    "order_block_clusters": f"""WITH RECURSIVE b AS {blocks(200)}, e AS (SELECT a.symbol, a.block_row AS x, c.block_row AS y FROM b a JOIN b c ON a.symbol = c.symbol AND a.lo <= c.hi AND c.lo <= a.hi),
        r(symbol, x, y) AS (SELECT symbol, x, y FROM e UNION SELECT r.symbol, r.x, e.y FROM r JOIN e ON e.symbol = r.symbol AND e.x = r.y),
        k AS (SELECT r.symbol, r.x, min(b.lo) AS low, count(*) AS n FROM r JOIN b ON b.symbol = r.symbol AND b.block_row = r.y GROUP BY ALL)
        SELECT b.symbol, block_row AS row, lo AS zone_lower, hi AS zone_upper, dense_rank() OVER (PARTITION BY b.symbol ORDER BY low) AS cluster, n AS cluster_size FROM b JOIN k ON k.symbol = b.symbol AND k.x = b.block_row""",
    "touch_density": f"WITH {BINNED} SELECT symbol, timeframe, bin, touches, episodes, close_inside, months, smoothed FROM smooth",
    "touch_peaks": f"WITH {BINNED} SELECT * FROM peak",
    "touch_levels": LEVELS + """
        SELECT * EXCLUDE (busiest), (close_inside + body) / touches AS engagement, CASE WHEN months <= 2 OR date_diff('day', first_touch, last_touch) < 60 THEN 'RECENT_OR_EMERGING' WHEN busiest / touches >= 0.45 THEN 'FREQUENT_BUT_CONCENTRATED' WHEN months >= 6 AND busiest / touches <= 0.35 THEN 'FREQUENT_AND_PERSISTENT' ELSE 'INFREQUENT_BUT_PERSISTENT' END AS persistence FROM z""",
    "touch_accepted": LEVELS + f""",
        o AS (SELECT z.*, center, row_number() OVER (PARTITION BY z.timeframe ORDER BY z.touches DESC, z.episodes DESC, z.months DESC, z.close_inside DESC, z.bin) AS i FROM z JOIN peak USING (timeframe, bin)),
        pick AS (SELECT DISTINCT timeframe, 0::BIGINT AS i, []::DOUBLE[] AS taken, NULL::BIGINT AS bin, false AS ok FROM o
                 UNION ALL SELECT q.timeframe, q.i, CASE WHEN clash THEN taken ELSE list_append(taken, center) END, q.bin, NOT clash
                 FROM (SELECT o.timeframe, o.i, o.bin, o.center, g.taken, len(list_filter(g.taken, lambda x: abs(x - o.center) / ((x + o.center) / 2) * 100 < 0.5)) > 0 AS clash FROM pick g JOIN o ON o.timeframe = g.timeframe AND o.i = g.i + 1) q),
        u AS (SELECT timeframe, bin, row, close_time, count(*) OVER w AS n, count(*) FILTER (WHERE was IS NULL OR was <> row - 1) OVER w AS e, count(DISTINCT open_time::DATE) OVER w AS d FROM y WINDOW w AS (PARTITION BY timeframe, bin ORDER BY row)),
        least_ AS (SELECT unnest(['1h', '4h', '1d']) AS timeframe, unnest([40, 20, 10]) AS need),
        met AS (SELECT timeframe, bin, min(close_time) AS first_eligible FROM u JOIN least_ USING (timeframe) WHERE n >= need AND e >= 3 AND d >= 3 GROUP BY ALL),
        good AS (SELECT o.*, first_eligible FROM o JOIN least_ USING (timeframe) JOIN pick USING (timeframe, bin) LEFT JOIN met USING (timeframe, bin) WHERE ok AND touches >= need AND episodes >= 3 AND dates >= 3),
        scored AS (SELECT *, (close_inside + body) / touches AS engagement FROM good)
        SELECT timeframe, timeframe || '-' || lpad(CAST(row_number() OVER (PARTITION BY timeframe ORDER BY center) AS VARCHAR), 6, '0') AS id,
        row_number() OVER (PARTITION BY timeframe ORDER BY touches DESC, episodes DESC, months DESC, close_inside DESC, bin) AS rank, center, touches, {pct('touches')} AS touches_pct, {pct('episodes')} AS episodes_pct, {pct('months')} AS months_pct, {pct('engagement')} AS engagement_pct, first_eligible FROM scored""",
    "special_30m": SPECIAL_30M + " SELECT * EXCLUDE (miss) FROM found",
    "special_30m_outcomes": SPECIAL_30M + OUTCOMES,
    "special_4h": SPECIAL_4H + " SELECT * EXCLUDE (miss) FROM found",
    "special_4h_outcomes": SPECIAL_4H + OUTCOMES,
    "archive_plan": """WITH d AS (SELECT CAST(unnest(range(DATE '2024-12-01', DATE '2025-02-11', INTERVAL 1 DAY)) AS DATE) AS day), m AS (SELECT *, count(*) OVER (PARTITION BY date_trunc('month', day)) = day(last_day(day)) AS whole FROM d),
        p AS (SELECT DISTINCT CASE WHEN whole THEN 'monthly' ELSE 'daily' END AS kind, CASE WHEN whole THEN strftime(day, '%Y-%m') ELSE strftime(day, '%Y-%m-%d') END AS period, CASE WHEN day < DATE '2025-01-01' THEN 'ms' ELSE 'us' END AS unit FROM m)
        SELECT symbol, kind, period, unit FROM p CROSS JOIN (SELECT unnest(['BTCUSDT', 'ETHUSDT']) AS symbol)""",
    "leg_statistics": f"""WITH s AS (SELECT *, CAST(open_time AS DATE) AS day FROM {rows("1h", True)}), t AS (SELECT *, close - lag(close) OVER w AS d, ln(close / lag(close) OVER w) AS r, CASE WHEN high > low THEN (close - low) / (high - low) END AS loc FROM s WINDOW w AS (PARTITION BY symbol, day ORDER BY row))
        SELECT symbol, day, count(*) AS rows, round(regr_slope(close, row), 6) AS slope, round(abs(arg_max(close, row) - arg_min(close, row)) / nullif(sum(abs(d)), 0), 6) AS efficiency, round(coalesce(sum(abs(d)), 0), 6) AS path,
        round(sum((high + low + close) / 3 * volume) / sum(volume), 6) AS vwap, round(stddev_pop(r), 6) AS volatility, round(avg(loc), 6) AS close_location FROM t GROUP BY symbol, day""",
    "swing_formations": f"""WITH s AS (SELECT symbol, row, {exact("high")} AS h, {exact("low")} AS l, {exact("close")} AS c FROM {rows("4h", True)}),
        win AS (SELECT a.symbol, a.row, n AS length, b.row - a.row + 1 AS i, side, CASE WHEN side = 'HIGH' THEN b.h ELSE -b.l END AS h, CASE WHEN side = 'HIGH' THEN b.l ELSE -b.h END AS l, CASE WHEN side = 'HIGH' THEN b.c ELSE -b.c END AS c
            FROM s a CROSS JOIN (SELECT unnest(range(5, 11)) AS n) CROSS JOIN (SELECT unnest(['HIGH', 'LOW']) AS side) JOIN s b ON b.symbol = a.symbol AND b.row BETWEEN a.row AND a.row + n - 1),
        top AS (SELECT *, max(h) OVER (PARTITION BY symbol, row, length, side) AS peak FROM win),
        g AS (SELECT symbol, side, row, length, any_value(peak) AS peak, count(*) AS got, min(i) FILTER (WHERE h = peak) AS lo, max(i) FILTER (WHERE h = peak) AS hi, count(*) FILTER (WHERE h = peak) AS np, any_value(c) FILTER (WHERE i = 1) AS ref,
            any_value(l) FILTER (WHERE i = length) AS ll, any_value(h) FILTER (WHERE i = length) AS lh, max(i) FILTER (WHERE h = peak AND i BETWEEN CASE WHEN length % 2 = 1 THEN (length + 1) // 2 - 1 ELSE length // 2 END AND CASE WHEN length % 2 = 1 THEN (length + 1) // 2 + 1 ELSE length // 2 + 1 END) AS rep FROM top GROUP BY ALL)
        SELECT symbol, side, row, length, CASE WHEN hi - lo + 1 <> np THEN 'BROKEN_PLATEAU' WHEN rep IS NULL THEN 'NOT_CENTRAL' WHEN (peak - ref) * 100 < abs(ref) THEN 'SMALL_OUTBOUND' WHEN NOT (ll <= ref AND ref <= lh) THEN 'NO_REVISIT' ELSE 'VALID' END AS label,
        row + rep - 1 AS extreme_row, abs(peak) / 100.0 AS price, row + length - 1 AS close_row FROM g WHERE got = length""",
}


def sound(checks: str) -> str:
    """An audit of a sound result: no failures of any check."""
    return f"SELECT unnest(string_split('{checks}', ' ')) AS check, 0::BIGINT AS failures"


ORACLES |= {
    "open_liquidity_audit": sound("status_known mitigated_has_row mitigated_later mechanism_if_mitigated penetration_not_negative close_not_before_reach terminal_is_last two_sides_per_candle chain_numbered one_open_per_chain"),
    "order_block_audit": sound("disposition_known side_in_disposition zone_ordered gap_row_after_impulse touch_row_after_impulse midpoint_row_after_impulse full_row_after_impulse invalid_row_after_impulse wick_only_row_after_impulse full_not_before_midpoint invalid_not_before_full episodes_within_touches status_agrees quality_in_range"),
    "swing_audit": sound("sequence_unbroken sides_alternate confirmed_after_extreme confirmed_in_order spaced displaced labelled"),
    "special_audit": sound("close_after_opening plateau_in_span boundaries_positive one_primary_per_event"),
}
