"""Order blocks: an opposite body followed by a displacing one, and what later candles do to its zone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.functions import bars
from candlewright.operators import crossing
from candlewright.operators.access import SERIES
from candlewright.operators.features import series, with_rolling
from candlewright.sources.scratch import settled

DISPLACEMENT = "1.00"
#: What becomes of a pair, apart from its side's two outcomes.
ORIGIN_DOJI, IMPULSE_DOJI, SAME_DIRECTION = "REJECTED_ORIGIN_DOJI", "REJECTED_IMPULSE_DOJI", "REJECTED_SAME_DIRECTION"
QUALIFIED = {"BULLISH": "QUALIFIED_BULLISH_ORDER_BLOCK", "BEARISH": "QUALIFIED_BEARISH_ORDER_BLOCK"}
BELOW = {"BULLISH": "REJECTED_BULLISH_DISPLACEMENT_BELOW_1_PERCENT", "BEARISH": "REJECTED_BEARISH_DISPLACEMENT_BELOW_1_PERCENT"}


def by_side(labels: dict[str, str]):
    return F.when(F.col("side") == "BULLISH", labels["BULLISH"]).otherwise(labels["BEARISH"])


def pairs(numbered: DataFrame, displacement: str = DISPLACEMENT) -> DataFrame:
    """Every adjacent pair (origin, impulse) with its side and disposition."""
    nxt = F.lead(F.struct("open", "high", "low", "close", "row", "open_time")).over(series())
    rows = numbered.withColumn("n", nxt).filter("n IS NOT NULL")
    first = bars.direction()
    second = F.when(F.col("n.close") > F.col("n.open"), "BULLISH").when(F.col("n.close") < F.col("n.open"), "BEARISH").otherwise("DOJI")
    rows = rows.withColumns({"origin_direction": first, "impulse_direction": second})
    side = F.when((F.col("origin_direction") == "BEARISH") & (F.col("impulse_direction") == "BULLISH"), "BULLISH").when((F.col("origin_direction") == "BULLISH") & (F.col("impulse_direction") == "BEARISH"), "BEARISH")
    moved = F.when(side == "BULLISH", F.col("n.close") - F.col("open")).when(side == "BEARISH", F.col("open") - F.col("n.close"))
    rows = rows.withColumns({"side": side, "moved": moved})
    label = (
        F.when(F.col("origin_direction") == "DOJI", ORIGIN_DOJI)
        .when(F.col("impulse_direction") == "DOJI", IMPULSE_DOJI)
        .when(F.col("side").isNull(), SAME_DIRECTION)
        .when(bars.at_least_percent(F.col("moved"), F.col("open"), displacement), by_side(QUALIFIED))
        .otherwise(by_side(BELOW))
    )
    return rows.withColumn("disposition", label)


def blocks(numbered: DataFrame, displacement: str = DISPLACEMENT) -> DataFrame:
    """Qualified pairs with zone, rolling measures before the impulse, structure break and quality 0-100."""
    rolled = with_rolling(numbered).select(*SERIES, "row", "median_body", "mean_body", "highest_close", "lowest_close")
    rows = pairs(numbered, displacement).filter(F.col("disposition").isin(*QUALIFIED.values())).select("*", F.col("n.row").alias("impulse_row"))
    rows = rows.join(rolled.withColumnRenamed("row", "impulse_row"), [*SERIES, "impulse_row"])
    up = F.col("side") == "BULLISH"
    body, impulse = bars.body().cast("double"), F.abs(F.col("n.close") - F.col("n.open")).cast("double")
    # a pair from zero to zero qualifies, with an undefined percentage
    percent = F.when(F.col("open") == 0, float("nan")).otherwise(F.col("moved").cast("double") / F.col("open").cast("double") * 100)
    broke = F.coalesce(F.when(up, F.col("n.close") > F.col("highest_close")).otherwise(F.col("n.close") < F.col("lowest_close")), F.lit(False))
    ratio20 = F.when(F.col("median_body") > 0, impulse / F.col("median_body"))
    ratio = F.when(body > 0, impulse / body)
    quality = 100 * (0.50 * bars.clamp((percent - 1) / 2) + 0.25 * bars.clamp(F.coalesce(ratio20, F.lit(0.0)) / 3) + 0.15 * bars.clamp(F.coalesce(ratio, F.lit(0.0)) / 3) + 0.10 * broke.cast("double"))
    label = bars.bands(quality, [(85, "VERY_STRONG"), (70, "STRONG"), (50, "MODERATE"), (30, "WEAK")], "VERY_WEAK")
    return rows.select(*SERIES, "side", "row", "impulse_row", "open_time", bars.body_low().alias("zone_lower"), bars.body_high().alias("zone_upper"), percent.alias("displacement_percent"), ratio20.alias("impulse_to_median"), ratio.alias("impulse_to_origin"), broke.alias("structure_break"), quality.alias("quality"), label.alias("quality_label"))


def firsts(candles: DataFrame, b: DataFrame) -> DataFrame:
    """(block key, event rows): the first later candle whose open, body or close passes a level of the block."""
    up = F.col("side") == "BULLISH"
    half = (F.col("zone_lower") + F.col("zone_upper")) / 2
    inner = F.when(up, F.col("zone_lower")).otherwise(F.col("zone_upper"))
    # below a bullish zone and above a bearish one: a price p beyond level x is -p >= -x (bullish) or p >= x, one unit more if strictly
    sides = {"open": "open", "body": None, "close": "close"}
    kinds = {}
    for name, column in sides.items():
        kinds[f"{name}_BULLISH"] = (column or bars.body_low(), -1)
        kinds[f"{name}_BEARISH"] = (column or bars.body_high(), 1)
    sign = F.when(up, -1).otherwise(1)
    level = lambda x, strictly=0: sign * crossing.scaled(x) + strictly
    sought = {"gap": ("open", level(inner, 1)), "midpoint": ("body", level_of_half(up, half)), "full": ("body", level(inner)), "invalid": ("close", level(inner, 1))}
    out = None
    for event, (name, at) in sought.items():
        q = b.select(*SERIES, F.concat(F.lit(f"{name}_"), F.col("side")).alias("kind"), F.col("block_id").alias("id"), F.col("impulse_row").cast("bigint").alias("after"), at.cast("bigint").alias("level"), F.lit(event).alias("event"))
        out = q if out is None else out.unionByName(q)
    # one search for all four: the event is folded into the id
    numbers = {e: i for i, e in enumerate(sought)}
    coded = F.col("id") * len(numbers) + F.coalesce(*(F.when(F.col("event") == e, i) for e, i in numbers.items()))
    hits = crossing.first_hits(crossing.points_of(candles, kinds), out.withColumn("id", coded).drop("event"))
    event = F.pmod(F.col("id"), F.lit(len(numbers)))
    return hits.groupBy(*SERIES, F.floor(F.col("id") / len(numbers)).alias("block_id")).agg(*(F.min(F.when(event == i, F.col("hit"))).alias(f"{e}_row") for e, i in numbers.items()))


def level_of_half(up, half):
    """The level of the middle of a zone, which may lie between two units: rounded away from where price comes from."""
    units = half * 100_000_000
    return F.when(up, -F.floor(units)).otherwise(F.ceil(units)).cast("bigint")


def touches(candles: DataFrame, b: DataFrame, piece: int = crossing.PIECE, share: int = 1 << 18) -> DataFrame:
    """(block key, touch_row, touch_bars, touch_episodes, wick_only_row, wick_only_bars) of blocks that later candles meet.

    A series is cut into pieces of ``piece`` rows. A block is compared with the candles of those pieces alone whose prices meet
    its zone, and brings one row from each, whatever the prices are; an episode that goes on into the next piece counts once.
    A task holds a piece and the blocks of ``share`` rows.
    """
    key, group = [*SERIES, "block_id"], [*SERIES, "piece", "part"]
    scaled = lambda x: crossing.scaled(x).alias
    own = lambda x: F.floor(x / piece).cast("bigint")
    rows = candles.select(*SERIES, own(F.col("row")).alias("piece"), "row", scaled(F.col("low"))("low"), scaled(F.col("high"))("high"), scaled(bars.body_low())("body_low"), scaled(bars.body_high())("body_high"))
    ranges = rows.groupBy(*SERIES, "piece").agg(F.min("low").alias("bottom"), F.max("high").alias("top"))
    zones = b.select(*key, F.col("impulse_row").cast("bigint").alias("after"), F.floor(F.col("block_row") / share).cast("bigint").alias("part"), scaled(F.col("zone_lower"))("lower"), scaled(F.col("zone_upper"))("upper"))
    zones = zones.join(F.broadcast(ranges), SERIES).filter((F.col("piece") >= own(F.col("after") + 1)) & (F.col("lower") <= F.col("top")) & (F.col("upper") >= F.col("bottom"))).drop("top", "bottom")
    zones = settled(zones, "zones")
    counts = "touch_row bigint, touch_bars bigint, touch_episodes bigint, head_row bigint, tail_row bigint, wick_only_row bigint, wick_only_bars bigint"
    wanted = zones.select(*group).distinct().toDF(*group)
    met = rows.join(wanted, [*SERIES, "piece"]).groupBy(*group).cogroup(zones.groupBy(*group)).applyInArrow(in_piece, f"symbol string, timeframe string, block_id bigint, piece bigint, {counts}")
    goes_on = F.col("head_row") == F.lag("tail_row").over(Window.partitionBy(*key).orderBy("piece")) + 1
    sums = [*(F.min(c).alias(c) for c in ("touch_row", "wick_only_row")), *(F.sum(c).alias(c) for c in ("touch_bars", "wick_only_bars"))]
    return met.withColumn("goes_on", goes_on).groupBy(*key).agg(*sums, (F.sum("touch_episodes") - F.count_if("goes_on")).alias("touch_episodes"))


def in_piece(candles: pa.Table, zones: pa.Table) -> pa.Table:
    """A row for each zone: first rows and counts of its touches in one piece, and the piece's first and last row where touched."""
    candles = candles.sort_by("row")
    row, low, high, body_low, body_high = (candles.column(c).to_numpy() for c in ("row", "low", "high", "body_low", "body_high"))
    next_to = np.diff(row) == 1
    found: dict[str, list] = {f: [] for f in ("touch_row", "touch_bars", "touch_episodes", "head_row", "tail_row", "wick_only_row", "wick_only_bars")}
    put = lambda name, values, there=None: found[name].append(pa.array(values, pa.int64(), mask=None if there is None else ~there))
    for lo in range(0, zones.num_rows, 256):
        after, lower, upper = (zones.column(c).slice(lo, 256).to_numpy()[:, None] for c in ("after", "lower", "upper"))
        met = (row > after) & (high >= lower) & (low <= upper)
        touch = met & (body_high >= lower) & (body_low <= upper)
        wick = met & ~touch
        put("touch_row", row[touch.argmax(1)], touch.any(1))
        put("touch_bars", touch.sum(1))
        put("touch_episodes", touch.sum(1) - (touch[:, 1:] & touch[:, :-1] & next_to).sum(1))
        put("head_row", np.full(len(touch), row[0]), touch[:, 0])
        put("tail_row", np.full(len(touch), row[-1]), touch[:, -1])
        put("wick_only_row", row[wick.argmax(1)], wick.any(1))
        put("wick_only_bars", wick.sum(1))
    columns = {c: zones.column(c) for c in (*SERIES, "block_id", "piece")} | {c: pa.chunked_array(x, pa.int64()) for c, x in found.items()}
    return pa.table(columns)


def lifecycle(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """Blocks with the first later rows of each event, touch episodes, status and excursions.

    Later means after the impulse. Events by price are searched in pieces (``crossing.first_hits``), touches are counted in the
    pieces whose prices meet the zone, and excursions are greatest values between two rows, so no step makes a row of each
    block and later candle.
    """
    candles = settled(numbered.select(*SERIES, F.col("row").cast("bigint").alias("row"), "open", "high", "low", "close"), "life")
    # a block is known by its row and side, folded into one number
    b = settled(found.withColumn("block_row", F.col("row").cast("bigint")).withColumn("block_id", F.col("row").cast("bigint") * 2 + (F.col("side") == "BULLISH").cast("int")), "blocks")
    key = [*SERIES, "block_id"]
    ends = candles.groupBy(*SERIES).agg(F.max("row").alias("last_row"))
    all_ = b.join(ends, SERIES).join(firsts(candles, b), key, "left").join(touches(candles, b), key, "left")
    later = F.col("last_row") - F.col("impulse_row")
    all_ = all_.withColumns({"later_bars": F.when(later > 0, later), **{c: F.when(later > 0, F.coalesce(F.col(c), F.lit(0))) for c in ("touch_bars", "touch_episodes", "wick_only_bars")}})
    all_ = settled(all_, "lived")
    windows = {"excursion_before": (F.col("impulse_row") + 1, F.coalesce(F.col("touch_row") - 1, F.col("last_row"))), "excursion_after": (F.col("touch_row") + 1, F.col("last_row"))}
    for name, (lo, hi) in windows.items():
        best = extremes_between(candles, all_.select(*key, lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi")))
        all_ = all_.join(best, key, "left").withColumn(name, F.when(F.col("side") == "BULLISH", F.col("top") - F.col("zone_upper")).otherwise(F.col("zone_lower") - F.col("bottom"))).drop("top", "bottom")
    status = F.when(F.col("later_bars").isNull(), "TERMINAL").when(F.col("invalid_row").isNotNull(), "INVALIDATED").when(F.col("touch_row").isNotNull(), "MITIGATED").otherwise("UNTOUCHED")
    return all_.withColumn("status", status).drop("block_id", "last_row", "row")


def extremes_between(candles: DataFrame, spans: DataFrame, fan: int = 64) -> DataFrame:
    """(series, block_id, top, bottom): highest high and lowest low of rows lo .. hi; empty spans have no row.

    Levels of blocks of ``fan`` ^ k rows: a span is the whole blocks inside it, of the largest size first, and what sticks out on
    both sides of the next size, so it meets 2 x fan rows of each level at most.
    """
    level = candles.select(*SERIES, F.col("row").alias("at"), F.col("high").alias("top"), F.col("low").alias("bottom"))
    rest = spans.filter("lo <= hi").select("*", F.lit(True).alias("live"))
    parts = None
    while True:
        # blocks of the next level: the span's blocks from the first whole one to the last whole one
        up_lo, up_hi = F.ceil(F.col("lo") / fan).cast("bigint"), (F.floor((F.col("hi") + 1) / fan) - 1).cast("bigint")
        inner = rest.withColumns({"up_lo": up_lo, "up_hi": up_hi})
        whole = F.col("up_lo") <= F.col("up_hi")
        edges = F.when(whole, F.concat(between(F.col("lo"), F.col("up_lo") * fan - 1), between((F.col("up_hi") + 1) * fan, F.col("hi")))).otherwise(between(F.col("lo"), F.col("hi")))
        here = inner.select(*SERIES, "block_id", F.explode(edges).alias("at")).join(level, [*SERIES, "at"]).groupBy(*SERIES, "block_id").agg(F.max("top").alias("top"), F.min("bottom").alias("bottom"))
        parts = here if parts is None else parts.unionByName(here)
        rest = settled(inner.filter(whole).select(*SERIES, "block_id", F.col("up_lo").alias("lo"), F.col("up_hi").alias("hi")), "spans")
        if rest.isEmpty():
            return parts.groupBy(*SERIES, "block_id").agg(F.max("top").alias("top"), F.min("bottom").alias("bottom"))
        level = settled(level.groupBy(*SERIES, F.floor(F.col("at") / fan).cast("bigint").alias("at")).agg(F.max("top").alias("top"), F.min("bottom").alias("bottom")), "level")


def between(lo, hi):
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def events(lived: DataFrame) -> DataFrame:
    """One row per first event of a block, in order; within one candle gap, touch, midpoint, full, invalid, wick_only."""
    names = ["gap", "touch", "midpoint", "full", "invalid", "wick_only"]
    each = F.array(*(F.struct(F.lit(i).alias("order"), F.lit(n).alias("event"), F.col(f"{n}_row").alias("row")) for i, n in enumerate(names)))
    rows = lived.select(*SERIES, "side", "block_row", F.explode(each).alias("e")).filter("e.row IS NOT NULL")
    sequence = F.row_number().over(Window.partitionBy(*SERIES, "side", "block_row").orderBy("e.row", "e.order"))
    return rows.select(*SERIES, "side", "block_row", sequence.alias("sequence"), "e.event", "e.row")


def clusters(found: DataFrame) -> DataFrame:
    """Blocks with the cluster of zones they overlap, directly or through others.

    Closed intervals on a line are connected just where, in order of lower ends, one starts at or below the highest end so far.
    """
    w = Window.partitionBy(*SERIES).orderBy("zone_lower", "zone_upper", "row")
    before = F.max("zone_upper").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("zone_lower") <= before, 0).otherwise(1)
    rows = found.withColumn("cluster", F.sum(starts).over(w))
    return rows.withColumn("cluster_size", F.count(F.lit(1)).over(Window.partitionBy(*SERIES, "cluster")))
