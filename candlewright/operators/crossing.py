"""The first later row at which a series reaches a level.

A series is cut into pieces of ``PIECE`` rows. A level is looked for in the rest of its own piece; if it is not there, in the greatest
values of the later pieces, which are a series of their own and searched in the same way; and then in the piece found. So
no task holds more than a piece and the levels that are looked for in it, whatever the length of the series.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.operators.access import SERIES
from candlewright.sources.scratch import settled

PIECE = 4096
KEY = "symbol string, timeframe string, kind string"


def first_at_least(values: list[int], levels: list[int]) -> list[int | None]:
    """For each i the least j > i with values[j] >= levels[i].

    Rows are taken from the last to the first. Rows hidden behind a nearer one that is as high can never be first, so what
    remains is a stack that rises with distance; a level is found in it by bisection.
    """
    return first_after(values, list(range(len(values))), levels)


def first_after(values: list[int], after: list[int], levels: list[int]) -> list[int | None]:
    """For each query k the least j > after[k] (-1: any) with values[j] >= levels[k]."""
    out: list[int | None] = [None] * len(levels)
    rows: list[int] = []  # from far to near
    tops: list[int] = []  # negated values, rising from far to near
    order = sorted(range(len(levels)), key=lambda k: -after[k])
    i = len(values) - 1
    for k in order:
        while i > after[k]:
            while tops and -tops[-1] <= values[i]:
                tops.pop()
                rows.pop()
            rows.append(i)
            tops.append(-values[i])
            i -= 1
        # nearest row whose value reaches the level: the last place with -tops >= level
        at = bisect_left(tops, -levels[k] + 1)
        if at:
            out[k] = rows[at - 1]
    return out


def in_pieces(points: DataFrame, queries: DataFrame, piece) -> DataFrame:
    """Queries (series, kind, id, after, level, piece) answered by the points of their piece: ``hit``, null if there is none."""
    key = [*SERIES, "kind", "piece"]

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("row")
        rows = points["row"].to_numpy()
        after = np.searchsorted(rows, queries["after"].to_numpy(), side="right") - 1
        found = first_after(points["value"].tolist(), after.tolist(), queries["level"].tolist())
        out = queries[[*SERIES, "kind", "id", "after", "level", "piece"]].copy()
        out["hit"] = pd.array([None if j is None else int(rows[j]) for j in found], dtype="Int64")
        return out

    cut = points.withColumn("piece", F.floor(F.col("row") / piece).cast("bigint"))
    return cut.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(search, f"{KEY}, id bigint, after bigint, level bigint, piece bigint, hit bigint")


def first_hits(points: DataFrame, queries: DataFrame, piece: int = PIECE) -> DataFrame:
    """(symbol, timeframe, kind, id, hit): the first row > after whose value >= level; queries without one have no row.

    points: symbol, timeframe, kind, row, value; queries: symbol, timeframe, kind, id, after, level; whole numbers. An empty
    side gives no rows. Rows need not be consecutive, but are once each in a series and kind.
    """
    name = [*SERIES, "kind", "id"]
    own = settled(in_pieces(points, queries.withColumn("piece", F.floor(F.greatest(F.col("after"), F.lit(0)) / piece).cast("bigint")), piece), "hits")
    here = own.filter("hit IS NOT NULL").select(*name, "hit")
    open_ = own.filter("hit IS NULL").select(*name, "after", "level", "piece")
    tops = points.groupBy(*SERIES, "kind", F.floor(F.col("row") / piece).cast("bigint").alias("row")).agg(F.max("value").alias("value"))
    several = tops.groupBy(*SERIES, "kind").count().filter("count > 1").limit(1)
    if open_.isEmpty() or several.isEmpty():
        return here
    later = first_hits(settled(tops, "tops"), open_.select(*name, F.col("piece").alias("after"), "level"), piece)
    there = open_.drop("piece", "after").join(later.withColumnRenamed("hit", "piece"), name).withColumn("after", F.lit(-1).cast("bigint"))
    return here.unionByName(in_pieces(points, there, piece).filter("hit IS NOT NULL").select(*name, "hit"))


def scaled(price):
    """A price as a whole number of 1e-8."""
    return (price * 100_000_000).cast("bigint")


#: Whose value is compared, and the sign that makes "reaches" read "is at least".
KINDS = {"high": ("high", 1), "low": ("low", -1), "close_up": ("close", 1), "close_down": ("close", -1)}


def points_of(candles: DataFrame, kinds: dict) -> DataFrame:
    each = F.array(*(F.struct(F.lit(k).alias("kind"), (sign * scaled(F.col(c) if isinstance(c, str) else c)).alias("value")) for k, (c, sign) in kinds.items()))
    return candles.select(*SERIES, F.col("row").cast("bigint").alias("row"), F.explode(each).alias("p")).select(*SERIES, "row", "p.kind", "p.value")


def first_reaches(candles: DataFrame) -> DataFrame:
    """Per candle the rows that first reach its extremes later: by range (reach_) and by close (close_reach_), high and low.

    ``candles`` are numbered (row). Prices are compared as whole multiples of 1e-8.
    """
    candles = settled(candles.select(*SERIES, "row", "high", "low", "close"), "reaches")
    names = {"high": "reach_high", "low": "reach_low", "close_up": "close_reach_high", "close_down": "close_reach_low"}
    sought = {"high": ("high", 1), "low": ("low", -1), "close_up": ("high", 1), "close_down": ("low", -1)}
    queries = points_of(candles, sought).select(*SERIES, "kind", F.col("row").alias("id"), F.col("row").alias("after"), F.col("value").alias("level"))
    found = first_hits(points_of(candles, KINDS), queries)
    wide = found.groupBy(*SERIES, F.col("id").alias("row")).agg(*(F.max(F.when(F.col("kind") == k, F.col("hit"))).alias(n) for k, n in names.items()))
    return candles.select(*SERIES, F.col("row").cast("bigint").alias("row")).join(wide, [*SERIES, "row"], "left")
