"""Column functions over one candle. Prices are decimals; thresholds compare by multiplication, so that "exactly 1 %" holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(18,8)"


def direction(open_: str = "open", close: str = "close") -> Column:
    return F.when(F.col(close) > F.col(open_), "BULLISH").when(F.col(close) < F.col(open_), "BEARISH").otherwise("DOJI")


def body_low() -> Column:
    return F.least("open", "close")


def body_high() -> Column:
    return F.greatest("open", "close")


def body() -> Column:
    return F.abs(F.col("close") - F.col("open"))


def upper_wick() -> Column:
    return F.col("high") - body_high()


def lower_wick() -> Column:
    return body_low() - F.col("low")


def touches(lower: Column, upper: Column) -> Column:
    """Whether the candle's range meets a closed zone."""
    return (F.col("high") >= lower) & (F.col("low") <= upper)


def body_touches(lower: Column, upper: Column) -> Column:
    return (body_high() >= lower) & (body_low() <= upper)


def touch_type(lower: Column, upper: Column) -> Column:
    """CLOSE_INSIDE before BODY before WICK; null without a touch."""
    return F.when(F.col("close").between(lower, upper), "CLOSE_INSIDE").when(body_touches(lower, upper), "BODY").when(touches(lower, upper), "WICK")


def interaction_flags(lower: Column, upper: Column, before: Column) -> dict[str, Column]:
    """The booleans of one candle against a zone; ``before`` is the close of the candle before."""
    inside = lambda c: F.col(c).between(lower, upper)
    return {
        "open_inside": inside("open"),
        "close_inside": inside("close"),
        "high_inside": inside("high"),
        "low_inside": inside("low"),
        "crosses": (F.col("low") < lower) & (F.col("high") > upper),
        "from_above": F.coalesce(before > upper, F.lit(False)),
        "from_below": F.coalesce(before < lower, F.lit(False)),
        "bullish": F.col("close") > F.col("open"),
        "bearish": F.col("close") < F.col("open"),
        "doji": F.col("close") == F.col("open"),
    }


def at_least_percent(part: Column, whole: Column, percent: str) -> Column:
    """part / whole * 100 >= percent, without dividing. ``percent`` is a decimal literal such as "1.30"."""
    return part * 100 >= whole * F.lit(percent).cast("decimal(8,4)")


def relative_distance(a: Column, b: Column) -> Column:
    """|a - b| in percent of their midpoint."""
    return F.abs(a - b).cast("double") / ((a + b).cast("double") / 2) * 100


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def true_range(before: Column) -> Column:
    """``before`` is the close of the candle before, null on the first."""
    span = F.col("high") - F.col("low")
    return F.greatest(span, F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def bands(value: Column, cuts: list[tuple[float, str]], rest: str) -> Column:
    """The label of the first cut that value reaches."""
    out = F.when(value >= cuts[0][0], cuts[0][1])
    for cut, label in cuts[1:]:
        out = out.when(value >= cut, label)
    return out.otherwise(rest)


def month_key(ts: str = "open_time") -> Column:
    return F.date_format(ts, "yyyy-MM")


def quarter_key(ts: str = "open_time") -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))


def week_key(ts: str = "open_time") -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def sheet_value(col: Column, most: int = 32_767) -> Column:
    """Text safe for a spreadsheet cell: no control characters, limited length."""
    return F.substring(F.regexp_replace(col.cast("string"), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]", ""), 1, most)
