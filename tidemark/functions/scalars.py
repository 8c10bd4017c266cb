"""Column functions: null-safe arithmetic, parsing, formatting, presentation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gain(delta: Column) -> Column:
    """The positive part; null stays null (``greatest`` alone would turn it into 0)."""
    return F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))


def loss(delta: Column) -> Column:
    return F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))


def guarded_ratio(a: Column, b: Column) -> Column:
    """``a / b``, null where ``b`` is 0."""
    return F.try_divide(a, b)


def epsilon_ratio(a: Column, b: Column) -> Column:
    return a / (b + F.lit(P.EPSILON))


def flag(condition: Column) -> Column:
    """1 or 0; an undefined comparison is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def true_range(high: Column, low: Column, previous_close: Column) -> Column:
    """``greatest`` skips nulls, so the first bar's range is high - low."""
    return F.greatest(high - low, F.abs(high - previous_close), F.abs(low - previous_close))


def day_of_week(date: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(date))


def millis_to_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms.cast("bigint")))


def seconds_to_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds.cast("bigint")))


def parse_date(text: Column) -> Column:
    return F.trim(text).try_cast("date")


def parse_number(text: Column) -> Column:
    """Bad or empty text is null."""
    return F.trim(text).try_cast("double")


def parse_flag(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)) == "true", F.lit(False))


def presented(value: Column | str, digits: int) -> Column:
    """Rounding happens in presentation columns only; adding 0.0 turns -0.0 into 0.0."""
    return F.round(col(value), digits) + F.lit(0.0)


def binary_round(value: Column | str, digits: int) -> Column:
    """Round half to even on the exact binary value, as text formatting does, keeping the sign of zero.

    ``bround`` looks at the shortest decimal form and so sees a tie where the stored value lies beside it.
    The rounding error of ``value * 10^digits`` is computed exactly by splitting both factors, which tells
    on which side of the tie the value lies. NaN is null; a value of 2^52 / scale or more has no digits to round and stays as it is.
    """
    x, scale = col(value), 10.0**digits

    def halves(v):
        big = v * 134217729.0  # 2^27 + 1
        high = big - (big - v)
        return high, v - high

    size = F.abs(x)
    product = size * scale
    (a, b), (c, d) = halves(size), halves(scale)
    error = ((a * c - product) + a * d + b * c) + b * d
    small = product < 2.0**52
    whole = F.floor(F.when(small, product)).cast("double")
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    rounded = F.when(small, (whole + F.when(up, 1).otherwise(0)) / F.lit(scale)).otherwise(size)
    return F.when(F.isnan(x), F.lit(None)).when(x < 0, -rounded).otherwise(rounded)


def half_even(value: Column | str, digits: int) -> Column:
    """``binary_round`` without a negative zero."""
    return binary_round(value, digits) + F.lit(0.0)


def prob_too_low(prob: Column) -> Column:
    return F.format_string("PROB_TOO_LOW_%.4f", binary_round(prob, 4))


def flow_negative(flow: Column) -> Column:
    return F.format_string("OFI_NEGATIVE_%+.4f", binary_round(flow, 4))


def reason_code(reason: Column) -> Column:
    """The reason without its trailing value."""
    return F.regexp_replace(reason, r"_[+-]?[0-9][0-9.]*d?$", "")


def reason_value(reason: Column) -> Column:
    return F.regexp_extract(reason, r"_([+-]?[0-9][0-9.]*)d?$", 1).try_cast("double")


def row_id(number: Column) -> Column:
    return F.format_string("T%04d", number)


def sentiment_label(value: Column) -> Column:
    # Levels and names.
    return (
        F.when(value <= 25, "Extreme Fear")
        .when(value <= 49, "Fear")
        .when(value <= 74, "Greed")
        .when(value.isNotNull(), "Extreme Greed")
    )


def benchmark_label(weekly_return: Column) -> Column:
    """``weekly_return`` as a fraction; above 5 % the benchmark leads."""
    return F.when(weekly_return * 100 > 5, "leading").when(weekly_return.isNotNull(), "neutral")


def level_sizes(levels: Column, depth: int = P.BOOK_DEPTH) -> Column:
    """Total size of the first ``depth`` levels; a level is price, size and maybe a count."""
    return F.aggregate(F.slice(levels, 1, depth), F.lit(0.0), lambda total, level: total + level[1])


def imbalance(bid: Column, ask: Column) -> Column:
    """(bid - ask) / (bid + ask), 0 for an empty book."""
    return F.when(bid + ask > 0, F.try_divide(bid - ask, bid + ask)).otherwise(F.lit(0.0))


def flow_ratio(taker: Column, total: Column) -> Column:
    """(2 * taker-buy volume - total volume) / total volume."""
    return F.try_divide(2 * taker - total, total)


def filled_cells(columns: list[str]) -> Column:
    """Number of non-null cells in a row."""
    return F.size(F.filter(F.array(*columns), lambda cell: cell.isNotNull()))
