"""Row-window expressions. Every fixed window is null until it is full."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .scalars import col, guarded_ratio


# Spark evaluates every window expression it meets, equal ones too, so the helpers below use each one once.


def last(window, n: int):
    """The frame of the last ``n`` rows."""
    return window.rowsBetween(-(n - 1), 0)


def filled(value: Column | str, window, n: int) -> Column:
    """Whether all of the last ``n`` values are present."""
    return F.count(col(value)).over(last(window, n)) == n


def full(aggregate, value: Column | str, window, n: int) -> Column:
    """``aggregate`` over the last ``n`` rows, null unless all ``n`` values are present."""
    return F.when(filled(value, window, n), aggregate(col(value)).over(last(window, n)))


def change(value: Column | str, window, n: int = 1) -> Column:
    """``n``-row relative change; null when the earlier value is 0."""
    return guarded_ratio(col(value), F.lag(col(value), n).over(window)) - 1


def difference(value: Column | str, window, n: int = 1) -> Column:
    return col(value) - F.lag(col(value), n).over(window)


def zscore(value: Column | str, window, n: int) -> Column:
    """Sample standard deviation; null when it is 0."""
    frame = last(window, n)
    ratio = guarded_ratio(col(value) - F.avg(col(value)).over(frame), F.stddev_samp(col(value)).over(frame))
    return F.when(filled(value, window, n), ratio)


def ordered_values(value: Column | str, window, n: int) -> Column:
    """The last ``n`` values as a sorted array. Reading quantiles from it is several times faster than an
    exact percentile aggregate per row."""
    return F.sort_array(F.collect_list(col(value)).over(last(window, n)))


def quantile(ordered: Column, n: int, q: float) -> Column:
    """Linear interpolation between two neighbours of ``ordered_values``; null unless it is full."""
    at = q * (n - 1)
    low = math.floor(at)
    below, above = F.get(ordered, F.lit(low)), F.get(ordered, F.lit(min(low + 1, n - 1)))
    return F.when(F.size(ordered) == n, below + (above - below) * (at - low))


def ema_halo(span: int) -> int:
    """Rows after which the weight of older values is below 1e-17."""
    return math.ceil(40 / -math.log(1 - 2 / (span + 1)))


def _ema_by_chunks(value: Column | str, at: Column, window, span: int) -> Column:
    """The same mean where one scale would overflow: weights start anew in chunks of ``ema_halo`` rows.

    A frame of that many rows touches the row's chunk and the one before, which differ in parity, so two sums keep them apart;
    what lies further back weighs below 1e-17.
    """
    alpha, size = 2 / (span + 1), ema_halo(span)
    decay = 1 - alpha
    inside, odd = F.pmod(at, F.lit(size)), F.pmod(F.floor(at / size), F.lit(2)) == 1
    weighted = col(value) * F.when(at == 0, F.lit(1.0)).otherwise(F.lit(alpha)) * F.pow(F.lit(decay), -inside)
    frame = last(window, size)
    one, two = (F.coalesce(F.sum(F.when(side, weighted)).over(frame), F.lit(0.0)) for side in (odd, ~odd))
    here, before = F.when(odd, one).otherwise(two), F.when(odd, two).otherwise(one)
    return F.pow(F.lit(decay), inside) * (here + F.lit(decay**size) * before)


def ema(value: Column | str, position: Column | str, window, span: int, max_rows: int) -> Column:
    """Exponential mean seeded with the first value of the window partition, without a UDF.

    y_t = (1-a)^t * (x_0 + a * sum_{0<i<=t} x_i (1-a)^-i), one running sum. ``position`` counts from 0
    inside the partition and ``max_rows`` bounds it; where the scaled terms would leave the double range, they are scaled by chunks.
    For a block that does not start the series, ``ema_halo`` rows in front make the seed's weight vanish.
    """
    alpha = 2 / (span + 1)
    decay = 1 - alpha
    at = col(position)
    if max_rows * -math.log(decay) > 650:
        return _ema_by_chunks(value, at, window, span)
    weight = F.when(at == 0, F.lit(1.0)).otherwise(F.lit(alpha) * F.pow(F.lit(decay), -at))
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(col(value) * weight).over(upto) * F.pow(F.lit(decay), at)
