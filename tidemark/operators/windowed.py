"""Exact order statistics of long row windows, with logarithmic work per row.

Sorting every frame costs its length again for each row. Here a block of a series (see ``series.blocks``) is held as a wavelet
matrix: one level per bit of the values' ranks, zeros before ones, with running counts. The k-th smallest value of any stretch, or
the sum of its k smallest, is then one step per level, done for all rows of the block at once.

Missing values are NULL; NaN counts as missing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..params import FEATURES, RULES, Rules
from . import series


class Stretches:
    """Values of one block in their order; ``first`` (included) and ``last`` (excluded) below are arrays of positions."""

    def __init__(self, values: np.ndarray):
        self.sorted, ranks = np.unique(values, return_inverse=True)
        self.bits = max(len(self.sorted) - 1, 1).bit_length()
        self.zeros, self.order = [], []
        order = np.arange(len(values))
        for bit in reversed(range(self.bits)):
            ones = ranks[order] >> bit & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - ones)]))
            order = order[np.argsort(ones, kind="stable")]
            self.order.append(order)

    def _descend(self, first: np.ndarray, last: np.ndarray, k: np.ndarray, passed: Callable | None = None):
        """Rank of the k-th smallest (from 0) value, and which of its equals it is; ``passed`` sees the stretch of each level
        whose values are all smaller."""
        rank = np.zeros(len(k), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            left, right = zeros[first], zeros[last]
            up = k >= right - left
            if passed:
                passed(level, left, right, up)
            rank |= up.astype(np.int64) << self.bits - 1 - level
            k = np.where(up, k - (right - left), k)
            first, last = np.where(up, zeros[-1] + first - left, left), np.where(up, zeros[-1] + last - right, right)
        return rank, k

    def smallest(self, first: np.ndarray, last: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value, counting from 0, for 0 <= k < last - first."""
        return self.sorted[self._descend(first, last, k)[0]]

    def quantile(self, first: np.ndarray, last: np.ndarray, q: float) -> np.ndarray:
        """Linear interpolation between two neighbours, as SQL's percentile; NaN for an empty stretch."""
        out = np.full(len(first), np.nan)
        some = last > first
        first, last = first[some], last[some]
        at = q * (last - first - 1)
        low = np.floor(at).astype(np.int64)
        below = self.smallest(first, last, low)
        above = self.smallest(first, last, np.minimum(low + 1, last - first - 1))
        out[some] = below + (above - below) * (at - low)
        return out

    def sums(self, first: np.ndarray, last: np.ndarray, k: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of the k smallest values, for 0 <= k <= last - first. Exact where the weights are Python integers;
        values that are equal need equal weights."""
        total = np.zeros(len(k), dtype=weights.dtype)
        some = (k > 0) & (k < last - first)
        whole = np.concatenate([[0], np.cumsum(weights)])
        total[k >= last - first] = (whole[last] - whole[first])[k >= last - first]
        found = np.zeros(int(some.sum()), dtype=weights.dtype)

        def passed(level, left, right, up):
            running = np.concatenate([[0], np.cumsum(weights[self.order[level]])])
            found[up] += (running[right] - running[left])[up]

        if some.any():
            rank, equals = self._descend(first[some], last[some], k[some], passed)
            by_rank = np.zeros(len(self.sorted), dtype=weights.dtype)
            by_rank[self._ranks()] = weights
            total[some] = found + equals * by_rank[rank]
        return total

    def _ranks(self) -> np.ndarray:
        ranks = np.zeros(len(self.order[0]), dtype=np.int64)
        at = np.arange(len(ranks))
        # the last level lists positions by bit-reversed rank; read each bit where its level put it
        for level, order in enumerate(self.order):
            ones = np.zeros(len(ranks), dtype=np.int64)
            ones[order[self.zeros[level][-1]:]] = 1
            ranks |= ones[at] << self.bits - 1 - level
        return ranks


def whole_numbers(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Finite doubles as Python integers over one power of two: values = numbers / 2 ** shift, without loss."""
    mantissa, exponent = np.frexp(values)
    scaled = (mantissa * 2.0**53).astype(np.int64)
    lowest = int(exponent[values != 0].min()) if (values != 0).any() else 53
    shifts = np.where(values != 0, exponent - lowest, 0)
    numbers = np.array([int(m) << int(s) for m, s in zip(scaled, shifts)], dtype=object)
    return numbers, 53 - lowest


def _ratio(top: np.ndarray, bottom: np.ndarray, shift: int) -> np.ndarray:
    """top / bottom / 2 ** shift for Python integers, rounded once; NaN where the bottom is 0, infinite where too large."""

    def one(a, b):
        if b == 0:
            return math.nan
        try:
            return (a / (b << shift)) if shift >= 0 else (a << -shift) / b
        except OverflowError:
            return math.copysign(math.inf, a)

    return np.array([one(a, b) for a, b in zip(top.tolist(), bottom.tolist())], dtype=float)


def moments(n: np.ndarray, total: np.ndarray, square: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population standard deviation from exact sums; a deviation of 0 becomes 1, as it scales by 1."""
    n = np.array([int(x) for x in n], dtype=object)
    variance = _ratio(n * square - total * total, n * n, 2 * shift)
    std = np.sqrt(variance)
    return _ratio(total, n, shift), np.where(std == 0, 1.0, std)


def quantiles(df: DataFrame, value: str, span: int, qs: dict[str, float], keys: list[str] = ["symbol"], rows: int = series.BLOCK_ROWS) -> DataFrame:
    """Add one quantile column per name in ``qs`` over the last ``span`` rows; null unless all of them have a value. Needs ``rn``.

    Any span will do: blocks grow with it, so the copied rows stay at most the rows themselves.
    """
    blocked = series.blocks(df.withColumn("_v", F.col(value).cast("double")), span - 1, 0, max(rows, span))
    # only what identifies a row and its value travels to Python
    slim = blocked.select(*keys, "rn", "_v", "block", "own")
    names = list(qs)
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), "rn bigint", *(f"`{c}` double" for c in names)])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rn")
        v = table["_v"].to_numpy(zero_copy_only=False).astype(float)
        present = ~np.isnan(v)
        held = np.concatenate([[0], np.cumsum(present)])
        own = table["own"].to_numpy(zero_copy_only=False).astype(bool)
        at = np.flatnonzero(own)
        first, last = held[np.maximum(at - span + 1, 0)], held[at + 1]
        full = last - first == span
        tree = Stretches(v[present]) if full.any() else None
        kept = table.filter(pa.array(own))
        out = [kept[k] for k in keys] + [kept["rn"].cast(pa.int64())]
        for q in qs.values():
            got = np.full(len(at), np.nan)
            if tree:
                got[full] = tree.quantile(first[full], last[full], q)
            out.append(pa.array(got, from_pandas=True, type=pa.float64()))
        return pa.table(out, names=[*keys, "rn", *names])

    found = slim.groupBy(*keys, "block").applyInArrow(run, schema)
    return df.join(found.withColumn("rn", F.col("rn").cast(df.schema["rn"].dataType)), [*keys, "rn"])


STATS = ["lo", "hi", "mean", "std", "fit_mean", "fit_std"]


def training_stats(features: DataFrame, rules: Rules = RULES, inputs: list[str] = FEATURES, rows: int = series.BLOCK_ROWS) -> DataFrame:
    """What preparing a training window needs, for every (symbol, cutoff) with ``rules.min_history`` earlier rows, in one pass.

    The window is the ``rules.train_window`` rows before the cutoff's own, as in ``training.training_rows``, without a copy of the
    rows for each cutoff: a block's copies are ``train_window / rows`` of its rows. Per cutoff: ``n`` labeled rows, ``n_up`` of
    them up, the class weights ``weight_down`` and ``weight_up`` (null for an absent class), and arrays along ``inputs``: winsor
    bounds ``lo`` and ``hi``, ``mean`` and ``std`` of the raw inputs, ``fit_mean`` and ``fit_std`` of the clipped ones.

    Sums and sums of squares are differences of exact running sums, so nothing cancels whatever the scale of an input. Missing
    inputs count as 0, rows without a label are left out, an infinite input counts as missing. Without any labeled row the
    arrays hold nulls. ``features`` is read by two branches.
    """
    span, least = rules.train_window, rules.min_history
    numbered = series.ordinals(features.select("symbol", "date", "target", *inputs), name="rn")
    packed = numbered.select(
        "symbol", "date", "rn", F.col("target").cast("int").alias("target"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs]).alias("x"),
    )
    blocked = series.blocks(packed, span, 0, max(rows, span))
    width = len(inputs)
    day = features.schema["date"].dataType.simpleString()
    symbol = features.schema["symbol"].dataType.simpleString()
    arrays = ", ".join(f"{s} array<double>" for s in STATS)
    schema = f"symbol {symbol}, date {day}, n bigint, n_up bigint, weight_down double, weight_up double, {arrays}"
    q_low, q_high = P.WINSOR_LOW, P.WINSOR_HIGH

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rn")
        rn = table["rn"].to_numpy().astype(np.int64)
        target = table["target"].to_numpy(zero_copy_only=False).astype(float)
        labeled = np.flatnonzero(~np.isnan(target))
        wanted = table["own"].to_numpy(zero_copy_only=False).astype(bool) & (rn - 1 >= least)
        at = rn[wanted]
        first, last = np.searchsorted(rn[labeled], at - span), np.searchsorted(rn[labeled], at)
        x = table["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)[labeled]
        x = np.where(np.isfinite(x), x, 0.0)
        n = last - first
        ups = np.concatenate([[0], np.cumsum(target[labeled] == 1)])
        n_up = ups[last] - ups[first]
        found = np.full((len(STATS), len(at), width), np.nan)
        for c in range(width if len(at) and len(labeled) else 0):
            found[:, :, c] = _fit(x[:, c], first, last, q_low, q_high)
        with np.errstate(divide="ignore", invalid="ignore"):
            weights = [np.where(m > 0, n / (2.0 * m), np.nan) for m in (n - n_up, n_up)]
        kept = table.filter(pa.array(wanted))
        steps = pa.array(np.arange(len(at) + 1, dtype=np.int32) * width)
        lists = [pa.ListArray.from_arrays(steps, pa.array(a.reshape(-1), from_pandas=True)) for a in found]
        return pa.table(
            [kept["symbol"], kept["date"], pa.array(n), pa.array(n_up), *(pa.array(w, from_pandas=True) for w in weights), *lists],
            names=["symbol", "date", "n", "n_up", "weight_down", "weight_up", *STATS])

    return blocked.groupBy("symbol", "block").applyInArrow(run, schema)


def _fit(x: np.ndarray, first: np.ndarray, last: np.ndarray, q_low: float, q_high: float) -> np.ndarray:
    """STATS of one input for each stretch."""
    tree = Stretches(x)
    n = last - first
    lo, hi = tree.quantile(first, last, q_low), tree.quantile(first, last, q_high)
    # values, bounds and their sums on one scale, so that the clipped sums are exact as well
    bounds = np.nan_to_num(np.concatenate([lo, hi]))
    numbers, shift = whole_numbers(np.concatenate([x, bounds]))
    value, low, high = numbers[:len(x)], numbers[len(x):len(x) + len(lo)], numbers[len(x) + len(lo):]
    squared = value * value
    # as many of the smallest lie at or below the lower bound, as many of the largest at or above the upper one
    below = np.where(n > 0, np.floor(q_low * (n - 1)).astype(np.int64) + 1, 0)
    under = np.where(n > 0, np.ceil(q_high * (n - 1)).astype(np.int64), 0)
    under = np.maximum(under, below)

    def parts(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tree.sums(first, last, n, weights), tree.sums(first, last, under, weights) - tree.sums(first, last, below, weights)

    (total, middle), (square, middle_square) = parts(value), parts(squared)
    under_count, over_count = (np.array([int(v) for v in c], dtype=object) for c in (below, n - under))
    mean, std = moments(n, total, square, shift)
    fit_mean, fit_std = moments(n, middle + under_count * low + over_count * high,
                                middle_square + under_count * low * low + over_count * high * high, shift)
    empty = n == 0
    out = np.stack([lo, hi, mean, std, fit_mean, fit_std])
    out[:, empty] = np.nan
    return out


def tall_stats(stats: DataFrame, names: list[str], inputs: list[str] = FEATURES) -> DataFrame:
    """One row per (symbol, date, feature) with the named arrays of ``training_stats`` as columns."""
    labels = F.array(*[F.lit(c) for c in inputs]).alias("feature")
    zipped = stats.select("symbol", "date", F.explode(F.arrays_zip(labels, *names)).alias("s"))
    return zipped.select("symbol", "date", "s.*")


def scaled_at(features: DataFrame, stats: DataFrame, inputs: list[str] = FEATURES) -> DataFrame:
    """Every feature row clipped and scaled by the window before it: what a model refitted that day would be shown."""
    joined = features.join(stats.select("symbol", "date", *STATS), ["symbol", "date"])

    def scaled(at: int, c: str):
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        clipped = F.least(F.greatest(x, F.col("lo")[at]), F.col("hi")[at])
        return (clipped - F.col("fit_mean")[at]) / F.col("fit_std")[at]

    return joined.withColumns({c: scaled(at, c) for at, c in enumerate(inputs)}).drop(*STATS)
