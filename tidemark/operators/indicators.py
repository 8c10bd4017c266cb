"""Price, volatility, trend, band and volume indicators, and the next-day label.

All functions take bars with ``rn`` (see ``series.ordinals``) and return them with added columns. The
expressions share one window, so a call costs one shuffle and one sort whatever it computes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import rolling as R
from ..functions import scalars as S
from . import series

W = series.block_window

# rows a bar looks back, by what is asked for
RETURN_HALO = max(P.RETURN_SPANS)
RSI_HALO = P.RSI_SPAN
ATR_HALO = P.ATR_SPAN
REGIME_HALO = P.ATR_SPAN + P.REGIME_SPAN - 1
BAND_HALO = P.BAND_SPAN - 1
EMA_HALO = max(R.ema_halo(s) for s in P.EMA_SPANS)


def returns() -> list[Column]:
    return [R.change("close", W(), n).alias(f"ret_{n}d") for n in P.RETURN_SPANS]


def momentum() -> list[Column]:
    spread = F.col("ret_5d") - F.col("ret_20d")
    return [spread.alias("mom_5_20"), F.signum("ret_5d").alias("mom_sign")]


def rsi_means() -> list[Column]:
    """Mean gain and loss of ``_delta``, and whether all its values are there."""
    delta, frame = F.col("_delta"), R.last(W(), P.RSI_SPAN)
    return [
        F.avg(S.gain(delta)).over(frame).alias("_gain"),
        F.avg(S.loss(delta)).over(frame).alias("_loss"),
        R.filled(delta, W(), P.RSI_SPAN).alias("_moved"),
    ]


def rsi_value() -> Column:
    """Simple-mean RSI; a mean loss of 0 makes it null."""
    rsi = 100 - 100 / (1 + S.guarded_ratio(F.col("_gain"), F.col("_loss")))
    return F.when(F.col("_moved"), rsi).alias("rsi")


def add_rsi(df: DataFrame) -> DataFrame:
    moved = df.withColumn("_delta", R.difference("close", W())).select("*", *rsi_means())
    return moved.select("*", rsi_value()).drop("_delta", "_gain", "_loss", "_moved")


def rsi_flags() -> list[Column]:
    rsi = F.col("rsi")
    return [
        S.flag(rsi < P.RSI_LOW).alias("rsi_oversold"),
        S.flag(rsi > P.RSI_HIGH).alias("rsi_overbought"),
    ]


def true_range(previous: Column) -> Column:
    return S.true_range(F.col("high"), F.col("low"), previous).alias("tr")


def atr_mean() -> Column:
    return R.full(F.avg, "tr", W(), P.ATR_SPAN).alias("atr")


def atr_percent() -> Column:
    return S.guarded_ratio(F.col("atr"), F.col("close")).alias("atr_pct")


def add_atr(df: DataFrame) -> DataFrame:
    ranged = df.select("*", true_range(F.lag("close").over(W())))
    return ranged.select("*", atr_mean()).select("*", atr_percent())


def regime_stats() -> list[Column]:
    frame = R.last(W(), P.REGIME_SPAN)
    return [
        F.avg("atr_pct").over(frame).alias("_level"),
        F.stddev_samp("atr_pct").over(frame).alias("_spread"),
        R.ordered_values("atr_pct", W(), P.REGIME_SPAN).alias("_ordered"),
    ]


def regime() -> list[Column]:
    """Z-score of atr_pct and the flag for its upper quartile, over 60 rows."""
    atr, ordered = F.col("atr_pct"), F.col("_ordered")
    z = S.guarded_ratio(atr - F.col("_level"), F.col("_spread"))
    q = R.quantile(ordered, P.REGIME_SPAN, P.REGIME_QUANTILE)
    return [F.when(F.size(ordered) == P.REGIME_SPAN, z).alias("atr_pct_z"), S.flag(atr > q).alias("high_vol_regime")]


def add_regime(df: DataFrame) -> DataFrame:
    return df.select("*", *regime_stats()).select("*", *regime()).drop("_level", "_spread", "_ordered")


def block_position() -> Column:
    return (F.row_number().over(W()) - 1).alias("_pos")


def ema_means(max_rows: int) -> list[Column]:
    return [R.ema("close", "_pos", W(), s, max_rows).alias(f"ema{s}") for s in P.EMA_SPANS]


def ema_ratios() -> list[Column]:
    close, fast, slow = F.col("close"), F.col("ema20"), F.col("ema50")
    return [
        (S.guarded_ratio(close, fast) - 1).alias("price_ema20_ratio"),
        (S.guarded_ratio(close, slow) - 1).alias("price_ema50_ratio"),
        (S.guarded_ratio(fast, slow) - 1).alias("ema20_ema50_ratio"),
    ]


def add_ema(df: DataFrame, max_rows: int) -> DataFrame:
    placed = df.select("*", block_position())
    return placed.select("*", *ema_means(max_rows)).select("*", *ema_ratios()).drop("_pos")


def band_stats() -> list[Column]:
    frame = R.last(W(), P.BAND_SPAN)
    return [
        F.avg("close").over(frame).alias("_mean"),
        F.stddev_samp("close").over(frame).alias("_std"),
        R.filled("close", W(), P.BAND_SPAN).alias("_banded"),
    ]


def bands() -> list[Column]:
    upper, lower = F.col("_mean") + 2 * F.col("_std"), F.col("_mean") - 2 * F.col("_std")
    return [
        F.when(F.col("_banded"), S.epsilon_ratio(F.col("close") - lower, upper - lower)).alias("bb_position"),
        F.when(F.col("_banded"), S.guarded_ratio(upper - lower, F.col("_mean"))).alias("bb_width"),
    ]


def add_bands(df: DataFrame) -> DataFrame:
    return df.select("*", *band_stats()).select("*", *bands()).drop("_mean", "_std", "_banded")


def volume() -> list[Column]:
    return [
        R.zscore("volume", W(), P.VOLUME_SPAN).alias("vol_z"),
        R.change("volume", W(), P.VOLUME_TREND_SPAN).alias("vol_trend"),
    ]


def bar_shape() -> list[Column]:
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    return [
        S.epsilon_ratio(close - low, high - low).alias("hl_position"),
        S.guarded_ratio(high - low, close).alias("range_pct"),
    ]


def label(last_as_zero: bool = False) -> Column:
    """Next close above this close. Null on the last bar, which is not trainable; ``last_as_zero`` keeps that
    bar with 0, as a run does that cannot tell the two apart."""
    rises = (F.lead("close").over(W()) > F.col("close")).cast("int")
    return (F.coalesce(rises, F.lit(0)) if last_as_zero else rises).alias("target")


def blocked(bars: DataFrame, back: int, ahead: int, build, rows: int = series.BLOCK_ROWS) -> DataFrame:
    """Run ``build`` on the block copies and keep each bar once."""
    return series.owned(build(series.blocks(bars, back, ahead, rows)))


def features(bars: DataFrame, rows: int = series.BLOCK_ROWS, last_as_zero: bool = False, since=None) -> DataFrame:
    """All 28 model inputs and ``target``. ``bars`` carry ``rn`` and the filled sentiment value ``fg``
    (see ``sentiment.align``); rows without ret_1d, rsi or atr_pct are dropped. ``since`` computes the days
    from there on only, from no more history than they need."""
    from .sentiment import sentiment_features

    back = max(EMA_HALO, REGIME_HALO)

    if since is not None:
        bars = series.since(bars, since, back)

    # three window passes over one sort: on the bars, on their changes and ranges, on the volatility
    def build(df: DataFrame) -> DataFrame:
        df = df.select(
            "*", *returns(), *volume(), *bar_shape(), *band_stats(), *sentiment_features(W()), label(last_as_zero),
            S.day_of_week("date").alias("dow"), block_position(), F.lag("close").over(W()).alias("_previous"),
        )
        previous = F.col("_previous")
        df = df.select("*", *momentum(), *bands(), (F.col("close") - previous).alias("_delta"), true_range(previous))
        df = df.select("*", *rsi_means(), atr_mean(), *ema_means(rows + back))
        df = df.select("*", rsi_value(), atr_percent(), *ema_ratios())
        return df.select("*", *rsi_flags(), *regime_stats()).select("*", *regime())

    out = blocked(bars, back, 1, build, rows)
    if since is not None:
        out = out.filter(F.col("date") >= F.lit(since))
    keep = ["symbol", "date", "rn", "close", "high", "low", "open", "volume"]
    return out.select(*keep, *P.FEATURES, "target").dropna(subset=["ret_1d", "rsi", "atr_pct"])
