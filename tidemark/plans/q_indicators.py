"""Window functions and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import rolling as R
from ..functions import scalars as S
from ..operators import indicators as I
from ..operators import sentiment as SE
from ..operators import series
from . import inputs
from .registry import query
from .sqlparts import W as OVER
from .sqlparts import d, full, r, sql

W = I.W


def show(df, *cols, keys=("symbol", "date"), ints=()):
    """Key columns and rounded values."""
    return df.select(*keys, *[S.presented(c, 6).alias(c) for c in cols], *ints)


@query("w01_returns", sql(
    "select symbol, date, " + ", ".join(
        r(f"close/nullif(lag(close, {n}) {OVER}, 0) - 1") + f" as ret_{n}d" for n in P.RETURN_SPANS)
    + f", {r(f'volume/nullif(lag(volume, 5) {OVER}, 0) - 1')} as vol_trend, {r(f'close/lag(close, 7) {OVER} - 1')} as ret_7d from bars",
    "bars"))
def w01(spark, sf):
    df = I.blocked(inputs.bars(spark, sf), I.RETURN_HALO, 0, lambda b: b.select(
        "*", *I.returns(), R.change("volume", W(), P.VOLUME_TREND_SPAN).alias("vol_trend"),
        R.change("close", W(), 7).alias("ret_7d")))
    return show(df, *[f"ret_{n}d" for n in P.RETURN_SPANS], "vol_trend", "ret_7d")


@query("w02_momentum", sql(f"""
select symbol, date, {r('r5 - r20')} as mom_5_20, sign(r5) + cast(0 as double) as mom_sign from (
  select *, close/lag(close, 5) {OVER} - 1 as r5, close/lag(close, 20) {OVER} - 1 as r20 from bars)""", "bars"))
def w02(spark, sf):
    df = I.blocked(inputs.bars(spark, sf), I.RETURN_HALO, 0,
                   lambda b: b.select("*", *I.returns()).select("*", *I.momentum()))
    return show(df, "mom_5_20", "mom_sign")


@query("w03_difference", sql(f"select symbol, date, {r('delta')} as delta from delta", "delta"))
def w03(spark, sf):
    df = I.blocked(inputs.bars(spark, sf), 1, 0, lambda b: b.withColumn("delta", R.difference("close", W())))
    return show(df, "delta")


@query("w04_rsi14", sql(f"""
select symbol, date, {r('rsi')} as rsi, cast(coalesce(rsi < 30, false) as integer) as rsi_oversold,
       cast(coalesce(rsi > 70, false) as integer) as rsi_overbought from rsi""", "rsi"))
def w04(spark, sf):
    df = I.blocked(inputs.bars(spark, sf), I.RSI_HALO, 0, lambda b: I.add_rsi(b).select("*", *I.rsi_flags()))
    return show(df, "rsi", ints=["rsi_oversold", "rsi_overbought"])


@query("w05_atr14", sql(f"select symbol, date, {r('tr')} as tr, {r('atr')} as atr, {r('atr_pct')} as atr_pct from atr", "atr"))
def w05(spark, sf):
    return show(I.blocked(inputs.bars(spark, sf), I.ATR_HALO, 0, I.add_atr), "tr", "atr", "atr_pct")


def _regime(spark, sf):
    return I.blocked(inputs.bars(spark, sf), I.REGIME_HALO, 0, lambda b: I.add_regime(I.add_atr(b)))


@query("w06_atr_zscore60", sql(f"select symbol, date, {r('atr_pct_z')} as atr_pct_z from regime", "regime"))
def w06(spark, sf):
    return show(_regime(spark, sf), "atr_pct_z")


@query("w07_high_vol_regime", sql("select symbol, date, high_vol_regime from regime", "regime"))
def w07(spark, sf):
    return _regime(spark, sf).select("symbol", "date", "high_vol_regime")


EMA_COLUMNS = ["ema20", "ema50", "price_ema20_ratio", "price_ema50_ratio", "ema20_ema50_ratio"]


@query("w08_ema", sql("select symbol, date, " + ", ".join(f"{r(c)} as {c}" for c in EMA_COLUMNS) + " from ema", "ema"))
def w08(spark, sf):
    rows = series.BLOCK_ROWS
    df = I.blocked(inputs.bars(spark, sf), I.EMA_HALO, 0, lambda b: I.add_ema(b, rows + I.EMA_HALO), rows)
    return show(df, *EMA_COLUMNS)


@query("w09_bollinger20", sql(f"""
select symbol, date, {r('(close - (sma - 2*sd))/((sma + 2*sd) - (sma - 2*sd) + 1e-10)')} as bb_position,
       {r('((sma + 2*sd) - (sma - 2*sd))/sma')} as bb_width from bands""", "bands"))
def w09(spark, sf):
    return show(I.blocked(inputs.bars(spark, sf), I.BAND_HALO, 0, I.add_bands), "bb_position", "bb_width")


@query("w10_volume_zscore20", sql(f"""
select symbol, date, {r(f"(volume - {full('avg(volume)', 'volume', 20)})/nullif({full('stddev_samp(volume)', 'volume', 20)}, 0)")} as vol_z
from bars""", "bars"))
def w10(spark, sf):
    df = I.blocked(inputs.bars(spark, sf), I.BAND_HALO, 0,
                   lambda b: b.withColumn("vol_z", R.zscore("volume", W(), P.VOLUME_SPAN)))
    return show(df, "vol_z")


@query("w11_forward_fill", sql(f"""
select b.symbol, b.date, last_value(s.value ignore nulls) over (partition by b.symbol order by b.date
       rows between unbounded preceding and current row) as filled, s.value as day_value
from bars b left join sentiment s on b.date = s.date""", "bars", "sentiment"))
def w11(spark, sf):
    days = inputs.sentiment(spark, sf).withColumnRenamed("value", "day_value")
    joined = inputs.bars(spark, sf).join(F.broadcast(days), "date", "left").withColumn("_year", F.year("date"))
    return series.running(joined, ["symbol"], ["date"], "_year", filled=("last", "day_value")).select(
        "symbol", "date", "filled", "day_value")


@query("w12_running_peak", sql(f"""
select date, {r('balance')} as balance, {r('max(balance) over (order by date rows between unbounded preceding and current row)')} as peak
from equity""", "equity"))
def w12(spark, sf):
    from ..operators import ledger, risk

    bars = inputs.bars(spark, sf)
    equity = ledger.equity_curve(inputs.trades(bars), bars)
    return risk.with_peak(equity).select("date", S.presented("balance", 6).alias("balance"),
                                         S.presented("peak", 6).alias("peak"))


FG = ["fg_value", "fg_momentum"]


@query("w13_sentiment_features", sql(f"""
select symbol, date, {r('fg/100')} as fg_value, {r(f'(fg - lag(fg, 7) {OVER})/100')} as fg_momentum,
       cast(fg <= 25 as integer) as fg_extreme_fear, cast(fg >= 75 as integer) as fg_extreme_greed from fgs""", "fgs"))
def w13(spark, sf):
    aligned = SE.align(inputs.bars(spark, sf), inputs.sentiment(spark, sf))
    df = I.blocked(aligned, P.SENTIMENT_SPAN, 0, lambda b: b.select("*", *SE.sentiment_features(W())))
    return show(df, *FG, ints=["fg_extreme_fear", "fg_extreme_greed"])


@query("w13_sentiment_absent", sql("""
select symbol, date, cast(0.5 as double) as fg_value, cast(0 as double) as fg_momentum, 0 as fg_extreme_fear, 0 as fg_extreme_greed
from bars""", "bars"))
def w13_absent(spark, sf):
    df = I.blocked(SE.align(inputs.bars(spark, sf), None), P.SENTIMENT_SPAN, 0,
                   lambda b: b.select("*", *SE.sentiment_features(W())))
    return show(df, *FG, ints=["fg_extreme_fear", "fg_extreme_greed"])


@query("w14_bar_shape", sql(f"""
select symbol, date, {r('(close - low)/(high - low + 1e-10)')} as hl_position, {r('(high - low)/close')} as range_pct from bars""", "bars"))
def w14(spark, sf):
    return show(inputs.bars(spark, sf).select("*", *I.bar_shape()), "hl_position", "range_pct")


@query("w15_label", sql(f"""
select symbol, date, case when lead(close) {OVER} is not null then cast(lead(close) {OVER} > close as integer) end as target
from bars""", "bars"))
def w15(spark, sf):
    return I.blocked(inputs.bars(spark, sf), 0, 1, lambda b: b.select("*", I.label())).select("symbol", "date", "target")


@query("w16_armed_flag", sql("select symbol, entry_date, cast(k as integer) as k, armed from armed where k <= 5", "armed"))
def w16(spark, sf):
    from ..operators import exits

    return exits.armed_path(inputs.placed(inputs.bars(spark, sf)))


@query("w17_equity_return", sql(f"""
select date, {r('balance/lag(balance) over (order by date) - 1', 9)} as ret from equity""", "equity"))
def w17(spark, sf):
    from ..operators import ledger, metrics

    bars = inputs.bars(spark, sf)
    equity = ledger.equity_curve(inputs.trades(bars), bars)
    return metrics.equity_returns(equity).select("date", S.presented("ret", 9).alias("ret"))


@query("w18_latest_row", sql("""
select symbol, max(date) as date, arg_max(close, date) as close, arg_max(volume, date) as volume from bars group by 1""", "bars"))
def w18(spark, sf):
    row = F.struct("close", "volume")
    latest = inputs.bars(spark, sf).groupBy("symbol").agg(F.max("date").alias("date"), F.max_by(row, "date").alias("_r"))
    return latest.select("symbol", "date", "_r.*")


FLOAT_FEATURES = [c for c in P.FEATURES if c not in (
    "rsi_oversold", "rsi_overbought", "high_vol_regime", "dow", "fg_extreme_fear", "fg_extreme_greed")]
INT_FEATURES = [c for c in P.FEATURES if c not in FLOAT_FEATURES]


def full_features(spark, sf):
    return I.features(SE.align(inputs.bars(spark, sf), inputs.sentiment(spark, sf)))


FEATURES_SQL = f"""
select b.symbol, b.date, b.rn, b.close, {', '.join(f'b.close/lag(b.close, {n}) over w - 1 as ret_{n}d' for n in P.RETURN_SPANS)},
  b.close/lag(b.close, 5) over w - b.close/lag(b.close, 20) over w as mom_5_20,
  sign(b.close/lag(b.close, 5) over w - 1) as mom_sign,
  rsi.rsi, cast(coalesce(rsi.rsi < 30, false) as integer) as rsi_oversold, cast(coalesce(rsi.rsi > 70, false) as integer) as rsi_overbought,
  g.atr_pct, g.atr_pct_z, g.high_vol_regime, e.price_ema20_ratio, e.price_ema50_ratio, e.ema20_ema50_ratio,
  (b.close - (sma - 2*sd))/((sma + 2*sd) - (sma - 2*sd) + 1e-10) as bb_position, ((sma + 2*sd) - (sma - 2*sd))/sma as bb_width,
  (b.volume - {full('avg(b.volume)', 'b.volume', 20, 'partition by b.symbol order by b.date')})
    / nullif({full('stddev_samp(b.volume)', 'b.volume', 20, 'partition by b.symbol order by b.date')}, 0) as vol_z,
  b.volume/nullif(lag(b.volume, 5) over w, 0) - 1 as vol_trend,
  (b.close - b.low)/(b.high - b.low + 1e-10) as hl_position, (b.high - b.low)/b.close as range_pct,
  cast(isodow(b.date) - 1 as integer) as dow, f.fg/100 as fg_value, cast(f.fg <= 25 as integer) as fg_extreme_fear,
  cast(f.fg >= 75 as integer) as fg_extreme_greed, (f.fg - lag(f.fg, 7) over w)/100 as fg_momentum,
  case when lead(b.close) over w is not null then cast(lead(b.close) over w > b.close as integer) end as target
from bars b join rsi using (symbol, date) join regime g using (symbol, date) join ema e using (symbol, date)
  join bands using (symbol, date) join fgs f using (symbol, date)
window w as (partition by b.symbol order by b.date)"""


from .sqlparts import part  # noqa: E402

part("features_all", ["bars", "rsi", "regime", "ema", "bands", "fgs"], FEATURES_SQL)
part("features", ["features_all"],
     "select * from features_all where ret_1d is not null and rsi is not null and atr_pct is not null")


@query("feature_table", sql(
    "select symbol, date, " + ", ".join(f"{r(c)} as {c}" for c in FLOAT_FEATURES) + ", " + ", ".join(INT_FEATURES)
    + ", target from features", "features"))
def feature_table(spark, sf):
    return show(full_features(spark, sf), *FLOAT_FEATURES, ints=[*INT_FEATURES, "target"])
