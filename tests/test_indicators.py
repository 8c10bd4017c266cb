import math

import numpy as np
import pandas as pd
import pytest
from helpers import walk, numbered
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import rolling
from tidemark.operators import indicators, sentiment, series
from tidemark.params import FEATURES


def mean(xs):
    return math.fsum(xs) / len(xs)


def spread(xs):
    centre = mean(xs)
    return math.sqrt(math.fsum((x - centre) ** 2 for x in xs) / (len(xs) - 1))


def quarter(xs):
    """Linear interpolation at three quarters."""
    xs, at = sorted(xs), 0.75 * (len(xs) - 1)
    return xs[int(at)] + (xs[min(int(at) + 1, len(xs) - 1)] - xs[int(at)]) * (at - int(at))


def plain_features(df, fg=None):
    """The same features of one symbol from their definitions: for each row a loop over the last values it needs."""
    days = [row._asdict() for row in df.itertuples(index=False)]
    close = [day["close"] for day in days]
    volume = [day["volume"] for day in days]
    ranges, atrs, out = [], [], []
    slow = {20: None, 50: None}
    level, levels = 50.0, []
    for i, day in enumerate(days):
        row = {"date": day["date"]}

        def back(xs, n, i=i):
            return xs[i - n + 1:i + 1] if i >= n - 1 else None

        def grown(xs, n, i=i):
            return xs[i] / xs[i - n] - 1 if i >= n else math.nan

        def score(xs, n):
            part = back(xs, n)
            if part is None or any(math.isnan(x) for x in part) or spread(part) == 0:
                return math.nan
            return (part[-1] - mean(part)) / spread(part)

        for n in (1, 2, 3, 5, 10, 20):
            row[f"ret_{n}d"] = grown(close, n)
        row["mom_5_20"] = row["ret_5d"] - row["ret_20d"]
        row["mom_sign"] = math.nan if math.isnan(row["ret_5d"]) else float((row["ret_5d"] > 0) - (row["ret_5d"] < 0))
        row["rsi"] = math.nan
        if i >= 14:
            moves = [close[k] - close[k - 1] for k in range(i - 13, i + 1)]
            gain, loss = mean([max(m, 0.0) for m in moves]), mean([max(-m, 0.0) for m in moves])
            if loss:
                row["rsi"] = 100 - 100 / (1 + gain / loss)
        row["rsi_oversold"], row["rsi_overbought"] = int(row["rsi"] < 30), int(row["rsi"] > 70)
        before = close[i - 1] if i else None
        reach = [day["high"] - day["low"]] + ([abs(day["high"] - before), abs(day["low"] - before)] if i else [])
        ranges.append(max(reach))
        atrs.append(mean(back(ranges, 14)) / close[i] if i >= 13 else math.nan)
        row["atr_pct"], row["atr_pct_z"] = atrs[i], score(atrs, 60)
        recent = back(atrs, 60)
        row["high_vol_regime"] = int(recent is not None and not any(map(math.isnan, recent)) and atrs[i] > quarter(recent))
        for span, value in slow.items():
            slow[span] = close[i] if value is None else value + (close[i] - value) * 2 / (span + 1)
        row["price_ema20_ratio"], row["price_ema50_ratio"] = close[i] / slow[20] - 1, close[i] / slow[50] - 1
        row["ema20_ema50_ratio"] = slow[20] / slow[50] - 1
        band = back(close, 20)
        width = 4 * spread(band) if band else math.nan
        row["bb_position"] = (close[i] - mean(band) + width / 2) / (width + 1e-10) if band else math.nan
        row["bb_width"] = width / mean(band) if band else math.nan
        row["vol_z"], row["vol_trend"] = score(volume, 20), grown(volume, 5)
        height = day["high"] - day["low"]
        row["hl_position"], row["range_pct"], row["dow"] = (close[i] - day["low"]) / (height + 1e-10), height / close[i], day["date"].weekday()
        if fg is None:
            row |= {"fg_value": 0.5, "fg_extreme_fear": 0, "fg_extreme_greed": 0, "fg_momentum": 0.0}
        else:
            level = float(fg.get(day["date"], level))
            levels.append(level)
            row |= {"fg_value": level / 100, "fg_extreme_fear": int(level <= 25), "fg_extreme_greed": int(level >= 75),
                    "fg_momentum": (level - levels[i - 7]) / 100 if i >= 7 else math.nan}
        row["target"] = float(close[i + 1] > close[i]) if i + 1 < len(close) else math.nan
        if not any(math.isnan(row[c]) for c in ("ret_1d", "rsi", "atr_pct")):
            out.append(row)
    return pd.DataFrame(out)


def engine_features(spark, pdf, fg=None, rows=series.BLOCK_ROWS):
    days = None
    if fg is not None:
        days = spark.createDataFrame(list(fg.items()), "date date, value int")
    aligned = sentiment.align(numbered(spark, pdf), days)
    return indicators.features(aligned, rows).orderBy("symbol", "date").toPandas()


def close_enough(a, b):
    x, y = pd.to_numeric(a).to_numpy(float), pd.to_numeric(b).to_numpy(float)
    assert np.array_equal(np.isnan(x), np.isnan(y))
    np.testing.assert_allclose(x, y, rtol=1e-8, atol=1e-10, equal_nan=True)


@pytest.mark.parametrize("rows", [97, 4096])
def test_features_match_plain_loops_whatever_the_block_size(spark, rows):
    pdf = walk(n=420, gaps=True)
    rng = np.random.default_rng(5)
    fg = {d: int(rng.integers(0, 101)) for d in pdf["date"] if rng.random() < 0.4}
    got, want = engine_features(spark, pdf, fg, rows), plain_features(pdf, fg)
    assert got["date"].tolist() == want["date"].tolist()
    for name in [*FEATURES, "target"]:
        close_enough(got[name], want[name])


def test_long_series_ema_is_exact_over_many_blocks(spark):
    pdf = walk(n=3000, seed=9)
    rows = 300
    out = indicators.blocked(numbered(spark, pdf), indicators.EMA_HALO, 0, lambda b: indicators.add_ema(b, rows + indicators.EMA_HALO), rows)
    got = out.orderBy("date").toPandas()
    for span in (20, 50):
        np.testing.assert_allclose(got[f"ema{span}"], pdf["close"].ewm(span=span, adjust=False).mean(), rtol=1e-12)


@pytest.mark.parametrize("span", [2, 5, 12])
def test_short_spans_are_exact_on_long_blocks(spark, span):
    pdf = walk(n=1500)
    bars = numbered(spark, pdf).withColumn("pos", F.col("rn") - 1)
    got = bars.withColumn("e", rolling.ema("close", "pos", Window.partitionBy("symbol").orderBy("rn"), span, 4096)).orderBy("date").toPandas()
    np.testing.assert_allclose(got["e"], pdf["close"].ewm(span=span, adjust=False).mean(), rtol=1e-12)


def test_without_sentiment_the_constants_apply(spark):
    pdf = walk(n=120)
    got = engine_features(spark, pdf)
    assert set(got["fg_value"]) == {0.5} and set(got["fg_momentum"]) == {0.0}
    assert set(got["fg_extreme_fear"]) == {0} and set(got["fg_extreme_greed"]) == {0}


def test_sentiment_before_the_first_bar_is_not_carried_in(spark):
    import datetime as dt

    pdf = walk(n=40)
    days = spark.createDataFrame([(pdf["date"][0] - dt.timedelta(days=1), 10), (pdf["date"][20], 80)], "date date, value int")
    fg = sentiment.align(numbered(spark, pdf), days).orderBy("date").toPandas()["fg"].tolist()
    assert fg == [50.0] * 20 + [80.0] * 20


def test_a_monotone_series_has_no_rsi_and_no_rows(spark):
    pdf = walk(n=100)
    pdf["close"] = np.arange(1.0, 101.0)
    pdf["high"], pdf["low"], pdf["open"] = pdf["close"] + 1, pdf["close"] - 0.5, pdf["close"]
    assert len(engine_features(spark, pdf)) == 0


def test_constant_range_has_no_zscore_and_zero_volume_no_trend(spark):
    pdf = walk(n=140)
    pdf["close"] = [100.0 + (i % 2) for i in range(140)]
    pdf["open"], pdf["high"], pdf["low"] = 100.5, 102.0, 99.0
    pdf.loc[100, "volume"] = 0.0
    got = engine_features(spark, pdf).set_index("date")
    assert got.loc[pdf["date"][105], "vol_trend"] is None or np.isnan(got.loc[pdf["date"][105], "vol_trend"])
    flat = pdf.copy()
    flat["close"] = 100.0
    flat.loc[::2, "close"] = 100.0
    z = indicators.blocked(numbered(spark, flat), indicators.REGIME_HALO, 0, lambda b: indicators.add_regime(indicators.add_atr(b)))
    assert z.filter("atr_pct_z is not null").count() == 0


def test_first_true_range_is_high_minus_low(spark):
    pdf = walk(n=5)
    out = indicators.blocked(numbered(spark, pdf), indicators.ATR_HALO, 0, indicators.add_atr).orderBy("date").toPandas()
    assert out["tr"][0] == pdf["high"][0] - pdf["low"][0]


def test_no_look_ahead(spark):
    pdf = walk(n=300, seed=3)
    whole, cut = engine_features(spark, pdf), engine_features(spark, pdf.iloc[:250])
    for name in FEATURES:
        close_enough(whole[name][: len(cut)], cut[name])
    assert np.isnan(cut["target"].iloc[-1]) and not np.isnan(whole["target"][len(cut) - 1])


def test_symbols_do_not_touch_each_other(spark):
    both = pd.concat([walk("A", 150, 1), walk("B", 150, 2)])
    together = engine_features(spark, both)
    alone = engine_features(spark, walk("B", 150, 2))
    for name in FEATURES:
        close_enough(together[together["symbol"] == "B"][name].reset_index(drop=True), alone[name])


def test_last_label_can_be_kept_as_zero(spark):
    aligned = sentiment.align(numbered(spark, walk(n=90)), None)
    plain = indicators.features(aligned).orderBy("date").toPandas()["target"]
    kept = indicators.features(aligned, last_as_zero=True).orderBy("date").toPandas()["target"]
    assert np.isnan(plain.iloc[-1]) and kept.iloc[-1] == 0 and plain.iloc[:-1].tolist() == kept.iloc[:-1].tolist()


def test_new_days_only_equal_the_whole_history(spark):
    pdf = walk(n=1500, seed=13, gaps=True)
    aligned = sentiment.align(numbered(spark, pdf), None)
    day = pdf["date"].iloc[-30]
    whole = indicators.features(aligned).filter(F.col("date") >= F.lit(day)).orderBy("date").toPandas()
    new = indicators.features(aligned, rows=400, since=day).orderBy("date").toPandas()
    assert new["date"].tolist() == whole["date"].tolist() and len(new) == 30
    for name in [*FEATURES, "target"]:
        close_enough(new[name], whole[name])
    kept = series.since(numbered(spark, pdf), day, 100)
    assert kept.count() == 130
