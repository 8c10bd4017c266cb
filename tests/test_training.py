import datetime as dt

import numpy as np
import pandas as pd
import pytest
from helpers import numbered, walk
from pyspark.sql import functions as F

from tidemark.operators import indicators, sentiment, training
from tidemark.params import FEATURES, RULES
from tidemark.session import materialize


@pytest.fixture(scope="module")
def features(spark):
    pdf = pd.concat([walk("A", 330, 1), walk("B", 330, 2), walk("C", 60, 3, start=dt.date(2020, 9, 27))])
    return materialize(indicators.features(sentiment.align(numbered(spark, pdf), None)))


def test_training_window_is_the_last_180_labeled_rows(features):
    rows = training.training_window(features).toPandas()
    table = features.toPandas()
    for symbol, part in rows.groupby("symbol"):
        want = table[(table["symbol"] == symbol) & table["target"].notna()].sort_values("date").tail(180)
        assert sorted(part["date"]) == want["date"].tolist()
    assert not rows[FEATURES].isna().any().any()


def test_training_rows_per_cutoff(spark, features):
    table = features.toPandas().sort_values("date")
    cutoffs = [dt.date(2020, 5, 1), dt.date(2020, 11, 20)]
    got = training.training_rows(features, spark.createDataFrame([(c,) for c in cutoffs], "date date")).toPandas()
    for symbol in "ABC":
        mine = table[table["symbol"] == symbol]
        for cutoff in cutoffs:
            before = mine[mine["date"] < cutoff]
            has_row = (mine["date"] == cutoff).any()
            want = before["date"].tail(180).tolist() if has_row and len(before) >= 80 else []
            have = got[(got["symbol"] == symbol) & (got["cutoff"] == cutoff)]
            assert sorted(have["date"]) == want
    assert set(got["symbol"]) == {"A", "B"}


def test_winsorize_and_scale_match_numpy(features):
    window = training.training_window(features)
    clipped = training.clip(window, training.winsor_bounds(window))
    scaled = training.scale(clipped, training.scale_stats(clipped)).toPandas()
    raw = window.toPandas()
    for symbol in "AB":
        x = raw[raw["symbol"] == symbol].sort_values("date")[FEATURES].to_numpy(float)
        lo, hi = np.percentile(x, 1, axis=0), np.percentile(x, 99, axis=0)
        c = np.clip(x, lo, hi)
        std = c.std(axis=0)
        want = (c - c.mean(axis=0)) / np.where(std < 1e-12, 1, std)
        have = scaled[scaled["symbol"] == symbol].sort_values("date")[FEATURES].to_numpy(float)
        np.testing.assert_allclose(have, want, atol=1e-6)


def test_bounds_come_from_the_training_side_only(features):
    window = training.split(training.training_window(features))
    fitted = training.winsor_bounds(window.filter("not holdout"))
    held = training.clip(window.filter("holdout"), fitted)
    top = {r["symbol"]: r["atr_pct"][1] for r in fitted.collect()}
    assert all(r["atr_pct"] <= top[r["symbol"]] + 1e-15 for r in held.collect())


def test_class_weights_balance(features):
    rows = training.class_weights(training.training_window(features), ["symbol"]).toPandas()
    for _, part in rows.groupby("symbol"):
        assert (part["n"] * part["weight"]).nunique() == 1 or np.allclose(part["n"] * part["weight"], part["n"].sum() / 2)


@pytest.mark.parametrize("every", [1, 5, 9])
def test_retrain_chain(spark, every):
    pdf = walk(n=200, gaps=True, seed=6)
    days = spark.createDataFrame([("X", d) for d in pdf["date"]], "symbol string, date date")
    got = sorted(r["date"] for r in training.retrain_dates(days, every).collect())
    want = []
    for d in pdf["date"]:
        if not want or (d - want[-1]).days >= every:
            want.append(d)
    assert got == want
    scores = days.join(training.retrain_dates(days, every), ["symbol", "date"]).selectExpr("symbol", "date", "dayofyear(date) / 366.0D as prob")
    for r in training.reuse_scores(days, scores).collect():
        assert r["scored_on"] == max(w for w in want if w <= r["date"]) and (r["date"] - r["scored_on"]).days < max(every, 1)


def test_a_small_fit_end_to_end(features):
    cutoff = features.agg({"date": "max"}).first()[0]
    rows = training.score_cutoff(features, cutoff, trees=3).collect()
    assert {r["symbol"] for r in rows} == {"A", "B", "C"}  # C is too short and scores 0
    for r in rows:
        assert r["symbol"] != "C" or r["ensemble_prob"] == 0.0
        assert 0 <= r["rf_prob"] <= 1 and 0 <= r["xgb_prob"] <= 1
        assert r["ensemble_prob"] == pytest.approx((r["rf_prob"] + r["xgb_prob"]) / 2)
        assert r["signal"] == (r["ensemble_prob"] >= 0.6)


def test_a_short_history_scores_zero(features):
    cutoff = features.agg({"date": "max"}).first()[0]
    short = features.filter("symbol = 'A'").unionByName(features.filter("symbol = 'B'").filter(F.col("date") > F.date_sub(F.lit(cutoff), 30)))
    rows = {r["symbol"]: r for r in training.score_cutoff(short, cutoff, trees=2).collect()}
    assert set(rows) == {"A", "B"} and rows["A"]["ensemble_prob"] > 0
    assert (rows["B"]["rf_prob"], rows["B"]["xgb_prob"], rows["B"]["ensemble_prob"], rows["B"]["signal"]) == (0.0, 0.0, 0.0, False)
    none = training.score_cutoff(features.filter(F.col("date") > F.date_sub(F.lit(cutoff), 30)), cutoff, trees=2).collect()
    assert [r["ensemble_prob"] for r in none] == [0.0] * 3


def test_walk_forward_scores_every_cutoff(features):
    cutoffs = sorted(r["date"] for r in features.filter("symbol = 'A'").select("date").collect())[-2:]
    rows = training.walk_forward(features, cutoffs, trees=2, parallelism=2).collect()
    today = {(r["symbol"], r["date"]) for r in features.filter(F.col("date").isin(cutoffs)).select("symbol", "date").collect()}
    assert {(r["symbol"], r["date"]) for r in rows} == today >= {(s, c) for s in "AB" for c in cutoffs}


def planted(spark, rule):
    """Two symbols of 240 days and one of 40, every input random; ``rule`` makes the label from a row's inputs."""
    rng = np.random.default_rng(3)
    rows = []
    for symbol, days in (("A", 240), ("B", 240), ("C", 40)):
        for k in range(days):
            x = {c: float(v) for c, v in zip(FEATURES, rng.normal(size=len(FEATURES)))}
            rows.append((symbol, dt.date(2024, 12, 31) - dt.timedelta(days=days - k), *x.values(), int(rule(x, rng))))
    kinds = ", ".join(f"{c} double" for c in FEATURES)
    return materialize(spark.createDataFrame(rows, f"symbol string, date date, {kinds}, target int"))


def test_a_planted_signal_is_found_and_noise_is_not(spark):
    found = planted(spark, lambda x, rng: x["rsi"] + 0.2 * x["vol_z"] > 0)
    cutoff = dt.date(2024, 12, 30)
    rows = {r["symbol"]: r for r in training.signal_result(found, cutoff, trees=12).collect()}
    for symbol in "AB":
        r = rows[symbol]
        assert r["train_rows"] == RULES.train_window and not r["insufficient"] and r["top_features"][0] == "rsi" and len(r["top_features"]) == 5
        assert r["rf_accuracy"] >= 0.8 and r["xgb_accuracy"] >= 0.8  # a constant gets about half
        assert r["ensemble_prob"] == pytest.approx((r["rf_prob"] + r["xgb_prob"]) / 2)
    c = rows["C"]
    assert c["insufficient"] and c["train_rows"] < RULES.min_history and c["top_features"] == []
    assert (c["rf_prob"], c["xgb_prob"], c["ensemble_prob"], c["rf_accuracy"], c["signal"]) == (0.0, 0.0, 0.0, 0.0, False)
    noise = training.signal_result(planted(spark, lambda x, rng: rng.random() < 0.5), cutoff, trees=12).filter("not insufficient").collect()
    assert len(noise) == 2 and sum(r["rf_accuracy"] + r["xgb_accuracy"] for r in noise) / 4 < 0.72


def test_results_at_several_cutoffs(spark, features):
    cutoffs = sorted(r["date"] for r in features.filter("symbol = 'A'").select("date").collect())[-2:]
    rows = training.signal_results(features, cutoffs, trees=2, parallelism=2).collect()
    assert {(r["symbol"], r["date"]) for r in rows} >= {(s, c) for s in "AB" for c in cutoffs}
