import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import training, windowed
from tidemark.params import FEATURES, RULES


def _cases(rounds, seed=0):
    rng = np.random.default_rng(seed)
    for turn in range(rounds):
        n = int(rng.integers(1, 70))
        values = rng.normal(size=n) if turn % 3 else rng.integers(0, 4, n).astype(float)
        first = rng.integers(0, n, 20)
        yield values, first, np.array([rng.integers(a + 1, n + 1) for a in first])


def test_smallest_and_quantiles_are_those_of_sorted_stretches():
    for values, first, last in _cases(60):
        tree = windowed.Stretches(values)
        for k in (np.zeros(len(first), dtype=int), (last - first) // 2, last - first - 1):
            assert (tree.smallest(first, last, k) == [np.sort(values[a:b])[i] for a, b, i in zip(first, last, k)]).all()
        for q in (0, 0.01, 0.75, 1):
            assert tree.quantile(first, last, q) == pytest.approx([np.quantile(values[a:b], q) for a, b in zip(first, last)])


def test_empty_stretches_have_no_quantile():
    tree = windowed.Stretches(np.array([1.0, 2.0]))
    assert np.isnan(tree.quantile(np.array([1]), np.array([1]), 0.5)).all()


def test_sums_of_the_smallest_are_exact():
    for values, first, last in _cases(40, 1):
        numbers, shift = windowed.whole_numbers(values)
        tree = windowed.Stretches(values)
        for k in (np.zeros(len(first), dtype=int), (last - first) // 3, last - first):
            want = [sum(sorted(numbers[a:b])[:i]) for a, b, i in zip(first, last, k)]
            assert tree.sums(first, last, k, numbers).tolist() == want


def test_whole_numbers_lose_nothing():
    values = np.array([0.0, 1.0, -0.1, 1e-300, 3.5e200, sys.float_info.min, 5e-324, -7e307])
    numbers, shift = windowed.whole_numbers(values)
    assert [n / (1 << shift) for n in numbers] == values.tolist()


def test_deviation_does_not_cancel():
    x = np.array([1e9, 1e9 + 1, 1e9 + 2] * 20)
    numbers, shift = windowed.whole_numbers(x)
    n = np.array([len(x)])
    mean, std = windowed.moments(n, np.array([sum(numbers)], dtype=object), np.array([sum(v * v for v in numbers)], dtype=object), shift)
    assert mean[0] == 1e9 + 1 and std[0] == pytest.approx(np.sqrt(2 / 3), rel=1e-15)


def _features(spark, days=260, seed=3):
    rnd = random.Random(seed)
    rows = []
    for symbol in ("A", "B"):
        for day in range(days if symbol == "A" else 90):
            x = [rnd.choice([0.0, 1.0, None, 1e6]) if c % 5 == 0 else rnd.gauss(0, 10.0 ** (c % 4)) for c in range(len(FEATURES))]
            label = None if rnd.random() < 0.05 else rnd.randint(0, 1)
            rows.append((symbol, day, *x, label))
    schema = "symbol string, _day int, " + ", ".join(f"{c} double" for c in FEATURES) + ", target int"
    return spark.createDataFrame(rows, schema).withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("_day"))).drop("_day")


@pytest.mark.parametrize("rows", [64, 3072])
def test_every_window_equals_the_window_fitted_alone(spark, rows):
    features = _features(spark)
    got = {(s["symbol"], s["date"]): s for s in windowed.training_stats(features, rows=rows).collect()}
    cutoffs = features.select("date")
    window = training.training_rows(features, cutoffs).toPandas()
    assert set(got) == {(s, c) for s, c in zip(window["symbol"], window["cutoff"])}
    for (symbol, cutoff), part in window.groupby(["symbol", "cutoff"]):
        s = got[symbol, cutoff]
        assert (s["n"], s["n_up"]) == (len(part), part["target"].sum())
        assert s["weight_up"] == pytest.approx(len(part) / (2 * part["target"].sum()))
        x = part[FEATURES].to_numpy()
        lo, hi = np.quantile(x, [0.01, 0.99], axis=0)
        cut = np.clip(x, lo, hi)
        assert s["lo"] == pytest.approx(lo) and s["hi"] == pytest.approx(hi)
        for mean, std, m in ((s["mean"], s["std"], x), (s["fit_mean"], s["fit_std"], cut)):
            assert mean == pytest.approx(m.mean(axis=0)) and std == pytest.approx(np.where(m.std(axis=0) == 0, 1, m.std(axis=0)))


def test_last_window_equals_the_stages_of_a_fit(spark):
    features = _features(spark).filter("symbol = 'A'")
    cutoff = features.agg(F.max("date")).first()[0]
    rows = training.training_rows(features, features.filter(F.col("date") == cutoff).select("date"))
    bounds = training.winsor_bounds(rows)
    stats = training.scale_stats(training.clip(rows, bounds)).first()
    s = windowed.training_stats(features).filter(F.col("date") == cutoff).first()
    assert s["fit_mean"] == pytest.approx([stats[c][0] for c in FEATURES])
    assert s["fit_std"] == pytest.approx([stats[c][1] for c in FEATURES])
    scaled = windowed.scaled_at(features, windowed.training_stats(features)).filter(F.col("date") == cutoff).first()
    today = features.filter(F.col("date") == cutoff).fillna(0, FEATURES)
    want = training.scale(training.clip(today, bounds), training.scale_stats(training.clip(rows, bounds))).first()
    assert [scaled[c] for c in FEATURES] == pytest.approx([want[c] for c in FEATURES])


def test_windows_without_labels_and_empty_tables(spark):
    features = _features(spark).filter("symbol = 'B'").withColumn("target", F.lit(None).cast("int"))
    s = windowed.training_stats(features).first()
    assert s["n"] == 0 and s["weight_up"] is None and set(s["lo"]) == {None}
    assert windowed.training_stats(features.limit(0)).count() == 0


@pytest.mark.parametrize("span", [1, 5, 400])
def test_quantiles_over_any_span(spark, span):
    rnd = random.Random(span)
    rows = [("A", i + 1, None if i == 300 else rnd.choice([rnd.random(), 0.5])) for i in range(900)] + [("B", 1, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, rn int, v double")
    got = {(x["symbol"], x["rn"]): x for x in windowed.quantiles(df, "v", span, {"low": 0.1, "mid": 0.5}, rows=128).collect()}
    assert len(got) == 901
    for i in range(900):
        frame = [v for _, _, v in rows[max(i - span + 1, 0):i + 1]]
        if len(frame) < span or None in frame:
            assert got["A", i + 1]["low"] is None
        else:
            assert got["A", i + 1]["low"] == pytest.approx(np.quantile(frame, 0.1)) and got["A", i + 1]["mid"] == pytest.approx(np.median(frame))
    assert got["B", 1]["mid"] == (2.0 if span == 1 else None)
