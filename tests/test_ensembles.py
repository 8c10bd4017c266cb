"""Many tree ensembles in one job against trees grown one by one, recursively."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ensembles as E
from tidemark.operators import training
from tidemark.params import FEATURES, RULES
from tidemark.session import materialize


def planted(spark, rule, days=(230, 200, 60), label="int"):
    """Symbols of daily rows with random inputs; ``rule`` makes the label. The last row of each has none."""
    rng = np.random.default_rng(3)
    rows = []
    for symbol, count in zip("ABC", days, strict=True):
        for k in range(count):
            x = {c: float(v) for c, v in zip(FEATURES, rng.normal(size=len(FEATURES)), strict=True)}
            rows.append((symbol, dt.date(2024, 12, 31) - dt.timedelta(days=count - 1 - k), *x.values(), int(rule(x, rng)) if k < count - 1 else None))
    kinds = ", ".join(f"{c} double" for c in FEATURES)
    return materialize(spark.createDataFrame(rows, f"symbol string, date date, {kinds}, target {label}"))


def tree_value(bins, at, stats, depth, offered, gain, leaf, place=0, total=None, left=None):
    """Value of every scored row in ``at`` by growing one tree as nested calls; ``left`` are the fitted rows of this node."""
    total = stats[left].sum(axis=0)
    best = None
    if depth:
        for f in offered(place):
            for b in range(E.BINS):
                low = left[bins[left, f] <= b]
                g = round(gain(stats[low].sum(axis=0), total), 9)
                if g > 0 and (best is None or g > best[0]):
                    best = (g, f, b)
    if best is None:
        return {k: leaf(total) for k in at}, []
    _, f, b = best
    out, used = {}, [(f, best[0])]
    for side, child in ((0, 2 * place + 1), (1, 2 * place + 2)):
        pick = lambda rows: rows[(bins[rows, f] > b) == bool(side)]  # noqa: B023, E731
        values, more = tree_value(bins, pick(at), stats, depth - 1, offered, gain, leaf, child, left=pick(left))
        out |= values
        used += more
    return out, used


def plain_forest(fit, spec):
    n, inputs = len(fit.y), fit.bins.shape[1]
    rng = fit.generator(1)
    times = [np.bincount(rng_rows, minlength=n) for rng_rows in rng.integers(0, n, (spec.trees, n))]
    keys = rng.random((spec.trees, 2 ** spec.depth, inputs))
    weight = n / (2 * np.bincount(fit.y, minlength=2))
    scored, total, share = np.arange(n, len(fit.bins)), np.zeros(len(fit.bins)), np.zeros(inputs)

    def gain(low, whole):
        high = whole - low
        if low[0] < spec.least_rows or high[0] < spec.least_rows:
            return -1
        return 2 * (whole[1] * whole[2] / whole[1:].sum() - low[1] * low[2] / low[1:].sum() - high[1] * high[2] / high[1:].sum())

    for t in range(spec.trees):
        w = times[t] * weight[fit.y]
        stats = np.stack([times[t] > 0, w * (fit.y == 0), w * (fit.y == 1)], axis=1).astype(float)
        values, used = tree_value(fit.bins, scored, stats, spec.depth, lambda place, t=t: sorted(np.argsort(keys[t, place])[:spec.offered]),
                                  gain, lambda whole: whole[2] / whole[1:].sum(), left=np.flatnonzero(times[t]))
        for k, v in values.items():
            total[k] += v / spec.trees
        own = np.zeros(inputs)
        for f, g in used:
            own[f] += g
        share += own / max(own.sum(), 1e-300) / spec.trees
    return total[n:], share


def plain_booster(fit, spec):
    n, inputs = len(fit.y), fit.bins.shape[1]
    rng = fit.generator(2)
    drawn, keys = rng.random((spec.rounds, n)) < spec.rows, rng.random((spec.rounds, inputs))
    margin = np.zeros(len(fit.bins))

    def gain(low, whole):
        high = whole - low
        found = sum(sign * a[0] ** 2 / (a[1] + spec.l2) for a, sign in ((low, 1), (high, 1), (whole, -1)))
        return found if min(low[1], high[1]) >= spec.least_weight and found >= spec.gamma else -1

    for turn in range(spec.rounds):
        p = 1 / (1 + np.exp(-margin[:n]))
        stats = np.stack([p - fit.y, p * (1 - p)], axis=1) * drawn[turn][:, None]
        offered = sorted(np.argsort(keys[turn])[:max(1, int(spec.columns * inputs))])
        values, _ = tree_value(fit.bins, np.arange(len(fit.bins)), stats, spec.depth, lambda place, o=offered: o, gain,
                               lambda whole: -whole[0] / (whole[1] + spec.l2), left=np.arange(n))
        for k, v in values.items():
            margin[k] += spec.rate * v
    return 1 / (1 + np.exp(-margin[n:]))


def fits(count=3, inputs=6):
    rng = np.random.default_rng(8)
    out = []
    for k in range(count):
        x = rng.normal(size=(90 + 20 * k, inputs))
        x[:, 2] = np.round(x[:, 2])  # ties
        y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=len(x)) > 0).astype(int)
        out.append(E.Fit(E.binned(x[:-10], x[-10:]), y[:-10], [k, 7]))
    return out


def test_forests_equal_trees_grown_one_by_one():
    spec = E.Forest(trees=6, depth=4, least_rows=4, offered=2)
    got, share = E.forests(fits(), spec)
    for fit, up, own in zip(fits(), got, share, strict=True):
        want, importance = plain_forest(fit, spec)
        np.testing.assert_allclose(up, want, atol=1e-12)
        np.testing.assert_allclose(own, importance, atol=1e-8)
        assert own.sum() == pytest.approx(1)


def test_boosters_equal_trees_grown_one_by_one():
    spec = E.Booster(rounds=8, depth=3, least_weight=1.0, gamma=0.1, rows=0.7, columns=0.6)
    for fit, up in zip(fits(), E.boosters(fits(), spec), strict=True):
        np.testing.assert_allclose(up, plain_booster(fit, spec), atol=1e-12)


def test_regularisers_of_the_booster():
    one = fits(1)
    # without splits: one Newton step per round
    y = one[0].y
    step = (y - 0.5).sum() / (0.25 * len(y) + 5)
    got = E.boosters(one, E.Booster(rounds=1, depth=0, rows=1.0))[0]
    np.testing.assert_allclose(got, 1 / (1 + np.exp(-0.05 * step)))
    # without any of them the same trees give more extreme scores
    spread = [np.abs(E.boosters(one, E.Booster(rounds=1, rate=1.0, rows=1.0, columns=1.0, gamma=0.0, least_weight=0.0, l2=x))[0] - 0.5).max() for x in (0.0, 5.0, 50.0)]
    assert spread[0] > spread[1] > spread[2]
    # no split gains that much: one leaf per tree, so every row has the same score
    assert np.ptp(E.boosters(one, E.Booster(rounds=5, gamma=1e9))[0]) == 0
    # no child can be heavy enough
    assert np.ptp(E.boosters(one, E.Booster(rounds=5, least_weight=1e9))[0]) == 0


def test_a_leaf_of_one_class_or_one_value():
    x = np.ones((30, 4))
    for y in (np.zeros(30, int), np.ones(30, int), np.arange(30) % 2):
        fit = E.Fit(E.binned(x, x[:2]), y, [1])
        up, share = E.forests([fit], E.Forest(trees=3, bootstrap=False))
        assert up[0] == pytest.approx([0.5 if len(set(y)) == 2 else y[0]] * 2) and share[0].sum() == 0
        assert np.ptp(E.boosters([fit])[0]) == 0


def test_windows_rows_and_history(spark):
    table = planted(spark, lambda x, rng: x["rsi"] > 0)
    due = table.select("symbol", "date").filter(F.dayofmonth("date") % 9 == 0)
    small = E.Forest(trees=3), E.Booster(rounds=3)
    rows = E.signals(table, due, *small).collect()
    pdf = table.toPandas().sort_values("date")
    assert len(rows) == due.count()
    for r in rows:
        before = pdf[(pdf.symbol == r.symbol) & (pdf.date < r.date) & pdf.target.notna()]
        assert r.train_rows == min(len(before), RULES.train_window) and r.insufficient == (len(before) < RULES.min_history)
        if r.insufficient:
            assert (r.rf_prob, r.xgb_prob, r.ensemble_prob, r.rf_accuracy, r.signal, r.top_features) == (0.0, 0.0, 0.0, 0.0, False, [])
    r = next(r for r in rows if r.symbol == "A" and r.train_rows == RULES.train_window)
    mine = pdf[(pdf.symbol == "A") & (pdf.date < r.date)].tail(RULES.train_window)
    today = pdf[(pdf.symbol == "A") & (pdf.date == r.date)]
    import zlib
    seed = [42, zlib.crc32(b"A"), r.date.toordinal()]
    x, y = mine[FEATURES].to_numpy(), mine["target"].to_numpy().astype(int)
    tested = E.Fit(E.binned(x[:-20], x[-20:]), y[:-20], [*seed, 0])
    whole = E.Fit(E.binned(x, today[FEATURES].to_numpy()), y, [*seed, 1])
    assert r.rf_prob == pytest.approx(plain_forest(whole, small[0])[0][0]) and r.xgb_prob == pytest.approx(plain_booster(whole, small[1])[0])
    assert r.rf_accuracy == np.mean((plain_forest(tested, small[0])[0] > 0.5) == y[-20:])
    assert r.xgb_accuracy == np.mean((plain_booster(tested, small[1]) > 0.5) == y[-20:])


def test_results_do_not_depend_on_blocks_partitions_or_other_dates(spark):
    table = planted(spark, lambda x, rng: x["rsi"] + x["vol_z"] > 0)
    due = table.select("symbol", "date").filter(F.dayofmonth("date") % 11 == 0)
    small = E.Forest(trees=4), E.Booster(rounds=3)

    def run(block, rows):
        return sorted(map(tuple, E.signals(table.repartition(3), rows, *small, block=block).collect()))

    want = run(64, due)
    assert run(7, due) == want and run(500, due) == want
    some = run(64, due.filter("symbol = 'A'").filter(F.month("date") == 10))
    assert some and all(row in want for row in some)


def test_a_planted_signal_is_found_and_noise_is_not(spark):
    last = F.col("date") == F.lit(dt.date(2024, 12, 31))
    table = planted(spark, lambda x, rng: x["rsi"] + 0.2 * x["vol_z"] > 0)
    rows = {r.symbol: r for r in E.signals(table, table.filter(last)).collect()}
    for symbol in "AB":
        r = rows[symbol]
        assert r.top_features[0] == "rsi" and len(set(r.top_features)) == 5
        assert r.rf_accuracy >= 0.8 and r.xgb_accuracy >= 0.8
        assert r.ensemble_prob == pytest.approx((r.rf_prob + r.xgb_prob) / 2) and r.signal == (r.ensemble_prob >= 0.6)
    assert rows["C"].insufficient
    noise = planted(spark, lambda x, rng: rng.random() < 0.5)
    due = noise.filter(F.col("date") > F.lit(dt.date(2024, 12, 31)) - F.expr("interval 30 days")).filter("symbol <> 'C'")
    found = E.signals(noise, due).agg(F.avg("rf_accuracy"), F.avg("xgb_accuracy")).first()
    assert all(0.3 < a < 0.7 for a in found)


def test_null_inputs_empty_tables_and_dates_without_rows(spark):
    table = planted(spark, lambda x, rng: x["rsi"] > 0).withColumn("vol_z", F.lit(None).cast("double"))
    due = table.filter(F.col("date") == F.lit(dt.date(2024, 12, 30))).select("symbol", "date")
    elsewhere = due.select("symbol", F.date_add("date", 900).alias("date"))
    rows = E.signals(table, due.unionByName(due).unionByName(elsewhere), E.Forest(trees=2), E.Booster(rounds=2)).collect()
    assert len(rows) == 3 and all(0 <= r.ensemble_prob <= 1 for r in rows)
    assert E.signals(table.limit(0), due).collect() == [] and E.signals(table, due.limit(0)).collect() == []


def test_scores_expire(spark):
    start = dt.date(2024, 1, 1)
    days = spark.createDataFrame([("X", start + dt.timedelta(days=k)) for k in (0, 1, 4, 5, 6, 20, 21)], "symbol string, date date")
    scores = spark.createDataFrame([("X", start, 0.7), ("X", start + dt.timedelta(days=20), 0.8)], "symbol string, date date, prob double")
    got = [(r.scored_on, r.prob) for r in training.reuse_scores(days, scores, within=5).orderBy("date").collect()]
    late = start + dt.timedelta(days=20)
    assert got == [(start, 0.7)] * 3 + [(None, None)] * 2 + [(late, 0.8)] * 2
