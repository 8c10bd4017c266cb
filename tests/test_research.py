import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, research


@pytest.mark.parametrize("n", [3, 10, 402])
def test_tiles_match_ntile_with_a_hot_value(spark, n):
    rows = [(0.5 if i % 3 else i / 1000, i) for i in range(n)]
    df = spark.createDataFrame(rows, "p double, id int")
    got = research.tiles(df, ["p", "id"], 4, parts=3)
    df.createOrReplaceTempView("tiled")
    want = spark.sql("select id, ntile(4) over (order by p, id) as t from tiled").collect()
    assert {r["id"]: r["tile"] for r in got.collect()} == {r["id"]: r["t"] for r in want}


def test_bootstrap_interval_covers_and_repeats(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(0.02, 0.05, 800)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
    one = research.bootstrap_mean(df, "v", ["id"], 300).first()
    two = research.bootstrap_mean(df.repartition(7), "v", ["id"], 300).first()
    assert one["low"] == pytest.approx(two["low"]) and one["high"] == pytest.approx(two["high"])
    half = 1.96 * values.std(ddof=1) / np.sqrt(len(values))
    assert one["low"] == pytest.approx(values.mean() - half, abs=half * 0.35)
    assert one["high"] == pytest.approx(values.mean() + half, abs=half * 0.35)
    assert one["boot_mean"] == pytest.approx(values.mean(), abs=half * 0.3)


def test_wilson(spark):
    row = spark.range(1).select(*research.wilson(F.lit(6.0), F.lit(10.0))).first()
    # 60 % of 10: about 31 to 83 %
    assert row["low"] == pytest.approx(0.3127, abs=1e-3) and row["high"] == pytest.approx(0.8318, abs=1e-3)


def test_recompounding_matches_a_loop(spark):
    rng = random.Random(2)
    rows = [(dt.date(2023, 12, 1) + dt.timedelta(days=rng.randrange(90)), rng.uniform(-0.01, 0.03)) for _ in range(300)]
    df = spark.createDataFrame(rows, "exit_date date, pnl_pct double")
    got = {r["risk"]: r for r in research.sizing_summary(research.recompounded(df, [0.01, 0.25])).collect()}
    for risk in (0.01, 0.25):
        balance = peak = 10000.0
        worst = 0.0
        for day in sorted({r[0] for r in rows}):
            balance *= 1 + risk / 3 * sum(p - 2 * 0.0026 for d, p in rows if d == day)
            peak = max(peak, balance)
            worst = min(worst, balance / peak - 1)
        assert got[risk]["total_return"] == pytest.approx(balance / 10000 - 1)
        assert got[risk]["max_drawdown"] == pytest.approx(worst)


def test_concurrency(spark):
    d = lambda k: dt.date(2024, 1, k)
    trades = spark.createDataFrame([(d(1), d(4)), (d(2), d(5)), (d(2), d(3)), (d(8), d(9))], "entry_date date, exit_date date")
    calendar = spark.createDataFrame([(d(k),) for k in range(1, 11)], "date date")
    row = research.concurrency_summary(research.concurrency(trades), calendar).first()
    assert (row["max_open"], row["days_3_or_more"]) == (3, 1) and row["time_in_market"] == pytest.approx(0.5)


def test_profit_factor_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", -1.0), ("b", 0.0)], "k string, pnl_net double")
    got = {r["k"]: r["pf"] for r in df.groupBy("k").agg(metrics.profit_factor().alias("pf")).collect()}
    assert got == {"a": float("inf"), "b": 3.0}


def test_equity_sheet(spark):
    values = [10000, 10100, 9900, 9950, 10300]
    rows = [(dt.date(2023, 12, 30) + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    row = metrics.equity_sheet(spark.createDataFrame(rows, "date date, balance double")).first()
    x = np.array(values, float)
    moves = x[1:] / x[:-1] - 1
    assert row["sharpe"] == pytest.approx(moves.mean() / moves.std(ddof=1) * np.sqrt(252))
    assert row["max_drawdown"] == pytest.approx(9900 / 10100 - 1)
    assert row["cagr"] == pytest.approx(1.03 ** (365.25 / 4) - 1)
    flat = [(r[0], 10000.0) for r in rows]
    none = metrics.equity_sheet(spark.createDataFrame(flat, "date date, balance double")).first()
    assert (none["sharpe"], none["calmar"], none["cagr"]) == (0.0, 0.0, 0.0)


def test_bootstrap_moves_one_row_per_task_and_no_replicates(spark):
    df = spark.range(1000).select(F.col("id"), F.col("id").cast("double").alias("v")).repartition(5)
    plan = research.bootstrap_mean(df, "v", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.index("MapInArrow") > plan.index("FlatMapGroupsInArrow")
    assert "explode" not in plan[plan.index("MapInArrow"):]


def test_bootstrap_weights_follow_the_md5_of_seed_replicate_and_key(spark):
    import hashlib
    import math

    df = spark.createDataFrame([(1, None, 2.0), (2, "x", None), (3, "y", -1.5)], "id int, k string, v double")
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    means = []
    for replicate in range(1, 41):
        total, mass = 0.0, 0
        for i, k, v in df.collect():
            name = "|".join(str(x) for x in (42, replicate, i, k) if x is not None)
            u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            w = int((u > steps).sum())
            total, mass = total + (v or 0.0) * w, mass + w
        means += [total / mass] if mass else []
    got = research.bootstrap_mean(df, "v", ["id", "k"], 40).first()
    assert got["boot_mean"] == pytest.approx(np.mean(means))
    assert got["low"] == pytest.approx(np.quantile(means, 0.025)) and got["high"] == pytest.approx(np.quantile(means, 0.975))


def test_bootstrap_of_nothing_has_no_bounds(spark):
    got = research.bootstrap_mean(spark.createDataFrame([], "id int, v double"), "v", ["id"]).first()
    assert got.asDict() == {"low": None, "high": None, "boot_mean": None}
