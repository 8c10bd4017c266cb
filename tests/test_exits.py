import datetime as dt
from dataclasses import replace

import pytest
from helpers import bars_frame, numbered, plain_exit, walk

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import exits
from tidemark.params import RULES

DAY = dt.date(2024, 3, 4)


def later(*rows, gaps=None):
    offsets = gaps or range(1, len(rows) + 1)
    return [(DAY + dt.timedelta(days=i), *map(float, r)) for i, r in zip(offsets, rows)]


def run(spark, rows, entry_high=100.5, rules=RULES):
    frame = [("X", DAY, 100.0, entry_high, 99.5, 100.0, 1.0)] + [("X", d, o, h, lo, c, 1.0) for d, o, h, lo, c in rows]
    pdf = pd.DataFrame(frame, columns=["symbol", "date", "open", "high", "low", "close", "volume"])
    positions = spark.createDataFrame([("X", DAY, 100.0)], "symbol string, entry_date date, entry_price double")
    done = exits.first_exit(exits.at_entry(positions, exits.with_path(numbered(spark, pdf))), rules).first()
    return done["reason"], done["exit_price"], done["hold_days"], done["pnl_pct"]


QUIET = (100, 100.4, 99.6, 100.1)
CASES = {
    "target": (later((100, 103.2, 99.5, 102)), 100.5, ("TP", 103.0, 1)),
    "target and stop in one bar": (later((100, 103.5, 98.5, 100)), 100.5, ("TP", 103.0, 1)),
    "stop": (later((100, 100.4, 98.9, 99.2)), 100.5, ("SL", 99.0, 1)),
    "stop with a gap below": (later((97, 98, 96, 97)), 100.5, ("SL", 99.0, 1)),
    "arms then reverts": (later((100, 101.6, 100.1, 101.4), (101.2, 101.3, 100.6, 100.8)), 100.5, ("TRAIL_BE", 101.2, 2)),
    "armed, opens above": (later((100, 101.6, 100.1, 101.4), (102, 102.4, 101, 101.2)), 100.5, ("TRAIL_BE", 101.5, 2)),
    "seeded by the entry day": (later((101, 101.2, 100.8, 101)), 101.6, ("TRAIL_BE", 101.0, 1)),
    "the arming bar holds": (later((100, 101.6, 99.2, 100.2)), 100.5, (None, None, None)),
    "time exit": (later(QUIET, QUIET, QUIET, QUIET, QUIET), 100.5, ("MAX_HOLD", 100.1, 5)),
    "time exit over a gap": (later(QUIET, QUIET, gaps=[1, 6]), 100.5, ("MAX_HOLD", 100.1, 6)),
    "no later bars": ([], 100.5, (None, None, None)),
}


@pytest.mark.parametrize("case", CASES)
def test_hand_built_paths(spark, case):
    rows, high, (reason, price, hold) = CASES[case]
    got = run(spark, rows, high)
    assert (got[0], got[2]) == (reason, hold)
    assert got[1] == (pytest.approx(price) if price else None)


def test_options(spark):
    gap = later((97, 98, 96, 97))
    assert run(spark, gap, rules=replace(RULES, gap_aware_stop=True))[1] == 97.0
    seeded = later((101, 101.2, 100.8, 101))
    assert run(spark, seeded, 101.6, replace(RULES, seed_entry_day=False))[0] is None


@pytest.mark.parametrize("rows,gaps", [(4096, False), (16, False), (16, True)])
def test_every_bar_as_an_entry_matches_a_loop(spark, rows, gaps):
    pdf = walk(n=300, seed=11, gaps=gaps)
    bars = numbered(spark, pdf)
    positions = bars.select("symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    done = exits.first_exit(exits.at_entry(positions, exits.with_path(bars, rows=rows)))
    got = {r["entry_date"]: r for r in done.collect()}
    table = list(pdf[["date", "open", "high", "low", "close"]].itertuples(index=False, name=None))
    reasons = set()
    for i, (date, _, high, _, close) in enumerate(table):
        want = plain_exit(date, close, table[i + 1:], high >= close * 1.015)
        row = got[date]
        if want is None:
            assert row["reason"] is None
        else:
            assert (row["exit_date"], row["reason"], row["hold_days"]) == (want[0], want[1], want[3])
            assert row["exit_price"] == pytest.approx(want[2])
            reasons.add(want[1])
            if want[1] == "TRAIL_BE":  # an armed fill is never better than the open
                assert row["exit_price"] <= row["exit_open"]
    assert reasons == {"TP", "SL", "TRAIL_BE", "MAX_HOLD"}


def test_an_entry_day_without_a_bar_stays_unresolved(spark):
    bars = numbered(spark, walk(n=20))
    positions = spark.createDataFrame([("X", dt.date(2019, 1, 1), 100.0)], "symbol string, entry_date date, entry_price double")
    assert exits.first_exit(exits.at_entry(positions, exits.with_path(bars))).first()["reason"] is None


def test_daily_check_agrees_with_the_replay(spark):
    pdf = walk(n=200, seed=4)
    bars = numbered(spark, pdf)
    positions = bars.select("symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price")).withColumn(
        "row_id", F.col("entry_date").cast("string"))
    replay = {r["row_id"]: r for r in exits.first_exit(exits.at_entry(positions, exits.with_path(bars))).collect()}
    open_rows, found = {r["row_id"] for r in positions.collect()}, {}
    for k in range(2, 9):  # the run k days after the entry looks at the bar k-1 days after it
        rows = exits.check_day(positions, bars, F.date_add("entry_date", k)).filter("reason is not null").collect()
        for r in rows:
            if r["row_id"] in open_rows:
                open_rows.discard(r["row_id"])
                found[r["row_id"]] = (r["reason"], r["exit_date"])
    for row_id, r in replay.items():
        assert found.get(row_id) == ((r["reason"], r["exit_date"]) if r["reason"] else None)


def test_known_counts_on_the_given_tables(spark, sf_mid):
    from tidemark.plans import QUERIES

    rows = {r["reason"]: r["n"] for r in QUERIES["a06_by_reason"](spark, sf_mid).collect()}
    assert rows == {"MAX_HOLD": 39, "SL": 623, "TP": 126, "TRAIL_BE": 660}


def test_final_close(spark):
    pdf = walk(n=30)
    left = spark.createDataFrame([("X", pdf["date"][28], 100.0)], "symbol string, entry_date date, entry_price double")
    row = exits.final_close(left, bars_frame(spark, pdf)).first()
    assert (row["reason"], row["exit_price"], row["hold_days"]) == ("FINAL_CLOSE", pdf["close"].iloc[-1], 1)


def test_the_horizon_follows_the_rules(spark):
    from dataclasses import replace

    rules = replace(RULES, max_hold=10, take_profit=9.0, stop_loss=0.9)
    flat = pd.DataFrame([("A", dt.date(2024, 1, 1) + dt.timedelta(days=k), 10.0, 10.0, 10.0, 10.0, 1.0) for k in range(30)],
                        columns=["symbol", "date", "open", "high", "low", "close", "volume"])
    bars = numbered(spark, flat)
    positions = spark.createDataFrame([("A", dt.date(2024, 1, 2), 10.0)], "symbol string, entry_date date, entry_price double")
    done = exits.first_exit(exits.at_entry(positions, exits.with_path(bars, rules=rules)), rules).first()
    assert done["reason"].startswith("MAX_HOLD") and done["hold_days"] == 10
    with pytest.raises(ValueError, match="cannot settle"):
        exits.first_exit(exits.at_entry(positions, exits.with_path(bars)), rules)
