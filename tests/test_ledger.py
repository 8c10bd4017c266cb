import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger, risk, series
from tidemark.params import RULES

D = dt.date


def test_recorded_trade_recomputes(spark):
    # One recorded trade.
    row = spark.createDataFrame([((1861.52 - 1879.48) / 1879.48, 33.3333)], "pnl_pct double, trade_size double")
    done = ledger.with_pnl(row).first()
    assert round(done["pnl_gross"], 4) == -0.3185 and round(done["fees"], 4) == 0.1733
    assert round(done["pnl_net"], 4) == -0.4919 and done["win"] is False
    assert round(10000 + done["pnl_net"], 2) == 9999.51


def test_missing_size(spark):
    df = spark.createDataFrame([(None,), (50.0,)], "trade_size double")
    assert sorted(r[0] for r in ledger.sized(df, F.lit(9000.0)).collect()) == [pytest.approx(30.0), 50.0]


LEDGER = ("row_id string, date date, symbol string, action string, entry_price double, exit_price double, pnl_gross double, "
          "pnl_net double, fees double, reason string, hold_days int, win boolean, balance_after double, stop_order_id string, fill_qty double")
EXITS = ("row_id string, date date, symbol string, exit_date date, exit_price double, pnl_gross double, pnl_net double, fees double, "
         "reason string, hold_days int, win boolean, balance_after double")


def opened(row_id, day, symbol):
    return (row_id, D(2024, 1, day), symbol, "OPEN", 100.0, None, None, None, None, None, None, None, 10000.0, "abc", 1.5)


def closing(row_id, day, symbol, reason="TP"):
    return (row_id, D(2024, 1, day), symbol, D(2024, 1, day + 1), 103.0, 1.0, 0.8, 0.2, reason, 1, True, 10000.8)


def test_two_positions_close_one(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A"), opened("T0002", 1, "B")], LEDGER)
    done = {r["row_id"]: r for r in ledger.close_trades(book, spark.createDataFrame([closing("T0002", 1, "B")], EXITS)).collect()}
    assert done["T0001"]["action"] == "OPEN" and done["T0001"]["stop_order_id"] == "abc"
    closed = done["T0002"]
    assert (closed["action"], closed["reason"], closed["stop_order_id"], closed["fill_qty"]) == ("CLOSED", "TP", None, None)


def test_fallback_key_closes_the_first_open_row_only(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A"), opened("T0002", 1, "A"), opened("T0003", 2, "A")], LEDGER)
    done = ledger.close_trades(book, spark.createDataFrame([closing("", 1, "A")], EXITS))
    assert {r["row_id"]: r["action"] for r in done.collect()} == {"T0001": "CLOSED", "T0002": "OPEN", "T0003": "OPEN"}


def test_closing_twice_changes_nothing(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A")], LEDGER)
    exit_row = spark.createDataFrame([closing("T0001", 1, "A")], EXITS)
    once = ledger.close_trades(book, exit_row)
    assert once.collect() == ledger.close_trades(once, exit_row).collect()


def test_reconciliation_cases(spark):
    positions = spark.createDataFrame(
        [("filled", D(2024, 1, 1), 100.0), ("rest", D(2024, 1, 1), 100.0), ("lost", D(2024, 1, 1), 100.0), ("", D(2024, 1, 1), 100.0),
         ("FLATTEN_FAILED", D(2024, 1, 1), 100.0), ("noprice", D(2024, 1, 1), 100.0), (None, D(2024, 1, 1), 100.0)],
        "stop_order_id string, entry_date date, entry_price double")
    status = spark.createDataFrame(
        [("filled", "closed", 98.7), ("rest", "open", None), ("noprice", "closed", 0.0), ("FLATTEN_FAILED", "closed", 1.0), ("", "closed", 1.0)],
        "stop_order_id string, status string, average double")
    done = {r["stop_order_id"]: r for r in ledger.reconcile(positions, status, F.lit(D(2024, 1, 3))).collect()}
    assert {k for k, r in done.items() if r["closed_by_stop"]} == {"filled", "noprice"}
    assert (done["filled"]["exit_price"], done["filled"]["reason"], done["filled"]["hold_days"]) == (98.7, "SL", 2)
    assert done["noprice"]["exit_price"] == pytest.approx(99.0)
    assert done["lost"]["reason"] is None


def test_running_balance_over_range_parts(spark):
    rng = random.Random(3)
    rows = [(D(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 1, 5])), f"S{i % 40:02d}", D(2023, 1, 1) + dt.timedelta(days=i), rng.uniform(-2, 2))
            for i in range(600)]
    df = spark.createDataFrame(rows, "exit_date date, symbol string, entry_date date, pnl_net double")
    got = ledger.running_balance(df, parts=4).orderBy("exit_date", "symbol", "entry_date").collect()
    balance = 10000.0
    for want, row in zip(sorted(rows), got):
        balance += want[3]
        assert row["balance_after"] == pytest.approx(balance, abs=1e-9)
    assert got[-1]["balance_after"] == pytest.approx(10000 + sum(r[3] for r in rows))


def equity(spark, values):
    rows = [(D(2023, 12, 20) + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, balance double")


def test_halt_trips_at_16_percent_and_not_below_15(spark):
    rows = risk.with_drawdown(equity(spark, [10000, 8600, 8400])).orderBy("date").collect()
    assert [r["tripped"] for r in rows] == [False, False, True]


def test_latched_halt_matches_a_loop(spark):
    rng = random.Random(8)
    values = [10000.0]
    for _ in range(120):
        values.append(values[-1] * (1 + rng.uniform(-0.06, 0.055)))
    frame = equity(spark, values)
    days = [r["date"] for r in frame.orderBy("date").collect()]
    reset_days = set(rng.sample(days, 12))
    resets = spark.createDataFrame([(d,) for d in reset_days], "date date")
    got = {r["date"]: r["halted"] for r in risk.latched_halt(frame, resets).collect()}
    peak, halted = 10000.0, False
    seen = set()
    for day, balance in zip(days, values):
        peak = max(peak, balance)
        halted = (halted and day not in reset_days) or (peak - balance) / peak >= 0.15
        assert got[day] == halted
        seen.add(halted)
    assert seen == {True, False}


def test_row_ids_continue(spark):
    df = spark.createDataFrame([(D(2024, 1, 2), "B"), (D(2024, 1, 1), "A")], "date date, symbol string")
    rows = {r["symbol"]: r["row_id"] for r in ledger.numbered(df, ["date", "symbol"], base=7).collect()}
    assert rows == {"A": "T0008", "B": "T0009"}


def test_stale_positions_are_reported(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A")], LEDGER)
    run = F.lit(D(2024, 4, 10))
    assert ledger.open_positions(book, run).count() == 0 and ledger.stale_positions(book, run).count() == 1
    assert ledger.open_positions(book, F.lit(D(2024, 3, 31))).count() == 1


def test_every_exit_closes_a_row_or_is_returned(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A"), opened("T0002", 1, "A"), opened("T0003", 1, "B")], LEDGER)
    exits = spark.createDataFrame(
        [closing("", 1, "A", "TP"), closing(None, 1, "A", "SL"), closing("", 1, "A", "X"), closing("", 2, "A"), closing("T0003", 1, "B"), closing("T0003", 1, "B", "SL"),
         closing("T0009", 1, "B")], EXITS)
    done = {r["row_id"]: (r["action"], r["reason"]) for r in ledger.close_trades(book, exits).collect()}
    assert set(done) == {"T0001", "T0002", "T0003"} and {a for a, _ in done.values()} == {"CLOSED"}
    lost = ledger.unmatched_exits(book, exits).collect()
    assert len(lost) == 4 and sorted((r["row_id"] or "", r["date"].day, r["symbol"]) for r in lost) == [
        ("", 1, "A"), ("", 2, "A"), ("T0003", 1, "B"), ("T0009", 1, "B")]


def test_a_row_closed_by_its_id_is_not_closed_again_by_key(spark):
    book = spark.createDataFrame([opened("T0001", 1, "A"), opened("T0002", 1, "A")], LEDGER)
    exits = spark.createDataFrame([closing("T0001", 1, "A", "TP"), closing("", 1, "A", "SL")], EXITS)
    assert {r["row_id"]: r["reason"] for r in ledger.close_trades(book, exits).collect()} == {"T0001": "TP", "T0002": "SL"}
    assert ledger.unmatched_exits(book, exits).isEmpty()


def test_repeated_resets_count_once(spark):
    equity = spark.createDataFrame([(D(2024, 1, k), b) for k, b in ((1, 10000.0), (2, 8000.0), (3, 8100.0))], "date date, balance double")
    resets = spark.createDataFrame([(D(2024, 1, 3),)] * 2, "date date")
    assert risk.latched_halt(equity, resets).count() == 3


def test_a_state_that_does_not_fit_is_an_error(spark, tmp_path):
    from tidemark.sources import state

    assert state.read(spark, str(tmp_path / "none")).first()["halted"] is False
    good, other, hole = (str(tmp_path / n) for n in ("good", "other", "hole"))
    stored = spark.sql("select timestamp'2024-01-01' as run_ts, 9000.0D as balance, 10000.0D as peak_balance, true as halted")
    state.append(stored, good)
    assert state.read(spark, good).first()["halted"] is True
    stored.withColumnRenamed("balance", "money").write.parquet(other)
    with pytest.raises(ValueError, match="not an account state"):
        state.read(spark, other)
    stored.withColumn("balance", F.lit(None).cast("double")).write.parquet(hole)
    with pytest.raises(Exception, match="null in the latest account state"):
        state.read(spark, hole).collect()
