import datetime as dt

import pandas as pd
import pytest
from helpers import numbered, plain_exit, walk
from pyspark.sql import functions as F

from tidemark.operators import compare


@pytest.fixture(scope="module")
def bars(spark):
    return numbered(spark, walk(n=120, seed=21))


def rows_of(pdf):
    return list(pdf[["date", "open", "high", "low", "close"]].itertuples(index=False, name=None))


def outcome(pdf, i):
    table = rows_of(pdf)
    return plain_exit(table[i][0], table[i][4], table[i + 1:], table[i][2] >= table[i][4] * 1.015)


def test_gate_rows_use_the_ledger_for_entries_and_bars_for_blocks(spark, bars):
    pdf = walk(n=120, seed=21)
    dates = pdf["date"].tolist()
    signals = spark.createDataFrame(
        [(dates[10], "X", float(pdf["close"][10]), "NONE"), (dates[20], "X", float(pdf["close"][20]), "OFI_NEGATIVE_-0.1000"),
         (dates[30], "X", float(pdf["close"][30]), "PROB_TOO_LOW_0.5000"), (dates[40], "X", float(pdf["close"][40]), "NONE"),
         (dates[50], "X", float(pdf["close"][50]), "NONE"), (dt.date(2019, 1, 1), "X", 100.0, "OFI_NEGATIVE_-0.2000")],
        "date date, symbol string, close double, reject_reason string")
    trades = spark.createDataFrame(
        [("T0002", dates[10], "X", "CLOSED", 100.0, 99.0, "SL"), ("T0001", dates[10], "X", "CLOSED", 100.0, 103.0, "TP"),
         ("T0003", dates[50], "X", "OPEN", 100.0, None, None)],
        "row_id string, date date, symbol string, action string, entry_price double, exit_price double, reason string")
    got = {(r["date"], r["group"]): r for r in compare.gate_rows(signals, trades, bars).collect()}
    want = outcome(pdf, 20)
    assert set(got) == {(dates[10], "OFI_PASS"), (dates[20], "OFI_BLOCKED")}
    assert got[(dates[10], "OFI_PASS")]["reason"] == "TP" and got[(dates[10], "OFI_PASS")]["win"]  # the first trade counts
    assert got[(dates[20], "OFI_BLOCKED")]["reason"] == want[1]
    kept = compare.gate_rows(signals, trades, bars, include_open=True).filter(F.col("date") == F.lit(dates[50])).first()
    assert kept["pnl_pct"] is None
    assert [r["date"] for r in compare.without_trade(compare.wanted_signals(signals).filter("group = 'OFI_PASS'"), trades).collect()] == [dates[40]]


def test_fidelity_compares_codes_unless_strict(spark, bars):
    pdf = walk(n=120, seed=21)
    held = [i for i in range(110) if (outcome(pdf, i) or (0, ""))[1] == "MAX_HOLD"][:1]
    other = [i for i in range(110) if (outcome(pdf, i) or (0, ""))[1] == "SL"][:1]
    rows = [("X", pdf["date"][i], float(pdf["close"][i]), why) for i, why in [(held[0], f"MAX_HOLD_{outcome(pdf, held[0])[3]}d"), (other[0], "TP")]]
    rows.append(("X", dt.date(2018, 1, 1), 100.0, "TP"))
    recorded = spark.createDataFrame(rows, "symbol string, entry_date date, entry_price double, reason string")
    summary = compare.fidelity_summary(compare.fidelity(recorded, bars)).first()
    assert (summary["n"], summary["n_match"]) == (3, 1)
    strict = compare.fidelity_summary(compare.fidelity(recorded, bars, strict=True)).first()
    assert strict["n_match"] == 0
    missing = compare.fidelity(recorded, bars).filter("entry_date < date '2019-01-01'").first()
    assert missing["reconstructed"] == "NO_DATA"


def test_many_trades_on_one_key_join_once(spark, bars):
    date = walk(n=120, seed=21)["date"][5]
    signals = spark.createDataFrame([(date, "X", 100.0)], "date date, symbol string, close double")
    trades = spark.range(3000).select(
        F.format_string("T%06d", 3000 - F.col("id")).alias("row_id"), F.lit(date).alias("date"), F.lit("X").alias("symbol"),
        F.lit(100.0).alias("entry_price"), (100.0 + F.col("id")).alias("exit_price"), F.lit("TP").alias("reason"))
    rows = compare.first_trade(signals, trades).collect()
    assert len(rows) == 1 and rows[0]["row_id"] == "T000001"


def test_buy_and_hold_needs_two_bars(spark):
    from helpers import bars_frame
    from tidemark.operators import metrics

    pdf = pd.concat([walk("A", 30, 1), walk("B", 1, 2)])
    row = metrics.buy_and_hold(bars_frame(spark, pdf)).first()
    a = pdf[pdf["symbol"] == "A"]["close"]
    assert row["n_symbols"] == 1 and row["buy_hold"] == pytest.approx(a.iloc[-1] / a.iloc[0] - 1)
