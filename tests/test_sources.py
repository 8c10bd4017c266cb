import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalars as S
from tidemark.operators import flow
from tidemark.sources import logs, market, sinks, state

MS = 1704067200000  # 2024-01-01


def test_klines(spark):
    raw = spark.createDataFrame(
        [("A", 2, [str(MS), "1", "2", "0.5", "9", "7", "", "", "", "3", "", ""]), ("A", 1, [str(MS), "1", "2", "0.5", "1.5", "10", "", "", "", "4", "", ""]),
         ("A", 3, [str(MS + 86400000), "1", "2", "0.5", "0", "10"]), ("A", 4, [str(MS + 2 * 86400000), "1", "x", "0.5", "1", "10"])], schemas.KLINES)
    rows = market.bars_from_klines(raw).collect()
    assert [(r["date"], r["close"], r["volume"]) for r in rows] == [(dt.date(2024, 1, 1), 1.5, 10.0)]
    assert market.bars_from_klines(raw, dedup=False).count() == 2
    assert market.flow_from_klines(raw.filter("ingest_seq = 1")).first()["ofi"] == pytest.approx(-0.2)


def test_many_copies_of_one_bar_keep_the_first(spark):
    raw = spark.range(5000).select(
        F.lit("A").alias("symbol"), "id", F.array(F.lit(str(MS)), F.lit("1"), F.lit("2"), F.lit("0.5"), (F.col("id") + 1).cast("string"), F.lit("5")).alias("k"))
    rows = market.bars_from_klines(raw.withColumnRenamed("id", "ingest_seq")).collect()
    assert len(rows) == 1 and rows[0]["close"] == 1.0


def test_sentiment_json(spark):
    docs = [(1, '{"data":[{"timestamp":"1704067200","value":"40"},{"timestamp":"1704153600","value":"41"}]}'),
            (2, '{"data":[{"timestamp":"1704067200","value":"55"},{"timestamp":"1704067200","value":"56"},{"timestamp":"x","value":"1"}]}'), (3, '{"dat')]
    rows = market.parse_sentiment(spark.createDataFrame(docs, "payload_seq int, payload string")).orderBy("date").collect()
    assert [(r["date"], r["value"]) for r in rows] == [(dt.date(2024, 1, 1), 56), (dt.date(2024, 1, 2), 41)]


def test_book(spark):
    raw = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1), [[100.0 - i, 1.0, 3.0] for i in range(30)], [[101.0 + i, 0.5] for i in range(10)]), ("B", dt.datetime(2024, 1, 1), [], [])],
        schemas.BOOK)
    got = {r["symbol"]: r["ofi"] for r in flow.book_imbalance(market.parse_book(raw)).collect()}
    assert got == {"A": pytest.approx((20 - 5) / 25), "B": 0.0}


def test_top_levels_cut_before_collecting(spark):
    rows = [("A", dt.date(2024, 1, 1), "O", float(p), 1.0) for p in range(1, 2000)]
    df = spark.createDataFrame(rows, "symbol string, date date, side string, price double, size double")
    snap = market.top_levels(df)
    assert "WindowGroupLimit" in snap._jdf.queryExecution().executedPlan().toString()
    row = snap.first()
    assert [lv[0] for lv in row["bids"]] == [float(p) for p in range(1999, 1979, -1)] and row["asks"] == []


def test_signal_log_reader_splits_legacy_rows(spark, tmp_path):
    header = ",".join(schemas.columns(schemas.SIGNALS))
    (tmp_path / "s.csv").write_text("\n".join([
        header,
        "2024-01-01,A,12.5,0.25,0.5,0.125,False,PROB_TOO_LOW_0.2500,0.75,YES,41.5,2.25,False",
        "2024-01-02,A,13.5,0.25,0.5,0.125,True,0.75,YES,42.5,2.5",
        "2024-01-03,A,14.5,0.75,0.875,0.625,True,NONE,0.5,YES,,2.75,False",
        "2024-01-04,A,15.5,0.75,0.875,0.625,True,NONE,0.5,YES,44.5,3.25,False",
        "2024-01-05,A,16.5,0.75,0.875,0.625,True,NONE,0.5,YES,45.5,3.5,False,one more"]) + "\n")
    good, legacy = logs.read_signals(spark, str(tmp_path / "s.csv"))
    rows = good.orderBy("date").collect()
    assert [r["date"].day for r in rows] == [1, 4] and good.columns == schemas.columns(schemas.SIGNALS)
    assert rows[0]["signal_fired"] is False and rows[1]["signal_fired"] is True and rows[1]["rsi"] == 44.5
    rejected = {r["date"]: r for r in legacy.collect()}
    assert sorted(rejected) == ["2024-01-02", "2024-01-03", "2024-01-05"]
    assert rejected["2024-01-05"]["raw"].endswith("False,one more")


def test_signal_meets_its_trade(spark, tmp_path):
    # one signal with its closed trade, one blocked by a held position, and the state after
    signals = tmp_path / "s.csv"
    signals.write_text("\n".join([
        ",".join(schemas.columns(schemas.SIGNALS)),
        "2024-05-06,Q,200.0,0.7,0.75,0.65,True,NONE,0.4,YES,55.0,2.0,False",
        "2024-05-07,Q,198.0,0.7,0.75,0.65,False,ALREADY_IN_POS,0.4,YES,56.0,2.0,True"]) + "\n")
    trades = tmp_path / "t.csv"
    trades.write_text(",".join(schemas.columns(schemas.TRADES)) + "\n"
                      "T0001,2024-05-06,Q,CLOSED,200.0,190.0,-2.0,-2.25,0.25,TRAIL_BE,1,False,9997.75,0.7,0.75,0.65,40.0,,\n")
    good, _ = logs.read_signals(spark, str(signals))
    closed, still = logs.closed_and_open(logs.read_trades(spark, str(trades)))
    from tidemark.operators import compare

    wanted = compare.wanted_signals(good)
    assert [r["group"] for r in wanted.collect()] == ["OFI_PASS"]
    match = compare.first_trade(wanted, closed).collect()
    assert len(match) == 1 and still.count() == 0
    assert match[0]["pnl_pct"] == pytest.approx(-0.05) and match[0]["win"] is False
    payload = spark.createDataFrame([('{"balance": 9997.75, "halted": "False", "peak_balance": 10000.0}',)], "payload string")
    row = state.from_json(payload).first()
    assert (row["balance"], row["peak_balance"], row["halted"]) == (9997.75, 10000.0, False)


def test_trade_log_reader(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("date,symbol,action,entry_price,exit_price,pnl_net,reason,balance_after\n"
                    "2024-01-01,A,closed,1,x,0.5,TP,\nbad,A,CLOSED,1,2,3,SL,1\n2024-01-03,B,OPEN,1,,,,\n")
    trades = logs.read_trades(spark, str(path))
    closed, still = logs.closed_and_open(trades)
    assert [(r["symbol"], r["exit_price"]) for r in closed.collect()] == [("A", None)]
    assert [r["symbol"] for r in still.collect()] == ["B"]
    path.write_text("date,symbol\n2024-01-01,A\n")
    with pytest.raises(ValueError, match="missing columns"):
        logs.read_trades(spark, str(path))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        logs.typed_trades(spark.createDataFrame([("bad", *["1"] * 7)], ", ".join(f"{c} string" for c in logs.TRADE_COLUMNS)), lenient=False).collect()


def test_state_round_trip_and_defaults(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.read(spark, path).first()["balance"] == 10000.0
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), 9000.12345, 10000.0, False), (dt.datetime(2024, 1, 2), 8400.0, 10000.0, True)], schemas.ACCOUNT_STATE)
    for row in rows.collect():
        state.append(state.from_json(state.to_json(spark.createDataFrame([row], schemas.ACCOUNT_STATE))), path)
    last = state.read(spark, path).first()
    assert (last["balance"], last["halted"], last["run_ts"]) == (8400.0, True, dt.datetime(2024, 1, 2))
    broken = spark.createDataFrame([("{oops",), ("{}",)], "payload string")
    assert {(r["balance"], r["halted"]) for r in state.from_json(broken).collect()} == {(10000.0, False)}


def test_result_sink_replaces_only_its_own_run(spark, tmp_path):
    path = str(tmp_path / "r")
    a = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "symbol string, entry_date date")
    sinks.write_results(a, path, "x", False)
    sinks.write_results(a.union(a), path, "x", True)
    sinks.write_results(a, path, "x", True)
    read = lambda config: logs.read_results(spark, path, config, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).count()
    assert (read("x"), read("x_ofi"), read("none")) == (1, 1, 0)
    assert logs.read_results(spark, str(tmp_path / "absent"), "x", dt.date(2024, 1, 1), dt.date(2024, 1, 1)) is None


def test_stored_results_prune_and_push_down(spark, tmp_path):
    path = str(tmp_path / "r")
    sinks.write_results(spark.createDataFrame([("A", dt.date(2024, 1, 1))], "symbol string, entry_date date"), path, "x", False)
    plan = logs.read_results(spark, path, "x", dt.date(2024, 1, 1), dt.date(2024, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_config" in plan and "GreaterThanOrEqual(entry_date" in plan


def test_create_missing_is_idempotent(spark, tmp_path):
    assert sorted(sinks.create_missing(spark, str(tmp_path))) == ["account_state", "signals", "trades"]
    assert sinks.create_missing(spark, str(tmp_path)) == []
    assert spark.read.parquet(str(tmp_path / "trades")).columns == schemas.columns(schemas.TRADES)


def test_scalar_edges(spark):
    row = spark.range(1).select(
        S.guarded_ratio(F.lit(1.0), F.lit(0.0)).alias("zero"), S.flag(F.lit(None).cast("double") > 1).alias("unknown"),
        S.gain(F.lit(None).cast("double")).alias("gain"), S.parse_number(F.lit("")).alias("blank"), S.parse_date(F.lit("soon")).alias("soon"),
        S.parse_flag(F.lit(" TRUE ")).alias("true"), S.day_of_week(F.lit("2024-01-01").cast("date")).alias("monday"),
        S.reason_code(F.lit("OFI_NEGATIVE_-0.2500")).alias("code"), S.reason_value(F.lit("OFI_NEGATIVE_-0.2500")).alias("value"),
        S.reason_code(F.lit("MAX_HOLD_6d")).alias("hold"), S.reason_code(F.lit("MAX_POSITIONS")).alias("plain"),
        S.true_range(F.lit(3.0), F.lit(1.0), F.lit(None).cast("double")).alias("tr"), S.row_id(F.lit(12345)).alias("wide"),
        S.prob_too_low(F.lit(0.0)).alias("none"), S.presented(F.lit(-0.0000001), 6).cast("string").alias("no_minus_zero")).first()
    assert row.asDict() == {
        "zero": None, "unknown": 0, "gain": None, "blank": None, "soon": None, "true": True, "monday": 0, "code": "OFI_NEGATIVE",
        "value": -0.25, "hold": "MAX_HOLD", "plain": "MAX_POSITIONS", "tr": 2.0, "wide": "T12345", "none": "PROB_TOO_LOW_0.0000", "no_minus_zero": "0.0"}


def test_rounding_follows_the_binary_value(spark):
    values = [83.09955, 0.00625, -0.53125, 0.53125, 2.675, 0.125, 1e-9, -1e-9, 0.0, 1879.48, 2.5, -2.5, 3.5, 0.99995, 123456.785]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[S.half_even("v", k).alias(f"d{k}") for k in (0, 2, 4)])
    for r in df.collect():
        assert [r["d0"], r["d2"], r["d4"]] == [round(r["v"], 0) + 0.0, round(r["v"], 2) + 0.0, round(r["v"], 4) + 0.0]
    text = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.flow_negative(F.col("v")).alias("t"))
    assert all(r["t"] == f"OFI_NEGATIVE_{r['v']:+.4f}" for r in text.collect())


def test_rounding_of_odd_numbers(spark):
    from tidemark.functions import scalars

    values = [(float("nan"),), (None,), (1e13,), (-123456789012345.678,), (2.5e300,), (0.125,), (-0.5,)]
    rows = spark.createDataFrame(values, "x double").select(scalars.half_even("x", 6).alias("y"), scalars.half_even("x", 2).alias("z")).collect()
    assert [r["y"] for r in rows] == [None, None, 1e13, -123456789012345.678, 2.5e300, 0.125, -0.5]
    assert [r["z"] for r in rows][4:] == [2.5e300, 0.12, -0.5]


def test_two_sentiment_values_for_a_day(spark):
    from tidemark.operators import sentiment

    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "symbol string, date date")
    days = lambda *v: spark.createDataFrame([(dt.date(2024, 1, 1), x) for x in v], "date date, value int")
    assert sentiment.align(bars, days(20, 20)).first()["fg"] == 20.0
    with pytest.raises(Exception, match="two sentiment values"):
        sentiment.align(bars, days(80, 20)).collect()
