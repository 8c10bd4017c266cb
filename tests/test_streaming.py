import datetime as dt

from helpers import bars_frame, numbered, walk
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import exits
from tidemark.session import scratch_path
from tidemark.streaming import bars as SB
from tidemark.streaming import state as SS


def test_late_ticks_are_dropped_and_open_days_held_back(spark):
    landing, out = scratch_path(spark, "ticks"), scratch_path(spark, "bars")
    schema = "event_type string, ts timestamp, event_id bigint, value double, user_id bigint"
    t = lambda day, hour: dt.datetime(2024, 1, day, hour)
    batches = [
        [("A", t(1, 1), 1, 10.0, 1), ("A", t(1, 20), 2, 12.0, 1), ("A", t(2, 3), 3, 11.0, 1)],
        [("A", t(3, 5), 4, 9.0, 1)],
        [("A", t(1, 23), 5, 99.0, 1), ("A", t(4, 5), 6, 9.5, 1)],  # the first tick belongs to an emitted day
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
        SB.drain(SB.daily_bars(SB.ticks(stream)), out, f"{out}-offsets")
    rows = spark.read.parquet(out).orderBy("date").collect()
    assert [(r["date"].day, r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in rows] == [
        (1, 10.0, 12.0, 10.0, 12.0, 2.0), (2, 11.0, 11.0, 11.0, 11.0, 1.0), (3, 9.0, 9.0, 9.0, 9.0, 1.0)]


def test_streamed_exits_equal_the_batch(spark):
    pdf = pd.concat([walk("A", 120, 1, gaps=True), walk("B", 120, 2)])
    bars = numbered(spark, pdf)
    batch = exits.first_exit(exits.at_entry(
        bars.select("symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price")), exits.with_path(bars)))
    want = {(r["symbol"], r["entry_date"]): (r["exit_date"], r["reason"], r["exit_price"], r["hold_days"])
            for r in exits.resolved(batch).collect()}
    landing, out = scratch_path(spark, "bars"), scratch_path(spark, "exits")
    marked = bars_frame(spark, pdf).withColumn("enter", F.lit(True))
    schema = marked.schema
    cuts = sorted(pdf["date"].unique())
    bounds = [cuts[0], cuts[40], cuts[41], cuts[90], cuts[-1] + dt.timedelta(days=1)]
    for a, b in zip(bounds, bounds[1:]):
        marked.filter((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b))).write.mode("append").parquet(landing)
        SB.drain(SS.position_exits(spark.readStream.schema(schema).parquet(landing)), out, f"{out}-offsets")
    got = {(r["symbol"], r["entry_date"]): (r["exit_date"], r["reason"], r["exit_price"], r["hold_days"])
           for r in spark.read.schema(SS.EXIT_OUT).parquet(out).collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][:2] == want[key][:2] and got[key][3] == want[key][3]
        assert abs(got[key][2] - want[key][2]) < 1e-9


def test_streamed_halt_stays_until_reset(spark):
    landing, out = scratch_path(spark, "daily"), scratch_path(spark, "halts")
    schema = "account string, date date, net double, reset boolean"
    day = lambda k: dt.date(2024, 1, k)
    batches = [[("a", day(1), 0.0, False), ("a", day(2), -1600.0, False)], [("a", day(3), 1500.0, False)],
               [("a", day(4), 0.0, True), ("a", day(5), -1500.0, False), ("a", day(6), 0.0, True)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        SB.drain(SS.latched_halt(spark.readStream.schema(schema).parquet(landing)), out, f"{out}-offsets")
    rows = spark.read.schema(SS.HALT_OUT).parquet(out).orderBy("date").collect()
    # recovery does not clear it, a reset does, and it trips again at once while the drawdown lasts
    assert [r["halted"] for r in rows] == [False, True, True, False, True, True]


def test_bars_that_come_late_settle_nothing_and_are_reported(spark):
    landing, out = scratch_path(spark, "late-bars"), scratch_path(spark, "late-exits")
    schema = "symbol string, date date, open double, high double, low double, close double, enter boolean"
    bar = lambda day, high, enter=False: ("A", dt.date(2024, 1, day), 10.0, high, 10.0, 10.0, enter)
    for rows in ([bar(10, 10.0, True)], [bar(5, 99.0)], [bar(11, 10.0)], [bar(11, 99.0), bar(12, 99.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        SB.drain(SS.position_exits(spark.readStream.schema(schema).parquet(landing)), out, f"{out}-offsets")
    rows = spark.read.schema(SS.EXIT_OUT).parquet(out).collect()
    done = [r for r in rows if r["reason"] != SS.LATE]
    assert [(r["entry_date"].day, r["exit_date"].day, r["reason"], r["hold_days"]) for r in done] == [(10, 12, "TP", 2)]
    assert sorted(r["exit_date"].day for r in rows if r["reason"] == SS.LATE) == [5, 11]
    assert all(r["exit_price"] is None and r["hold_days"] is None for r in rows if r["reason"] == SS.LATE)


def test_a_reset_may_set_a_new_peak(spark):
    landing, out = scratch_path(spark, "daily-peak"), scratch_path(spark, "halts-peak")
    schema = "account string, date date, net double, reset boolean, new_peak double"
    rows = [("a", dt.date(2024, 1, k), net, reset, peak) for k, net, reset, peak in
            ((1, 0.0, False, None), (2, -1600.0, False, None), (3, 0.0, True, 8400.0), (4, 0.0, False, None))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(landing)
    SB.drain(SS.latched_halt(spark.readStream.schema(schema).parquet(landing)), out, f"{out}-offsets")
    got = spark.read.schema(SS.HALT_OUT).parquet(out).orderBy("date").collect()
    assert [(r["halted"], r["peak"]) for r in got] == [(False, 10000.0), (True, 10000.0), (False, 8400.0), (False, 8400.0)]


def test_positions_without_bars_go_stale(spark):
    """A symbol falls silent while another goes on: its position leaves by a timer, once, and its state with it."""
    landing, out = scratch_path(spark, "stale-bars"), scratch_path(spark, "stale-exits")
    schema = "symbol string, date date, open double, high double, low double, close double, enter boolean"
    start = dt.date(2024, 1, 1)
    bar = lambda s, day, high=10.0, enter=False: (s, start + dt.timedelta(days=day), 10.0, high, 10.0, 10.0, enter)
    batches = [[bar("A", 0, enter=True), bar("B", 0)], [bar("A", 1), bar("B", 100)], [bar("B", 179)], [bar("B", 190)], [bar("B", 200, enter=True)],
               [bar("A", 201, 99.0)], [bar("B", 201, 99.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        SB.drain(SS.position_exits(spark.readStream.schema(schema).parquet(landing)), out, f"{out}-offsets")
    rows = sorted((r["symbol"], r["reason"], (r["entry_date"] - start).days, r["exit_price"]) for r in spark.read.schema(SS.EXIT_OUT).parquet(out).collect())
    # A's bar of day 201 finds no position to settle
    assert rows == [("A", SS.STALE, 0, None), ("B", "TP", 200, 10.3)]
