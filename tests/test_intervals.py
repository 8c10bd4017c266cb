"""Highest bars between two days against a loop over the bars."""

import datetime as dt
import random

import pytest
from helpers import START, numbered, walk
from pyspark.sql import functions as F

from tidemark.operators import intervals, research
from tidemark.session import materialize


@pytest.mark.parametrize("rows", [16, 3072])
def test_stretches_of_up_to_a_thousand_bars(spark, rows):
    pdf = walk("X", n=1300, seed=3, gaps=True)
    other = walk("Y", n=40, seed=4)
    assert len(pdf) > 1000
    import pandas as pd
    bars = materialize(numbered(spark, pd.concat([pdf, other])))
    rnd = random.Random(5)
    spans = []
    for k in range(400):
        symbol = "Y" if k % 8 == 0 else "X"
        a = START + dt.timedelta(days=rnd.randint(-30, 1310))
        length = rnd.choice((0, 1, 2, 3, 4, 7, 8, 100, 1024, 1400, -3))
        spans.append((k, symbol, a, a + dt.timedelta(days=length)))
    spans += [(900, "X", None, START), (901, "X", START, None), (902, "Z", START, START), (903, "X", *spans[1][2:]), (904, "X", *spans[1][2:])]
    frame = spark.createDataFrame(spans, "id int, symbol string, a date, b date").repartition(3)
    got = {r["id"]: r["highest"] for r in intervals.highest(bars, frame, F.col("a"), F.col("b")).collect()}
    table = {"X": pdf, "Y": other}
    assert len(got) == len(spans)
    for k, symbol, a, b in spans:
        mine = table.get(symbol)
        highs = [] if mine is None or a is None or b is None else mine[(mine["date"] >= a) & (mine["date"] <= b)]["high"].tolist()
        assert got[k] == (max(highs) if highs else None)
    longest = intervals.doubled(bars, "high", 1000, rows)
    first = longest.filter("symbol = 'X' and rn = 500").first()["up"]
    high = pdf["high"].tolist()
    assert first == [max(high[499:499 + 2 ** j]) for j in range(10)]


def test_long_excursions_agree_with_paths(spark):
    from tidemark.operators import exits

    bars = materialize(numbered(spark, walk(n=300, seed=6)))
    positions = bars.select("symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    paths = research.excursion(exits.at_entry(positions, exits.with_path(bars)))
    want = {r["entry_date"]: r["mfe"] for r in paths.collect()}
    got = {r["entry_date"]: r["mfe"] for r in research.excursion_over(positions, bars, 5).collect()}
    assert got == want and sum(v is None for v in got.values()) == 1


def test_no_spans(spark):
    bars = materialize(numbered(spark, walk(n=30)))
    none = spark.createDataFrame([], "symbol string, a date, b date")
    assert intervals.highest(bars, none, F.col("a"), F.col("b")).collect() == []
