import datetime as dt

import pytest
from helpers import walk, bars_frame, numbered
from pyspark.sql import functions as F

from tidemark.operators import series


def test_running_matches_plain_scan_across_years(spark):
    pdf = walk(n=1500)
    df = bars_frame(spark, pdf).withColumn("_year", F.year("date"))
    df = df.withColumn("sparse", F.when(F.dayofmonth("date") == 3, F.col("close")))
    out = series.running(
        df, ["symbol"], ["date"], "_year", n=("count",), s=("sum", "volume"), b=("sum_before", "volume"),
        m=("max", "close"), mb=("max_before", "close"), f=("last", "sparse"),
    ).orderBy("date").toPandas()
    assert list(out["n"]) == list(range(1, 1501))
    assert out["s"].tolist() == pdf["volume"].cumsum().tolist()
    assert out["b"].tolist() == (pdf["volume"].cumsum() - pdf["volume"]).tolist()
    assert out["m"].tolist() == pdf["close"].cummax().tolist()
    assert out["mb"].iloc[1:].tolist() == pdf["close"].cummax().iloc[:-1].tolist()
    expect = pdf["close"].where([d.day == 3 for d in pdf["date"]]).ffill()
    assert out["f"].fillna(-1).tolist() == expect.fillna(-1).tolist()


@pytest.mark.parametrize("parts", [1, 5])
def test_global_running_splits_a_hot_key(spark, parts):
    rows = [(1 if i % 3 else 0, i, float(i % 7)) for i in range(3000)]  # two thirds share one key
    df = spark.createDataFrame(rows, "k int, id int, v double")
    out = series.global_running(df, ["k", "id"], parts, n=("count",), s=("sum", "v")).orderBy("k", "id").toPandas()
    ordered = sorted(rows)
    total, sums = 0.0, []
    for _, _, v in ordered:
        total += v
        sums.append(total)
    assert out["n"].tolist() == list(range(1, 3001))
    assert out["s"].tolist() == sums
    assert out["id"].tolist() == [r[1] for r in ordered]


def test_range_parts_really_split_one_key(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    parts = series.ordered_parts(df, ["k", "id"], 4).groupBy("_part").count().collect()
    assert len(parts) == 4
    assert max(r["count"] for r in parts) < 2000


@pytest.mark.parametrize("rows,back,ahead", [(7, 20, 0), (10, 3, 5), (64, 73, 2), (4096, 73, 5)])
def test_blocks_hold_every_needed_row_once(spark, rows, back, ahead):
    n = 150
    df = numbered(spark, walk(n=n))
    blocks = series.blocks(df, back, ahead, rows).select("rn", "block", "own").collect()
    by_block, home = {}, {}
    for r in blocks:
        by_block.setdefault(r["block"], []).append(r["rn"])
        if r["own"]:
            assert r["rn"] not in home
            home[r["rn"]] = r["block"]
    assert sorted(home) == list(range(1, n + 1))
    for members in by_block.values():
        assert len(members) == len(set(members))
    for rn, block in home.items():
        need = set(range(max(1, rn - back), min(n, rn + ahead) + 1))
        assert need <= set(by_block[block])


def test_ordinals_are_per_symbol(spark):
    import pandas as pd

    pdf = pd.concat([walk("A", 500, 1), walk("B", 80, 2, start=dt.date(2021, 6, 1))])
    out = numbered(spark, pdf).orderBy("symbol", "date").toPandas()
    assert out.groupby("symbol")["rn"].apply(list).tolist() == [list(range(1, 501)), list(range(1, 81))]


def test_equal_order_values_keep_their_totals(spark):
    import datetime as dt

    rows = [("A", dt.date(2023, 12, 31), 1.0)] * 5 + [("A", dt.date(2024, 1, 1), 2.0)] * 3 + [("A", dt.date(2025, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, v double").withColumn("_year", F.year("date"))
    out = series.running(df, ["symbol"], ["date"], "_year", n=("count",), s=("sum", "v")).collect()
    assert sorted(r["n"] for r in out) == list(range(1, 10))
    assert sorted(r["s"] for r in out) == [1.0, 2.0, 3.0, 4.0, 5.0, 7.0, 9.0, 11.0, 12.0]
