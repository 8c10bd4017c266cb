import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import compare, exits
from tidemark.sources import bucketed


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def place(tmp_path):
    def new(name):
        return f"{name}_{uuid.uuid4().hex}", str(tmp_path / name)

    return new


def keep(df, place, name, keys, buckets=3):
    table, path = place(name)
    return bucketed.save(df, table, keys, buckets, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def trades(spark):
    data = [("A" if i % 3 else "B", day(i // 2), day(i // 2 + 1), "TP" if i % 4 else "SL", 100.0, 103.0) for i in range(60)]
    return spark.createDataFrame(data, "symbol string, date date, exit_date date, reason string, entry_price double, exit_price double")


def signals(spark):
    return spark.createDataFrame([(s, day(i)) for s in "ABC" for i in range(20)], "symbol string, date date")


def test_first_trade_without_an_exchange(spark, place):
    keys = ["symbol", "date"]
    got = compare.first_trade(keep(signals(spark), place, "signals", keys), keep(trades(spark), place, "trades", keys))
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
    assert rows(got) == rows(compare.first_trade(signals(spark), trades(spark))) and got.count() > 0


def test_unmatched_signals_without_an_exchange(spark, place):
    keys = ["symbol", "date"]
    got = compare.without_trade(keep(signals(spark), place, "signals", keys), keep(trades(spark), place, "trades", keys))
    assert "Exchange" not in plan(got)
    assert rows(got) == rows(compare.without_trade(signals(spark), trades(spark)))


def test_live_keys_without_an_exchange(spark, place):
    keys = ["symbol", "entry_date"]
    every = trades(spark).withColumnRenamed("date", "entry_date")
    live = every.filter("reason = 'SL'")
    got = compare.on_keys(keep(every, place, "every", keys), keep(live, place, "live", keys))
    assert "Exchange" not in plan(got)
    assert rows(got) == rows(compare.on_keys(every, live))


def test_reconstruction_from_kept_paths_without_an_exchange(spark, place):
    bars = spark.createDataFrame(
        [(s, day(i), i + 1, 100.0 + i, 104.0 + i, 97.0 + i, 101.0 + i) for s in "AB" for i in range(40)],
        "symbol string, date date, rn int, open double, high double, low double, close double")
    recorded = trades(spark).withColumnRenamed("date", "entry_date")
    paths = keep(exits.with_path(bars), place, "paths", ["symbol", "date"])
    got = compare.fidelity(keep(recorded, place, "recorded", ["symbol", "entry_date"]), paths)
    assert "Exchange" not in plan(got)
    cols = ["symbol", "entry_date", "recorded", "reconstructed", "matches"]
    assert rows(got.select(*cols)) == rows(compare.fidelity(recorded, bars).select(*cols))


def test_other_numbers_of_buckets_still_join_right(spark, place):
    keys = ["symbol", "date"]
    got = compare.first_trade(keep(signals(spark), place, "s", keys, 4), keep(trades(spark), place, "t", keys, 3))
    assert rows(got) == rows(compare.first_trade(signals(spark), trades(spark)))


def test_a_bucket_is_one_file(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    bucketed.save(trades(spark).repartition(7), name, ["symbol", "date"], 3, str(tmp_path / name))
    assert len(list((tmp_path / name).glob("*.parquet"))) <= 3


def test_saving_again_replaces_the_table(spark, place):
    name, path = place("again")
    bucketed.save(trades(spark), name, ["symbol", "date"], 3, path)
    assert bucketed.save(trades(spark).limit(5), name, ["symbol", "date"], 3, path).count() == 5


def test_attached_tables_keep_their_buckets(spark, place):
    keys = ["symbol", "date"]
    name, path = place("kept")
    bucketed.save(trades(spark), name, keys, 3, path)
    spark.sql(f"drop table `{name}`")
    again = bucketed.attach(spark, name, path, keys, 3)
    got = compare.first_trade(keep(signals(spark), place, "signals", keys), again)
    assert "Exchange" not in plan(got)
    assert rows(got) == rows(compare.first_trade(signals(spark), trades(spark)))


def test_null_keys_and_empty_tables(spark, place):
    keys = ["symbol", "date"]
    odd = trades(spark).withColumn("symbol", F.when(F.col("symbol") == "A", F.col("symbol")))
    left, right = keep(signals(spark), place, "signals", keys), keep(odd, place, "odd", keys)
    assert rows(compare.without_trade(left, right)) == rows(compare.without_trade(signals(spark), odd))
    none = keep(trades(spark).limit(0), place, "none", keys)
    assert compare.first_trade(left, none).count() == 0 and compare.without_trade(left, none).count() == 60


def results(spark):
    return trades(spark).withColumnRenamed("date", "entry_date").dropDuplicates(["symbol", "entry_date"])


def test_results_replace_their_own_configuration_only(spark, place):
    keys = ["symbol", "entry_date"]
    name, path = place("results")
    every = results(spark)
    bucketed.replace_results(every, name, "venue", False, keys, 3, path)
    bucketed.replace_results(every.filter("reason = 'TP'"), name, "venue", True, keys, 3, path)
    bucketed.replace_results(every.filter("reason = 'SL'"), name, "venue", False, keys, 3, path)
    counts = {r["run_config"]: r["count"] for r in spark.table(name).groupBy("run_config").count().collect()}
    assert counts == {"venue": every.filter("reason = 'SL'").count(), "venue_ofi": every.filter("reason = 'TP'").count()}


def test_configurations_meet_without_an_exchange(spark, place):
    keys = ["symbol", "entry_date"]
    name, path = place("results")
    every = results(spark)
    bucketed.replace_results(every, name, "venue", False, keys, 3, path)
    bucketed.replace_results(every.filter("reason = 'TP'"), name, "venue", True, keys, 3, path)
    got = bucketed.side_by_side(name, spark, "venue", "venue_ofi", keys, "reason")
    assert "Exchange" not in plan(got)
    want = every.select(*keys, "reason", F.when(F.col("reason") == "TP", "TP"))
    assert sorted(map(str, rows(got))) == sorted(map(str, (tuple(r) for r in want.collect())))


def test_attached_results_keep_their_folders(spark, place):
    keys = ["symbol", "entry_date"]
    name, path = place("results")
    bucketed.replace_results(results(spark), name, "venue", False, keys, 3, path)
    n = spark.table(name).count()
    spark.sql(f"drop table `{name}`")
    assert bucketed.attach(spark, name, path, keys, 3, ["run_config"]).filter("run_config = 'venue'").count() == n > 0
