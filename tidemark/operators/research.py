"""Studies over finished trades: quartiles, sweeps, excursions, audits, intervals, sizing, concurrency."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import RULES, Rules
from . import exits, intervals, metrics, series

TRADE_ORDER = ["exit_date", "symbol", "entry_date"]


def tiles(df: DataFrame, order: list[str], n: int = 4, parts: int | None = None) -> DataFrame:
    """``tile`` 1..n of equal size over a global order (the first ones larger by one), as SQL's ntile, but
    ranked over range partitions instead of in one task."""
    ranked = series.global_running(df, order, parts, _rank=("count",))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    at, base, extra = F.col("_rank") - 1, F.floor(F.col("_total") / n), F.col("_total") % n
    wide = extra * (base + 1)
    tile = F.when(at < wide, F.floor(at / (base + 1))).otherwise(extra + F.floor((at - wide) / F.greatest(base, F.lit(1)))) + 1
    # one row: the broadcast is bounded
    return ranked.crossJoin(F.broadcast(total)).withColumn("tile", tile.cast("int")).drop("_rank", "_total")


def by_score_quartile(trades: DataFrame) -> DataFrame:
    ranked = tiles(trades, ["signal_prob", "symbol", "entry_date"])
    return ranked.groupBy("tile").agg(
        F.count(F.lit(1)).alias("n"), F.min("signal_prob").alias("prob_min"), F.max("signal_prob").alias("prob_max"),
        (F.avg(F.col("win").cast("double")) * 100).alias("win_pct"), metrics.profit_factor().alias("profit_factor"),
    )


def score_correlation(trades: DataFrame) -> DataFrame:
    return trades.agg(F.corr("signal_prob", "pnl_net").alias("correlation"), F.count(F.lit(1)).alias("n"))


def sweep(placed: DataFrame, settings: DataFrame, rules: Rules = RULES) -> DataFrame:
    """First exits of every position under every setting (setting, take_profit, stop_loss, trigger,
    threshold). The settings are a handful of literal rows, so the cross join is a broadcast of those
    rows; no shuffle is added."""
    crossed = placed.crossJoin(F.broadcast(settings)).filter(F.col("signal_prob") >= F.col("threshold"))
    rates = {name: F.col(name) for name in ("take_profit", "stop_loss", "trigger")}
    return exits.resolved(exits.first_exit(crossed, rules, **rates))


def excursion(placed: DataFrame, days: int = 5) -> DataFrame:
    """Best later price within ``days`` calendar days of the entry, relative to the entry price."""
    within = F.filter("path", lambda b: F.datediff(b["date"], F.col("entry_date")) <= days)
    best = F.array_max(F.transform(within, lambda b: b["high"]))
    return placed.withColumn("mfe", best / F.col("entry_price") - 1)


def excursion_over(positions: DataFrame, bars: DataFrame, days: int) -> DataFrame:
    """``excursion`` over any number of days, by ordinals instead of paths. ``bars`` needs ``rn``."""
    first, last = F.date_add("entry_date", 1), F.date_add("entry_date", days)
    best = intervals.highest(bars, positions, first, last, name="_best")
    return best.withColumn("mfe", F.col("_best") / F.col("entry_price") - 1).drop("_best")


def excursion_summary(with_mfe: DataFrame) -> DataFrame:
    mfe = F.col("mfe")
    return with_mfe.agg(
        F.count("mfe").alias("n"), F.avg("mfe").alias("mean_mfe"),
        F.avg((mfe >= 0.05).cast("double")).alias("share_5pct"), F.avg((mfe >= 0.08).cast("double")).alias("share_8pct"),
        F.avg((mfe >= 0.02).cast("double")).alias("share_2pct"),
    )


def fill_audit(closed: DataFrame, rules: Rules = RULES) -> DataFrame:
    """How many armed-stop exits opened below the trigger price, and what the open cost them."""
    trigger = exits.levels(F.col("entry_price"), rules)["trigger"]
    below = F.col("exit_open") < trigger
    return closed.filter(F.col("reason") == "TRAIL_BE").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(below).alias("n_below"),
        F.avg(below.cast("double")).alias("share_below"),
        F.avg((trigger - F.col("exit_price")) / F.col("entry_price")).alias("mean_gap_pct"),
    )


def _added(sums: np.ndarray, weights: np.ndarray) -> pa.Table:
    return pa.table([pa.array([sums], pa.list_(pa.float64())), pa.array([weights], pa.list_(pa.int64()))], names=["sums", "weights"])


def bootstrap_mean(values: DataFrame, value: str, key: list[str], replicates: int = 200, seed: int = 42) -> DataFrame:
    """95 % interval of a mean. Every row gets a Poisson(1) weight per replicate, from the MD5 of its key, so nothing is sampled on
    the driver and the result does not depend on the partitions.

    A task keeps one vector of replicate sums and one of weights and adds its rows to them; the shuffle moves one row per task,
    added up in 64 groups before the last one. A null value adds nothing to a sum but counts in the weight; an empty table has null bounds.

    Weights follow a 52-bit number; weights of 18 and more have less than one part in 2^52 and so no number that would give them.
    """
    steps = np.array(list(itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(18))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = [hashlib.md5(f"{seed}|{replicate}".encode()) for replicate in range(1, replicates + 1)]
        sums, weights, rows = np.zeros(replicates), np.zeros(replicates, dtype=np.int64), 0

        def drawn(tail: bytes) -> bytes:
            out = []
            for head in heads:
                mixed = head.copy()
                mixed.update(tail)
                out.append(mixed.digest()[:8])
            return b"".join(out)

        for batch in batches:
            rows += batch.num_rows
            numbers = batch["value"].to_numpy(zero_copy_only=False).astype(float)
            numbers = np.where(batch["value"].is_null().to_numpy(zero_copy_only=False), 0.0, numbers)
            for at in range(0, batch.num_rows, 512):
                tails = batch["tail"].slice(at, 512).to_pylist()
                bits = np.frombuffer(b"".join(drawn(t.encode()) for t in tails), dtype=">u8").reshape(len(tails), replicates)
                w = np.searchsorted(steps, ((bits >> np.uint64(12)).astype(float) + 0.5) / 2.0**52)
                sums += numbers[at:at + 512] @ w
                weights += w.sum(axis=0)
        if rows:
            yield from _added(sums, weights).to_batches()

    def add(table: pa.Table) -> pa.Table:
        both = [np.array(table[c].combine_chunks().flatten()).reshape(-1, replicates).sum(axis=0) for c in ("sums", "weights")]
        return _added(*both)

    vector = "sums array<double>, weights array<bigint>"
    # the empty string in front gives every tail its separator, as many keys as are not null
    tail = F.concat_ws("|", F.lit(""), *[F.col(c).cast("string") for c in key])
    per_task = values.select(F.col(value).cast("double").alias("value"), tail.alias("tail")).mapInArrow(run, vector)
    groups = per_task.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("_g").applyInArrow(add, vector)
    drawn = groups.select(F.posexplode(F.arrays_zip("sums", "weights")).alias("replicate", "v"))
    means = drawn.groupBy("replicate").agg((F.sum("v.sums") / F.nullif(F.sum("v.weights"), F.lit(0))).alias("m"))
    points = means.agg(F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))).alias("q"), F.avg("m").alias("boot_mean"))
    return points.select(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"), "boot_mean")


def wilson(wins: Column, n: Column, z: float = 1.959963984540054) -> list[Column]:
    """Score interval of a share."""
    p = wins / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return [(centre - half).alias("low"), (centre + half).alias("high")]


def recompounded(trades: DataFrame, risks: list[float], rules: Rules = RULES) -> DataFrame:
    """Balance path if the risk budget were ``risk``: each day multiplies the balance by one plus the sum of
    its trades' results at ``risk / max_positions`` of the balance each. Days first (combined on the map
    side), then the product as a running sum of logs in yearly buckets."""
    spark = trades.sparkSession
    grid = spark.createDataFrame([(float(x),) for x in risks], "risk double")
    net_pct = F.col("pnl_pct") - 2 * rules.fee
    days = trades.groupBy(F.col("exit_date").alias("date")).agg(F.sum(net_pct).alias("day_pct"))
    crossed = days.crossJoin(F.broadcast(grid)).withColumn("_year", F.year("date")).withColumn(
        "_log", F.log(1 + F.col("risk") / rules.max_positions * F.col("day_pct"))
    )
    run = series.running(crossed, ["risk"], ["date"], "_year", _sum=("sum", "_log"))
    return run.select("risk", "date", (F.lit(rules.start_balance) * F.exp("_sum")).alias("balance"))


def sizing_summary(paths: DataFrame, start: float = RULES.start_balance) -> DataFrame:
    """Total return and deepest drawdown (from a peak not below the start) per risk."""
    peaked = series.running(paths.withColumn("_year", F.year("date")), ["risk"], ["date"], "_year", peak=("max", "balance"))
    peak = F.greatest(F.col("peak"), F.lit(start))
    return peaked.groupBy("risk").agg(
        (F.max_by("balance", "date") / start - 1).alias("total_return"),
        F.min((F.col("balance") - peak) / peak).alias("max_drawdown"),
    )


def concurrency(trades: DataFrame) -> DataFrame:
    """Positions open at the end of each day on which that number changes: +1 at entry, -1 at exit, summed
    per day before the running total."""
    steps = trades.select(
        F.explode(F.array(
            F.struct(F.col("entry_date").alias("date"), F.lit(1).alias("step")),
            F.struct(F.col("exit_date").alias("date"), F.lit(-1).alias("step")),
        )).alias("e")
    ).select("e.*")
    days = steps.groupBy("date").agg(F.sum("step").alias("step"))
    run = series.running(days.withColumn("_year", F.year("date")), [], ["date"], "_year", n_open=("sum", "step"))
    return run.select("date", "n_open")


def concurrency_summary(levels: DataFrame, calendar: DataFrame) -> DataFrame:
    """Maximum, days at three or more, and share of calendar days in the market."""
    days = calendar.select("date").distinct().join(levels, "date", "left").withColumn("_year", F.year("date"))
    filled = series.running(days, [], ["date"], "_year", held=("last", "n_open"))
    held = F.coalesce(F.col("held"), F.lit(0))
    return filled.agg(
        F.max(held).alias("max_open"), F.count_if(held >= 3).alias("days_3_or_more"),
        F.avg((held > 0).cast("double")).alias("time_in_market"),
    )


def crash_scan(returns: DataFrame) -> DataFrame:
    """Worst 1-day and 14-row return per symbol with its date."""
    return returns.groupBy("symbol").agg(
        F.min("ret_1d").alias("worst_1d"), F.min_by("date", F.struct("ret_1d", "date")).alias("worst_1d_date"),
        F.min("ret_14d").alias("worst_14d"),
        F.min_by("date", F.when(F.col("ret_14d").isNotNull(), F.struct("ret_14d", "date"))).alias("worst_14d_date"),
    )


def score_by_month(scores: DataFrame) -> DataFrame:
    return scores.groupBy(F.trunc("date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("prob").alias("prob_std"),
        F.min("prob").alias("prob_min"), F.max("prob").alias("prob_max"),
    )


def variant_stats(trades: DataFrame) -> DataFrame:
    """Per run_config: rate-normalised statistics."""
    net = F.col("pnl_net")
    return trades.groupBy("run_config").agg(
        F.count(F.lit(1)).alias("n"), F.avg((net > 0).cast("double")).alias("win_rate"),
        metrics.profit_factor().alias("profit_factor"), F.avg("pnl_pct").alias("mean_pnl_pct"),
        F.avg((F.col("reason") == "SL").cast("double")).alias("sl_share"),
        F.avg((F.col("reason") == "TP").cast("double")).alias("tp_share"),
        F.avg(F.col("reason").startswith("TRAIL").cast("double")).alias("trail_share"),
    )


def variant_deltas(stats: DataFrame, base: str) -> DataFrame:
    """Every variant against the base variant."""
    cols = ["win_rate", "profit_factor", "mean_pnl_pct", "sl_share", "tp_share", "trail_share"]
    reference = stats.filter(F.col("run_config") == base).select(*[F.col(c).alias(f"_{c}") for c in cols])
    # one row: the broadcast is bounded
    return stats.crossJoin(F.broadcast(reference)).select(
        "run_config", "n", *[(F.col(c) - F.col(f"_{c}")).alias(f"d_{c}") for c in cols]
    )


def dormancy(signals: DataFrame, as_of: Column, rules: Rules = RULES) -> DataFrame:
    """Days since the last fired signal and the distance of the best score to the threshold, per symbol."""
    fired = F.max(F.when(F.col("signal_fired"), F.col("date")))
    best = F.max("ensemble_prob")
    return signals.groupBy("symbol").agg(
        fired.alias("last_fired"), F.datediff(as_of, fired).alias("days_since"), best.alias("max_prob"),
        (best - rules.signal_threshold).alias("over_threshold"),
    )


def duplicate_runs(signals: DataFrame, ingest: str) -> tuple[DataFrame, DataFrame]:
    """(keys logged more than once, latest row per key)."""
    others = [c for c in signals.columns if c not in ("date", "symbol", ingest)]
    grouped = signals.groupBy("date", "symbol").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(F.struct(*others), ingest).alias("_last")
    )
    return (
        grouped.filter(F.col("n") > 1).select("date", "symbol", "n"),
        grouped.select("date", "symbol", "_last.*"),
    )
