"""Peak, drawdown and the latched halt.

Days are cut into buckets (years). Inside one everything is a window over its rows; what a bucket does to the days after it is a small
summary that composes: its highest balance, whether it holds a reset, the lowest balance since the last one and whether the days since
then tripped by themselves. A peak from before can only make a day trip that lies low enough, so the lowest balance decides for all of
them, and the summaries of all buckets, one row a year, give every bucket its start. The daily rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..params import RULES, Rules
from . import series


def with_peak(equity: DataFrame, date: str = "date") -> DataFrame:
    """Running peak over a daily series, in yearly buckets."""
    bucketed = equity.withColumn("_year", F.year(date))
    return series.running(bucketed, [], [date], "_year", peak=("max", "balance")).drop("_year")


def _fall(peak: Column, balance: Column) -> Column:
    return F.coalesce(S.guarded_ratio(peak - balance, peak), F.lit(0.0))


def _scanned(equity: DataFrame, resets: DataFrame | None, rules: Rules, date: str) -> DataFrame:
    """Peak, drawdown, tripped, epoch (resets so far) and halted of every row of ``equity``."""
    limit = rules.halt_drawdown
    rows = equity.withColumns({"_year": F.year(date), "_own": F.lit(True)})
    if resets is not None:
        days = resets.select(F.col("date").alias(date)).distinct()
        rows = rows.unionByName(days.withColumns({"_year": F.year(date), "_own": F.lit(False)}), allowMissingColumns=True)
    rows = rows.repartition("_year")  # every window below keeps to its bucket
    if resets is None:
        rows = rows.withColumn("_reset", F.lit(0))
    else:
        # a reset counts on the day's own row, and not at all on a day without one
        marked = F.max((~F.col("_own")).cast("int")).over(Window.partitionBy("_year", date))
        rows = rows.withColumn("_reset", marked).filter("_own")
    upto = Window.partitionBy("_year").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_high": F.max("balance").over(upto), "_epoch": F.sum("_reset").over(upto)})
    rows = rows.withColumn("_trips", (_fall(F.greatest("_high", F.lit(rules.start_balance)), F.col("balance")) >= limit).cast("int"))
    since = Window.partitionBy("_year", "_epoch").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_low": F.min("balance").over(since), "_tripped": F.max("_trips").over(since)})

    ends = rows.groupBy("_year").agg(
        F.max("balance").alias("high"), F.max("_epoch").alias("resets"), F.max_by("_low", date).alias("low"), F.max_by("_tripped", date).alias("trips"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({
        "_peak_in": F.greatest(F.max("high").over(earlier), F.lit(rules.start_balance)),
        "_epoch_in": F.coalesce(F.sum("resets").over(earlier), F.lit(0))})
    out = (F.col("trips") == 1) | (_fall(F.col("_peak_in"), F.col("low")) >= limit)
    decided = F.when(out | (F.col("resets") > 0), out)  # else what came in goes out
    ends = ends.withColumn("_halted_in", F.coalesce(F.last(decided, ignorenulls=True).over(earlier), F.lit(False)))
    carried = F.broadcast(ends.select("_year", "_peak_in", "_epoch_in", "_halted_in"))  # one row a year

    joined = rows.join(carried, "_year")
    tripped = (F.col("_tripped") == 1) | (_fall(F.col("_peak_in"), F.col("_low")) >= limit)
    peak = F.greatest("_peak_in", "_high")
    return joined.select(
        *equity.columns, peak.alias("peak"), _fall(peak, F.col("balance")).alias("drawdown"),
        (_fall(peak, F.col("balance")) >= limit).alias("tripped"), (F.col("_epoch") + F.col("_epoch_in")).alias("epoch"),
        (tripped | ((F.col("_epoch") == 0) & F.col("_halted_in"))).alias("halted"))


def with_drawdown(equity: DataFrame, rules: Rules = RULES, date: str = "date") -> DataFrame:
    """Peak not below the start balance, drawdown from it, and whether the limit is reached. One row a day."""
    return _scanned(equity, None, rules, date).drop("epoch", "halted")


def latched_halt(equity: DataFrame, resets: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Once tripped the halt stays until a manual reset. A reset clears the flag before that day's check and
    leaves the peak alone, so it trips again at once while the drawdown lasts.

    Several rows of ``resets`` for one date are one reset; on a day without a balance it has no effect. ``epoch`` counts resets.
    """
    return _scanned(equity, resets, rules, "date")
