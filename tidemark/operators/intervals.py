"""Highest values between two days, whatever their distance.

For every bar the maxima of the next 1, 2, 4, ... bars are kept, each the larger of two from the step before. Any stretch of bars is covered by two of
them, so an interval is two lookups by ordinal instead of one row per bar or day in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import series


def doubled(bars: DataFrame, column: str, longest: int, rows: int = series.BLOCK_ROWS) -> DataFrame:
    """(symbol, rn, up): ``up[j]`` is the highest ``column`` of the 2 ** j bars from this one on, of those that exist. Needs ``rn``.

    ``longest`` bounds the stretches asked for; a block of bars grows with it and holds at most three times as many.
    """
    steps = max(longest, 1).bit_length() - 1
    ahead = 2 ** steps - 1
    held = series.blocks(bars.select("symbol", "rn", F.col(column).alias("_up0")), 0, ahead, max(rows, 2 * ahead))
    window = series.block_window()
    for j in range(steps):
        held = held.withColumn(f"_up{j + 1}", F.greatest(f"_up{j}", F.lead(f"_up{j}", 2 ** j).over(window)))
    return series.owned(held).select("symbol", "rn", F.array(*[f"_up{j}" for j in range(steps + 1)]).alias("up"))


def numbered_days(bars: DataFrame, days: DataFrame) -> DataFrame:
    """(symbol, day, below, upto) of distinct (symbol, day): how many bars the symbol has before the day and up to it.

    ``days`` needs no bar on the day. One running count over bars and days together.
    """
    here = days.select("symbol", F.col("day").alias("date")).distinct()
    rows = bars.select("symbol", "date", F.lit(1).alias("_bar"), F.lit(1).alias("_kind"))
    marks = here.select("*", F.lit(0).alias("_bar"), F.explode(F.array(F.lit(0), F.lit(2))).alias("_kind"))
    both = rows.unionByName(marks).withColumn("_year", F.year("date"))
    counted = series.running(both, ["symbol"], ["date", "_kind"], "_year", _n=("sum", "_bar")).filter("_bar = 0")
    return counted.groupBy("symbol", F.col("date").alias("day")).agg(F.min("_n").alias("below"), F.max("_n").alias("upto"))


def highest(bars: DataFrame, spans: DataFrame, start: Column, end: Column, column: str = "high", name: str = "highest") -> DataFrame:
    """``spans`` with the highest ``column`` of the symbol's bars from the day ``start`` to the day ``end``, both included; null where there is none.

    ``bars`` is read by several branches and needs ``rn``, ordinals without gaps. Null days have no bars.
    """
    asked = spans.withColumns({"_start": start, "_end": end})
    days = asked.select("symbol", F.explode(F.array("_start", "_end")).alias("day")).filter("day is not null")
    known = numbered_days(bars, days)
    asked = (asked.join(known.select("symbol", F.col("day").alias("_start"), (F.col("below") + 1).alias("_first")), ["symbol", "_start"], "left")
             .join(known.select("symbol", F.col("day").alias("_end"), F.col("upto").alias("_last")), ["symbol", "_end"], "left"))
    asked = asked.withColumn("_n", F.col("_last") - F.col("_first") + 1)
    longest = asked.agg(F.max("_n")).first()[0] or 1
    # the largest power of two within the stretch, by whole numbers
    step = F.when(F.col("_n") > 0, F.length(F.bin("_n")) - 1)
    asked = asked.withColumn("_step", step).withColumn("_late", F.col("_last") - F.expr("shiftleft(1L, _step)") + 1)
    table = doubled(bars, column, longest)
    left = table.select("symbol", F.col("rn").alias("_first"), F.col("up").alias("_a"))
    right = table.select("symbol", F.col("rn").alias("_late"), F.col("up").alias("_b"))
    found = asked.join(left, ["symbol", "_first"], "left").join(right, ["symbol", "_late"], "left")
    best = F.when(F.col("_step").isNotNull(), F.greatest(F.get("_a", F.col("_step")), F.get("_b", F.col("_step"))))
    return found.select(*spans.columns, best.alias(name))
