"""The daily sentiment series on bar dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import rolling as R
from ..functions import scalars as S
from . import series


def align(bars: DataFrame, sentiment: DataFrame | None) -> DataFrame:
    """Add ``fg``: the day's value, else the last value that fell on an earlier bar of the symbol, else 50.

    The exact-date join comes first, so a value before the first bar is never carried in. The broadcast
    side is grouped by day here, so it has at most 366 small rows a year whatever it was made from; two values for one day are an
    error, as readers keep the last one. Without
    a series ``fg`` is null and the features take their constants.
    """
    if sentiment is None:
        return bars.withColumn("fg", F.lit(None).cast("double"))
    one = F.when(F.min("value").eqNullSafe(F.max("value")), F.max("value")).otherwise(
        F.raise_error(F.concat(F.lit("two sentiment values for "), F.col("date").cast("string"))).cast(dict(sentiment.dtypes)["value"]))
    days = sentiment.groupBy("date").agg(one.alias("_day_value"))
    joined = bars.join(F.broadcast(days), "date", "left")
    filled = series.running(
        joined.withColumn("_year", series.year_bucket()), ["symbol"], ["date"], "_year",
        _filled=("last", "_day_value"),
    )
    fg = F.coalesce(F.col("_filled"), F.lit(P.SENTIMENT_DEFAULT)).cast("double")
    return filled.withColumn("fg", fg).select(*bars.columns, "fg")


def sentiment_features(window) -> list[Column]:
    """Level, level flags and 7-row change. Constants where there is no series."""
    fg = F.col("fg")
    momentum = F.when(fg.isNull(), F.lit(0.0)).otherwise(R.difference("fg", window, P.SENTIMENT_SPAN) / 100)
    return [
        F.coalesce(fg / 100, F.lit(0.5)).alias("fg_value"),
        S.flag(fg <= P.SENTIMENT_FEAR).alias("fg_extreme_fear"),
        S.flag(fg >= P.SENTIMENT_GREED).alias("fg_extreme_greed"),
        momentum.alias("fg_momentum"),
    ]
