"""Order-book and trade-flow imbalance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def book_imbalance(book: DataFrame) -> DataFrame:
    """Size imbalance over the top 20 levels of each snapshot."""
    bid, ask = S.level_sizes(F.col("bids")), S.level_sizes(F.col("asks"))
    return book.select("symbol", "ts", S.imbalance(bid, ask).alias("ofi"))


def daily_flow(flow: DataFrame) -> DataFrame:
    """Flow ratio per (symbol, day) from taker-buy and total volume; days without volume are skipped."""
    daily = flow.groupBy("symbol", "date").agg(F.sum("taker").alias("taker"), F.sum("total").alias("total"))
    return daily.filter("total > 0").withColumn("ofi", S.flow_ratio(F.col("taker"), F.col("total")))


def with_flow(df: DataFrame, flow: DataFrame) -> DataFrame:
    """The imbalance at (symbol, date); a missing value is 0.0 and so fails the gate."""
    return df.join(flow.select("symbol", "date", "ofi"), ["symbol", "date"], "left").withColumn(
        "ofi", F.coalesce("ofi", F.lit(0.0))
    )
