"""Ticks to complete daily bars and daily flow behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import scratch_path

LATENESS = "1 hour"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream one Parquet table of a folder. The schema is taken from the table itself."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available, then read what was written. Output and offsets go to the shared
    checkpoint folder."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    drain(df, out, f"{out}-offsets", mode)
    return spark.read.schema(df.schema).parquet(out)


def drain(df: DataFrame, out: str, offsets: str, mode: str = "append") -> None:
    """One run over the available input; a later call with the same offsets continues where it stopped."""
    running = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    running.awaitTermination()


def ticks(events: DataFrame) -> DataFrame:
    """Ticks from events: the type is the symbol, the value the price, one unit of volume each. The table's
    timestamps have no zone, and a watermark needs one."""
    return events.select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.col("value").alias("price"), F.lit(1.0).alias("volume"), "user_id",
    )


def daily_bars(tick_rows: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Daily OHLCV per symbol. In append mode a bar is emitted once its day lies behind the watermark, so the
    still-open day never leaves, and later ticks for an emitted day are dropped."""
    at = F.struct("ts", "event_id")
    return (
        tick_rows.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "symbol")
        .agg(
            F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max_by("price", at).alias("close"), F.sum("volume").alias("volume"),
        )
        .select("symbol", F.to_date("w.start").alias("date"), "open", "high", "low", "close", "volume")
    )


def daily_flow(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Flow ratio per symbol and day from a stream of (symbol, ts, taker, total)."""
    return (
        trades.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "symbol")
        .agg(F.sum("taker").alias("taker"), F.sum("total").alias("total"))
        .filter("total > 0")
        .select("symbol", F.to_date("w.start").alias("date"), S.flow_ratio(F.col("taker"), F.col("total")).alias("ofi"))
    )


def daily_results(results: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Net result and reset flag per account and day from a stream of (account, ts, net, reset)."""
    return (
        results.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "account")
        .agg(F.sum("net").alias("net"), F.max("reset").alias("reset"))
        .select("account", F.to_date("w.start").alias("date"), "net", "reset")
    )
