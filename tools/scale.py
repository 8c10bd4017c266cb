"""Scaling checks on generated bars: python tools/scale.py SYMBOLS BARS [HOT_BARS]

SYMBOLS series of BARS days each, and one symbol with HOT_BARS days. Prints seconds for the feature table, the
exponential means and the first exits of every bar, and the largest number of rows one window task would get.
"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import exits, indicators, sentiment, series  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402


def generated(spark, symbols: int, bars: int, hot: int):
    regular = spark.range(symbols * bars).select(
        F.format_string("S%06d", F.floor(F.col("id") / bars)).alias("symbol"), (F.col("id") % bars).cast("int").alias("i"))
    df = regular
    if hot:
        df = regular.union(spark.range(hot).select(F.lit("HOT").alias("symbol"), F.col("id").cast("int").alias("i")))
    noise = (F.pmod(F.xxhash64("symbol", "i"), F.lit(1000)) / 1000.0 - 0.5) * 0.04
    close = 100 * F.exp(F.sin(F.col("i") / 40.0) * 0.3 + noise)
    return df.select(
        "symbol", F.date_add(F.lit("0100-01-01").cast("date"), F.col("i")).alias("date"),
        (close * (1 + noise / 8)).alias("open"), (close * 1.012).alias("high"), (close * 0.989).alias("low"), close.alias("close"),
        F.pmod(F.xxhash64("i", "symbol"), F.lit(500)).cast("double").alias("volume"))


def main() -> None:
    symbols, bars = int(sys.argv[1]), int(sys.argv[2])
    hot = int(sys.argv[3]) if len(sys.argv) > 3 else 0
    spark = build_session("scale", "local[8]", **{
        "spark.sql.shuffle.partitions": "32", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_path(spark, "generated-bars")
    generated(spark, symbols, bars, hot).write.parquet(path)
    numbered = series.ordinals(spark.read.parquet(path))

    def timed(name, df):
        started = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:10s} {time.perf_counter() - started:7.2f}s", flush=True)

    print(f"{symbols} symbols x {bars} bars + {hot}", flush=True)
    timed("ordinals", numbered)
    rows = series.BLOCK_ROWS
    timed("ema", indicators.blocked(numbered, indicators.EMA_HALO, 0, lambda b: indicators.add_ema(b, rows + indicators.EMA_HALO), rows))
    timed("features", indicators.features(sentiment.align(numbered, None)))
    positions = numbered.select("symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    timed("exits", exits.first_exit(exits.at_entry(positions, exits.with_path(numbered))))
    largest = series.blocks(numbered, indicators.EMA_HALO, 1).groupBy("symbol", "block").count().agg(F.max("count")).first()[0]
    print(f"largest window group {largest} rows", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
