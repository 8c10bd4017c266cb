"""The engine's inputs, derived from the given tables.

Symbols are return flags and days are ship dates, so daily bars are a strong reduction of the line items:
the scan pre-aggregates on the map side and the result is written once per query (``materialize``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import exits, indicators, ledger, series
from ..params import RULES, Rules
from ..session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer sums per (symbol, day); the only pass over the line items."""
    lines = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("bigint")
    return (
        lines.groupBy(F.col("l_returnflag").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.rint(F.col("l_discount") * 100).cast("bigint")).alias("di"),
            F.sum(F.rint(F.col("l_tax") * 100).cast("bigint")).alias("ti"),
            F.sum(quantity).alias("vi"),
            F.sum(F.when(F.col("l_linestatus") == "O", quantity).otherwise(0)).alias("taker"),
        )
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with ``rn``: a compounded walk, about 1 % a day. ``vi`` and ``taker`` stay for flow and scores."""
    days = materialize(daily(spark, sf_dir))
    steps = days.withColumn("ret", F.col("di").cast("double") / (100 * F.col("n")) - F.lit(0.05)).withColumn(
        "_year", series.year_bucket()
    )
    walk = series.running(
        steps, ["symbol"], ["date"], "_year",
        rn=("count",), walked=("sum", "ret"), walked_before=("sum_before", "ret"),
    )
    close = F.round(100 * F.exp("walked"), 8)
    before = F.round(100 * F.exp("walked_before"), 8)
    opened = before * (1 + (((F.col("n") + F.col("vi")) % 5) - 2) * F.lit(0.002))
    amp = F.col("ti").cast("double") / (100 * F.col("n")) * F.lit(0.10)
    return (
        walk.withColumns({"close": close, "open": opened, "amp": amp})
        .select(
            "symbol", "date", "open",
            (F.greatest("open", "close") * (1 + F.col("amp"))).alias("high"),
            (F.least("open", "close") * (1 - F.col("amp"))).alias("low"),
            "close", F.col("vi").cast("double").alias("volume"), "rn", "vi", "taker",
        )
    )


def business_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars on business days only, renumbered: every week has a gap, so row and calendar windows differ."""
    full = materialize(bars(spark, sf_dir).filter(F.weekday("date") < 5).drop("rn"))
    return series.ordinals(full)


def flow(bar_rows: DataFrame) -> DataFrame:
    """Flow imbalance per bar from its taker volume."""
    return bar_rows.filter("vi > 0").select(
        "symbol", "date", S.flow_ratio(F.col("taker").cast("double"), F.col("vi").cast("double")).alias("ofi")
    )


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of urgent orders per day, 0..100, published on business days; one row per calendar day."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("date", F.to_date("o_orderdate"))
        .filter(F.weekday("date") < 5)
        .groupBy("date")
        .agg((F.floor(100 * F.count_if(urgent) / F.count(F.lit(1)))).cast("int").alias("value"))
    )


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-book snapshots per symbol and month. A side can hold any number of levels, so it is built
    from the price levels' totals and cut to the depth by rank before anything is collected."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.trunc("l_shipdate", "month").alias("date"),
        F.col("l_linestatus").alias("side"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("size"),
    )
    from ..sources.market import top_levels

    return top_levels(lines)


def score() -> Column:
    """A stand-in probability for a bar, from its volume."""
    return (F.col("vi") % 100) / F.lit(100.0)


def rsi_positions(bar_rows: DataFrame) -> DataFrame:
    """Entry at the close of every bar with RSI below 35."""
    scored = indicators.blocked(bar_rows, indicators.RSI_HALO, 0, indicators.add_rsi)
    return scored.filter("rsi < 35").select(
        "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"), score().alias("signal_prob")
    )


def placed(bar_rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The same positions with their entry bar and path, in the same pass over the bars: the entry rule and
    the path are windows over one block layout, so no join is needed."""
    horizon = rules.max_hold

    def build(df: DataFrame) -> DataFrame:
        ahead = series.block_window().rowsBetween(1, horizon)
        bar = F.struct("date", "open", "high", "low", "close")
        return indicators.add_rsi(df).withColumn("path", exits.path_column(F.collect_list(bar).over(ahead), horizon))

    both = indicators.blocked(bar_rows, indicators.RSI_HALO, horizon, build)
    return both.filter("rsi < 35").select(
        "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"),
        F.col("high").alias("entry_high"), score().alias("signal_prob"),
        S.flow_ratio(F.col("taker").cast("double"), F.col("vi").cast("double")).alias("ofi"),
        "path",
    )


def exited(bar_rows: DataFrame) -> DataFrame:
    """All positions with their first exit; unresolved ones have null exit columns."""
    return exits.first_exit(placed(bar_rows))


def trades(bar_rows: DataFrame, scale: float = 1.0) -> DataFrame:
    """Closed trades with their result at the fixed size."""
    closed = exits.resolved(exited(bar_rows))
    return ledger.with_pnl(closed.withColumn("trade_size", F.lit(RULES.trade_size * scale)))


def candidates(bar_rows: DataFrame) -> DataFrame:
    """Entry candidates per (day, symbol), with the day's account state in its columns."""
    return bar_rows.select(
        "date", "symbol", "close", score().alias("prob"),
        S.flow_ratio(F.col("taker").cast("double"), F.col("vi").cast("double")).alias("ofi"),
        (F.col("vi") % 7 == 0).alias("in_position"),
    )


def day_state(cands: DataFrame) -> DataFrame:
    """Open positions, halt and balance at the start of each day; one row per calendar day."""
    return cands.select("date").distinct().select(
        "date", (F.dayofmonth("date") % 4).alias("n_open"), (F.month("date") == 12).alias("halted"),
        F.lit(RULES.start_balance).alias("balance"),
    )


def live_trades(closed: DataFrame) -> DataFrame:
    """The recorded side of the comparisons: trades entered on business days, with the reason of entries
    on the first day of a month recorded as SL."""
    wrong = F.dayofmonth("entry_date") == 1
    return closed.filter(F.weekday("entry_date") < 5).withColumn(
        "reason", F.when(wrong, "SL").otherwise(F.col("reason"))
    )


def entry_signals(bar_rows: DataFrame) -> DataFrame:
    """Bars whose stand-in probability reaches the threshold."""
    scored = bar_rows.select(
        "date", "symbol", "close", score().alias("prob"),
        S.flow_ratio(F.col("taker").cast("double"), F.col("vi").cast("double")).alias("ofi"),
    )
    return scored.filter(F.col("prob") >= RULES.signal_threshold)
