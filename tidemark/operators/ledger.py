"""Trade results, running balance, equity, the open/closed ledger and its updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..params import RULES, Rules
from . import series

CLOSING = {
    "exit_price": "double", "pnl_gross": "double", "pnl_net": "double", "fees": "double",
    "reason": "string", "hold_days": "int", "win": "boolean",
}
# Order ids that stand for no resting order.
NEVER_QUERIED = ["", "FLATTEN_FAILED"]


def sized(df: DataFrame, balance: Column, rules: Rules = RULES) -> DataFrame:
    """Fill a missing trade size with the share of ``balance`` one position may use."""
    fallback = balance * rules.risk_per_trade / rules.max_positions
    return df.withColumn("trade_size", F.coalesce("trade_size", fallback))


def with_pnl(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Gross, fees on the entry size both ways, net, and win = net above 0."""
    size = F.col("trade_size")
    return df.withColumns({
        "pnl_gross": F.col("pnl_pct") * size,
        "fees": size * rules.fee * 2,
    }).withColumn("pnl_net", F.col("pnl_gross") - F.col("fees")).withColumn("win", F.col("pnl_net") > 0)


def running_balance(trades: DataFrame, start: float = RULES.start_balance,
                    order: list[str] = ["exit_date", "symbol", "entry_date"], parts: int | None = None) -> DataFrame:
    """``balance_after`` for each trade in one global order, over range partitions."""
    total = series.global_running(trades, order, parts, _net=("sum", "pnl_net"))
    return total.withColumn("balance_after", F.lit(start) + F.col("_net")).drop("_net")


def equity_curve(trades: DataFrame, calendar: DataFrame, start: float = RULES.start_balance) -> DataFrame:
    """Balance after each calendar day's exits. Trades are summed per day first, so the ordered part sees
    one row per day, in yearly buckets."""
    per_day = trades.groupBy(F.col("exit_date").alias("date")).agg(F.sum("pnl_net").alias("net"))
    days = calendar.select("date").distinct().join(per_day, "date", "left").withColumn("net", F.coalesce("net", F.lit(0.0)))
    total = series.running(days.withColumn("_year", F.year("date")), [], ["date"], "_year", _net=("sum", "net"))
    return total.select("date", (F.lit(start) + F.col("_net")).alias("balance"))


def numbered(df: DataFrame, order: list[str], base: int = 0, parts: int | None = None) -> DataFrame:
    """Row ids T0001, T0002, ... continuing after ``base`` existing rows."""
    ranked = series.global_running(df, order, parts, _n=("count",))
    return ranked.withColumn("row_id", S.row_id(F.col("_n") + base)).drop("_n")


def opened(positions: DataFrame, rules: Rules = RULES) -> DataFrame:
    """OPEN ledger rows for entries (symbol, entry_date, entry_price, signal_prob); the closing fields are null."""
    empty = {name: F.lit(None).cast(kind) for name, kind in CLOSING.items()}
    return positions.select(
        F.col("entry_date").alias("date"), "symbol", F.lit("OPEN").alias("action"), "entry_price",
        *[value.alias(name) for name, value in empty.items()],
        F.lit(None).cast("double").alias("balance_after"), "signal_prob", F.lit(rules.trade_size).alias("trade_size"),
        F.lit("").alias("stop_order_id"), F.lit(None).cast("double").alias("fill_qty"),
    )


def open_positions(ledger: DataFrame, run_date: Column, rules: Rules = RULES) -> DataFrame:
    """OPEN rows without an exit price, entered within the last 90 days."""
    return ledger.filter(
        (F.col("action") == "OPEN") & F.col("exit_price").isNull()
        & (F.col("date") >= F.date_sub(run_date, rules.stale_after_days))
    )


def stale_positions(ledger: DataFrame, run_date: Column, rules: Rules = RULES) -> DataFrame:
    """OPEN rows that ``open_positions`` passes over because of their age."""
    return ledger.filter(
        (F.col("action") == "OPEN") & F.col("exit_price").isNull()
        & (F.col("date") < F.date_sub(run_date, rules.stale_after_days))
    )


def reconcile(positions: DataFrame, order_status: DataFrame, run_date: Column, rules: Rules = RULES) -> DataFrame:
    """Match resting stop orders with their status. ``closed_by_stop`` rows carry the exit at the average
    fill, or at the stop level without one; everything else stays open, failed lookups included."""
    wanted = F.when(~F.coalesce(F.trim("stop_order_id"), F.lit("")).isin(NEVER_QUERIED), F.trim("stop_order_id"))
    status = order_status.select(F.col("stop_order_id").alias("_id"), "status", "average")
    entry = F.col("entry_price")
    filled = F.coalesce(F.col("status") == "closed", F.lit(False))
    price = F.when(F.coalesce("average", F.lit(0.0)) != 0, F.col("average")).otherwise(entry * (1 - rules.stop_loss))
    joined = positions.withColumn("_wanted", wanted).join(status, F.col("_wanted") == F.col("_id"), "left")
    return joined.select(
        *positions.columns,
        filled.alias("closed_by_stop"),
        F.when(filled, F.lit("SL")).alias("reason"),
        F.when(filled, price).alias("exit_price"),
        F.when(filled, run_date).alias("exit_date"),
        F.when(filled, (price - entry) / entry).alias("pnl_pct"),
        F.when(filled, F.datediff(run_date, "entry_date")).alias("hold_days"),
    )


def close_trades(ledger: DataFrame, exits: DataFrame) -> DataFrame:
    """Merge exits into the ledger: by row_id, or by (date, symbol) of an open row for exits without one.

    Both matches are equi joins. If several exits name a row the one with the smallest exit date counts. Exits without a row id
    close the open rows of their (date, symbol) one each, earliest exit to smallest row_id. ``unmatched_exits`` has the rest.
    """
    return _merged_exits(ledger, exits)[0]


def unmatched_exits(ledger: DataFrame, exits: DataFrame) -> DataFrame:
    """The exits that ``close_trades`` finds no row for: an unknown row id, a further exit of the same row, or more exits of a
    (date, symbol) than it has open rows."""
    return _merged_exits(ledger, exits)[1]


def _merged_exits(ledger: DataFrame, exits: DataFrame) -> tuple[DataFrame, DataFrame]:
    fields = ["exit_price", "pnl_gross", "pnl_net", "fees", "reason", "hold_days", "win", "balance_after"]
    bundle = F.struct(*fields)
    order = F.struct("exit_date", *fields)
    # a trade's exits are few: one symbol on one day, or one row
    named = exits.filter(F.coalesce("row_id", F.lit("")) != "").withColumn(
        "_k", F.row_number().over(Window.partitionBy("row_id").orderBy(order)))
    by_id = named.filter("_k = 1").select("row_id", bundle.alias("_by_id"))
    unnamed = exits.filter(F.coalesce("row_id", F.lit("")) == "").withColumn(
        "_k", F.row_number().over(Window.partitionBy("date", "symbol").orderBy(order)))
    is_open = (F.col("action") == "OPEN") & F.col("exit_price").isNull()
    open_rows = ledger.filter(is_open).join(by_id.select("row_id"), "row_id", "left_anti").select(
        F.col("row_id").alias("_open"), "date", "symbol",
        F.row_number().over(Window.partitionBy("date", "symbol").orderBy("row_id")).alias("_k"))
    met = unnamed.join(open_rows, ["date", "symbol", "_k"], "left")
    by_key = met.filter("_open is not null").select(F.col("_open").alias("row_id"), bundle.alias("_by_key"))
    unknown = named.join(ledger.select("row_id"), "row_id", "left_anti").select(*exits.columns)
    lost = unknown.unionByName(named.filter("_k > 1").join(ledger.select("row_id"), "row_id", "left_semi").select(*exits.columns))
    lost = lost.unionByName(met.filter("_open is null").select(*exits.columns))
    joined = ledger.join(by_id, "row_id", "left").join(by_key, "row_id", "left")
    hit = F.coalesce("_by_id", "_by_key")
    closed = hit.isNotNull()

    def merged(name: str) -> Column:
        if name in fields:
            return F.when(closed, hit[name]).otherwise(F.col(name)).alias(name)
        if name == "action":
            return F.when(closed, "CLOSED").otherwise(F.col(name)).alias(name)
        if name in ("stop_order_id", "fill_qty"):
            return F.when(~closed, F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[merged(c) for c in ledger.columns]), lost
