"""Composite reports over trades, bars and the recorded ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rolling as R
from ..functions import scalars as S
from ..operators import compare, indicators, ledger, metrics, risk, series
from ..params import RULES, Rules
from ..session import materialize
from . import inputs


def metrics_sheet(trades: DataFrame, calendar: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The backtest's 13 figures and the win/loss counts in one row."""
    equity = materialize(ledger.equity_curve(trades, calendar, rules.start_balance))
    sheet = metrics.equity_sheet(equity, rules).drop("years")
    stats = trades.agg(*metrics.trade_stats(), metrics.profit_factor().alias("profit_factor"))
    return sheet.crossJoin(stats)  # two single rows


def breakdown(trades: DataFrame) -> DataFrame:
    """Per reason and per symbol in one pass: each trade is tagged with both dimensions, and the tagged rows
    are combined on the map side."""
    tagged = trades.select(
        "win", "pnl_net",
        F.explode(F.array(
            F.struct(F.lit("reason").alias("dimension"), F.col("reason").alias("value")),
            F.struct(F.lit("symbol").alias("dimension"), F.col("symbol").alias("value")),
        )).alias("t"),
    )
    return tagged.groupBy("t.dimension", "t.value").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("win").cast("double")) * 100).alias("win_pct"), F.sum("pnl_net").alias("net")
    )


def realized_vs_predicted(live: DataFrame, predicted: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Three rows: the live trades, the prediction over the live window, the prediction on the live keys; each with the deepest fall of its own
    balance, which starts at the start balance and moves on days with exits."""
    bounds = live.agg(F.min("entry_date").alias("_a"), F.max("entry_date").alias("_b"))
    window = predicted.crossJoin(F.broadcast(bounds)).filter(F.col("entry_date").between(F.col("_a"), F.col("_b")))
    sides = [("realized", live), ("predicted", window), ("predicted_same_keys", compare.on_keys(predicted, live))]
    rows = [
        metrics.summary(df, rules).crossJoin(trade_drawdown(df, rules)).select(F.lit(name).alias("side"), "*") for name, df in sides  # single rows
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def trade_drawdown(trades: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The deepest fall below the peak so far of the balance after each exit day, 0 without trades. One row."""
    days = trades.groupBy(F.col("exit_date").alias("date")).agg(F.sum("pnl_net").alias("net"))
    total = series.running(days.withColumn("_year", F.year("date")), [], ["date"], "_year", _net=("sum", "net"))
    falls = risk.with_drawdown(materialize(total.select("date", (F.lit(rules.start_balance) + F.col("_net")).alias("balance"))), rules)
    return falls.agg(F.coalesce(-F.max("drawdown"), F.lit(0.0)).alias("max_drawdown"))


def strategy_vs_hold(trades: DataFrame, bars: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Return on the start balance, the equal-weight benchmark and the edge in percentage points."""
    strategy = trades.agg((F.sum("pnl_net") / rules.start_balance).alias("strategy"))
    hold = metrics.buy_and_hold(bars).select("buy_hold")
    return strategy.crossJoin(hold).withColumn("edge_pp", (F.col("strategy") - F.col("buy_hold")) * 100)


def live_vs_hold(live: DataFrame, bars: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The same over the window the live trades span."""
    bounds = live.agg(F.min("entry_date").alias("window_start"), F.max("entry_date").alias("window_end"))
    inside = bars.crossJoin(F.broadcast(bounds)).filter(F.col("date").between(F.col("window_start"), F.col("window_end")))
    return bounds.crossJoin(strategy_vs_hold(live, inside, rules))


def run_counts(positions: DataFrame, calendar: DataFrame, day: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The daily run's closing summary for the one ``run_date`` in ``day``: exits found on yesterday's bar,
    entries of the day, positions open, balance and peak before the day."""
    closed = ledger.with_pnl(positions.filter(F.col("reason").isNotNull()), rules)
    run = F.col("run_date")
    flags = positions.crossJoin(F.broadcast(day))
    counts = flags.agg(
        F.max(run).alias("run_date"),
        F.count_if(F.col("exit_date") == F.date_sub(run, 1)).alias("n_exits"),
        F.count_if(F.col("entry_date") == run).alias("n_entries"),
        F.count_if((F.col("entry_date") <= run) & (F.col("exit_date").isNull() | (F.col("exit_date") >= run))).alias("n_open"),
    )
    equity = ledger.equity_curve(closed, calendar, rules.start_balance).crossJoin(F.broadcast(day)).filter(F.col("date") < run)
    money = equity.agg(
        F.max_by("balance", "date").alias("balance"),
        F.max(F.greatest("balance", F.lit(rules.start_balance))).alias("peak"),
    )
    return counts.crossJoin(money)


def day_notes(bars: DataFrame, sentiment: DataFrame, benchmark: str, rules: Rules = RULES) -> DataFrame:
    """Sentiment label, the benchmark symbol's 7-row return and signal counts for each day that has a bar, a sentiment value or a candidate.
    What a day lacks is null, its counts 0."""
    week = indicators.blocked(
        bars.filter(F.col("symbol") == benchmark), 7, 0,
        lambda b: b.withColumn("benchmark_week", R.change("close", indicators.W(), 7)),
    ).select("date", "benchmark_week")
    cands = inputs.candidates(bars)
    fired = (F.col("prob") >= rules.signal_threshold) & (F.col("ofi") > rules.flow_gate)
    counts = cands.groupBy("date").agg(F.count(F.lit(1)).alias("n_signals"), F.count_if(fired).alias("n_fired"))
    labeled = sentiment.select("date", "value", S.sentiment_label(F.col("value")).alias("label"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return week.join(labeled, "date", "full").join(counts, "date", "full").select(
        "date", "value", "label", "benchmark_week", S.benchmark_label(F.col("benchmark_week")).alias("benchmark_label"),
        zero("n_signals"), zero("n_fired"),
    )
