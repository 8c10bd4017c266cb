"""Trade statistics, equity metrics and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..params import RULES, Rules
from . import risk


def trade_stats() -> list[Column]:
    """Count, wins, losses, win rate, mean win and loss, mean holding time; 0 where undefined."""
    win = F.col("win")
    return [
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(win).alias("n_wins"),
        F.count_if(~win).alias("n_losses"),
        F.avg(win.cast("double")).alias("win_rate"),
        F.coalesce(F.avg(F.when(win, F.col("pnl_net"))), F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(~win, F.col("pnl_net"))), F.lit(0.0)).alias("avg_loss"),
        F.avg("hold_days").alias("avg_hold_days"),
    ]


def profit_factor(net: Column | None = None, weight: Column | None = None) -> Column:
    """Sum of gains over the absolute sum of losses, infinite without a loss."""
    net = F.col("pnl_net") if net is None else net
    value = net if weight is None else net * weight
    gains = F.coalesce(F.sum(F.when(net > 0, value)), F.lit(0.0))
    losses = F.abs(F.coalesce(F.sum(F.when(net <= 0, value)), F.lit(0.0)))
    return F.when(losses > 0, gains / losses).otherwise(F.lit(float("inf")))


def equity_returns(equity: DataFrame) -> DataFrame:
    """Daily relative change. The equity has one row per calendar day, so the previous day is found by a
    window over years with the last balance of the year before carried in."""
    from . import series

    numbered = series.running(
        equity.withColumn("_year", F.year("date")), [], ["date"], "_year", rn=("count",),
    )
    w = Window.partitionBy("block").orderBy("rn")
    blocks = series.blocks(numbered, 1, 0)
    out = blocks.withColumn("ret", S.guarded_ratio(F.col("balance"), F.lag("balance").over(w)) - 1)
    return series.owned(out).drop("_year", "rn")


def equity_growth() -> list[Column]:
    """Start, end, total return and annual growth of a daily equity."""
    first, last = F.min_by("balance", "date"), F.max_by("balance", "date")
    years = F.datediff(F.max("date"), F.min("date")) / F.lit(365.25)
    total = last / first - 1
    return [
        first.alias("start_balance"),
        last.alias("end_balance"),
        total.alias("total_return"),
        years.alias("years"),
        F.when(years > 0, F.pow(1 + total, 1 / F.nullif(years, F.lit(0.0))) - 1).otherwise(F.lit(0.0)).alias("cagr"),
    ]


def sharpe(rules: Rules = RULES) -> Column:
    spread = F.stddev_samp("ret")
    return F.when(spread > 0, F.avg("ret") / spread * F.sqrt(F.lit(float(rules.periods_per_year)))).otherwise(F.lit(0.0))


def max_drawdown(equity: DataFrame) -> DataFrame:
    """The deepest fall below the running peak, as a negative fraction."""
    fall = (F.col("balance") - F.col("peak")) / F.col("peak")
    return risk.with_peak(equity).agg(F.min(fall).alias("max_drawdown"))


def calmar(cagr: Column, drawdown: Column) -> Column:
    return F.when(drawdown != 0, cagr / F.abs(F.nullif(drawdown, F.lit(0.0)))).otherwise(F.lit(0.0))


def equity_sheet(equity: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Growth, Sharpe, drawdown and Calmar in one row."""
    moves = equity_returns(equity)
    with_peak = risk.with_peak(moves)
    fall = (F.col("balance") - F.col("peak")) / F.col("peak")
    row = with_peak.agg(*equity_growth(), sharpe(rules).alias("sharpe"), F.min(fall).alias("max_drawdown"))
    return row.withColumn("calmar", calmar(F.col("cagr"), F.col("max_drawdown")))


def by_reason(trades: DataFrame) -> DataFrame:
    return trades.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("pnl_net").alias("net"))


def by_symbol(trades: DataFrame, universe: DataFrame) -> DataFrame:
    """Every symbol of the universe, those without trades included."""
    grouped = trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("win").cast("double")) * 100).alias("win_pct"),
        F.sum("pnl_net").alias("net"),
    )
    return universe.select("symbol").distinct().join(grouped, "symbol", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def buy_and_hold(bars: DataFrame) -> DataFrame:
    """Mean over symbols with two or more bars of last close over first close, minus 1."""
    per_symbol = bars.groupBy("symbol").agg(
        F.min_by("close", "date").alias("first"), F.max_by("close", "date").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    return per_symbol.filter(F.col("n") >= 2).agg(
        F.avg(F.col("last") / F.col("first") - 1).alias("buy_hold"), F.count(F.lit(1)).alias("n_symbols")
    )


def family_counts() -> list[Column]:
    reason = F.col("reason")
    return [
        F.count_if(reason == "TP").alias("n_tp"),
        F.count_if(reason == "SL").alias("n_sl"),
        F.count_if(reason.startswith("TRAIL")).alias("n_trail"),
        F.count_if(reason.startswith("MAX_HOLD")).alias("n_max_hold"),
    ]


def summary(trades: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Realized or predicted side of the forward comparison; a net of 0 counts as a loss."""
    net = F.col("pnl_net")
    return trades.agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(net) / rules.start_balance).alias("total_return"),
        F.avg((net > 0).cast("double")).alias("win_rate"),
        profit_factor().alias("profit_factor"),
        (F.avg(net / rules.start_balance) * 100).alias("avg_pnl_pct"),
        *family_counts(),
    )


def small_sample(n: Column, minimum: int = 30) -> Column:
    return n < minimum
