"""Signals against trades, recorded against reconstructed, realized against predicted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import RULES, Rules
from . import exits


def wanted_signals(signals: DataFrame) -> DataFrame:
    """Rows the model wanted to enter: entered, or blocked by the flow gate only."""
    reason = F.col("reject_reason")
    return signals.filter((reason == "NONE") | reason.startswith("OFI_NEGATIVE")).withColumn(
        "group", F.when(reason == "NONE", "OFI_PASS").otherwise("OFI_BLOCKED")
    )


def first_trade(signals: DataFrame, trades: DataFrame) -> DataFrame:
    """Each signal with the first trade of its (date, symbol). Trades are reduced to one per key on the
    map side, so the join is at most one row per signal."""
    others = [c for c in trades.columns if c not in ("date", "symbol")]
    order = F.struct("exit_date") if "row_id" not in others else F.struct("row_id")
    first = trades.groupBy("date", "symbol").agg(F.min_by(F.struct(*others), order).alias("_t")).select("date", "symbol", "_t.*")
    joined = signals.select("date", "symbol").join(first, ["date", "symbol"])
    pnl = (F.col("exit_price") - F.col("entry_price")) / F.col("entry_price")
    return joined.withColumn("pnl_pct", pnl).withColumn("win", F.col("reason") == "TP")


def without_trade(signals: DataFrame, trades: DataFrame) -> DataFrame:
    return signals.join(trades.select("date", "symbol"), ["date", "symbol"], "left_anti")


def reconstruct(entries: DataFrame, bars: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The exit the rules give for each entry (symbol, entry_date, entry_price, ...). ``bars`` may carry their paths already."""
    taken = [c for c in ("entry_high", "path", "exit_date", "exit_price", "pnl_pct", "hold_days", "exit_open", "reason")
             if c in entries.columns]
    paths = bars if "path" in bars.columns else exits.with_path(bars, rules.max_hold)
    return exits.first_exit(exits.at_entry(entries.drop(*taken), paths), rules)


def fidelity(recorded: DataFrame, bars: DataFrame, rules: Rules = RULES, strict: bool = False) -> DataFrame:
    """Recorded against reconstructed reason; NO_DATA where the bars settle nothing. A recorded
    ``MAX_HOLD_5d`` equals ``MAX_HOLD`` unless ``strict``."""
    kept = recorded.select("symbol", "entry_date", "entry_price", F.col("reason").alias("recorded"))
    done = reconstruct(kept, bars, rules).withColumn("reconstructed", F.coalesce("reason", F.lit("NO_DATA")))
    said = F.col("recorded")
    if not strict:
        said = F.regexp_replace(said, r"^MAX_HOLD_[0-9]+d$", "MAX_HOLD")
    return done.withColumn("matches", said == F.col("reconstructed"))


def fidelity_summary(checked: DataFrame) -> DataFrame:
    share = F.avg(F.col("matches").cast("double")) * 100
    return checked.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("matches")).alias("n_match"), share.alias("match_pct")
    )


def gate_rows(signals: DataFrame, trades: DataFrame, bars: DataFrame, rules: Rules = RULES,
              include_open: bool = False) -> DataFrame:
    """Outcome of each wanted signal: from the ledger where it was entered, reconstructed where it was
    blocked. Signals without an outcome are left out. A win is a target hit on both sides. Where the ledger
    has an action, only closed rows count unless ``include_open``, which keeps open ones with a null result."""
    if "action" in trades.columns and not include_open:
        trades = trades.filter(F.upper("action") == "CLOSED")
    wanted = wanted_signals(signals)
    passed = first_trade(wanted.filter(F.col("group") == "OFI_PASS"), trades)
    blocked = wanted.filter(F.col("group") == "OFI_BLOCKED").select(
        "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price")
    )
    rebuilt = exits.resolved(reconstruct(blocked, bars, rules))
    cols = ["date", "symbol", "group", "reason", "pnl_pct", "win"]
    return passed.withColumn("group", F.lit("OFI_PASS")).select(*cols).unionByName(
        rebuilt.withColumnRenamed("entry_date", "date").withColumn("group", F.lit("OFI_BLOCKED"))
        .withColumn("win", F.col("reason") == "TP").select(*cols)
    )


def gate_quality(rows: DataFrame) -> DataFrame:
    def share(reason: str) -> Column:
        return F.avg((F.col("reason") == reason).cast("double")) * 100

    return rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), share("TP").alias("tp_pct"), share("SL").alias("sl_pct"),
        share("TRAIL_BE").alias("trail_pct"), F.avg("pnl_pct").alias("mean_pnl_pct"),
        F.avg(F.col("win").cast("double")).alias("win_rate"),
        (F.count(F.lit(1)) < 30).alias("small_sample"),
    )


def in_window(df: DataFrame, date: str, start: Column, end: Column) -> DataFrame:
    return df.filter(F.col(date).between(start, end))


def on_keys(predicted: DataFrame, live: DataFrame) -> DataFrame:
    """Predicted trades restricted to the (entry_date, symbol) the live side took."""
    return predicted.join(live.select("entry_date", "symbol"), ["entry_date", "symbol"], "left_semi")
