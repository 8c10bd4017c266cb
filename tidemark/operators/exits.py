"""First exit of a position over the bars after its entry.

The k-th later bar lies at least k days after the entry, so a position with a time limit of ``max_hold``
days is settled within ``max_hold`` later bars. Each bar therefore carries its next few bars as a small
array, and a position finds its whole future with one equi join on (symbol, entry date) instead of a
range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import RULES, Rules
from ..session import materialize
from . import intervals, series

EXIT_TYPE = "struct<exit_date:date,reason:string,exit_price:double,pnl_pct:double,hold_days:int,exit_open:double>"


def with_path(bars: DataFrame, horizon: int | None = None, rows: int = series.BLOCK_ROWS, rules: Rules = RULES) -> DataFrame:
    """Add ``path``: the next ``horizon`` bars of the symbol in order, as many as ``rules`` may hold a position unless given.
    Needs ``rn``. The path carries its horizon, and exits for rules that look further ahead are refused."""
    horizon = rules.max_hold if horizon is None else horizon
    ahead = series.block_window().rowsBetween(1, horizon)
    bar = F.struct("date", "open", "high", "low", "close")
    return series.owned(
        series.blocks(bars, 0, horizon, rows).withColumn("path", path_column(F.collect_list(bar).over(ahead), horizon))
    )


def path_column(path: Column, horizon: int) -> Column:
    return path.alias("path", metadata={"horizon": horizon})


def require_horizon(placed: DataFrame, rules: Rules) -> None:
    """A path known to be shorter than the time limit would leave positions open without a word."""
    horizon = next((f.metadata.get("horizon") for f in placed.schema.fields if f.name == "path"), None)
    if horizon is not None and horizon < rules.max_hold:
        raise ValueError(f"paths of {horizon} bars cannot settle positions held for up to {rules.max_hold} days")


def at_entry(positions: DataFrame, paths: DataFrame) -> DataFrame:
    """Positions (symbol, entry_date, entry_price, ...) with the entry bar's high and path. A position
    whose entry day has no bar keeps a null path."""
    entry = paths.select("symbol", F.col("date").alias("entry_date"), F.col("high").alias("entry_high"), "path")
    return positions.join(entry, ["symbol", "entry_date"], "left")


def position_bars(placed: DataFrame) -> DataFrame:
    """One row per position and later bar, ``k`` counting from 1."""
    return placed.select("*", F.posexplode("path").alias("_k", "bar")).select(
        *[c for c in placed.columns if c != "path"], (F.col("_k") + 1).alias("k"), "bar.*"
    )


def armed_path(placed: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Whether the stop is armed before each later bar: an earlier bar, or the entry bar's own high, has
    reached the trigger. The earlier bars are the front of the position's own path."""
    trigger = levels(F.col("entry_price"), rules)["trigger"]
    seed = F.coalesce(F.col("entry_high") >= trigger, F.lit(False))
    bars = placed.select("symbol", "entry_date", "entry_price", "entry_high", F.posexplode("path").alias("k0", "_bar"), "path")
    before = F.exists(F.slice("path", F.lit(1), F.col("k0")), lambda b: b["high"] >= trigger)
    return bars.select("symbol", "entry_date", (F.col("k0") + 1).alias("k"), (seed | before).alias("armed"))


def levels(entry: Column, rules: Rules | None = None, **columns: Column) -> dict[str, Column]:
    """Target, stop and trigger prices. ``columns`` may replace rates by columns (parameter sweeps)."""
    rules = rules or RULES
    rate = {name: columns.get(name, F.lit(getattr(rules, name))) for name in ("take_profit", "stop_loss", "trigger")}
    return {
        "target": entry * (1 + rate["take_profit"]),
        "stop": entry * (1 - rate["stop_loss"]),
        "trigger": entry * (1 + rate["trigger"]),
        **{f"{name}_rate": value for name, value in rate.items()},
    }


def bar_exit(entry: Column, entry_date: Column, bar: Column, armed: Column, level: dict[str, Column],
             rules: Rules) -> Column:
    """The exit at one bar as EXIT_TYPE, or null to hold. The target is tested before the stop; an armed
    stop fills no better than the open."""
    hold = F.datediff(bar["date"], entry_date)
    fill = F.least(level["trigger"], bar["open"])
    plain = F.least(level["stop"], bar["open"]) if rules.gap_aware_stop else level["stop"]
    plain_pct = (plain - entry) / entry if rules.gap_aware_stop else -level["stop_loss_rate"]

    def out(reason: str, price: Column, pct: Column) -> Column:
        return F.struct(
            bar["date"].alias("exit_date"), F.lit(reason).alias("reason"), price.alias("exit_price"),
            pct.alias("pnl_pct"), hold.alias("hold_days"), bar["open"].alias("exit_open"),
        ).cast(EXIT_TYPE)

    return (
        F.when(bar["high"] >= level["target"], out("TP", level["target"], level["take_profit_rate"]))
        .when(armed & (bar["low"] <= level["trigger"]), out("TRAIL_BE", fill, (fill - entry) / entry))
        .when(~armed & (bar["low"] <= level["stop"]), out("SL", plain, plain_pct))
        .when(hold >= rules.max_hold, out("MAX_HOLD", bar["close"], (bar["close"] - entry) / entry))
    )


def first_exit(placed: DataFrame, rules: Rules = RULES, **rates: Column) -> DataFrame:
    """Add exit_date, reason, exit_price, pnl_pct, hold_days and exit_open; all null while unresolved.

    ``placed`` comes from ``at_entry``. The first bar of the path that meets any exit condition settles the
    position; whether the stop is armed at a bar depends on earlier highs only (the entry bar's own high
    and the path before that bar).
    """
    require_horizon(placed, rules)
    entry, entry_date, path = F.col("entry_price"), F.col("entry_date"), F.col("path")
    level = levels(entry, rules, **rates)
    kept = [c for c in placed.columns if c != "path"]
    known = {**level, "target": F.col("_target"), "stop": F.col("_stop"), "trigger": F.col("_trigger")}
    bars = [F.get(path, F.lit(k)) for k in range(rules.max_hold)]

    # the bar from which on the stop is armed: the one after the first touch of the trigger
    touches = [bar["high"] >= known["trigger"] for bar in bars]
    if rules.seed_entry_day:
        touches = [F.col("entry_high") >= known["trigger"], *touches]
    first_armed = 1 if rules.seed_entry_day else 2
    armed_from = F.lit(rules.max_hold + 2)
    for k, touch in reversed(list(enumerate(touches, first_armed))):
        armed_from = F.when(touch, k).otherwise(armed_from)

    # the first bar with an exit
    at = F.lit(None).cast("int")
    for k, bar in reversed(list(enumerate(bars, 1))):
        floor = F.when(F.col("_armed_from") <= k, known["trigger"]).otherwise(known["stop"])
        overdue = F.datediff(bar["date"], entry_date) >= rules.max_hold
        at = F.when((bar["high"] >= known["target"]) | (bar["low"] <= floor) | overdue, k).otherwise(at)

    found = (
        placed.select("*", level["target"].alias("_target"), level["stop"].alias("_stop"), level["trigger"].alias("_trigger"))
        .withColumn("_armed_from", armed_from)
        .withColumn("_at", at)
    )
    # generated columns, not expressions: what follows reads the bar without repeating the search
    names = ["_date", "_open", "_high", "_low", "_close"]
    hit = found.select(
        *kept, "_target", "_stop", "_trigger", (F.col("_at") >= F.col("_armed_from")).alias("_armed"),
        F.inline_outer(F.slice(path, F.col("_at"), F.lit(1))).alias(*names),
    )
    bar = {n[1:]: F.col(n) for n in names}
    settled = hit.withColumn("_exit", bar_exit(entry, entry_date, bar, F.col("_armed"), known, rules))
    return settled.select(*kept, "_exit.*")


def resolved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())


def unresolved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def final_close(open_positions: DataFrame, bars: DataFrame) -> DataFrame:
    """Close unresolved positions at the symbol's last close, dated at the last day of the whole calendar."""
    last = bars.groupBy("symbol").agg(F.max_by("close", "date").alias("exit_price"))
    end = bars.agg(F.max("date").alias("exit_date"))
    drop = ["exit_date", "reason", "exit_price", "pnl_pct", "hold_days", "exit_open"]
    base = open_positions.drop(*drop)
    entry = F.col("entry_price")
    # one row: the broadcast is bounded
    return (
        base.join(last, "symbol").crossJoin(F.broadcast(end))
        .withColumn("reason", F.lit("FINAL_CLOSE"))
        .withColumn("pnl_pct", (F.col("exit_price") - entry) / entry)
        .withColumn("hold_days", F.datediff("exit_date", "entry_date"))
    )


def check_day(positions: DataFrame, bars: DataFrame, run_date: Column, rules: Rules = RULES) -> DataFrame:
    """The daily check of open positions against yesterday's complete bar, with no fallback to another bar.

    ``bars`` needs ``rn`` and is read by several branches. The result keeps positions whose check bar exists and lies at
    least a day after the entry: ``reason`` is null while they are held, and ``unrealised`` is their open
    result. Earlier bars of the holding period, the entry day included, may have armed the stop.
    """
    check = F.date_sub(run_date, 1)
    held = positions.withColumn("check_date", check).filter(F.datediff("check_date", "entry_date") >= 1)
    # the highest bar from the entry day to the day before the check, however long the position has been held
    held = materialize(intervals.highest(bars, held, F.col("entry_date"), F.date_sub("check_date", 1), name="_high"))
    bar = bars.select("symbol", F.col("date").alias("check_date"), F.struct("date", "open", "high", "low", "close").alias("bar"))
    entry = F.col("entry_price")
    level = levels(entry, rules)
    joined = held.join(bar, ["symbol", "check_date"]).withColumn("armed", F.coalesce(F.col("_high") >= level["trigger"], F.lit(False)))
    outcome = bar_exit(entry, F.col("entry_date"), F.col("bar"), F.col("armed"), level, rules)
    return joined.withColumn("_exit", outcome).select(
        *[c for c in held.columns if c != "_high"], "armed", "_exit.*",
        F.when(F.col("_exit").isNull(), (F.col("bar.close") - entry) / entry).alias("unrealised"),
        level["target"].alias("target"),
        F.when(F.col("armed"), level["trigger"]).otherwise(level["stop"]).alias("effective_stop"),
    )


def skipped(positions: DataFrame, bars: DataFrame, run_date: Column) -> DataFrame:
    """Positions the daily check passes over because yesterday's bar is missing."""
    check = positions.withColumn("date", F.date_sub(run_date, 1))
    return check.join(bars.select("symbol", "date"), ["symbol", "date"], "left_anti").drop("date")


def reason_text(reason: Column, hold_days: Column) -> Column:
    """The daily run writes the held days into the time exit; the replay does not."""
    return F.when(reason == "MAX_HOLD", F.format_string("MAX_HOLD_%dd", hold_days)).otherwise(reason)
