"""Which candidates of a day are entered, and why the others are not.

Candidates are walked by falling probability (ties by symbol); every entry takes a slot; the first
candidate met when all slots are taken is logged as MAX_POSITIONS and the rest of the day is not logged.
No day is ordered as a whole: at most ``max_positions`` entries can happen, so they are a top-k per day
(cut per map task before the shuffle), the candidate after the last entry is one minimum per day, and
every other row is decided against that one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..params import RULES, Rules


NO_STATE = "NO_ACCOUNT_STATE"


def position_key() -> Column:
    """Sorts like the walk: probability falling, then symbol."""
    return F.struct((-F.col("prob")).alias("p"), F.col("symbol").alias("s"))


def ranked(cands: DataFrame, k: int) -> DataFrame:
    """The first ``k`` candidates of each day in walking order."""
    w = Window.partitionBy("date").orderBy(F.col("prob").desc(), F.col("symbol"))
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def trade_size(balance: Column, rules: Rules = RULES) -> Column:
    return balance * rules.risk_per_trade / rules.max_positions


def planned_levels(entry: Column, rules: Rules = RULES) -> list[Column]:
    return [
        (entry * (1 + rules.take_profit)).alias("target"),
        (entry * (1 - rules.stop_loss)).alias("stop"),
        (entry * (1 + rules.trigger)).alias("trigger"),
    ]


def reject_reason(rules: Rules = RULES, extended: bool = False) -> Column:
    """The reason of a candidate met while a slot is free; NONE means entry. Expects halted, in_position,
    prob, ofi and trade_size. ``extended`` also expects insufficient and names it instead of a probability
    of 0."""
    known = F.col("halted").isNotNull() & F.col("n_open").isNotNull() & F.col("trade_size").isNotNull()
    first = F.when(~known, F.lit(NO_STATE))
    first = first.when(F.col("halted"), F.lit("KILL_SWITCH_HALTED")).when(F.col("in_position"), F.lit("ALREADY_IN_POS"))
    if extended:
        first = first.when(F.col("insufficient"), F.lit("INSUFFICIENT_DATA"))
    prob, ofi = F.coalesce("prob", F.lit(0.0)), F.coalesce("ofi", F.lit(0.0))
    return (
        first.when(~(prob >= rules.signal_threshold) | F.isnan(prob), S.prob_too_low(prob))
        .when(~(ofi > rules.flow_gate) | F.isnan(ofi), S.flow_negative(ofi))
        .when(F.col("trade_size") < rules.min_order, F.lit("MIN_ORDER_SIZE"))
        .otherwise(F.lit("NONE"))
    )


def one_state(days: DataFrame) -> DataFrame:
    """One row per day; two rows that differ are an error, not a choice."""
    same = lambda c: F.min(c).eqNullSafe(F.max(c)) & ((F.count(c) == 0) | (F.count(c) == F.count("*")))
    checked = F.when(same("n_open") & same("halted") & same("balance"), F.min("n_open")).otherwise(
        F.raise_error(F.concat(F.lit("two account states for "), F.col("date").cast("string"))).cast("int"))
    return days.groupBy("date").agg(checked.alias("n_open"), F.min("halted").alias("halted"), F.min("balance").alias("balance"))


def admit(cands: DataFrame, days: DataFrame, rules: Rules = RULES, extended: bool = False) -> DataFrame:
    """Logged candidates with ``reject_reason``.

    ``cands``: date, symbol, prob, ofi, in_position, close; unique per (date, symbol).
    ``days``: n_open, halted and balance per day. Every broadcast here is made unique per day first, so it
    has at most 366 small rows a year. Whatever is unknown closes the gate: a null probability or flow counts as 0,
    a null in_position or insufficient as false, and all candidates of a day without a state, or with a null in it, are logged as
    ``NO_STATE``.
    ``cands`` is read by three branches: pass a table or a materialized frame.
    """
    unknown = {c: F.coalesce(c, F.lit(0.0)) for c in ("prob", "ofi")}
    unknown |= {c: F.coalesce(c, F.lit(False)) for c in ("in_position", "insufficient") if c in cands.columns}
    cands = cands.withColumns(unknown)
    days = one_state(days)
    day = F.broadcast(days.withColumn("slots", F.greatest(rules.max_positions - F.col("n_open"), F.lit(0))))
    rows = (
        cands.join(day, "date", "left")
        .withColumn("trade_size", trade_size(F.col("balance"), rules))
        .withColumn("own_reason", reject_reason(rules, extended))
        .withColumn("key", position_key())
    )
    w = Window.partitionBy("date").orderBy("key")
    entries = (
        rows.filter((F.col("own_reason") == "NONE") & (F.col("slots") > 0))
        .select("date", "key", "slots")
        .withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") <= rules.max_positions)
        .filter(F.col("_n") <= F.col("slots"))
    )
    # the walk reaches capacity after the entry that takes the last slot, or at once without a free slot
    last_entry = entries.filter(F.col("_n") == F.col("slots")).select("date", F.col("key").alias("last_key"))
    full = F.broadcast(
        days.filter(~F.col("halted")).select("date", "n_open").join(last_entry, "date", "left")
        .filter((F.col("n_open") >= rules.max_positions) | F.col("last_key").isNotNull())
        .select("date", F.lit(True).alias("fills"), "last_key")
    )
    placed = rows.join(full, "date", "left").withColumn("fills", F.coalesce("fills", F.lit(False)))
    after = F.col("fills") & (F.col("last_key").isNull() | (F.col("key") > F.col("last_key")))
    placed = placed.withColumn("after", after)
    cut = placed.filter("after").groupBy("date").agg(F.min("key").alias("cut_key"))
    logged = placed.join(F.broadcast(cut), "date", "left").filter(~F.col("after") | (F.col("key") == F.col("cut_key")))
    reason = F.when(F.col("after"), F.lit("MAX_POSITIONS")).otherwise(F.col("own_reason"))
    return logged.withColumn("reject_reason", reason).withColumn("signal_fired", F.col("reject_reason") == "NONE").drop(
        "own_reason", "key", "slots", "fills", "last_key", "after", "cut_key"
    )
