"""Keyed state over daily rows: the latched halt per account and open positions per symbol.

Input rows are daily aggregates, so one key brings at most one row a day whatever the number of raw events
behind it, and sorting a key's rows of one batch stays small. State lives in the session's store (``session.prepare`` chooses the one on disk);
a position is an entry of its own there, so a bar rewrites the positions it touches and nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..params import RULES, Rules

HALT_OUT = "account string, date date, balance double, peak double, halted boolean"


class Halts(StatefulProcessor):
    """One value per account: balance, peak and halt."""

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.account = handle.getValueState("account", "balance double, peak double, halted boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        start = self.rules.start_balance
        balance, peak, halted = self.account.get() if self.account.exists() else (start, start, False)
        for row in sorted(rows, key=lambda r: r.date):
            balance += row.net
            fresh = getattr(row, "new_peak", None)
            peak = max(float(fresh) if row.reset and fresh is not None else peak, balance)
            tripped = (peak - balance) / peak >= self.rules.halt_drawdown if peak > 0 else False
            halted = bool((halted and not row.reset) or tripped)
            yield Row(account=key[0], date=row.date, balance=float(balance), peak=float(peak), halted=halted)
        self.account.update((float(balance), float(peak), bool(halted)))

    def close(self) -> None:
        pass


def latched_halt(daily: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Balance, peak and halt of each account after each day. A reset clears the halt before the day's
    check; it leaves the peak unless the row has a ``new_peak``, which then takes its place."""
    return daily.groupBy("account").transformWithState(Halts(rules), HALT_OUT, "append", "None")


EXIT_OUT = ("symbol string, entry_date date, exit_date date, reason string, hold_days int, exit_price double, "
            "pnl_pct double, entry_price double")
LATE, STALE = "LATE_BAR", "STALE"
EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000


def settle(entry: float, hold: int, armed: bool, bar, rules: Rules) -> tuple[str, float, float] | None:
    """(reason, exit price, result) of one position at one later bar, or None."""
    target, stop, trigger = entry * (1 + rules.take_profit), entry * (1 - rules.stop_loss), entry * (1 + rules.trigger)
    if bar.high >= target:
        return "TP", target, rules.take_profit
    if armed and bar.low <= trigger:
        fill = min(trigger, bar.open)
        return "TRAIL_BE", fill, (fill - entry) / entry
    if not armed and bar.low <= stop:
        return "SL", stop, -rules.stop_loss
    if hold >= rules.max_hold:
        return "MAX_HOLD", bar.close, (bar.close - entry) / entry
    return None


class Positions(StatefulProcessor):
    """A map from entry day to price, armed and last bar seen, and one timer per symbol for the day its positions go stale."""

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "entry int", "price double, armed boolean, seen int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rules = self.rules
        held = {k[0]: tuple(v) for k, v in self.open.iterator()} if self.open.exists() else {}
        before = dict(held)
        for bar in sorted(rows, key=lambda r: r.date):
            today = (bar.date - EPOCH).days
            for entry, (price, armed, seen) in sorted(held.items()):
                entered = EPOCH + dt.timedelta(days=entry)
                if today <= seen:
                    yield self._row(key[0], entered, bar.date, LATE, None, None, None, price)
                    continue
                done = settle(price, today - entry, armed, bar, rules)
                if done:
                    del held[entry]
                    yield self._row(key[0], entered, bar.date, done[0], today - entry, float(done[1]), float(done[2]), price)
                else:
                    held[entry] = (price, bool(armed or bar.high >= price * (1 + rules.trigger)), today)
            if bar.enter:
                seeded = rules.seed_entry_day and bar.high >= bar.close * (1 + rules.trigger)
                held[today] = (float(bar.close), bool(seeded), today)
        for entry in before.keys() - held.keys():
            self.open.removeKey((entry,))
        for entry, value in held.items():
            if before.get(entry) != value:
                self.open.updateValue((entry,), value)
        self._wake(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Positions without a bar for ``stale_after_days`` are reported and forgotten."""
        now = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS
        held = {k[0]: tuple(v) for k, v in self.open.iterator()} if self.open.exists() else {}
        for entry, (price, _, seen) in sorted(held.items()):
            if seen + self.rules.stale_after_days <= now:
                del held[entry]
                self.open.removeKey((entry,))
                yield self._row(key[0], EPOCH + dt.timedelta(days=entry), EPOCH + dt.timedelta(days=int(now)), STALE, None, None, None, price)
        self._wake(held)

    def _wake(self, held: dict) -> None:
        due = (min(seen for _, _, seen in held.values()) + self.rules.stale_after_days) * DAY_MS if held else None
        set_ = list(self.handle.listTimers())
        for timer in set_:
            if timer != due:
                self.handle.deleteTimer(timer)
        if due is not None and due not in set_:
            self.handle.registerTimer(due)

    @staticmethod
    def _row(*values) -> Row:
        return Row(*[c.split()[0] for c in EXIT_OUT.split(", ")])(*values)

    def close(self) -> None:
        pass


def position_exits(bars: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Exits as bars arrive, ``enter`` marking an entry at the close.

    Every position keeps the date of the last bar it has seen. A bar that is not later is not applied to it, and is reported
    as a row with reason ``LATE_BAR``, the bar's date and no price, so that late data can be counted; bars of the entry day or before
    that arrive after the entry are such. The watermark follows the newest bar of all symbols by ``stale_after_days`` days; older bars are dropped. A position
    whose last bar lies as many days behind the watermark leaves with the reason ``STALE`` and no price, so the state is bounded by what
    can still be settled.
    """
    timed = bars.withColumn("at", F.col("date").cast("timestamp")).withWatermark("at", f"{rules.stale_after_days} days")
    return timed.groupBy("symbol").transformWithState(Positions(rules), EXIT_OUT, "append", "EventTime")
