"""Explicit schemas of every table the engine reads or writes (Spark DDL)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and their order.
BARS = "symbol string, date date, open double, high double, low double, close double, volume double"
KLINES = "symbol string, ingest_seq bigint, k array<string>"
SENTIMENT = "date date, value int"
BOOK = "symbol string, ts timestamp, bids array<array<double>>, asks array<array<double>>"
SIGNALS = (
    "date date, symbol string, close double, ensemble_prob double, rf_prob double, xgb_prob double, "
    "signal_fired boolean, reject_reason string, ofi_value double, ofi_gate_pass string, "
    "rsi double, atr_pct double, in_position boolean"
)
TRADES = (
    "row_id string, date date, symbol string, action string, entry_price double, exit_price double, "
    "pnl_gross double, pnl_net double, fees double, reason string, hold_days int, win boolean, "
    "balance_after double, signal_prob double, rf_prob double, xgb_prob double, trade_size double, "
    "stop_order_id string, fill_qty double"
)
ACCOUNT_STATE = "run_ts timestamp, balance double, peak_balance double, halted boolean"
BACKTEST_TRADES = (
    "symbol string, entry_date date, exit_date date, entry_price double, exit_price double, hold_days int, "
    "reason string, trade_size double, pnl_gross double, pnl_net double, fees double, win boolean, "
    "signal_prob double"
)
EQUITY = "date date, balance double"
ORDER_STATUS = "stop_order_id string, status string, average double, filled double"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


def all_strings(ddl: str) -> T.StructType:
    """The same columns as text, for files whose cells are parsed leniently."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns(ddl)])
