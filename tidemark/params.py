"""Strategy parameters. The defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    start_balance: float = 10_000.0
    risk_per_trade: float = 0.01
    max_positions: int = 3
    take_profit: float = 0.03
    stop_loss: float = 0.01
    trigger: float = 0.015
    max_hold: int = 5
    signal_threshold: float = 0.60
    flow_gate: float = 0.0
    fee: float = 0.0026
    min_order: float = 15.0
    halt_drawdown: float = 0.15
    train_window: int = 180
    holdout: int = 20
    min_history: int = 80
    stale_after_days: int = 90
    periods_per_year: int = 252
    # a plain stop fills at its level even below the open unless this is set
    gap_aware_stop: bool = False
    # the entry bar's own high may arm the stop
    seed_entry_day: bool = True

    @property
    def trade_size(self) -> float:
        return self.start_balance * self.risk_per_trade / self.max_positions


RULES = Rules()

# Indicator spans and levels.
RETURN_SPANS = [1, 2, 3, 5, 10, 20]
RSI_SPAN = 14
RSI_LOW = 30
RSI_HIGH = 70
ATR_SPAN = 14
REGIME_SPAN = 60
REGIME_QUANTILE = 0.75
EMA_SPANS = [20, 50]
BAND_SPAN = 20
VOLUME_SPAN = 20
VOLUME_TREND_SPAN = 5
EPSILON = 1e-10
SENTIMENT_DEFAULT = 50
SENTIMENT_FEAR = 25
SENTIMENT_GREED = 75
SENTIMENT_SPAN = 7
BOOK_DEPTH = 20
WINSOR_LOW = 0.01
WINSOR_HIGH = 0.99

# Model inputs in column order.
FEATURES = [
    "ret_1d", "ret_2d", "ret_3d", "ret_5d", "ret_10d", "ret_20d",
    "mom_5_20", "mom_sign",
    "rsi", "rsi_oversold", "rsi_overbought",
    "atr_pct", "atr_pct_z", "high_vol_regime",
    "price_ema20_ratio", "price_ema50_ratio", "ema20_ema50_ratio",
    "bb_position", "bb_width",
    "vol_z", "vol_trend",
    "hl_position", "range_pct",
    "dow",
    "fg_value", "fg_extreme_fear", "fg_extreme_greed", "fg_momentum",
]
