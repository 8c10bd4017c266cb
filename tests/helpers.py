"""Small inputs and plain re-implementations to compare with."""

import datetime as dt

import numpy as np
import pandas as pd

from tidemark import schemas
from tidemark.operators import series

START = dt.date(2020, 1, 1)


def walk(symbol="X", n=400, seed=1, step=0.011, gaps=False, start=START):
    """A random daily walk as pandas rows."""
    rng = np.random.default_rng(seed)
    days = [start + dt.timedelta(days=i) for i in range(n)]
    if gaps:
        days = [d for d in days if rng.random() > 0.2]
    close = np.round(100 * np.exp(np.cumsum(rng.normal(0, step, len(days)))), 8)
    before = np.concatenate([[100.0], close[:-1]])
    opened = before * (1 + rng.normal(0, 0.002, len(days)))
    spread = rng.random(len(days)) * 0.012
    return pd.DataFrame({
        "symbol": symbol, "date": days, "open": opened, "high": np.maximum(opened, close) * (1 + spread),
        "low": np.minimum(opened, close) * (1 - spread), "close": close,
        "volume": rng.integers(1, 500, len(days)).astype(float),
    })


def bars_frame(spark, pdf):
    return spark.createDataFrame(pdf[schemas.columns(schemas.BARS)], schemas.BARS)


def numbered(spark, pdf):
    return series.ordinals(bars_frame(spark, pdf))


def plain_exit(entry_date, entry, rows, seeded, tp=0.03, sl=0.01, trig=0.015, hold_limit=5):
    """First exit by a loop over later (date, open, high, low, close) rows."""
    armed = seeded
    for date, o, h, low, c in rows:
        hold = (date - entry_date).days
        if h >= entry * (1 + tp):
            return date, "TP", entry * (1 + tp), hold
        if armed and low <= entry * (1 + trig):
            return date, "TRAIL_BE", min(entry * (1 + trig), o), hold
        if not armed and low <= entry * (1 - sl):
            return date, "SL", entry * (1 - sl), hold
        if hold >= hold_limit:
            return date, "MAX_HOLD", c, hold
        armed = armed or h >= entry * (1 + trig)
    return None
