"""Registered queries over the given tables."""

from . import q_basics, q_indicators, q_positions, q_research, q_results, q_streaming  # noqa: F401
from .registry import QUERIES
from .registry import SQL as _RENDER

SQL = {name: render() for name, render in _RENDER.items()}

__all__ = ["QUERIES", "SQL"]
