"""Layered match analytics on Spark: raw records to standings, batch and stream."""

from .plans.jobs import Lake, ensure_built, run_all, run_bronze, run_gold, run_silver
from .session import build_session

__all__ = [
    "Lake", "build_session", "ensure_built", "run_all", "run_bronze", "run_gold", "run_silver",
]
