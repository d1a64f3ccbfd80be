"""Structured Streaming jobs."""

from .bronze import BronzeStream

__all__ = ["BronzeStream"]
