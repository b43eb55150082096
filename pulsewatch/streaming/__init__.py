"""Structured Streaming runners (EVT3-6)."""

from .jobs import TRIGGERS, StreamSpec, run_available, run_together, start

__all__ = ["TRIGGERS", "StreamSpec", "run_available", "run_together", "start"]
