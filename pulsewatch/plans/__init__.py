"""Composite plans: the reference's jobs and dashboard panel queries."""

from . import applications, panels, telemetry

__all__ = ["applications", "panels", "telemetry"]
