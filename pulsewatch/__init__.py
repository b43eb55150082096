"""pulsewatch: service-telemetry analytics as Spark DataFrame plans.

Subpackages: ``functions`` (decode, time, columns), ``operators`` (filters,
windows, aggregates, rolling, pairing, evaluation, ordering), ``sources``,
``sinks``, ``plans`` (jobs, panels) and ``streaming`` (runners).
"""

from .session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path"]
