"""What a stream dropped behind its watermark (EVT3).

In append mode a row whose window is already final is dropped, and neither the sink nor
the query says so. Spark counts these rows in every stateful operator; :class:`LateRows`
is a query listener that adds the counts up per query.

What is counted are the rows that reach the operator, after partial aggregation: for a
windowed count, one per late (group, window) of a micro-batch, however many late
messages fell into it.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Late rows per query name; register it with :meth:`watch` before the queries start."""

    def __init__(self) -> None:
        self._lock = threading.Condition()
        self._late: dict[tuple[str, int], int] = {}
        self._ended: set[str] = set()
        self._names: dict[str, str] = {}

    # -- listener callbacks (in the order of the listener bus) ----------------------------
    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802 - Spark's interface
        with self._lock:
            self._names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        progress = event.progress
        dropped = sum(max(0, s.numRowsDroppedByWatermark) for s in progress.stateOperators)
        name = progress.name or str(progress.id)
        with self._lock:
            # A batch reports once a run; a batch that ran again after a restart replaces its report.
            self._late[name, progress.batchId] = max(dropped, self._late.get((name, progress.batchId), 0))

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    # -- use ------------------------------------------------------------------------------
    def watch(self, spark: SparkSession) -> LateRows:
        spark.streams.addListener(self)
        return self

    def forget(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def settle(self, queries: Sequence[StreamingQuery], timeout: float = 60.0) -> None:
        """Wait until the reports of ended ``queries`` have all arrived (they come asynchronously)."""
        wanted = {str(q.runId) for q in queries}
        until = time.monotonic() + timeout
        with self._lock:
            while not wanted <= self._ended:
                left = until - time.monotonic()
                if left <= 0 or not self._lock.wait(left):
                    missing = wanted - self._ended
                    if missing:
                        raise TimeoutError(f"no end reported for {len(missing)} streaming queries")

    def totals(self) -> dict[str, int]:
        """Late rows by query name, over all batches (0 where none was late)."""
        with self._lock:
            out: dict[str, int] = {}
            for (name, _), n in self._late.items():
                out[name] = out.get(name, 0) + n
            return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """``query``, ``late_rows``: one row per query."""
        return spark.createDataFrame(sorted(self.totals().items()), "query string, late_rows bigint")
