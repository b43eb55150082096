"""Starting and awaiting streaming queries (EVT3-EVT6).

Each query has its own checkpoint folder (never nested in another's) under
the shared checkpoint dir; recovery after a lost driver or executor replays
from it, and the keyed sink makes a replayed batch idempotent. Aggregates
run in append mode: a window is written once, after the watermark passes its
end. Several queries over one typed stream are started together and awaited
with ``awaitAnyTermination``, so a failure of any query is seen at once.

Watermark note: Catalyst pushes a filter that does not reference event time
below the watermark, so each query's watermark follows the max event time of
the rows that pass its own filter, not of the whole stream (true of the
reference's jobs as well).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Micro-batch cadence of the reference's jobs (None: as fast as possible).
TRIGGERS: dict[str, str | None] = {
    "logs": "10 seconds",
    "metrics": "10 seconds",
    "aggregates": "5 seconds",
    "resources": "2 seconds",
    "ddos": None,
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class StreamSpec:
    """One streaming query: its plan, sink and checkpoint.

    ``sink`` is a ``foreachBatch`` function (df, batch_id) or a format name.
    ``trigger`` is a processing-time interval, ``"availableNow"`` or None.
    ``state_partitions`` sets the number of state-store partitions of a new
    query (kept in its checkpoint from then on); None keeps the session's
    ``spark.sql.shuffle.partitions``. ``rocksdb`` keeps a new query's state
    in RocksDB, off the heap, instead of the session's store.
    """

    name: str
    df: DataFrame
    checkpoint: str
    sink: Callable[[DataFrame, int], None] | str
    trigger: str | None = None
    output_mode: str = "append"
    options: dict[str, str] = field(default_factory=dict)
    state_partitions: int | None = None
    rocksdb: bool = False


def start(spec: StreamSpec) -> StreamingQuery:
    """Start one query. The query copies the session's settings when it
    starts, so its own are set only around ``start()``."""
    conf = spec.df.sparkSession.conf
    own = {"spark.sql.shuffle.partitions": str(spec.state_partitions)} if spec.state_partitions else {}
    if spec.rocksdb:
        own["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    before = {key: conf.get(key) for key in own}
    for key, value in own.items():
        conf.set(key, value)
    try:
        return _start(spec)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _start(spec: StreamSpec) -> StreamingQuery:
    w = (spec.df.writeStream.queryName(spec.name)
         .outputMode(spec.output_mode)
         .option("checkpointLocation", spec.checkpoint)
         .options(**spec.options))
    if callable(spec.sink):
        w = w.foreachBatch(spec.sink)
    else:
        w = w.format(spec.sink)
    if spec.trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif spec.trigger:
        w = w.trigger(processingTime=spec.trigger)
    return w.start()


def run_together(spark: SparkSession, specs: Sequence[StreamSpec],
                 timeout: float | None = None) -> list[StreamingQuery]:
    """EVT6: start all, wait for the first to end (or fail), stop the rest."""
    spark.streams.resetTerminated()  # queries that ended or failed earlier in the session are not ours
    queries = [start(s) for s in specs]
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        spark.streams.resetTerminated()
    return queries


@contextmanager
def running(specs: Sequence[StreamSpec]) -> Iterator[list[StreamingQuery]]:
    """EVT4: the queries at their own cadence for as long as the block lasts; then they are stopped.

    Use :func:`caught_up` inside to wait until all input that is there by then has been written.
    """
    queries = [start(s) for s in specs]
    try:
        yield queries
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        for q in queries:
            if q.exception() is not None:
                raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def caught_up(queries: Sequence[StreamingQuery]) -> None:
    """Wait until every query has processed the input that was there when this was called."""
    for q in queries:
        q.processAllAvailable()


def run_available(specs: Sequence[StreamSpec]) -> list[StreamingQuery]:
    """Run each query over the input available now, to completion (tests, backfills).

    Surfaces the first query exception instead of leaving it in a thread.
    """
    queries = [start(StreamSpec(**{**s.__dict__, "trigger": "availableNow"})) for s in specs]
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
    return queries


def run_caught_up(specs: Sequence[StreamSpec]) -> list[StreamingQuery]:
    """As :func:`run_available`, for sources without available-now support of their own (``sources.segments``).

    Spark reads such a source in a single batch under that trigger and leaves the windows and timers which the
    batch's watermark closes to a later one. Here the queries run as fast as they can until nothing is left to do.
    """
    with running([StreamSpec(**{**s.__dict__, "trigger": None}) for s in specs]) as queries:
        caught_up(queries)
        return list(queries)
