"""Record schemas, stored-table specs and the adapter from the driver's tables.

Schemas are fixed and declared, never inferred. ``from_json`` treats a schema
as a projection: unknown fields are ignored, missing ones are null, and every
field comes back nullable, so non-null keys are validated explicitly
(see ``functions.decode.split_decoded``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _s(name: str, dtype=StringType(), nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


# Field names, order and types of the wire records.
METRICS = StructType([
    _s("id", nullable=False),
    _s("timestamp", TimestampType()),
    _s("microservice_id"),
    _s("operation_type"),
    _s("action_id"),
    _s("user_id"),
    _s("value", IntegerType()),
])

LOGS = StructType([
    _s("id", nullable=False),
    _s("timestamp", TimestampType()),
    _s("level"),
    _s("microservice_id"),
    _s("operation_type"),
    _s("action_id"),
    _s("user_id"),
])

# The producer also sends ``message``; parity projections drop it.
LOGS_WITH_MESSAGE = StructType(LOGS.fields + [_s("message")])

RESOURCES = StructType([
    _s("id"),
    _s("timestamp", TimestampType()),
    _s("microservice_id"),
    _s("cpu", IntegerType()),
    _s("ram", IntegerType()),
])

# What the windowed counts read of a metrics message: a bad value or a missing
# id does not keep a message from being counted.
COUNTED = StructType([
    _s("timestamp", TimestampType()),
    _s("operation_type"),
    _s("action_id"),
    _s("user_id"),
])

# What the rolling detector reads of a metrics message.
DETECTED = StructType([
    _s("timestamp", TimestampType()),
    _s("user_id"),
    _s("value", IntegerType()),
])

# Event kinds of the reference's streams.
# "Transactions" count these kinds (TRANSACTION itself is not among them).
TRANSACTION_KINDS = ["VIEW", "BUY", "CANCEL", "REFUND"]

# Fixed value: retention of every stored row, seconds after write.
TTL_SECONDS = 2_640_000


@dataclass(frozen=True)
class TableSpec:
    """A stored table: schema, primary key, clustering order, partitioning, TTL.

    ``key`` columns identify a row: a later write with the same key replaces
    the earlier one. ``order`` is the clustering order inside one key prefix
    (first key column), as (column, descending) pairs.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    order: tuple[tuple[str, bool], ...] = ()
    ttl_seconds: int | None = TTL_SECONDS
    time_column: str = "timestamp"


def _counts(name: str) -> StructType:
    return StructType([
        _s("timestamp", TimestampType()),
        StructField(name, LongType(), False),
        StructField("distinct_users", LongType(), False),
        _s("dummy_id"),
    ])


BURSTS = StructType([
    _s("timestamp", TimestampType()),
    _s("action_id"),
    _s("user_id"),
    StructField("count", LongType(), False),
    _s("dummy_id"),
])

# The reference's tables and keys.
TABLES: dict[str, TableSpec] = {
    "metrics": TableSpec("metrics", METRICS, ("microservice_id", "operation_type", "id")),
    "logs": TableSpec("logs", LOGS_WITH_MESSAGE, ("action_id", "id")),
    "resources": TableSpec("resources", RESOURCES, ("microservice_id", "id")),
    "metrics_ddos": TableSpec("metrics_ddos", BURSTS, ("user_id", "timestamp", "count"),
                              order=(("timestamp", True), ("count", True))),
    "views": TableSpec("views", _counts("views"), ("timestamp",)),
    "transactions": TableSpec("transactions", _counts("transactions"), ("timestamp",)),
}


def _sketched(name: str) -> StructType:
    return StructType([
        _s("timestamp", TimestampType()),
        StructField(name, LongType(), False),
        _s("users_sketch", BinaryType()),
        _s("dummy_id"),
    ])


# The minute tables with a mergeable sketch of the users in place of their number.
SKETCH_TABLES: dict[str, TableSpec] = {
    name: TableSpec(f"{name}_sketch", _sketched(name), ("timestamp",)) for name in ("views", "transactions")
}

# Closed rolling frames of a user above the detector's threshold (``streaming.attackers``).
ATTACKERS = TableSpec("attackers", StructType([
    _s("user_id"), _s("timestamp", TimestampType()), StructField("rolling_count", LongType(), False),
]), ("user_id", "timestamp"), order=(("timestamp", True),))

# ---------------------------------------------------------------------------
# Adapter from the driver's ``events`` table to the metrics vocabulary.
# operation_type := event_type, timestamp := ts, action_id := props.k
# ---------------------------------------------------------------------------

def action_id(props: Column | str = "props") -> Column:
    return F.get_json_object(F.col(props) if isinstance(props, str) else props, "$.k")


def events_as_metrics(events: DataFrame) -> DataFrame:
    """Rename ``events`` columns to the metrics names the operators use.

    Types are kept (``timestamp`` stays ``timestamp_ntz``, ``user_id`` bigint,
    ``value`` double) so results compare 1:1 with SQL over the same table.
    """
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("operation_type"),
        action_id("props").alias("action_id"),
        F.col("user_id"),
        F.col("value"),
    )


# The driver's ``events`` table, as stored (event time is zone-less).
EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    _s("event_type"),
    StructField("value", DoubleType()),
    _s("props"),
])

# ``events`` as it travels through a stream: event time must be a
# TIMESTAMP (with zone) for watermarks.
EVENTS_WIRE = StructType([
    f if f.name != "ts" else StructField("ts", TimestampType()) for f in EVENTS.fields
])
