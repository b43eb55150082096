"""Scalar building blocks: decoding, encoding, time and column helpers."""

from .columns import as_double
from .decode import (
    REJECT_STATUSES,
    decode,
    encode_json,
    parse_json,
    rejected,
    split_decoded,
    valid,
)
from .timefn import (
    TEXT_TIMESTAMP_FORMAT,
    duration_micros,
    epoch_seconds_to_timestamp,
    event_date,
    month_ago,
)

__all__ = [
    "REJECT_STATUSES",
    "TEXT_TIMESTAMP_FORMAT",
    "as_double",
    "decode",
    "duration_micros",
    "encode_json",
    "epoch_seconds_to_timestamp",
    "event_date",
    "month_ago",
    "parse_json",
    "rejected",
    "split_decoded",
    "valid",
]
