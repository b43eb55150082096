"""Sinks: keyed upsert tables, day archives, extracts, publishing (SNK1-6)."""

from .archive import archive_day, archive_frame, archive_range, month_ago_date, write_extract
from .keyed import KeyedTable, latest_per_key, retained
from .publish import publish_kafka, publish_text
from .text import csv_options

__all__ = [
    "KeyedTable",
    "archive_day",
    "archive_frame",
    "archive_range",
    "csv_options",
    "latest_per_key",
    "month_ago_date",
    "publish_kafka",
    "publish_text",
    "retained",
    "write_extract",
]
