"""Sources: message streams, stored tables, file extracts (SRC1-4)."""

from .files import read_batches, read_csv_extract
from .streams import kafka_options, subscribe, text_stream
from .tables import read_driver_table, read_events, read_table

__all__ = [
    "kafka_options",
    "read_batches",
    "read_csv_extract",
    "read_driver_table",
    "read_events",
    "read_table",
    "subscribe",
    "text_stream",
]
