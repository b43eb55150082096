"""Driver queries on row positions: renumbered batches, indexed extracts, whole-table pairing, histories.

See :mod:`.registry` for the mapping of the ``events`` table to the
reference's vocabulary; ``SQL`` holds the DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import IndexedBatches, row_index, union_indexed
from ..operators.ordering import top_n_per_key
from ..operators.pairing import pair_tables
from ..operators.rolling import attackers
from ..schemas import EVENTS
from ..session import scratch_path
from ..sinks.archive import write_extract
from ..sources.files import read_csv_extract
from ..sources.tables import read_events
from .registry import BATCH_CUTOFF, DAY_FRAME, VIEW, _early

# Parameters of the driver queries.
HISTORY_ROWS = 10
RETIMED_THRESHOLD = 3
_ORDER = ["ts", "event_id"]


def _batches(spark, sf_dir: str) -> list[DataFrame]:
    ev = read_events(spark, sf_dir)
    return [ev.filter(_early()), ev.filter(~_early())]


def union_indexed_q(spark, sf_dir):
    """SET1: two batches appended and renumbered as one table."""
    return union_indexed(_batches(spark, sf_dir), _ORDER)


def appended_index(spark, sf_dir):
    """SET1 batch by batch: each append numbers its own rows only; the last one is replayed."""
    table = IndexedBatches(spark, scratch_path(spark, "indexed-batches"))
    one, two = _batches(spark, sf_dir)
    for number, batch in ((0, one), (1, two), (1, two)):
        table.append(number, batch, _ORDER)
    return table.read()


def csv_indexed(spark, sf_dir):
    """SET1 -> SNK6 -> SRC3: the renumbered table as an extract with its index column, read back with it."""
    path = write_extract(union_indexed(_batches(spark, sf_dir), _ORDER), scratch_path(spark, "indexed-extract"),
                         index_col="index")
    return read_csv_extract(spark, path, EVENTS, index_col="index")


def time_sorted(spark, sf_dir):
    """SRT1: every event and its place after a sort by time."""
    return row_index(read_events(spark, sf_dir).select("event_id", "ts"), _ORDER, "position")


def _sides(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = read_events(spark, sf_dir)
    views = ev.filter(F.col("event_type") == VIEW).select("event_id", "ts", "user_id", "value")
    clicks = ev.filter(F.col("event_type") == "click").select("event_id", "ts")
    return views, clicks


def paired_global(spark, sf_dir):
    """JOI1: the i-th view with the i-th click of the whole table."""
    views, clicks = _sides(spark, sf_dir)
    return pair_tables(views.select("event_id", "ts"), clicks, _ORDER, _ORDER, "view_", "click_")


def attackers_retimed(spark, sf_dir):
    """JOI1 -> SRT1 -> WIN2: views take the time of the click at their position, then the rolling detector."""
    views, clicks = _sides(spark, sf_dir)
    paired = pair_tables(views, clicks, _ORDER, _ORDER, "view_", "click_")
    rows = paired.select(F.col("view_user_id").alias("user_id"), F.col("click_ts").alias("ts"),
                         F.col("view_value").alias("value"))
    return attackers(rows, DAY_FRAME, RETIMED_THRESHOLD, "user_id", "ts", "value")


def user_histories(spark, sf_dir):
    """SRT2 + SRT3: the newest rows of every user, newest first."""
    return top_n_per_key(read_events(spark, sf_dir), HISTORY_ROWS, "user_id",
                         [F.col("ts").desc(), F.col("event_id").desc()], "place")


QUERIES = {
    "union_indexed": union_indexed_q,
    "appended_index": appended_index,
    "csv_indexed": csv_indexed,
    "time_sorted": time_sorted,
    "paired_global": paired_global,
    "attackers_retimed": attackers_retimed,
    "user_histories": user_histories,
}

_INDEXED_SQL = (f"SELECT *, row_number() OVER (ORDER BY ts >= TIMESTAMP '{BATCH_CUTOFF}', ts, event_id) - 1 AS \"index\" "
                "FROM events")
_PAIRS = """
WITH v AS (SELECT event_id, ts, user_id, value, row_number() OVER (ORDER BY ts, event_id) AS rn
           FROM events WHERE event_type = 'view'),
c AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'click')"""

SQL = {
    "union_indexed": _INDEXED_SQL,
    "appended_index": _INDEXED_SQL,
    "csv_indexed": _INDEXED_SQL,
    "time_sorted": "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events",
    "paired_global": f"""{_PAIRS}
SELECT rn, v.event_id AS view_event_id, v.ts AS view_ts, c.event_id AS click_event_id, c.ts AS click_ts
FROM v JOIN c USING (rn)""",
    "attackers_retimed": f"""{_PAIRS},
r AS (SELECT v.user_id, count(v.value) OVER (PARTITION BY v.user_id ORDER BY c.ts
        RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW) AS n FROM v JOIN c USING (rn))
SELECT user_id, max(n) AS peak_count FROM r GROUP BY user_id HAVING max(n) > {RETIMED_THRESHOLD}""",
    "user_histories": (
        "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events "
        f"QUALIFY place <= {HISTORY_ROWS}"
    ),
}
