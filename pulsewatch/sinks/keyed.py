"""Keyed tables with last-write-wins and retention, on plain files (SNK1-3, SRT3).

The reference writes into a wide-column store whose primary key turns every
write into an upsert, with a TTL counted from write time. Here the same
semantics sit on Parquet folders under one path:

* ``log/event_date=D/query_id=Q/batch_id=N``: each micro-batch, with its
  ``write_time``. A replayed batch replaces its own folders, so the sink is
  idempotent. ``query_id`` is the stream id kept in the checkpoint: a fresh
  checkpoint restarts at batch 0 and must not overwrite earlier output.
* ``manifests/Q/N.json``: per batch its days, with rows and least and greatest write time.
* ``base/run=R/event_date=D``: the latest row per key of a day, as one compaction wrote it, with
  the bookkeeping columns.
* ``state/G.json``: one small file per generation: the last batch of each query that the base
  contains, the run that holds each day with its rows and write times, and
  ``as_of``. It is written last and created exclusively: readers see a generation only once it is
  whole, and of two compactions that run at once the later one fails and leaves nothing behind.
Rows that cannot be stored because a key column or the event time is null
are written with their batch, under the log's null day, and are read with
:meth:`KeyedTable.rejected` only.

**View.** The latest live row per key over the base and the batches it does
not contain. Within a query the batch number decides, whatever the clock
says; between queries the write time does; then every other column, so the
result is deterministic. It is a declarative aggregate (combined map-side).

**Retention.** ``as_of`` is always an argument, and rows written a TTL or
more before it are invisible to every reader.

**Compaction and purge.** :meth:`KeyedTable.compact` merges new batches into the days they
touch; other days keep their files. Where the key holds the event time, a day's keys are its own.
Elsewhere a key may have moved, so the days that hold an older row of a new
key are touched as well; finding them reads the base's key columns only. A key without any live
row keeps its latest one, unseen by readers, until :meth:`KeyedTable.purge` has made sure that it is
archived. Purge reads manifests and the state, never rows: it deletes contained batches, replaced
day folders, and days of which every row has expired.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DateType, LongType, StringType, StructField, StructType, TimestampType,
)

from ..functions.timefn import event_date
from ..operators.ordering import clustered
from ..schemas import TableSpec
from ..storage import AlreadyThere, Files
from .archive import ArchiveBook


BOOKKEEPING = StructType([
    StructField("write_time", TimestampType()), StructField("query_id", StringType()),
    StructField("batch_id", LongType()),
])
MANIFEST = StructType([
    StructField("query", StringType()), StructField("batch", LongType()),
    StructField("days", ArrayType(StructType([
        StructField("day", DateType()), StructField("folder", StringType()), StructField("rows", LongType()),
        StructField("least", LongType()), StructField("greatest", LongType())]))),
])


class CompactionConflict(RuntimeError):
    """Another compaction committed first; nothing of this one is left."""


@dataclass(frozen=True)
class Held:
    """Where the base holds a day: the run that wrote it, its rows, and its write times (microseconds)."""

    run: str
    rows: int
    least: int
    greatest: int


@dataclass(frozen=True)
class State:
    """What a generation of the base consists of."""

    generation: int = 0
    contains: dict[str, int] = field(default_factory=dict)
    as_of: dt.datetime | None = None
    days: dict[dt.date, Held] = field(default_factory=dict)

    def to_json(self) -> dict:
        return {"generation": self.generation, "contains": self.contains,
                "as_of": self.as_of.isoformat() if self.as_of else None,
                "days": {d.isoformat(): vars(h) for d, h in self.days.items()}}

    @classmethod
    def from_json(cls, raw: dict) -> State:
        return cls(raw["generation"], raw["contains"], dt.datetime.fromisoformat(raw["as_of"]) if raw["as_of"] else None,
                   {dt.date.fromisoformat(d): Held(**h) for d, h in raw["days"].items()})


def _micros(time: dt.datetime) -> int:
    """Microseconds since the epoch, as Spark reads a zone-less literal."""
    return int(time.replace(microsecond=0).timestamp()) * 1_000_000 + time.microsecond


def retained(df: DataFrame, as_of: dt.datetime | Column, ttl_seconds: int,
             time_col: str = "write_time") -> DataFrame:
    """SNK2: rows still alive at ``as_of`` (strictly younger than the TTL)."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.filter(F.col(time_col) > now - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key by the ``order`` columns; remaining columns break ties.

    One aggregate over one struct, so each column is shuffled once. Output
    columns keep the input order.
    """
    rest = [*order, *(c for c in df.columns if c not in key and c not in order)]
    picked = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def scan(spark: SparkSession, paths: Sequence[str], schema: StructType, base_path: str) -> DataFrame:
    """The Parquet files under ``paths``, or no rows if nothing was ever written."""
    if not paths:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).option("basePath", base_path).parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# Spark's folder name of a null partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class KeyedTable:
    """A stored table of :class:`schemas.TableSpec` at ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, spec: TableSpec, path: str, namespace: str = "pulsewatch"):
        self.spark = spark
        self.spec = spec
        self.path = path.rstrip("/")
        self.namespace = namespace
        self.files = Files(spark)
        self.columns = [f.name for f in spec.schema.fields]
        self.stored = StructType([*[StructField(f.name, f.dataType) for f in spec.schema.fields],
                                  *BOOKKEEPING.fields])

    # -- SNK1: writes ------------------------------------------------------
    def storable(self) -> Column:
        """True for rows whose key columns and event time are all known."""
        known = F.col(self.spec.time_column).isNotNull()
        for k in self.spec.key:
            known = known & F.col(k).isNotNull()
        return known

    def write_batch(self, df: DataFrame, batch_id: int, query_id: str = "batch",
                    write_time: dt.datetime | None = None, partitions: int | None = None) -> None:
        """Write one batch; re-writing the same (query_id, batch_id) replaces it.

        Batches of a query have ascending numbers. One pass writes the rows and
        those that cannot be stored (see :meth:`rejected`). A replay of a batch that a compaction already
        contains is left out by readers. ``partitions`` is the number of
        tasks to write with (by day and key ranges); without it AQE sizes the
        files of a batch job, and a stream's micro-batch is written as it is dealt.
        """
        wt = F.lit(write_time).cast("timestamp") if write_time else F.current_timestamp()
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema.fields]
        rows = df.select(*typed, wt.alias("write_time"), F.lit(query_id).alias("query_id"),
                         F.lit(int(batch_id)).cast("long").alias("batch_id"))
        dated = rows.withColumn("event_date", F.when(self.storable(), event_date(self.spec.time_column)))
        laid = dated.repartitionByRange(partitions, "event_date", *self.spec.key) if partitions \
            else dated.hint("rebalance", "event_date")
        (laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "query_id", "batch_id").parquet(f"{self.path}/log"))
        self._describe(query_id, int(batch_id))

    def _describe(self, query_id: str, batch_id: int) -> None:
        """Write the batch's manifest, from the files of the batch alone."""
        found = self.files.matching(f"{self.path}/log/event_date=*/query_id={query_id}/batch_id={batch_id}")
        folders = {f.rsplit("event_date=", 1)[1].split("/", 1)[0]: f for f in found}
        days = []
        if dated := {d: f for d, f in folders.items() if d != NO_DAY}:
            rows = scan(self.spark, list(dated.values()), StructType([*self.stored.fields, StructField("event_date", DateType())]),
                        f"{self.path}/log")
            days = [{"day": d.isoformat(), "folder": dated[d.isoformat()], **vars(h)} for d, h in self._per_day(rows, "").items()]
            for day in days:
                del day["run"]
        self.files.write_json(f"{self.path}/manifests/{query_id}/{batch_id}.json",
                              {"query": query_id, "batch": batch_id, "days": days})

    @staticmethod
    def _per_day(rows: DataFrame, run: str) -> dict[dt.date, Held]:
        """Rows and write times by day: one row a day reaches the driver."""
        micros = F.unix_micros("write_time")
        sums = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"), F.min(micros).alias("least"),
                                              F.max(micros).alias("greatest"))
        return {r["event_date"]: Held(run, r["rows"], r["least"], r["greatest"]) for r in sums.collect()}

    def _files(self) -> DataFrame:
        return scan(self.spark, [f"{self.path}/log"],
                    StructType([*self.stored.fields, StructField("event_date", DateType())]), f"{self.path}/log")

    def rejected(self) -> DataFrame:
        """Rows that could not be stored, with their bookkeeping columns."""
        return self._files().filter(F.col("event_date").isNull()).select(*self.stored.names)

    def foreach_batch(self, checkpoint: str, write_time: dt.datetime | None = None,
                      query_name: str | None = None, rejects_path: str | None = None,
                      partitions: int | None = None):
        """A ``foreachBatch`` function writing each micro-batch into this table.

        The query id is the one kept in the checkpoint: stable across restarts
        on that checkpoint and new for a fresh one. It is taken from the
        running query named ``query_name`` when given, else read once from
        the checkpoint's metadata file.

        With ``rejects_path`` the batch is the output of
        ``functions.decode.split_decoded``: rows with status 'ok' go to the
        table and the others (with status and raw text) to
        ``rejects_path/query_id=Q/batch_id=N``, replay-safe like the table.
        """
        state: dict[str, str] = {}

        def query_id(spark: SparkSession) -> str:
            if query_name:
                for q in spark.streams.active:
                    if q.name == query_name:
                        return q.id
            meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata")
            return meta.select(F.get_json_object("value", "$.id")).first()[0]

        def sink(batch: DataFrame, batch_id: int) -> None:
            if "query_id" not in state:
                state["query_id"] = query_id(batch.sparkSession)
            qid = state["query_id"]
            if rejects_path is None:
                self.write_batch(batch, batch_id, qid, write_time, partitions)
                return
            batch.persist()  # decoded once for the table and the rejects
            try:
                self.write_batch(batch.filter(F.col("status") == "ok"), batch_id, qid, write_time, partitions)
                (batch.filter(F.col("status") != "ok").write.mode("overwrite")
                 .parquet(f"{rejects_path.rstrip('/')}/query_id={qid}/batch_id={int(batch_id)}"))
            finally:
                batch.unpersist()

        return sink

    # -- reads --------------------------------------------------------------
    def _states(self) -> list[str]:
        return [n for n in self.files.names(f"{self.path}/state") if n.endswith(".json") and not n.startswith(".")]

    def _state(self) -> State:
        names = self._states()
        raw = self.files.read_json(f"{self.path}/state/{names[-1]}") if names else None
        return State.from_json(raw) if raw else State()

    def _commit(self, state: State) -> None:
        name = f"{state.generation:010d}.json"
        try:
            self.files.write_json(f"{self.path}/state/{name}", state.to_json(), exclusive=True)
        except AlreadyThere:
            raise CompactionConflict(f"{self.spec.name}: generation {state.generation} was committed meanwhile") from None
        if self._states()[-1] != name:  # the number was free only because a purge has cleared it
            self.files.delete([f"{self.path}/state/{name}"])
            raise CompactionConflict(f"{self.spec.name}: a later generation than {state.generation} is in place")

    def _folder(self, day: dt.date, held: Held) -> str:
        return f"{self.path}/base/run={held.run}/event_date={day.isoformat()}"

    def _base(self, days: dict[dt.date, Held]) -> DataFrame:
        """The base's rows of ``days``, from their folders alone."""
        rows = scan(self.spark, [self._folder(d, h) for d, h in sorted(days.items())],
                    StructType([*self.stored.fields, StructField("run", StringType()), StructField("event_date", DateType())]),
                    f"{self.path}/base")
        return rows.drop("run")

    def log(self) -> DataFrame:
        """Every written row still on file, with bookkeeping columns and its day."""
        return self._files().filter(F.col("event_date").isNotNull())

    def _newer(self, state: State) -> DataFrame:
        """Log rows of the batches that the base does not contain; others' folders are not read."""
        newer = F.lit(True)
        for query, last in state.contains.items():
            newer = newer & ((F.col("query_id") != query) | (F.col("batch_id") > last))
        return self.log().filter(newer)

    def stored_rows(self, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """Rows of the current base (of ``days`` only, if given) and of the batches it does not contain."""
        state = self._state()
        held = {d: h for d, h in state.days.items() if days is None or days[0] <= d <= days[1]}
        return self._newer(state).unionByName(self._base(held))

    def _latest(self, rows: DataFrame) -> DataFrame:
        per_query = latest_per_key(rows, [*self.spec.key, "query_id"], ["batch_id"])
        return latest_per_key(per_query, list(self.spec.key), ["write_time", "query_id"])

    def _live(self, as_of: dt.datetime | None, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        rows = self.stored_rows(days)
        if not self.spec.ttl_seconds:
            return rows
        if as_of is None:
            raise ValueError(f"{self.spec.name} has a retention: pass as_of")
        return retained(rows, as_of, self.spec.ttl_seconds)

    def view(self, as_of: dt.datetime | None = None,
             days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """Latest row per key alive at ``as_of``, in the spec's column order.

        ``days`` (first, last) limits the view to rows whose event date is in
        that range. Where the key holds the event time, the range prunes the
        ``event_date`` folders before the aggregation; elsewhere a key may have moved to
        another day, so the range is applied after it.
        """
        timed = days is not None and self.spec.time_column in self.spec.key
        rows = self._live(as_of, days if timed else None)
        inside = F.lit(True)
        if days is not None:
            first, last = (F.lit(d).cast("date") for d in days)
            inside = event_date(self.spec.time_column).between(first, last)
            if timed:
                rows = rows.filter(F.col("event_date").between(first, last))
        latest = self._latest(rows.select(*self.stored.names)).select(*self.columns)
        return latest.filter(inside)

    # -- SRT3 + SNK2: compaction and purge -----------------------------------
    def _touched(self, new: DataFrame, state: State) -> set[dt.date]:
        """Days that new rows fall on, and days that hold an older row of their keys."""
        days = {r[0] for r in new.select("event_date").distinct().collect()}
        if self.spec.time_column not in self.spec.key and state.days:
            key = list(self.spec.key)
            moved = self._base(state.days).select(*key, "event_date").join(new.select(*key).distinct(), key, "left_semi")
            days |= {r[0] for r in moved.select("event_date").distinct().collect()}
        return days

    def compact(self, as_of: dt.datetime | None = None) -> int:
        """Merge the new batches into the base, day by day; returns the generation.

        Only touched days are read and written, by day and in the spec's clustering order. Readers switch over
        when the state file appears. Raises :class:`CompactionConflict` if another compaction or
        purge committed meanwhile. A table with a retention needs ``as_of``.
        """
        ttl = self.spec.ttl_seconds
        if ttl and as_of is None:
            raise ValueError(f"{self.spec.name} has a retention: pass as_of")
        state = self._state()
        new = self._newer(state)
        held = {r["query_id"]: r["n"] for r in
                new.groupBy("query_id").agg(F.max("batch_id").alias("n")).collect()}  # one row a query
        # Batches that appear from here on belong to the next compaction.
        known = F.lit(False)
        for query, last in held.items():
            known = known | ((F.col("query_id") == query) & (F.col("batch_id") <= last))
        new = new.filter(known)
        touched = self._touched(new, state) if held else set()
        days = {d: h for d, h in state.days.items() if d not in touched}
        run = f"r{uuid.uuid4().hex}"
        if touched:
            rows = new.unionByName(self._base({d: h for d, h in state.days.items() if d in touched}))
            alive = (F.col("write_time") > F.lit(as_of) - F.expr(f"INTERVAL {int(ttl)} SECONDS")) if ttl else F.lit(True)
            rows = rows.select(*self.stored.names, alive.cast("int").alias("_alive"))
            per_query = latest_per_key(rows, [*self.spec.key, "query_id"], ["_alive", "batch_id"])
            latest = (latest_per_key(per_query, list(self.spec.key), ["_alive", "write_time", "query_id"]).drop("_alive")
                      .withColumn("event_date", event_date(self.spec.time_column)))
            laid = clustered(latest, "event_date", [(self.spec.key[0], False), *self.spec.order]) if self.spec.order \
                else latest.hint("rebalance", "event_date")
            laid.write.partitionBy("event_date").parquet(f"{self.path}/base/run={run}")
            written = scan(self.spark, [f"{self.path}/base/run={run}"],
                           StructType([*self.stored.fields, StructField("event_date", DateType())]), f"{self.path}/base/run={run}")
            days |= self._per_day(written, run)
        merged = {**state.contains, **held}
        try:
            self._commit(State(state.generation + 1, merged, as_of, days))
        except CompactionConflict:
            self.files.delete([f"{self.path}/base/run={run}"])
            raise
        return state.generation + 1

    def _manifests(self) -> DataFrame:
        """One row per batch and day: query, batch, day, folder, rows, least, greatest."""
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifests/*/*.json")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], MANIFEST)
        return rows.select("query", "batch", F.explode("days").alias("d")).select("query", "batch", "d.*")

    def _replaced(self, state: State) -> Iterator[str]:
        """Day folders of earlier generations that the current one does not use."""
        current = {self._folder(d, h) for d, h in state.days.items()}
        seen: set[str] = set()
        for name in self._states():
            raw = self.files.read_json(f"{self.path}/state/{name}")
            for day, held in State.from_json(raw).days.items() if raw else ():
                folder = self._folder(day, held)
                if folder not in current and folder not in seen:
                    seen.add(folder)
                    yield folder

    def purge(self, archived: Sequence[dt.date] = (), book: ArchiveBook | None = None) -> list[dt.date]:
        """Delete what no reader needs any more, by manifests and state alone.

        That is: log batches that the base contains, day folders that a later generation replaced, and
        days of the base of which every row has expired (relative to the last compaction's ``as_of``). Days
        with expired rows must be archived: named in ``archived``, or proven by ``book``, whose archives of
        this table are read back and compared here. Otherwise ValueError is raised and nothing is deleted. Returns the
        days that had expired rows.
        """
        state = self._state()
        if not state.generation:
            return []
        inside = F.lit(False)
        for query, last in state.contains.items():
            inside = inside | ((F.col("query") == query) & (F.col("batch") <= last))
        old = self._manifests().filter(inside)
        expired: list[dt.date] = []
        gone: set[dt.date] = set()
        if self.spec.ttl_seconds and state.as_of:
            limit = _micros(state.as_of) - self.spec.ttl_seconds * 1_000_000
            gone = {d for d, h in state.days.items() if h.greatest <= limit}
            days = {r[0] for r in old.filter(F.col("least") <= limit).select("day").distinct().collect()}
            expired = sorted(days | gone)
            missing = [d for d in expired if d not in set(archived)]
            if missing and book is not None:
                proven = book.verify(self.spec.name, missing)
                missing = [d for d in missing if not proven[d]]
            if missing:
                raise ValueError(f"{self.spec.name}: not archived: {', '.join(map(str, missing))}")
        if gone:
            kept = {d: h for d, h in state.days.items() if d not in gone}
            state = replace(state, generation=state.generation + 1, days=kept)
            self._commit(state)
        self.files.delete(r[0] for r in old.select("folder").toLocalIterator())
        self.files.delete(f"{self.path}/manifests/{r[0]}/{r[1]}.json"
                          for r in old.select("query", "batch").distinct().toLocalIterator())
        self.files.delete(self._replaced(state))
        self.files.delete(f"{self.path}/state/{n}" for n in self._states()[:-1])
        return expired

    # -- SNK3 -----------------------------------------------------------------
    def ensure(self) -> str:
        """Register the table: ``<name>_log`` over the log's files and, under the
        table's name, a view that gives the latest live row per key now."""
        name, log = f"{self.namespace}.{self.spec.name}", f"{self.namespace}.{self.spec.name}_log"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {log} ({cols}, event_date date) USING parquet "
                       f"PARTITIONED BY (event_date, query_id, batch_id) LOCATION '{self.path}/log'")
        state = self._state()
        stored, key = ", ".join(f"`{c}`" for c in self.stored.names), [f"`{k}`" for k in self.spec.key]
        newer = " AND ".join(["event_date IS NOT NULL",
                              *(f"(query_id <> '{q}' OR batch_id > {n})" for q, n in state.contains.items())])
        rows = f"SELECT {stored} FROM {log} WHERE {newer}"
        runs: dict[str, list[str]] = {}
        for day, held in state.days.items():
            runs.setdefault(held.run, []).append(f"DATE '{day.isoformat()}'")
        if runs:
            inside = " OR ".join(f"(run = '{r}' AND event_date IN ({', '.join(d)}))" for r, d in runs.items())
            rows += f" UNION ALL SELECT {stored} FROM parquet.`{self.path}/base` WHERE {inside}"
        live = f"write_time > current_timestamp() - INTERVAL {self.spec.ttl_seconds} SECONDS" \
            if self.spec.ttl_seconds else "true"

        def latest(source: str, by: list[str], order: list[str]) -> str:
            rest = [*order, *(f"`{c}`" for c in self.stored.names if f"`{c}`" not in by and c not in order)]
            return f"SELECT {', '.join(by)}, r.* FROM (SELECT {', '.join(by)}, max(struct({', '.join(rest)})) AS r " \
                   f"FROM ({source}) GROUP BY {', '.join(by)})"

        per_query = latest(f"SELECT * FROM ({rows}) WHERE {live}", [*key, "`query_id`"], ["batch_id"])
        final = latest(per_query, key, ["write_time", "query_id"])
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in self.columns)} FROM ({final})")
        return name

    def refresh(self) -> str:
        """Make batches and generations written since :meth:`ensure` visible in the catalog."""
        name = self.ensure()
        self.spark.sql(f"MSCK REPAIR TABLE {name}_log SYNC PARTITIONS")
        self.spark.catalog.refreshTable(f"{name}_log")
        return name

    def drop(self) -> None:
        """Take the table out of the catalog (its files stay)."""
        name = f"{self.namespace}.{self.spec.name}"
        self.spark.sql(f"DROP VIEW IF EXISTS {name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}_log")
