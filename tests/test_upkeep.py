import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulsewatch.schemas import EVENTS
from pulsewatch.sinks.archive import ArchiveBook, archive_day, archive_range
from pulsewatch.storage import AlreadyThere, Files
from pulsewatch.sinks.keyed import CompactionConflict, KeyedTable
from tests.conftest import SF_SMALL
from tests.test_keyed_archive import DATED, KEPT, SPEC, T0, W1, W2, _kv, _view

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def _dated(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, d, 5), v) for k, d, v in rows], "k string, timestamp timestamp, v long")


def _read_files(df):
    return set(df.select(F.input_file_name().alias("f")).distinct().toPandas()["f"])


def test_small_files(spark, scratch):
    files = Files(spark)
    assert files.names(f"{scratch}/x") == [] and files.read_json(f"{scratch}/x/a.json") is None
    files.write_json(f"{scratch}/x/a.json", {"a": "ü"})
    files.write_json(f"{scratch}/x/a.json", {"a": "é"})
    assert files.read_json(f"{scratch}/x/a.json") == {"a": "é"}
    with pytest.raises(AlreadyThere):
        files.write_json(f"{scratch}/x/a.json", {}, exclusive=True)
    assert files.names(f"{scratch}/x") == ["a.json"] and files.read_json(f"{scratch}/x/a.json") == {"a": "é"}
    assert files.delete(f"{scratch}/x/{n}" for n in ("a.json", "none")) == 2
    assert files.matching(f"{scratch}/x/*") == []


def test_compaction_rewrites_touched_days_only(spark, scratch):
    t = KeyedTable(spark, DATED, scratch)
    t.write_batch(_dated(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]), 0, "q", W1)
    t.compact()
    first = t._state().days
    t.purge()
    t.write_batch(_dated(spark, [("b", 2, 2), ("b2", 2, 1)]), 1, "q", W2)
    t.compact()
    second = t._state().days
    assert sorted(second) == DAYS
    assert {d for d in DAYS if second[d].run != first[d].run} == {DAYS[1]} and second[DAYS[1]].rows == 2
    assert os.listdir(f"{scratch}/base/run={second[DAYS[1]].run}/") and not os.path.exists(
        f"{scratch}/base/run={second[DAYS[1]].run}/event_date=2024-01-01")
    read = _read_files(t._base({DAYS[1]: first[DAYS[1]]}))
    assert all("event_date=2024-01-02" in f for f in read)
    # A view of one day opens that day's files only.
    one = t.stored_rows((DAYS[0], DAYS[0]))
    assert {f.split("event_date=")[1][:10] for f in _read_files(one.filter("query_id = 'q' and batch_id = 0"))} == {"2024-01-01"}
    t.purge()
    assert not os.path.exists(t._folder(DAYS[1], first[DAYS[1]])) and os.path.exists(t._folder(DAYS[0], first[DAYS[0]]))
    assert {(r["k"], r["timestamp"].day): r["v"] for r in t.view().collect()} == {
        ("a", 1): 1, ("b", 2): 2, ("b2", 2): 1, ("c", 3): 1}


def test_a_key_that_moves_leaves_its_old_day(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_dated(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]), 0, "q", W1)
    t.compact()
    before = t._state().days
    t.write_batch(_dated(spark, [("a", 3, 5)]), 1, "q", W2)
    t.compact()
    after = t._state().days
    assert sorted(after) == DAYS[1:] and after[DAYS[1]].run == before[DAYS[1]].run and after[DAYS[2]].rows == 2
    assert {(r["k"], r["timestamp"].day): r["v"] for r in t.view().collect()} == {("a", 3): 5, ("b", 2): 1, ("c", 3): 1}
    assert t.compact() == 3 and t._state().days == after          # nothing new: nothing rewritten


def test_the_later_of_two_compactions_fails_and_leaves_nothing(spark, scratch):
    t, u = KeyedTable(spark, SPEC, scratch), KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1)]), 0, "q", W1)
    stale = u._state()
    u._state = lambda: stale
    assert t.compact() == 1
    runs = set(os.listdir(f"{scratch}/base"))
    with pytest.raises(CompactionConflict):
        u.compact()
    assert set(os.listdir(f"{scratch}/base")) == runs and _view(t) == {"a": 1}
    # Also where a purge has cleared the number that the later one wants.
    t.write_batch(_kv(spark, [("a", 2)]), 1, "q", W2)
    t.compact()
    t.purge()
    with pytest.raises(CompactionConflict):
        u.compact()
    assert _view(t) == {"a": 2} and len(os.listdir(f"{scratch}/state")) <= 2


def test_manifests_say_what_a_batch_holds(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_dated(spark, [("a", 1, 1), ("b", 2, 1), ("c", 2, 1), (None, 3, 1)]), 7, "q", W1)
    rows = {r["day"]: r for r in t._manifests().collect()}
    assert {d: r["rows"] for d, r in rows.items()} == {DAYS[0]: 1, DAYS[1]: 2}
    assert {(r["query"], r["batch"]) for r in rows.values()} == {("q", 7)}
    assert all(r["least"] == r["greatest"] == int(W1.timestamp()) * 1_000_000 for r in rows.values())
    assert t.rejected().count() == 1
    t.compact()
    t.purge()
    assert t._manifests().collect() == [] and t.log().count() == 0 and t.rejected().count() == 1


def test_expired_days_leave_once_they_are_proven(spark, scratch):
    t = KeyedTable(spark, KEPT, f"{scratch}/t")
    old, now = dt.datetime(2023, 11, 1), dt.datetime(2024, 1, 10)
    t.write_batch(_dated(spark, [("a", 1, 1), ("b", 2, 1)]), 0, "q", old)
    t.write_batch(_dated(spark, [("c", 2, 1), ("d", 3, 1)]), 1, "q", W1)
    book = ArchiveBook(spark, f"{scratch}/archive")
    t.compact(now)
    assert _view(t, as_of=now) == {"c": 1, "d": 1}
    with pytest.raises(ValueError, match="2024-01-01, 2024-01-02"):
        t.purge(book=book)
    assert t.log().count() == 4
    archive_range(t.view(as_of=old), "kv", DAYS[0], DAYS[1], f"{scratch}/archive")
    assert t.purge(book=book) == DAYS[:2]
    # Day 1 held expired rows only; day 2 keeps its file until the rest of it expires.
    assert sorted(t._state().days) == DAYS[1:] and t._state().days[DAYS[1]].rows == 2
    assert _view(t, as_of=now) == {"c": 1, "d": 1}
    assert t.purge(book=book) == []


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_proofs(spark, scratch, fmt):
    ev = spark.read.schema(EVENTS).parquet(f"{SF_SMALL}/events.parquet")
    book, as_of, day = ArchiveBook(spark, scratch), dt.date(2024, 2, 15), dt.date(2024, 1, 15)
    path = archive_day(ev.repartition(3), "events", as_of, scratch, fmt, time_col="ts")
    rows = ev.filter(F.to_date("ts") == F.lit(day)).count()
    assert book.proof("events", day)["rows"] == rows > 0
    assert book.verify("events", [day, DAYS[0]]) == {day: True, DAYS[0]: False}
    part = max((os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")), key=os.path.getsize)
    with open(part, "rb") as f:
        whole = f.read()
    # Cut off, changed in place, and missing files are all noticed.
    for content in (whole[:len(whole) // 2], whole.replace(b"view", b"vieW") if fmt != "parquet" else whole[:-9], None):
        os.unlink(part)
        crc = os.path.join(path, f".{os.path.basename(part)}.crc")
        if os.path.exists(crc):
            os.unlink(crc)
        if content is not None:
            with open(part, "wb") as f:
                f.write(content)
        assert book.verify("events", [day]) == {day: content == whole}, content is None
        if content is None:
            break
    with open(part, "wb") as f:
        f.write(whole)
    assert book.verify("events", [day]) == {day: True}


def test_a_truncated_archive_blocks_the_purge(spark, scratch):
    t = KeyedTable(spark, replace(KEPT, name="kv"), f"{scratch}/t")
    old, now = dt.datetime(2023, 11, 1), dt.datetime(2024, 1, 10)
    t.write_batch(_dated(spark, [(f"k{i}", 1, i) for i in range(50)]), 0, "q", old)
    path = archive_range(t.view(as_of=old), "kv", DAYS[0], DAYS[0], f"{scratch}/archive")
    t.compact(now)
    folder = f"{path}/event_date=2024-01-01"
    part = next(f for f in os.listdir(folder) if f.startswith("part-"))
    with open(f"{folder}/{part}", "rb") as f:
        whole = f.read()
    if os.path.exists(f"{folder}/.{part}.crc"):
        os.unlink(f"{folder}/.{part}.crc")
    with open(f"{folder}/{part}", "wb") as f:
        f.write(whole[:-40])
    book = ArchiveBook(spark, f"{scratch}/archive")
    with pytest.raises(ValueError, match="not archived: 2024-01-01"):
        t.purge(book=book)
    assert t.log().count() == 50
    with open(f"{folder}/{part}", "wb") as f:
        f.write(whole)
    assert t.purge(book=book) == [DAYS[0]] and t.stored_rows().count() == 0


def test_archives_without_rows_are_proven_too(spark, scratch):
    rows = _kv(spark, [("a", 1)])
    archive_day(rows, "kv", dt.date(2024, 5, 1), scratch)
    assert ArchiveBook(spark, scratch).verify("kv", [dt.date(2024, 4, 1)]) == {dt.date(2024, 4, 1): True}
    assert T0 < W1
