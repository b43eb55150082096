import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pulsewatch.llm import ctph, warc
from tests.llm.cases import documents


def _levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_edit_distance_equals_brute_force():
    r = random.Random(1)
    for _ in range(500):
        a, b = ([r.choice("abc") for _ in range(r.randint(0, 70))] for _ in range(2))
        assert ctph.edit_distance(a, b) == _levenshtein(a, b)


def test_likeness_follows_the_edit():
    r = random.Random(2)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(800))
    other = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(800))
    own = ctph.fingerprint(text.encode())
    assert ctph.likeness(own, ctph.fingerprint(text.encode())) == 1.0
    assert ctph.likeness(own, ctph.fingerprint(text.replace(text[100:110], "!").encode())) > 0.85
    assert ctph.likeness(own, ctph.fingerprint((text[:4000] + other[4000:]).encode())) > 0.4
    assert ctph.likeness(own, ctph.fingerprint(other.encode())) < 0.1
    assert ctph.likeness(ctph.fingerprint(b""), ctph.fingerprint(b"")) == 1.0
    assert ctph.likeness(ctph.fingerprint(b""), own) == 0.0
    assert len(own.split(":")[1]) <= 2 * ctph.MAX_CHUNKS


def test_compare_with_next_equals_brute_force(spark):
    for df in (documents(spark), documents(spark).limit(1), documents(spark).limit(0), documents(spark).repartition(5)):
        rows = sorted((x.doc_id is None, -(x.doc_id or 0), x.text or "") for x in df.collect())
        want = []
        for i, (no_id, negative, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][2]
            cut = len(text) // 3
            edited = (text[:len(text) - cut] + following[:cut]).encode()
            a, b, c = (ctph.fingerprint(t) for t in (text.encode(), edited, following.encode()))
            want.append((None if no_id else -negative, len(text), hashlib.sha256(edited).hexdigest(), a, b,
                         ctph.likeness(a, b), ctph.likeness(a, c)))
        got = [tuple(x) for x in ctph.compare_with_next(df, runs=4).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_fingerprints_column(spark):
    rows = ctph.fingerprints(documents(spark), out="fp").collect()
    assert all(r["fp"] == ctph.fingerprint((r["text"] or "").encode()) for r in rows)


# --- WARC -----------------------------------------------------------------------

def _pages(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://b/\r\n4", ""),
            (5, "http://b/5", "é" * 200_000), (2, "http://a/2", "<p>x</p>"), (None, "http://c", "<p>only</p>"),
            (9, "http://a/9", "\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame([(*r, 1, "clash") for r in rows],
                                 "page_id long, url string, html string, payload int, digest string")


def test_pages_round_trip(spark, scratch):
    pages = _pages(spark).repartition(3)
    warc.archive_pages(pages, scratch)
    got = warc.page_index(warc.read_warc(spark, scratch, verify=True)).drop("url").collect()
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    want = []
    for page_id, body in rows:
        ids = [i for i, b in rows if b == body and i is not None]
        top = max(ids) if ids else None
        revisit = page_id != top
        want.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                     "revisit" if revisit else "response", top if revisit else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    bodies = {r["fields"]["X-Page-Id"]: r["payload"] for r in warc.read_warc(spark, scratch)
              .filter("warc_type = 'response'").collect() if "X-Page-Id" in r["fields"]}
    assert bytes(bodies["5"]) == ("é" * 200_000).encode() and bytes(bodies["9"]) == b"\r\n\r\nWARC/1.1\r\n"


def test_files_open_with_plain_gzip(spark, scratch):
    warc.archive_pages(_pages(spark).coalesce(1), scratch)
    import glob

    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{scratch}/part-*"))
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == 8


def test_header_filters_are_pushed_and_payloads_skipped(spark, scratch):
    warc.archive_pages(_pages(spark), scratch)
    df = warc.read_warc(spark, scratch, payload=False).filter(
        (F.col("warc_type") == "revisit") & F.col("target_uri").startswith("http://a/"))
    assert {r["target_uri"] for r in df.collect()} == {"http://a/1"}
    assert df.filter("payload IS NOT NULL").count() == 0
    reader = warc.WarcReader({"path": scratch})
    left = list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1 and len(reader.conditions) == 1
    read = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["warc_type"] for r in read} == {"revisit"}


def test_foreign_files_without_lengths(spark, scratch):
    import os

    os.makedirs(scratch)
    records = [warc.record_bytes({"warc_type": "response", "record_id": f"<{i}>", "payload": b"z" * n})
               for i, n in enumerate((0, 10, 300_000))]
    with open(f"{scratch}/a.warc.gz", "wb") as out:
        out.write(b"".join(gzip.compress(r) for r in records))
    with open(f"{scratch}/b.warc", "wb") as out:
        out.write(b"".join(records))
    sizes = sorted(len(r["payload"]) for r in warc.read_warc(spark, scratch).collect())
    assert sizes == [0, 0, 10, 10, 300_000, 300_000]
    assert warc.read_warc(spark, scratch, payload=False).filter("record_id = '<1>'").count() == 2


def test_small_files_share_a_partition_and_unlisted_files_are_not_read(spark, scratch):
    warc.register(spark)
    (warc.page_records(_pages(spark)).write.format("warc").option("file_bytes", "1")  # a file per record
     .mode("append").save(scratch))
    with open(f"{scratch}/part-stray.warc.gz", "wb") as out:
        out.write(warc.member(warc.record_bytes({"payload": b"stray"})))
    assert len(warc.WarcReader({"path": scratch}).partitions()) == 1
    assert len(warc.WarcReader({"path": scratch, "split_bytes": "1"}).partitions()) > 1
    assert warc.read_warc(spark, scratch).count() == 8


def test_damaged_payload_is_noticed(spark, scratch):
    import os

    os.makedirs(scratch)
    with open(f"{scratch}/a.warc", "wb") as out:
        out.write(warc.record_bytes({"warc_type": "response", "payload": b"x", "payload_digest": "sha1:WRONG"}))
    assert warc.read_warc(spark, scratch).count() == 1
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(spark, scratch, verify=True).collect()


def test_empty_table_and_folder(spark, scratch):
    warc.archive_pages(_pages(spark).limit(0), scratch)
    assert warc.read_warc(spark, scratch).count() == 0


def _foreign(scratch, name, data):
    import os

    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/{name}", "wb") as out:
        out.write(data)


def test_repeated_headers_are_kept(spark, scratch):
    head = (b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: <a>\r\nContent-Length: 2\r\n"
            b"WARC-Concurrent-To: <b>\r\nwarc-concurrent-to: <c>\r\n  folded\r\nX: y\r\n\r\nhi\r\n\r\n")
    _foreign(scratch, "a.warc", head)
    rows = warc.read_warc(spark, scratch).collect()
    assert rows[0]["fields"] == {"WARC-Concurrent-To": "<a>\n<b>\n<c> folded", "X": "y"} and bytes(rows[0]["payload"]) == b"hi"
    again = warc.record_bytes({"warc_type": "metadata", "content_type": "text/plain", "fields": rows[0]["fields"], "payload": b"hi"})
    assert again.count(b"WARC-Concurrent-To: ") == 3 and dict(warc.parse_head(again.split(b"\r\n\r\n")[0])["fields"]) == rows[0]["fields"]


@pytest.mark.parametrize("damage", [
    lambda good, last: last[:-30],                                              # the last record is cut off in its block
    lambda good, last: last[:25],                                               # and in its header
    lambda good, last: last.replace(b"Content-Length: ", b"Content-Length: x"),
    lambda good, last: last.replace(b"Content-Length: ", b"Content-Length: -"),
    lambda good, last: b"GARBAGE/1\r\n\r\n" + last,
])
@pytest.mark.parametrize("packed", [False, True])
def test_damaged_archives(spark, scratch, damage, packed):
    record = warc.record_bytes({"warc_type": "response", "record_id": "<1>", "payload": b"p" * 200})
    broken = damage(record, record)
    pack = warc.member if packed else bytes
    _foreign(scratch, "a.warc.gz" if packed else "a.warc", pack(record) * 2 + pack(broken))
    _foreign(scratch, "b.warc", record)
    for payload in (True, False):
        got = warc.read_warc(spark, scratch, payload=payload, damaged="stop").collect()
        cut_only = packed and not payload and broken == record[:-30]      # a whole member that says it is longer than it is
        assert len(got) == 3 + cut_only
        if not cut_only:
            with pytest.raises(Exception, match="a.warc"):
                warc.read_warc(spark, scratch, payload=payload).collect()


def test_members_cut_in_the_file(spark, scratch):
    record = warc.record_bytes({"warc_type": "response", "payload": bytes(range(256)) * 40})
    for name, whole in (("a.warc.gz", warc.member(record)), ("b.warc.gz", gzip.compress(record))):
        for cut in (5, 40, len(whole) - 3):
            _foreign(f"{scratch}/{name}-{cut}", name, whole + whole[:cut])
            for payload in (True, False):
                assert warc.read_warc(spark, f"{scratch}/{name}-{cut}", payload=payload, damaged="stop").count() == 1
