import datetime as dt

from pyspark.sql import functions as F

from pulsewatch.plans.applications import archiver, burst_listener, listener, views_listener
from pulsewatch.sinks.publish import publish_text
from pulsewatch.sources.files import read_csv_extract
from pulsewatch.sources.streams import text_stream
from pulsewatch.streaming.jobs import run_available
from pulsewatch.schemas import LOGS_WITH_MESSAGE
from tests.conftest import SF_SMALL


def _wire(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("TRACE").alias("level"),
        F.lit("svc").alias("microservice_id"),
        F.upper("event_type").alias("operation_type"),
        F.get_json_object("props", "$.k").alias("action_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.lit(0).alias("value"),
    )


def test_listeners_and_archiver_end_to_end(spark, scratch):
    wire = _wire(spark)
    publish_text(wire, f"{scratch}/topic", timestamp_format="yyyy-MM-dd HH:mm:ss")
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{scratch}/topic")
    messages = text_stream(spark, f"{scratch}/topic")
    tables, ckpts = f"{scratch}/tables", f"{scratch}/ckpt"
    specs = (listener(spark, "metrics", messages, tables, ckpts)
             + listener(spark, "logs", messages, tables, ckpts)
             + views_listener(spark, messages, tables, ckpts)
             + burst_listener(spark, messages, tables, ckpts))
    run_available(specs)
    n = wire.count()
    assert spark.read.parquet(f"{tables}/metrics/log").count() == n
    assert spark.read.parquet(f"{tables}/_rejected/logs").select("raw").first()[0] == "not json"
    assert spark.read.parquet(f"{tables}/metrics_ddos/log").agg(F.sum("count")).first()[0] > 0
    assert spark.read.parquet(f"{tables}/views/log").count() > 0
    out = archiver(spark, tables, dt.date(2024, 2, 15), f"{scratch}/archive")
    logs = read_csv_extract(spark, out["logs"], LOGS_WITH_MESSAGE, header=False)
    want = wire.filter(F.to_date("timestamp") == F.lit("2024-01-15").cast("date"))
    assert logs.count() == want.count() > 0


def test_command_line_backfill_and_archive(spark, scratch):
    from pulsewatch.__main__ import main

    wire = _wire(spark)
    publish_text(wire, f"{scratch}/topic", timestamp_format="yyyy-MM-dd HH:mm:ss")
    common = ["--files", f"{scratch}/topic", "--tables", f"{scratch}/tables",
              "--checkpoints", f"{scratch}/ckpt", "--available-now"]
    main(["listen", "logs", *common])
    main(["listen", "metrics", *common])
    main(["listen", "views", *common])
    assert spark.read.parquet(f"{scratch}/tables/logs/log").count() == wire.count()
    main(["archive", "--as-of", "2024-02-15", "--tables", f"{scratch}/tables", "--out",
          f"{scratch}/archive"])


def test_command_line_over_segments(spark, scratch, capsys):
    """Sketches and attackers from a topic of segments; compaction, and a purge that waits for proven archives."""
    from pulsewatch.__main__ import main
    from pulsewatch.operators.sketches import roll_up
    from pulsewatch.plans.applications import all_tables
    from pulsewatch.sinks.publish import publish_segments

    rows = _wire(spark).select("id", "microservice_id", "timestamp", "operation_type", "action_id", "user_id", "value")
    burst = spark.range(120).select(
        F.concat(F.lit("b"), "id").alias("id"), F.lit("svc").alias("microservice_id"),
        F.timestamp_seconds(F.lit(int(dt.datetime(2024, 1, 20).timestamp())) + F.col("id") / 40).alias("timestamp"),
        F.lit("VIEW").alias("operation_type"), F.lit("a").alias("action_id"), F.lit("bot").alias("user_id"),
        F.lit(0).alias("value"))
    publish_segments(rows.unionByName(burst), f"{scratch}/topic", timestamp_format="yyyy-MM-dd HH:mm:ss")
    common = ["--segments", f"{scratch}/topic", "--starting-offsets", "earliest", "--tables", f"{scratch}/tables",
              "--checkpoints", f"{scratch}/ckpt", "--available-now"]
    for job in ("sketches", "attackers", "metrics"):
        main(["listen", job, *common])
    tables = all_tables(spark, f"{scratch}/tables")
    assert sorted(tables) == ["attackers", "metrics", "transactions_sketch", "views_sketch"]
    now = dt.datetime(2024, 2, 15)
    found = tables["attackers"].view(as_of=now).collect()
    assert {r["user_id"] for r in found} == {"bot"} and max(r["rolling_count"] for r in found) == 120
    hours = roll_up(tables["views_sketch"].view(as_of=now), "1 hour", "views")
    assert hours.agg(F.max("views")).first()[0] >= 120
    # Rows were written just now, so at a later date all of them have expired; nothing of it is archived.
    later = ["--as-of", "2100-01-01T00:00:00", "--tables", f"{scratch}/tables", "--archives", f"{scratch}/archive"]
    main(["maintain", *later])
    said = capsys.readouterr().out
    assert said.count("generation 1") == 4 and said.count("not archived") == 4
    assert tables["metrics"].stored_rows().count() == rows.count() + 120


def test_resources_listener_with_rejects(spark, scratch):
    msgs = [
        '{"id":"r1","timestamp":"2024-01-01 00:00:01","microservice_id":"s1","cpu":50,"ram":500}',
        '{"id":"r2","timestamp":"2024-01-01 00:00:02","microservice_id":"s2","cpu":99,"ram":7999}',
        '{"id":"r1","timestamp":"2024-01-01 00:00:01","microservice_id":"s1","cpu":51,"ram":501}',
        '{"id":"r3","timestamp":"2024-01-01 00:00:03","cpu":70,"ram":900}',
        "{broken",
    ]
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(f"{scratch}/topic")
    specs = listener(spark, "resources", text_stream(spark, f"{scratch}/topic"),
                     f"{scratch}/tables", f"{scratch}/ckpt", trigger=None)
    run_available(specs)
    from pulsewatch.schemas import TABLES
    from pulsewatch.sinks.keyed import KeyedTable

    view = {r["id"]: (r["cpu"], r["ram"]) for r in
            KeyedTable(spark, TABLES["resources"], f"{scratch}/tables/resources").view(as_of=dt.datetime(2024, 1, 2)).collect()}
    assert view == {"r1": (51, 501), "r2": (99, 7999)}   # same key twice: one row, larger tie wins
    rejects = sorted(r["status"] for r in spark.read.parquet(f"{scratch}/tables/_rejected/resources").collect())
    assert rejects == ["malformed", "missing_key"]
