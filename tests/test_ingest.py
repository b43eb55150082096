import datetime as dt

from pulsewatch.functions.decode import decode, rejected, split_decoded, valid
from pulsewatch.plans.telemetry import counted, views_and_transactions
from pulsewatch.schemas import LOGS, LOGS_WITH_MESSAGE, RESOURCES

LOG = ('{"id":"l1","timestamp":"2024-01-01 00:00:01","level":"ERROR","microservice_id":"s1",'
       '"operation_type":"BUY","action_id":"a1","user_id":"u1","message":"x, \\"y\\""}')
RES = '{"id":"r1","timestamp":"2024-01-01 00:00:02","microservice_id":"s1","cpu":77,"ram":4096}'


def test_logs_parity_projection_drops_message(spark):
    df = spark.createDataFrame([(LOG,)], "value string")
    parity = decode(df, LOGS)
    assert parity.columns == ["id", "timestamp", "level", "microservice_id", "operation_type",
                              "action_id", "user_id"]
    full = decode(df, LOGS_WITH_MESSAGE).first()
    assert full["message"] == 'x, "y"' and full["level"] == "ERROR"


def test_resources_decode(spark):
    row = decode(spark.createDataFrame([(RES,)], "value string"), RESOURCES).first()
    assert (row["cpu"], row["ram"], row["timestamp"]) == (77, 4096, dt.datetime(2024, 1, 1, 0, 0, 2))


def test_ingest_splits_valid_and_rejected(spark):
    df = spark.createDataFrame([(RES,), ("junk",), ('{"timestamp":"2024-01-01 00:00:00"}',)], "value string")
    decoded = split_decoded(df, RESOURCES)
    assert valid(decoded).count() == 1
    assert sorted(r["status"] for r in rejected(decoded).collect()) == ["malformed", "missing_key"]


def test_views_and_transactions_plan_over_messages(spark):
    rows = [
        f'{{"id":"m{i}","timestamp":"2024-01-01 00:00:{i:02d}","operation_type":"{k}","user_id":"u{i % 2}"}}'
        for i, k in enumerate(["VIEW", "VIEW", "BUY", "TRANSACTION", "REFUND"])
    ]
    typed = valid(counted(spark.createDataFrame([(r,) for r in rows], "value string")))
    plans = views_and_transactions(typed, distinct="exact")
    assert plans["views"].first()["views"] == 2
    assert plans["transactions"].first()["transactions"] == 4
