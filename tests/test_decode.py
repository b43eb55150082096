import datetime as dt

from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from pulsewatch.functions.decode import decode, encode_json, rejected, split_decoded, valid
from pulsewatch.schemas import COUNTED, EVENTS, METRICS

SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("value", IntegerType()),
])

CASES = [
    ('{"id":"a","timestamp":"2024-01-01 00:00:01","value":1}', ("a", dt.datetime(2024, 1, 1, 0, 0, 1), 1), "ok"),
    ("garbage", (None, None, None), "malformed"),
    ('{"id":"b","timestamp":"bad","value":"x"}', ("b", None, None), "malformed"),
    ('{"id":"c","value":3,"message":"zz"}', ("c", None, 3), "missing_time"),
    (None, (None, None, None), "null_value"),
    ('{"id":"d","timestamp":"2024-01-01T05:00:00+03:00","value":2.7}', ("d", dt.datetime(2024, 1, 1, 2), None), "malformed"),
    ('[{"id":"e"}]', (None, None, None), "malformed"),
]


def _messages(spark):
    return spark.createDataFrame([(c[0],) for c in CASES], "value string")


def test_decode_matches_reference_parsing(spark):
    rows = decode(_messages(spark), SCHEMA).collect()
    assert [tuple(r) for r in rows] == [c[1] for c in CASES]


def test_split_tags_every_row(spark):
    rows = split_decoded(_messages(spark), SCHEMA).collect()
    assert [r["status"] for r in rows] == [c[2] for c in CASES]
    assert [r["raw"] for r in rows] == [c[0] for c in CASES]


def test_valid_and_rejected_partition_the_input(spark):
    decoded = split_decoded(_messages(spark), SCHEMA)
    assert valid(decoded).count() == 1
    assert rejected(decoded).count() == len(CASES) - 1
    assert valid(decoded).columns == ["id", "timestamp", "value"]


def test_missing_key_is_rejected(spark):
    msgs = spark.createDataFrame([('{"timestamp":"2024-01-01 00:00:01","value":1}',)], "value string")
    assert split_decoded(msgs, SCHEMA).first()["status"] == "missing_key"


def test_binary_value_is_cast(spark):
    msgs = spark.createDataFrame([(bytearray(CASES[0][0].encode()),)], "value binary")
    assert tuple(decode(msgs, SCHEMA).first()) == CASES[0][1]


def test_narrow_schema_is_a_projection(spark):
    msg = ('{"id":"m1","timestamp":"2024-01-01 00:00:01","microservice_id":"s1",'
           '"operation_type":"VIEW","action_id":"a1","user_id":"u1","value":0}')
    df = spark.createDataFrame([(msg,)], "value string")
    full = decode(df, METRICS).first()
    narrow = decode(df, COUNTED).first()
    assert full["operation_type"] == "VIEW"
    assert narrow.asDict() == {k: full[k] for k in COUNTED.fieldNames()}


def test_json_roundtrip_keeps_microseconds(spark):
    from tests.conftest import SF_SMALL

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    back = valid(split_decoded(encode_json(ev), EVENTS, key=("event_id",), time_col="ts"))
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_wire_format_whole_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 999999),)], "timestamp timestamp")
    text = encode_json(df, timestamp_format="yyyy-MM-dd HH:mm:ss").first()["value"]
    assert text == '{"timestamp":"2024-01-01 00:00:01"}'


def test_parse_happens_once(spark):
    """The status filter must not re-run from_json below the projection."""
    msgs = _messages(spark)
    plan = valid(split_decoded(msgs, SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan
