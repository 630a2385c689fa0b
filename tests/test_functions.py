import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions import (flight_status, parse_local, parse_utc, record_array, record_count,
                              surrogate_key, try_double, try_int)


def test_parsers_return_null_on_bad_text(spark):
    df = spark.createDataFrame(
        [("12", "1.5", "2024-01-01T10:30Z", "2024-01-01T10:30"),
         ("x1", "abc", "2024-01-01 10:30", "garbage"), (None, None, None, None)],
        "n string, d string, u string, l string")
    rows = df.select(try_int("n").alias("n"), try_double("d").alias("d"),
                     parse_utc("u").cast("timestamp_ntz").alias("u"),
                     parse_local("l").alias("l")).collect()
    assert tuple(rows[0]) == (12, 1.5, dt.datetime(2024, 1, 1, 10, 30), dt.datetime(2024, 1, 1, 10, 30))
    assert tuple(rows[1]) == (None, None, None, None)
    assert tuple(rows[2]) == (None, None, None, None)


def test_utc_text_is_read_as_utc(spark):
    # The session is pinned to UTC; 12:20Z must stay 12:20 as an instant.
    r = spark.range(1).select(parse_utc(F.lit("2026-03-16T12:20Z")).alias("t")).first()
    epoch = spark.range(1).select(F.unix_timestamp(parse_utc(F.lit("2026-03-16T12:20Z")))).first()[0]
    assert epoch == int(dt.datetime(2026, 3, 16, 12, 20, tzinfo=dt.timezone.utc).timestamp())
    assert r.t is not None


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([("LH", 400, dt.date(2024, 3, 1)), (None, 400, dt.date(2024, 3, 1)),
                                (None, None, None)], "a string, n int, d date")
    keys = [r.k for r in df.select(surrogate_key("a", "n", "d").alias("k")).collect()]
    assert keys == ["LH-400-2024-03-01", "400-2024-03-01", ""]


def test_flight_status_order_and_nulls(spark):
    df = spark.createDataFrame(
        [("DL", "CD"), ("OT", "DP"), ("OT", "LD"), ("OT", "IP"), ("NO", "CD"), (None, None),
         ("OT", "NA")], "ts string, sc string")
    got = [r.s for r in df.select(flight_status("ts", "sc").alias("s")).collect()]
    assert got == ["Delayed", "In Flight", "In Flight", "In Flight", "Cancelled", "On Time", "On Time"]


def test_record_array_normalises_object_and_array(spark):
    node = StructType([StructField("a", LongType()), StructField("b", StringType())])
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('[{"a": 2}, {"a": 3}]',), ("[]",),
                                (None,), ("not json",)], "raw string")
    rows = df.select(record_count("raw").alias("n"),
                     F.size(record_array("raw", node)).alias("s")).collect()
    assert [r.n for r in rows] == [1, 2, 0, 0, 0]
    exploded = df.select(F.explode_outer(record_array("raw", node)).alias("n"))
    assert exploded.count() == 6  # 1 + 2 + one NULL row each for empty, NULL, garbage
