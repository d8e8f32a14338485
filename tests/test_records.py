"""Record encodings: 8-byte longs and ISO instant text."""

import datetime as dt

from pyspark.sql import functions as F

from keytally.functions.records import decode_long, encode_long, long_to_hex, summary_json
from keytally.functions.times import iso_instant


def test_long_bytes_round_trip(spark):
    df = spark.createDataFrame([(-1,), (299,), (599,), (0,)], "n long")
    rows = df.select("n", encode_long("n").alias("b"), long_to_hex("n").alias("h")).collect()
    for r in rows:
        assert bytes(r["b"]) == r["n"].to_bytes(8, "big", signed=True)
        assert r["h"] == r["n"].to_bytes(8, "big", signed=True).hex().upper()
    back = df.select("n", decode_long(encode_long("n")).alias("m")).collect()
    assert all(r["n"] == r["m"] for r in back)


def test_iso_instant_rendering(spark):
    ts = [dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 7, 179000),
          dt.datetime(2024, 1, 1, 0, 0, 7, 179575)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = [r[0] for r in df.select(iso_instant("t")).collect()]
    assert got == ["1970-01-01T00:00:00Z", "2024-01-01T00:00:07.179Z", "2024-01-01T00:00:07.179575Z"]


def test_summary_json(spark):
    df = spark.createDataFrame([(3, 22, dt.datetime(2024, 1, 1, 0, 0, 2))], "c long, b long, t timestamp_ntz")
    assert df.select(summary_json("c", "b", "t")).first()[0] == \
        '{"count":3,"balance":22,"time":"2024-01-01T00:00:02Z"}'
    assert df.select(F.lit(1)).count() == 1


def test_instants_do_not_depend_on_session_time_zone(spark):
    from keytally.functions.times import parse_iso_instant, truncate_millis
    ts = [dt.datetime(2024, 3, 10, 2, 30, 0, 500000), dt.datetime(2024, 11, 3, 1, 30),
          dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    texts = ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z", "2024-03-10T07:30:00Z"]
    results = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            a = [tuple(r) for r in spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
                 .select(iso_instant("t"), truncate_millis("t")).collect()]
            b = [r[0] for r in spark.createDataFrame([(s,) for s in texts], "s string")
                 .select(parse_iso_instant("s")).collect()]
            results.append((a, b))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]
    a, b = results[0]
    assert a[0][0] == "2024-03-10T02:30:00.500Z"
    assert a[2][1] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert b == [dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30), dt.datetime(2024, 3, 10, 7, 30)]
