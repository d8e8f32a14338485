"""Transactions: parsing (T6, T8), balances and summaries (T12)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from keytally.functions.times import parse_iso_instant
from keytally.operators import accounts

REC = "offset long, key string, value string"


def tx(off, name, amount, time):
    return (off, name, '{"name":"%s","amount":%s,"time":"%s"}' % (name, amount, time))


def test_summary_fixture(spark):
    rows = [tx(0, "ann", 10, "2024-01-01T00:00:02Z"), tx(1, "ann", 5, "2024-01-01T00:00:01Z"),
            tx(2, "ann", 7, "1969-12-31T00:00:00Z"), tx(3, "old", 4, "1969-12-31T00:00:00Z")]
    t = accounts.parse_transactions(spark.createDataFrame(rows, REC))
    got = {r["name"]: (r["count"], r["balance"], r["time"]) for r in accounts.summaries(t).collect()}
    assert got["ann"] == (3, 22, dt.datetime(2024, 1, 1, 0, 0, 2))
    assert got["old"] == (1, 4, dt.datetime(1970, 1, 1))
    bal = {r["name"]: r["balance"] for r in accounts.balances(t).collect()}
    assert bal == {"ann": 22, "old": 4}


def test_running_summary_fixture(spark):
    rows = [tx(0, "ann", 10, "2024-01-01T00:00:02.5Z"), tx(1, "ann", 5, "2024-01-01T00:00:01Z")]
    t = accounts.parse_transactions(spark.createDataFrame(rows, REC))
    got = sorted(tuple(r) for r in accounts.running_summaries(t, buckets=2).collect())
    assert got == [(0, "ann", 1, 10, dt.datetime(2024, 1, 1, 0, 0, 2, 500000)),
                   (1, "ann", 2, 15, dt.datetime(2024, 1, 1, 0, 0, 2, 500000))]


def test_millisecond_truncation(spark):
    rows = [tx(0, "a", 1, "2024-01-01T00:00:07.179575Z")]
    t = accounts.parse_transactions(spark.createDataFrame(rows, REC)).first()
    assert t["time"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


# Fixed samples of ISO instants (JDK Instant.parse against the guard).
ACCEPT = ["2024-01-01T00:00:07Z", "2024-01-01T00:00:07.123456789Z", "2024-01-01T00:00:07+07:00"]
REJECT = ["2024-01-01T00:00Z", "2024-01-01T00:00:07", "2024-01-01T00:00:07+07", "2024-13-01T00:00:07Z",
          "2024-02-30T00:00:00Z", "2024-01-01", "2024-01-01 00:00:07Z"]


def test_iso_instants(spark):
    df = spark.createDataFrame([(s,) for s in ACCEPT + REJECT], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", parse_iso_instant("s").alias("t")).collect()}
    for s in ACCEPT:
        assert got[s] is not None, s
    for s in REJECT:
        assert got[s] is None, s
    assert got["2024-01-01T00:00:07+07:00"] == dt.datetime(2023, 12, 31, 17, 0, 7)


BAD = ["{}", "junk", '{"amount":null,"time":"2024-01-01T00:00:00Z"}', '{"amount":12.7,"time":"2024-01-01T00:00:00Z"}',
       '{"amount":"12","time":"2024-01-01T00:00:00Z"}', '{"amount":1,"time":"2024-01-01"}', None]


def test_bad_transactions_quarantine_and_drop(spark):
    rows = [(i, "a", v) for i, v in enumerate(BAD)] + [tx(99, "a", 3, "2024-01-01T00:00:00Z")]
    df = spark.createDataFrame(rows, REC)
    bad = {r["offset"]: r["reason"] for r in accounts.bad_transactions(df).collect()}
    assert sorted(bad) == list(range(len(BAD)))
    assert bad[5] == "time not an ISO-8601 instant"
    good = accounts.parse_transactions(df, on_bad="drop").collect()
    assert [(r["offset"], r["amount"]) for r in good] == [(99, 3)]


@pytest.mark.parametrize("value", [v for v in BAD if v is not None])
def test_bad_transaction_fails_by_default(spark, value):
    df = spark.createDataFrame([(0, "a", value)], REC)
    with pytest.raises(PySparkException):
        accounts.parse_transactions(df).collect()
    with pytest.raises(PySparkException):  # also where the plan reads no parsed column
        accounts.parse_transactions(df).groupBy("name").count().collect()


def test_null_value_is_skipped_not_failed(spark):
    df = spark.createDataFrame([(0, "a", None), tx(1, "a", 4, "2024-01-01T00:00:00Z")], REC)
    assert [r["amount"] for r in accounts.parse_transactions(df).collect()] == [4]


def test_balances_need_only_the_amount(spark):
    df = spark.createDataFrame([(0, "a", '{"amount":5}'), tx(1, "a", 4, "2024-01-01T00:00:00Z")], REC)
    for on_bad in ("fail", "drop"):
        parsed = accounts.parse_transactions(df, on_bad=on_bad, need_time=False)
        assert [tuple(r) for r in accounts.balances(parsed).collect()] == [("a", 9)]


def test_null_key_is_skipped_not_failed(spark):
    df = spark.createDataFrame([tx(0, None, 1, "2024-01-01T00:00:00Z")], REC)
    assert accounts.parse_transactions(df).count() == 0


def test_amounts_and_balances_are_64_bit(spark):
    big = 3_000_000_000  # beyond a 32-bit int, where the reference's JSON variant would overflow
    rows = [tx(0, "a", big, "2024-01-01T00:00:00Z"), tx(1, "a", big, "2024-01-01T00:00:01Z")]
    t = accounts.parse_transactions(spark.createDataFrame(rows, REC))
    assert accounts.balances(t).first()["balance"] == 2 * big
    assert [r["balance"] for r in accounts.running_summaries(t, buckets=2).orderBy("offset").collect()] == [big, 2 * big]
