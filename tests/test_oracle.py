"""Every registered batch query against its DuckDB SQL on the smallest tables,
and the changelogs closing on the batch state (last row per key = aggregate)."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from keytally.plans import catalog

from conftest import SF_SMALL


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.BATCH_QUERIES))
def test_batch_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, df.collect()) == canon(ocols, res.fetchall())


def test_every_query_has_sql():
    from keytally.plans.streams import STREAM_ORACLE, STREAM_QUERIES
    own = set(catalog.BATCH_QUERIES) | set(STREAM_QUERIES)
    assert own <= set(E.queries())
    assert own <= set(E.oracle_sql()) and set(STREAM_ORACLE) == set(STREAM_QUERIES)


def last_per_key(df, key, order):
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def test_running_summary_closes_on_summary(spark):
    run = last_per_key(catalog.running_summary(spark, SF_SMALL), "name", "event_id").drop("event_id")
    assert sorted(map(tuple, run.select("name", "count", "balance", "time").collect())) == \
        sorted(map(tuple, catalog.account_summary(spark, SF_SMALL).select("name", "count", "balance", "time").collect()))


def test_running_word_count_closes_on_word_count(spark):
    run = catalog.running_word_count(spark, SF_SMALL)
    w = Window.partitionBy("word").orderBy(F.col("doc_id").desc(), F.col("pos").desc())
    last = run.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("word", "count")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, catalog.word_count(spark, SF_SMALL).collect()))


def test_colour_changelog_closes_on_current_counts(spark):
    log = catalog.current_value_changelog(spark, SF_SMALL)
    w = Window.partitionBy("colour").orderBy(F.col("event_id").desc(), F.col("step").desc())
    last = log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("colour", "count")
    assert sorted(map(tuple, last.collect())) == \
        sorted(map(tuple, catalog.current_value_count(spark, SF_SMALL).collect()))
