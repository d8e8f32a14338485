"""Plan shapes the design depends on (checked with AQE off, on the initial plan)."""

import re

import pytest

from keytally.operators.changelog import previous_value, running
from keytally.plans import catalog

from conftest import SF_SMALL


@pytest.fixture()
def plan(spark):
    def _plan(df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    return _plan


def test_word_count_partial_then_final_and_one_split(spark, plan):
    p = plan(catalog.word_count(spark, SF_SMALL))
    assert "partial_count" in p and "Exchange hashpartitioning(word" in p
    assert len(re.findall(r"split\(lower", p)) == 1, p
    assert "size(" not in p.split("Exchange RoundRobinPartitioning")[1]  # no inferred filter on the scan


def test_latest_and_current_counts_partial_no_join(spark, plan):
    p = plan(catalog.latest_by_key(spark, SF_SMALL))
    assert "partial_max_by" in p
    p = plan(catalog.current_value_count(spark, SF_SMALL))
    assert "Join" not in p and "partial_sum" in p


def test_summary_parses_json_once(spark, plan):
    p = plan(catalog.account_summary(spark, SF_SMALL))
    assert len(re.findall(r"from_json\(", p)) == 2  # one to build amount from props, one parse of the record
    assert "partial_count" in p and "partial_sum" in p and "partial_max" in p


def test_changelogs_have_no_join(spark, plan):
    df = spark.range(0, 1000).selectExpr("id as o", "cast(id % 3 as string) as k", "id as v")
    for out in (running(df, "k", "o", {"s": ("sum", "v")}, buckets=8),
                previous_value(df, "k", "o", "v", buckets=8)):
        p = plan(out)
        assert "Join" not in p and "Union" in p
        assert "hashpartitioning(k#" in p


def test_running_queries_have_no_join(spark, plan):
    for name in ("running_word_count", "running_summary", "current_value_changelog"):
        p = plan(catalog.BATCH_QUERIES[name](spark, SF_SMALL))
        assert "Join" not in p, name


@pytest.mark.parametrize("name", ["current_value_count", "running_word_count"])
def test_shared_input_exchange_is_reused(spark, name):
    """Both branches of these plans read one exchange of the input (AQE final plan)."""
    df = catalog.BATCH_QUERIES[name](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    assert "ReusedExchange" in qe.executedPlan().toString()
