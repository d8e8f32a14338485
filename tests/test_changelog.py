"""Two-level running aggregates and previous value against brute force."""

import random

import pytest

from keytally.operators.changelog import previous_value, running


def rows_with_skew(n=1200, seed=1):
    rnd = random.Random(seed)
    out = []
    for off in range(n):
        k = "hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 30)}"
        out.append((off * 3 + rnd.randint(0, 2), k, rnd.randint(-50, 99)))
    return out


@pytest.mark.parametrize("buckets", [1, 5, 50, 5000])
def test_running_sum_count_max(spark, buckets):
    rows = rows_with_skew()
    df = spark.createDataFrame(rows, "o long, k string, v long")
    got = running(df, "k", "o", {"s": ("sum", "v"), "n": ("count", "v"), "m": ("max", "v")}, buckets=buckets)
    got = sorted(tuple(r) for r in got.select("o", "k", "s", "n", "m").collect())
    acc = {}
    want = []
    for o, k, v in sorted(rows):
        s, n, m = acc.get(k, (0, 0, None))
        s, n, m = s + v, n + 1, v if m is None else max(m, v)
        acc[k] = (s, n, m)
        want.append((o, k, s, n, m))
    assert got == sorted(want)


@pytest.mark.parametrize("buckets", [1, 9, 300])
def test_previous_value(spark, buckets):
    rows = rows_with_skew(600, seed=5)
    rows = [(o, k, None if v % 7 == 0 else str(v)) for o, k, v in rows]
    df = spark.createDataFrame(rows, "o long, k string, v string")
    got = sorted(tuple(r) for r in previous_value(df, "k", "o", "v", out="p", buckets=buckets)
                 .select("o", "k", "v", "p").collect())
    last, want = {}, []
    for o, k, v in sorted(rows):
        want.append((o, k, v, last.get(k)))
        last[k] = v
    assert got == sorted(want)


def test_running_plan_has_no_extra_exchange_before_inner_window(spark):
    rows = rows_with_skew(100)
    df = spark.createDataFrame(rows, "o long, k string, v long")
    out = running(df, "k", "o", {"s": ("sum", "v")}, buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # exchanges: totals aggregate, the carry window by key, the join's two sides;
    # the inner window reuses the join's hash partitioning on (key, bucket)
    assert plan.count("Exchange hashpartitioning") <= 4
