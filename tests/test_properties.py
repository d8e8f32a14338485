"""Property tests: the two-level changelog operators equal a plain in-order
scan for any data, any skew and any bucket count."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keytally.operators.changelog import previous_value, running

rows_st = st.lists(
    st.tuples(st.integers(0, 400), st.sampled_from(["a", "b", "hot", "hot", "hot"]),
              st.one_of(st.none(), st.integers(-20, 20))),
    min_size=1, max_size=60,
).map(lambda rs: [(o * 1000 + i, k, v) for i, (o, k, v) in enumerate(rs)])  # unique orders


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, buckets=st.integers(1, 40))
def test_running_equals_scan(spark, rows, buckets):
    df = spark.createDataFrame(rows, "o long, k string, v long")
    got = running(df, "k", "o", {"s": ("sum", "v"), "n": ("count", "v"), "m": ("max", "v")}, buckets=buckets)
    got = sorted(tuple(r) for r in got.select("o", "k", "s", "n", "m").collect())
    acc, want = {}, []
    for o, k, v in sorted(rows):
        s, n, m = acc.get(k, (None, 0, None))
        if v is not None:
            s = v if s is None else s + v
            n += 1
            m = v if m is None else max(m, v)
        acc[k] = (s, n, m)
        want.append((o, k, s, n, m))
    assert got == sorted(want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, buckets=st.integers(1, 40))
def test_previous_value_equals_scan(spark, rows, buckets):
    df = spark.createDataFrame(rows, "o long, k string, v long")
    got = sorted(tuple(r) for r in previous_value(df, "k", "o", "v", out="p", buckets=buckets)
                 .select("o", "k", "v", "p").collect())
    last, want = {}, []
    for o, k, v in sorted(rows):
        want.append((o, k, v, last.get(k)))
        last[k] = v
    assert got == sorted(want)
