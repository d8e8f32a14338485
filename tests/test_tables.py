"""Latest value per key, current-value counts (trap T4) and their changelog."""

import random

from pyspark.sql import functions as F

from keytally.operators import tables

# Fixed sequence: ann red, bob white, ann white, bob white -> red 0, white 2.
COLOURS = [(0, "ann", "red"), (1, "bob", "white"), (2, "ann", "white"), (3, "bob", "white")]
SCHEMA = "offset long, key string, value string"


def test_latest_by_key(spark):
    df = spark.createDataFrame(COLOURS, SCHEMA)
    assert sorted(tuple(r) for r in tables.latest_by_key(df).collect()) == [("ann", "white"), ("bob", "white")]


def test_latest_by_key_uses_order_not_arrival(spark):
    df = spark.createDataFrame([(5, "a", "x"), (1, "a", "y")], SCHEMA)
    assert [tuple(r) for r in tables.latest_by_key(df).collect()] == [("a", "x")]


def test_tombstone_deletes_and_value_comes_back(spark):
    rows = [(0, "a", "x"), (1, "a", None), (2, "b", "y"), (3, "b", None), (4, "b", "z"), (5, None, "q")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in tables.latest_by_key(df).collect()] == [("b", "z")]
    kept = sorted(tuple(r) for r in tables.latest_by_key(df, deletes=False).collect())
    assert kept == [("a", None), ("b", "z")]


def test_count_by_current_value_keeps_zero(spark):
    df = spark.createDataFrame(COLOURS, SCHEMA)
    got = sorted(tuple(r) for r in tables.count_by_current_value(df).collect())
    assert got == [("red", 0), ("white", 2)]


def brute_changelog(rows):
    cur, counts, out = {}, {}, []
    for off, k, v in sorted(rows):
        old = cur.get(k)
        if old is not None:
            counts[old] -= 1
            out.append((off, 0, old, counts[old]))
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
            out.append((off, 1, v, counts[v]))
        cur[k] = v
    return sorted(out)


def test_changelog_fixture(spark):
    df = spark.createDataFrame(COLOURS, SCHEMA)
    got = sorted(tuple(r) for r in tables.current_value_changelog(df, bounds=(0, 3), buckets=2).collect())
    assert got == brute_changelog(COLOURS)
    assert got[-1] == (3, 1, "white", 2)


def test_changelog_hot_key_many_buckets(spark):
    rnd = random.Random(3)
    # one key holds a third of all rows; three values only
    rows = []
    for off in range(900):
        k = "hot" if off % 3 == 0 else f"u{rnd.randint(0, 40)}"
        rows.append((off, k, rnd.choice(["r", "g", "b"])))
    df = spark.createDataFrame(rows, SCHEMA)
    for buckets in (1, 7, 64):
        got = sorted(tuple(r) for r in tables.current_value_changelog(df, buckets=buckets).collect())
        assert got == brute_changelog(rows), buckets


def test_changelog_with_deletes_ends_at_the_table(spark):
    rnd = random.Random(5)
    rows = [(off, f"u{rnd.randint(0, 9)}", rnd.choice(["r", "g", None])) for off in range(200)]
    rows += [(200, "none", None), (201, None, "r")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_changelog([r for r in rows if r[1] is not None])
    for buckets in (1, 9):
        got = sorted(tuple(r) for r in tables.current_value_changelog(df, buckets=buckets).collect())
        assert got == want, buckets
    last = {v: n for _, _, v, n in want}
    assert last == dict(tuple(r) for r in tables.count_by_current_value(df).collect())


def test_struct_read_order_across_partitions(spark):
    """Records of one key in two partitions: (timestamp, partition, offset) orders them."""
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("u", "red", t, 0, 5), ("u", "white", t + dt.timedelta(seconds=1), 1, 2),
            ("v", "red", t, 1, 3), ("v", "white", t, 0, 9)]  # same time: partition breaks the tie
    df = spark.createDataFrame(rows, "key string, value string, timestamp timestamp, partition int, offset long")
    df = df.withColumn("read_order", F.struct("timestamp", "partition", "offset"))
    got = sorted(tuple(r) for r in tables.latest_by_key(df, order="read_order").collect())
    assert got == [("u", "white"), ("v", "red")]
    counts = sorted(tuple(r) for r in tables.count_by_current_value(df, order="read_order").collect())
    assert counts == [("red", 1), ("white", 1)]
