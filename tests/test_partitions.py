"""Read order over partitions, from a source with partitions and offsets; owned outputs;
identities on topics; state of touched keys only."""

import glob
import os
from datetime import datetime, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import record_source
from keytally.operators import accounts, tables
from keytally.operators.changelog import BUCKET, order_cuts, with_bucket
from keytally.plans import catalog
from keytally.sources import sinks, topics
from keytally.streaming import apps, changelogs, current_value, jobs
from keytally.streaming.ownership import OutputOwnedElsewhere

from conftest import SF_SMALL

SCHEMA = "key string, value string, offset long, partition int, timestamp timestamp"

# (key, value, seconds) of two partitions: ann and bob are written to both, so offsets alone
# would keep ann's older "red" (offset 3) over her newer "white" (offset 0)
PARTS = {0: [("ann", "red", 1), ("cat", "red", 2), ("bob", "white", 5), ("ann", "red", 6), ("dan", "red", 7)],
         1: [("ann", "white", 9), ("bob", "red", 10), ("dan", None, 11), ("eve", "white", 12)]}
FINAL = {"ann": "white", "bob": "red", "cat": "red", "eve": "white"}


def at(seconds):
    return datetime.fromtimestamp(seconds, timezone.utc)


def records():
    return [(k, v, n, p, at(t)) for p, rows in PARTS.items() for n, (k, v, t) in enumerate(rows)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def file_stream(spark, scratch, order):
    """One file a partition, read one micro-batch each, in the given order of partitions."""
    for place, p in enumerate(order):
        path = f"{scratch}/recs/f{place}"
        spark.createDataFrame([r for r in records() if r[3] == p], SCHEMA).coalesce(1).write.parquet(path)
        for f in glob.glob(f"{path}/*.parquet"):
            os.utime(f, (1000 + place, 1000 + place))
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(f"{scratch}/recs"))


@pytest.fixture()
def whole(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    return df.withColumn("read_order", topics.read_order(df))


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_two_partitions_in_both_file_orders_equal_batch(spark, scratch, whole, order):
    name = os.path.basename(scratch)
    stream = file_stream(spark, scratch, order)
    got = jobs.current_value_count_job(stream, "count_" + name, fresh=True).run_to_end(spark)
    assert rows(got) == rows(tables.count_by_current_value(whole, order="read_order")) == [("red", 2), ("white", 2)]
    got = jobs.latest_by_key_job(stream, "latest_" + name, fresh=True).run_to_end(spark)
    assert dict(rows(got)) == dict(rows(tables.latest_by_key(whole, order="read_order"))) == FINAL
    # the changelog: in read order every record has its rows; a record that comes late,
    # older than what its key holds, has none, and the last counts are the same
    log = rows(changelogs.current_value_changelog_job(stream, "log_" + name, fresh=True).run_to_end(spark)
               .select("partition", "offset", "step", "value", "count"))
    want = rows(tables.current_value_changelog(whole.selectExpr("key", "value", "read_order.*"),
                                               order=["time", "partition", "offset"])
                .select("partition", "offset", "step", "value", "count"))
    if order == (0, 1):
        assert log == want
    else:
        late = {(0, 0), (0, 2), (0, 3), (0, 4), (1, 2)}  # dan's delete found nothing to delete yet
        assert {r[:2] for r in log} == {r[:2] for r in want} - late
        times = {(p, n): t for p, part in PARTS.items() for n, (_, _, t) in enumerate(part)}
        last = {}
        for p, n, step, v, c in sorted(log, key=lambda r: (r[0] == 0, times[r[:2]], r[2])):
            last[v] = c
        assert last == {"red": 2, "white": 2}


def test_partitioned_source_from_earliest_and_after_a_restart(spark, scratch):
    """A source with partitions and offsets: a new job starts at the earliest record, a
    restarted one at the offsets of its checkpoint, and partitions keep their order."""
    cloudpickle.register_pickle_by_value(record_source)
    spark.dataSource.register(record_source.RecordSource)
    folder, name = f"{scratch}/topic", "topic_" + os.path.basename(scratch)
    for p, part in PARTS.items():
        record_source.append(folder, p, part[:2])

    def run():
        stream = spark.readStream.format("test_records").load(folder)
        job = jobs.current_value_count_job(stream, name)
        out = job.run_to_end(spark)
        return rows(out), sum(p["numInputRows"] for p in job.query.recentProgress)

    assert run() == ([("red", 2), ("white", 1)], 4)  # from the earliest record on
    for p, part in PARTS.items():
        record_source.append(folder, p, part[2:])
    assert run() == ([("red", 2), ("white", 2)], 5)  # only what is new
    assert run()[0] == [("red", 2), ("white", 2)]


def test_logs_of_two_partitions_equal_batch(spark, scratch):
    """Balances in the order of topic time, whichever file comes first."""
    tx = [(k, '{"name":"%s","amount":%d,"time":"2024-01-01T00:00:%02dZ"}' % (k, 10 + t, t), n, p, at(t))
          for p, part in PARTS.items() for n, (k, _, t) in enumerate(part)]
    for place, p in enumerate((1, 0)):
        spark.createDataFrame([r for r in tx if r[3] == p], SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/f{place}")
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
    job = changelogs.running_summary_job(stream, "sums_" + os.path.basename(scratch), fresh=True)
    got = rows(job.run_to_end(spark).select("partition", "offset", "name", "count", "balance"))
    seen, want = {}, []
    for k, _, n, p, t in sorted(tx, key=lambda r: r[4]):
        count, total = seen.get(k, (0, 0))
        seen[k] = (count + 1, total + 10 + int(t.timestamp()))
        want.append((p, n, k, *seen[k]))
    assert got == sorted(want)


def test_a_hot_key_sends_one_row_per_task_and_value(spark):
    hot = [("hot", f"v{n % 3}", n, 0, at(n)) for n in range(4000)]
    cold = [(f"k{n % 500}", "x", n, 1, at(n)) for n in range(8000)]
    recs = spark.createDataFrame(hot + cold, SCHEMA).repartition(6)
    sent = current_value.newest_per_value(current_value.versioned(recs))
    assert sent.where("key = 'hot'").count() <= 6 * 3
    newest = sent.groupBy("key").agg(F.max_by("value", F.struct("time", "partition", "offset")).alias("value"))
    assert dict(rows(newest))["hot"] == "v0"


def test_a_batch_updates_the_state_of_its_own_keys(spark, scratch):
    """500 accounts, then one: the second micro-batch touches one row of state, and no
    totals are kept beside the output."""
    def write(n, names):
        recs = [(k, '{"name":"%s","amount":1,"time":"2024-01-01T00:00:00Z"}' % k, n * 1000 + i, 0, at(i))
                for i, k in enumerate(names)]
        spark.createDataFrame(recs, SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/b{n}")

    write(0, [f"a{i}" for i in range(500)])
    base = f"{scratch}/out"

    def run():
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
        job = changelogs.running_balance_job(stream, "own_" + os.path.basename(scratch), base=base)
        return job.run_to_end(spark), [p for p in job.query.recentProgress if p["numInputRows"]][-1]

    run()
    write(1, ["a7", "a7"])
    out, progress = run()
    state = progress["stateOperators"][0]
    assert (state["numRowsTotal"], state["numRowsUpdated"]) == (500, 1)
    assert sorted(r["balance"] for r in out.where("name = 'a7'").collect()) == [1, 2, 3]
    assert sorted(os.path.basename(p) for p in glob.glob(f"{base}/*")) == ["changelog", "checkpoint"]


def test_one_outlier_leaves_equal_buckets(spark):
    df = spark.range(20000).selectExpr("id as o").union(spark.createDataFrame([(10 ** 15,)], "o long"))
    for buckets in (4, 32):
        sizes = [r["count"] for r in with_bucket(df, "o", order_cuts(df, "o", buckets)).groupBy(BUCKET).count().collect()]
        assert len(sizes) == buckets and max(sizes) <= 2 * min(sizes), (buckets, sizes)
    # beyond the quantiles that are asked for, buckets are cut further by width
    cuts = order_cuts(spark.range(100000).selectExpr("id as o"), "o", 4000)
    many = with_bucket(spark.range(100000).selectExpr("id as o"), "o", cuts).groupBy(BUCKET).agg(
        F.min("o").alias("lo"), F.max("o").alias("hi"), F.count("o").alias("n")).orderBy(BUCKET).collect()
    assert len(many) > 3500 and max(r["n"] for r in many) < 200
    assert all(a["hi"] < b["lo"] for a, b in zip(many, many[1:]))  # never falls as the column rises


def test_building_a_word_count_starts_no_job(spark):
    context = spark.sparkContext
    context.setJobGroup("plan-only", "building plans")
    try:
        docs = topics.read_table(spark, SF_SMALL, "documents")  # reading a schema is Spark's own job
        context.setJobGroup("operators", "building plans")
        from keytally.operators import wordcount
        wordcount.word_count(topics.text_lines(docs))
        wordcount.line_tokens(topics.text_lines(docs))
        topics.small_table_parallelism(spark, SF_SMALL, "documents")
        assert list(context.statusTracker().getJobIdsForGroup("operators")) == []
    finally:
        context._jsc.clearJobGroup()


# --- owned outputs, identities on topics, publishing ---------------------------------------

def tx_folder(spark, scratch, n=40):
    recs = [(f"a{i % 5}", '{"name":"a%d","amount":%d,"time":"2024-01-01T00:00:00Z"}' % (i % 5, i), i, 0, at(i)) for i in range(n)]
    for b in range(2):
        spark.createDataFrame(recs[b::2], SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/b{b}")
    return f"{scratch}/in"


def app(spark, *argv):
    q = apps.start(spark, apps.parse_args([*argv, "--available-now", "--max-files-per-trigger", "1"]))
    q.awaitTermination()
    return q


@pytest.mark.parametrize("name", ["balance", "balance-log", "colour-count-log"])
def test_a_second_checkpoint_on_an_old_output_is_refused(spark, scratch, name):
    folder = tx_folder(spark, scratch)
    if name == "colour-count-log":
        folder = f"{scratch}/colours"
        spark.createDataFrame([(None, "ann,red", 0, 0, at(1))], SCHEMA).write.parquet(folder)
    out = f"{scratch}/out"
    common = [name, "--input-path", folder, "--output-path", out]
    assert app(spark, *common, "--checkpoint", f"{scratch}/one").exception() is None
    assert app(spark, *common, "--checkpoint", f"{scratch}/one").exception() is None  # a restart passes
    if name == "balance":  # the logs keep their checkpoint in the output folder
        before = sorted(glob.glob(f"{out}/**", recursive=True))
        with pytest.raises(OutputOwnedElsewhere):
            app(spark, *common, "--checkpoint", f"{scratch}/two")
        assert sorted(glob.glob(f"{out}/**", recursive=True)) == before
    else:
        os.rename(f"{out}/checkpoint", f"{scratch}/lost")
        with pytest.raises(OutputOwnedElsewhere):
            app(spark, *common)


def test_a_replay_writes_the_same_identities_and_runs_the_plan_once(spark, scratch, monkeypatch):
    folder, sent, fail = tx_folder(spark, scratch), [], {"at": 1}

    def write(df, topic, servers, **kw):
        got = {}
        for r in df.collect():
            headers = {h["key"]: bytes(h["value"]).decode() for h in r["headers"]}
            got[headers["row_id"]] = (headers["batch_id"], r["key"], bytes(r["value"]))
        assert len(got) == df.count()  # no identity twice
        sent.append(got)
        if len(sent) - 1 == fail["at"]:
            raise RuntimeError("the topic took the records, the acknowledgement was lost")

    monkeypatch.setattr(sinks, "write_topic", write)
    common = ["balance", "--input-path", folder, "--output-topic", "t", "--bootstrap-servers", "none:1",
              "--checkpoint", f"{scratch}/ckpt"]
    with pytest.raises(Exception, match="acknowledgement was lost"):
        app(spark, *common)
    fail["at"] = -1
    q = app(spark, *common)
    assert q.exception() is None
    assert sent[1] == sent[2] and {b for b, _, _ in sent[2].values()} == {"1"}
    total = {k: int.from_bytes(v, "big") for got in sent for _, k, v in got.values()}
    assert total == {f"a{n}": sum(i for i in range(40) if i % 5 == n) for n in range(5)}


def test_equal_records_have_identities_of_their_own(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), (None, "1"), (None, "1"), ("b", None)], "key string, value string")
    ids = [r["headers"][1]["value"] for r in sinks.identified(df, 3).collect()]
    again = [r["headers"][1]["value"] for r in sinks.identified(df.repartition(3), 3).collect()]
    assert len(set(map(bytes, ids))) == 5 and sorted(map(bytes, ids)) == sorted(map(bytes, again))


def test_publishing_any_table(spark, scratch):
    """orders as transactions: the columns are named on the command line."""
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    table = orders.select(F.col("o_custkey"), F.col("o_totalprice").cast("long").alias("cents"),
                          F.col("o_orderdate").cast("timestamp_ntz").alias("at"), "o_orderkey")
    table.write.parquet(f"{scratch}/orders")
    q = app(spark, "publish-transactions", "--input-path", f"{scratch}/orders", "--output-path", f"{scratch}/out",
            "--checkpoint", f"{scratch}/ckpt", "--name-column", "o_custkey", "--amount-column", "cents", "--time-column", "at")
    assert q.exception() is None
    got = spark.read.parquet(f"{scratch}/out").select("key", "value", F.lit(0).cast("long").alias("offset"))
    want = table.groupBy(F.col("o_custkey").cast("string").alias("name")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("cents").alias("balance"), F.max("at").alias("time"))
    assert rows(accounts.summaries(accounts.parse_transactions(got))) == rows(want)
    with pytest.raises(SystemExit):
        apps.parse_args(["publish-transactions", "--input-path", "/in", "--output-path", "/o", "--name-column", "x"])


def test_bad_transactions_are_listed_with_every_reason(spark):
    bad = catalog.bad_transactions(spark, SF_SMALL)
    assert {r["reason"] for r in bad.select("reason").distinct().collect()} == {
        "null key", "null value", "not a JSON object", "amount missing or not an integer", "time missing",
        "time not an ISO-8601 instant", "time not a valid instant"}
