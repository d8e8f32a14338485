"""Streams equal batch: several micro-batches, out-of-order files, restarts,
and a failure inside the upsert sink (exactly-once output)."""

import os

import pytest
from pyspark.sql import functions as F

from keytally.operators.pairs import split_pairs
from keytally.plans import catalog, streams
from keytally.sources import topics
from keytally.streaming import jobs
from keytally.streaming.upsert import UpsertSink, compact, read_upsert

from conftest import SF_CHECK, SF_SMALL


def split_table(spark, sf_dir, name, order_col, out_dir, parts, reverse=False, only=None):
    """Write a driver table as ``parts`` files, one per order range, into
    ``out_dir/<name>/c<i>/``.  With ``reverse`` the newest rows are written
    first (the file source reads oldest files first)."""
    df = topics.read_table(spark, sf_dir, name)
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    width = (hi - lo) // parts + 1
    idx = list(range(parts))
    if reverse:
        idx = idx[::-1]
    for i in (only if only is not None else idx):
        chunk = df.where((F.col(order_col) >= lo + i * width) & (F.col(order_col) < lo + (i + 1) * width))
        chunk.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/{name}/c{i}")
    return out_dir


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("reverse", [False, True])
def test_stream_equals_batch_over_micro_batches(spark, scratch, reverse):
    d = split_table(spark, SF_CHECK, "events", "event_id", scratch, 4, reverse=reverse)
    for name in ["stream_latest_by_key", "stream_latest_with_deletes", "stream_account_summary",
                 "stream_current_value_count"]:
        got = streams.STREAM_QUERIES[name](spark, d, max_files_per_trigger=1)
        want = catalog.BATCH_QUERIES[name.replace("stream_", "")](spark, SF_CHECK)
        assert rows(got.select(*want.columns)) == rows(want), name


def test_stream_word_count_equals_batch(spark, scratch):
    d = split_table(spark, SF_SMALL, "documents", "doc_id", scratch, 3, reverse=True)
    got = streams.stream_word_count(spark, d, max_files_per_trigger=1)
    assert rows(got) == rows(catalog.word_count(spark, SF_SMALL))


def test_restart_on_same_checkpoint_counts_once(spark, scratch):
    name = "restart_" + os.path.basename(scratch)
    d = split_table(spark, SF_CHECK, "events", "event_id", scratch, 4, only=[0, 1])

    def start():
        ev = topics.read_table_stream(spark, d, "events", 1)
        pairs = split_pairs(topics.colour_lines(ev), allowed=catalog.COLOUR_VALUES)
        return jobs.current_value_count_job(pairs, name, fresh=False)

    first = start()
    first.run_to_end(spark)
    again = start()  # nothing new: must not change the table
    again.run_to_end(spark)
    split_table(spark, SF_CHECK, "events", "event_id", scratch, 4, only=[2, 3])
    final = start().run_to_end(spark)
    want = catalog.current_value_count(spark, SF_CHECK).withColumnRenamed("colour", "value")
    assert rows(final) == rows(want)


class FailOnce(UpsertSink):
    def __init__(self, path, flag, fail_batch):
        super().__init__(path)
        self.flag, self.fail_batch = flag, fail_batch

    def __call__(self, batch, batch_id):
        super().__call__(batch, batch_id)
        if batch_id == self.fail_batch and not os.path.exists(self.flag):
            open(self.flag, "w").close()
            raise RuntimeError("forced failure after writing the batch")


def test_failure_in_sink_replays_to_same_table(spark, scratch):
    d = split_table(spark, SF_CHECK, "events", "event_id", scratch, 4)
    out, ckpt, flag = f"{scratch}/table", f"{scratch}/ckpt", f"{scratch}/failed"

    def run():
        recs = topics.transaction_records(topics.read_table_stream(spark, d, "events", 1))
        from keytally.operators import accounts
        agg = accounts.summaries(accounts.parse_transactions(recs))
        q = (agg.writeStream.outputMode("update").option("checkpointLocation", ckpt)
             .foreachBatch(FailOnce(out, flag, 1)).trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
        return q, agg.schema

    q, schema = run()
    assert q.exception() is not None  # the forced failure stopped it
    q, schema = run()
    assert q.exception() is None
    got = read_upsert(spark, out, schema, ["name"])
    assert rows(got) == rows(catalog.account_summary(spark, SF_CHECK))
    # compaction up to the last committed batch keeps the answer, read in full
    # or from the snapshot on
    last = q.lastProgress["batchId"]
    assert compact(spark, out, schema, ["name"], up_to=last) == last
    want = rows(catalog.account_summary(spark, SF_CHECK))
    assert rows(read_upsert(spark, out, schema, ["name"])) == want
    assert rows(read_upsert(spark, out, schema, ["name"], since=last)) == want


def test_current_value_stream_with_deletes_and_late_files(spark, scratch):
    """Tombstones in the stateful step: a delete removes the key's value, an
    older row arriving later does not bring it back, a newer one does."""
    from keytally.operators import tables
    from keytally.streaming.upsert import read_upsert as read
    batches = [
        [(0, "ann", "red"), (1, "bob", "white"), (2, "cat", "red")],
        [(3, "ann", None), (4, "bob", "red"), (9, "cat", "white")],
        [(5, "ann", "white"), (6, "cat", "red"), (7, "dan", None)],  # cat@6 is older than cat@9
        [(8, "ann", None), (10, "dan", "white"), (11, "bob", "red")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "offset long, key string, value string").coalesce(1) \
            .write.parquet(f"{scratch}/recs/b{i}")
    stream = spark.readStream.schema("offset long, key string, value string") \
        .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{scratch}/recs")
    job = jobs.current_value_count_job(stream, "cv_deletes_" + os.path.basename(scratch), fresh=True)
    got = sorted(tuple(r) for r in job.run_to_end(spark).collect())
    allrows = [r for b in batches for r in b]
    want = sorted(tuple(r) for r in tables.count_by_current_value(
        spark.createDataFrame(allrows, "offset long, key string, value string")).collect())
    assert got == want == [("red", 1), ("white", 2)]
    assert len(job.query.recentProgress) >= 4


def test_changelog_stream_with_deletes_equals_batch(spark, scratch):
    from keytally.operators import tables
    from keytally.streaming import changelogs
    schema = "offset long, key string, value string"
    batches = [[(0, "ann", "red"), (1, "bob", "white")], [(2, "ann", None), (3, "bob", "red")],
               [(4, "ann", "white"), (5, "bob", None), (6, "cat", None)]]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{scratch}/recs/b{i}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/recs"))
    job = changelogs.current_value_changelog_job(stream, "cl_deletes_" + os.path.basename(scratch), fresh=True)
    got = rows(job.run_to_end(spark))
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    assert got == rows(tables.current_value_changelog(whole))
    assert {v: n for _, _, v, n in got} == {"red": 0, "white": 1}


def test_every_upsert_job_keeps_its_state_in_rocksdb(spark, scratch):
    from keytally.session import session_conf
    spark.createDataFrame([(0, "a", "x")], "offset long, key string, value string").write.parquet(f"{scratch}/r")
    stream = spark.readStream.schema("offset long, key string, value string").parquet(f"{scratch}/r")
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with session_conf(spark, {"spark.sql.streaming.stateStore.providerClass": heap}):
        job = jobs.word_count_job(stream, "rocks_" + os.path.basename(scratch), fresh=True)
    job.run_to_end(spark)
    assert any("rocksdb" in k for k in job.query.lastProgress["stateOperators"][0]["customMetrics"])


def test_bad_transaction_stops_the_stream(spark, scratch):
    rows = [(0, "a", '{"name":"a","amount":1,"time":"2024-01-01T00:00:00Z"}'),
            (1, "a", '{"name":"a","amount":1.5,"time":"2024-01-01T00:00:00Z"}')]
    spark.createDataFrame(rows, "offset long, key string, value string").write.parquet(f"{scratch}/tx")
    stream = spark.readStream.schema("offset long, key string, value string").parquet(f"{scratch}/tx")
    job = jobs.account_balance_job(stream, "bad_" + os.path.basename(scratch), fresh=True)
    with pytest.raises(Exception, match="bad transaction at offset 1"):
        job.run_to_end(spark)


def test_changelog_streams_over_micro_batches_equal_batch(spark, scratch):
    """Files in read order, one per micro-batch: the per-record changelog of the
    stream (seeded with earlier batches' totals) equals the batch changelog."""
    d = split_table(spark, SF_CHECK, "events", "event_id", scratch, 4)
    for name in ["stream_running_summary", "stream_running_balance", "stream_current_value_changelog"]:
        got = streams.STREAM_QUERIES[name](spark, d, max_files_per_trigger=1)
        want = catalog.BATCH_QUERIES[name.replace("stream_", "")](spark, SF_CHECK)
        assert rows(got.select(*want.columns)) == rows(want), name
    d2 = split_table(spark, SF_SMALL, "documents", "doc_id", scratch, 3)
    got = streams.stream_running_word_count(spark, d2, max_files_per_trigger=1)
    want = catalog.running_word_count(spark, SF_SMALL)
    assert rows(got.select(*want.columns)) == rows(want)


def test_upsert_table_compacts_itself(spark, scratch):
    """Every 2 batches the previous batch is compacted into a snapshot; reads
    start there and still give the batch answer, deletes included."""
    d = split_table(spark, SF_CHECK, "events", "event_id", scratch, 5)
    recs = topics.tombstone_records(topics.read_table_stream(spark, d, "events", 1))
    job = jobs.latest_by_key_job(recs, "compacting_" + os.path.basename(scratch), fresh=True, compact_every=2)
    got = job.run_to_end(spark)
    from keytally.streaming.upsert import latest_snapshot
    assert latest_snapshot(spark, job.result_path) == 3  # compacted at batches 2 and 4
    want = catalog.latest_with_deletes(spark, SF_CHECK)
    assert rows(got) == rows(want)
    assert rows(read_upsert(spark, job.result_path, job.schema, ["key"], since=None)) == rows(want)


def test_quarantine_keeps_bad_records_aside(spark, scratch):
    rows = [(0, "a", '{"name":"a","amount":1,"time":"2024-01-01T00:00:00Z"}'),
            (1, "a", '{"name":"a","amount":1.5,"time":"2024-01-01T00:00:00Z"}'),
            (2, "a", '{"name":"a","amount":2,"time":"2024-01-01T00:00:01Z"}')]
    spark.createDataFrame(rows, "offset long, key string, value string").write.parquet(f"{scratch}/tx")
    stream = spark.readStream.schema("offset long, key string, value string").parquet(f"{scratch}/tx")
    name = "quarantine_" + os.path.basename(scratch)
    q, path = jobs.quarantine_job(stream, name, fresh=True)
    job = jobs.account_balance_job(stream, name, fresh=True, on_bad="quarantine")
    assert [tuple(r) for r in job.run_to_end(spark).collect()] == [("a", 3)]
    q.awaitTermination()
    bad = spark.read.parquet(path).collect()
    assert [(r["offset"], r["reason"]) for r in bad] == [(1, "amount missing or not an integer")]


def test_compaction_never_touches_a_batch_folder(spark, scratch):
    """A crash while a snapshot is written leaves every key; a rerun completes it."""
    import glob
    path, schema = f"{scratch}/t", "key string, count long"
    for n, batch in enumerate([[("a", 1), ("c", 1)], [("a", 2)], [("b", 2)]]):
        UpsertSink(path)(spark.createDataFrame(batch, schema), n)
    typed = spark.createDataFrame([], schema).schema
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/batch_id=*/*.parquet")}
    want = [("a", 2), ("b", 2), ("c", 1)]
    os.makedirs(f"{path}/_snapshots/1")  # as a crash in the middle of a compaction leaves it
    assert rows(read_upsert(spark, path, typed, ["key"])) == want
    assert compact(spark, path, typed, ["key"], up_to=1) == 1
    assert rows(read_upsert(spark, path, typed, ["key"])) == want
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{path}/batch_id=*/*.parquet")} == before
