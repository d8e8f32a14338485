"""Session helpers: building a session for tests/bench and finding the shared
folder for checkpoints and result tables.

Jobs never pick a machine-local folder on their own: they read
``spark.checkpoint.dir`` from the session (the cluster names a shared folder
there).  Only when it is unset -- local tests, the bench -- do we set one.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "keytally", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  UI off, UTC, AQE on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the Python state worker of transformWithStateInPandas talks over a
        # unix socket instead of a TCP port
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only where it is unset and Spark runs in one process
    (tests, a laptop) a fresh folder is created and registered on the session, so
    every later job of this session uses the same root.  On a cluster an unset
    folder is an error: executors cannot see the driver's temporary folders.
    """
    # the configured folder itself: stable across restarts (getCheckpointDir()
    # adds a per-context random subfolder, so a restarted job would not find
    # its checkpoint there)
    root = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()  # set in code, e.g. by tests
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="keytally-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def job_dir(spark: SparkSession, job_name: str, fresh: bool = True) -> str:
    """A folder for one job's checkpoint and result under the shared root.

    ``fresh=True`` gives a new folder per call (a one-shot run over a table);
    ``fresh=False`` gives the stable folder a long-running job restarts from.
    """
    base = checkpoint_root(spark).rstrip("/") + "/" + job_name
    if fresh:
        base = base + "/" + uuid.uuid4().hex
    return base


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply SQL settings for the duration of a block, then restore them.

    Used around ``writeStream.start()``: a streaming query runs on a clone of
    the session taken at start, so its settings stay with the query and the
    caller's session is left as it was.
    """
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
