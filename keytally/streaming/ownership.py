"""An output folder belongs to the checkpoint that fills it.

A job's output is exactly once only together with its checkpoint: batch ids say which
folder a micro-batch rewrites.  A second job, or the same job with a new checkpoint, would
overwrite batches 0, 1, ... of an older run with other rows.  So every checkpoint gets a
run id, kept beside Spark's own files, and the output keeps the id of its owner; starting
a job on an output that another checkpoint filled is refused before anything is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUN_ID = "keytally_run_id"  # in the checkpoint folder
OWNER = "_owner"  # in the output folder; readers of the folder skip names like this


class OutputOwnedElsewhere(ValueError):
    """The output folder was filled under another checkpoint."""


def _file(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _read(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _file(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _file(spark, path)
    stream = fs.create(jpath, False)  # two starters cannot both write it
    try:
        stream.writeUTF(text)
    finally:
        stream.close()


def _has_batches(spark: SparkSession, path: str, batch_col: str) -> bool:
    fs, jpath = _file(spark, path)
    return fs.exists(jpath) and any(st.getPath().getName().startswith(f"{batch_col}=") for st in fs.listStatus(jpath))


def claim(spark: SparkSession, output: str, checkpoint: str, batch_col: str = "batch_id") -> str:
    """Make ``checkpoint`` the owner of ``output`` and return its run id.

    Raises :class:`OutputOwnedElsewhere` if another checkpoint owns the output, or if it
    already holds batches while the checkpoint has never run (a new checkpoint on an old
    folder).  A restart on the same checkpoint and output passes."""
    output, checkpoint = output.rstrip("/"), checkpoint.rstrip("/")
    run, owner = _read(spark, f"{checkpoint}/{RUN_ID}"), _read(spark, f"{output}/{OWNER}")
    if owner is not None and owner != run:
        raise OutputOwnedElsewhere(f"{output} belongs to run {owner}, checkpoint {checkpoint} to {run or 'none yet'}")
    if run is None:
        fs, started = _file(spark, f"{checkpoint}/metadata")  # Spark's own, once a query ran
        if not fs.exists(started) and _has_batches(spark, output, batch_col):
            raise OutputOwnedElsewhere(f"{output} holds batches, but checkpoint {checkpoint} is new")
        run = uuid.uuid4().hex
        _write(spark, f"{checkpoint}/{RUN_ID}", run)
    if owner is None:
        _write(spark, f"{output}/{OWNER}", run)
    return run
