"""Frames that one result reads several times are held or cut, so that neither their plan nor their work is repeated."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame

_held: list[DataFrame] = []


def hold(df: DataFrame) -> DataFrame:
    """df, kept in Spark's cache from when it is first computed until release(); nothing runs here. What a lost executor
    held is computed anew."""
    _held.append(df.persist())
    return _held[-1]


def release() -> None:
    """Lets go of all held frames. Results that were built on them still give their rows, computed anew."""
    while _held:
        _held.pop().unpersist()


def cut(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder and read from there, so that what is built on it has a short plan.

    The folder is the session's spark.checkpoint.dir, which all executors share. Where none is set, a temporary one
    serves a session on one machine; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
