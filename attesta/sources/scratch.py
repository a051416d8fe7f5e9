"""New folders for tables that a query writes and reads again."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is not set, a local one, in a local session only."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not held.isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="attesta-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get()


def folder(spark: SparkSession) -> str:
    """A path in it that nothing uses yet; what is written there goes when the program ends."""
    path = f"{shared(spark)}/files-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the JVM may be gone by now; the cluster's own cleaning takes the rest
            return
