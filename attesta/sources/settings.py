"""Settings and the log of events."""

from __future__ import annotations

import logging
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Under this prefix the session's own settings stand above those of the environment and of files.
PREFIX = "spark.attesta."


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """(name, value, origin) for each NAME=value line of a file that Spark can read, in any store: the value of the
    session's setting ``PREFIX`` + name, else of the environment, else of the file, where the first line of a name counts.
    Other lines are left out, quotes round a value go; no file is an empty table. Nothing is set anywhere."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    lines = spark.read.text(path, wholetext=True) if there else spark.createDataFrame([], "value string")
    line = r"^\s*([A-Za-z_]\w*)\s*=\s*(?:\"(.*)\"|'(.*)'|(.*?))\s*$"
    part = lambda i: F.regexp_extract("l", line, i)
    told = lines.select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "l")).where(part(1) != "").select("at", part(1).alias("name"), F.concat(part(2), part(3), part(4)).alias("own"))
    first = told.groupBy("name").agg(F.min_by("own", "at").alias("own"))
    over = []
    for (name,) in first.select("name").collect():  # the lines of one file
        held = spark.conf.get(PREFIX + name, None)
        over.append((name, os.environ.get(name) if held is None else held, "environment" if held is None else "session"))
    above = spark.createDataFrame(over, "name string, over string, origin string").where("over is not null")
    return first.join(above, "name", "left").select("name", F.coalesce("over", "own").alias("value"), F.coalesce("origin", F.lit("file")).alias("origin"))


class _Quiet(logging.FileHandler):
    """A full disk or a missing folder must not stop a run."""

    def emit(self, record):
        try:
            super().emit(record)
        except OSError:
            return

    def handleError(self, record):  # noqa: N802 - the name that logging calls
        return


def events(folder: str, step: str) -> logging.Logger:
    """A logger that adds timed lines to the folder's log and to that of its step, and never raises. It
    runs on the driver: events are steps, not rows."""
    log = logging.Logger(f"attesta.{step}")
    try:
        Path(folder).mkdir(parents=True, exist_ok=True)
    except OSError:
        return log
    for name in ("pipeline", step):
        one = _Quiet(Path(folder) / f"{name}.log", encoding="utf-8", delay=True)
        one.setFormatter(logging.Formatter(f"%(asctime)s  [{step}]  %(message)s", "%Y-%m-%d %H:%M:%S"))
        log.addHandler(one)
    return log
