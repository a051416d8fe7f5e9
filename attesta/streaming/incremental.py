"""Incremental runs: job states, retries, and appending new papers as files arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.sources import sinks

# What providers call the states of a batch.
RUNNING = ["validating", "in_progress", "finalizing", "pending", "running", "queued", "JOB_STATE_PENDING", "JOB_STATE_RUNNING"]
DONE = ["completed", "succeeded", "ended", "JOB_STATE_SUCCEEDED"]


def job_state(status: Column) -> Column:
    """None, running, done or failed; failed is final, so its papers count an attempt."""
    return F.when(status.isNull(), "none").when(status.isin(RUNNING), "running").when(status.isin(DONE), "done").otherwise("failed")


def attempts_after(attempts: DataFrame, submitted: DataFrame) -> DataFrame:
    """One attempt more for each paper of a submission that succeeded."""
    one = submitted.select("paper_id", F.lit(1).cast("long").alias("attempts"))
    return attempts.select("paper_id", "attempts").unionByName(one).groupBy("paper_id").agg(F.sum("attempts").alias("attempts"))


def to_do(papers: DataFrame, done: DataFrame, attempts: DataFrame, most: int = 2) -> DataFrame:
    """Papers without a result and with attempts left."""
    spent = attempts.where(F.col("attempts") >= most).select("paper_id")
    return papers.join(done.select("paper_id"), "paper_id", "left_anti").join(spent, "paper_id", "left_anti")


def given_up(papers: DataFrame, done: DataFrame, attempts: DataFrame, most: int = 2) -> DataFrame:
    """Papers that used up their attempts without a result."""
    return papers.join(done.select("paper_id"), "paper_id", "left_anti").join(attempts.where(F.col("attempts") >= most), "paper_id")


def append_stream(spark: SparkSession, source: str, schema, path: str, checkpoint: str, key: str = "paper_id", flatten: Callable[[DataFrame], DataFrame] | None = None):
    """T4: takes files that have arrived in ``source`` and appends the papers that the table lacks; returns
    once all are taken. A batch that runs again appends nothing, so it is exactly once."""

    def each(batch: DataFrame, _: int) -> None:
        rows = flatten(batch) if flatten else batch
        sinks.append_new(spark, rows.dropDuplicates([key]) if not flatten else rows, path, key, f"{path}_delta")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def answered(requests: DataFrame, provider: Callable[[str], str], retries: int = 5) -> DataFrame:
    """The model call as a plug-in: requests (paper_id, prompt) -> (paper_id, text, error). T5, T6: a call
    that fails is tried again, ``retries`` times in all, then its error is a row and the batch goes on."""

    def call(batches: Iterator[pd.DataFrame]):
        for b in batches:
            out = []
            for paper, prompt in zip(b["paper_id"], b["prompt"], strict=True):
                text, error = None, None
                for _ in range(retries):
                    try:
                        text, error = provider(prompt), None
                        break
                    except Exception as e:  # noqa: BLE001 - whatever the plug-in raises becomes a row
                        error = str(e)
                out.append((paper, text, error))
            yield pd.DataFrame(out, columns=["paper_id", "text", "error"])

    return requests.select("paper_id", "prompt").mapInPandas(call, "paper_id string, text string, error string")
