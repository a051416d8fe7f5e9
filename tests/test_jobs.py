"""Job states over a stream of files, with restarts, replays and timers."""

import datetime as dt

import pytest

from attesta.streaming import jobs

EVENTS = "paper_id string, seq long, status string, at timestamp"


def run(spark, at, **how):
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    q = jobs.outcomes(events, **how).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert not q.isActive and q.exception() is None
    rows = spark.read.schema("paper_id string, outcome string, attempts int").parquet(f"{at}/out").collect()
    return sorted(tuple(r) for r in rows)


def add(spark, at, *rows):
    day = dt.datetime(2024, 1, 1)
    held = [(p, s, status, day + dt.timedelta(minutes=m)) for p, s, status, m in rows]
    spark.createDataFrame(held, EVENTS).coalesce(1).write.mode("append").parquet(f"{at}/in")


@pytest.fixture
def store(spark):
    before = spark.conf.get(jobs.STORE[0], None)
    spark.conf.set(*jobs.STORE)
    yield
    spark.conf.unset(jobs.STORE[0]) if before is None else spark.conf.set(jobs.STORE[0], before)


def test_states_survive_restarts_and_replays(spark, tmp_path, store):
    at = str(tmp_path)
    add(spark, at, ("a", 1, "in_progress", 0), ("a", 2, "expired", 1), ("b", 2, "completed", 1), ("b", 1, "running", 0), ("c", 1, "failed", 0), ("c", 2, "failed", 0), ("c", 3, "completed", 0), ("d", 1, None, 0))
    first = run(spark, at)
    assert first == [("b", "done", 0), ("c", "given_up", 2)]
    # the query starts anew from its checkpoint; what came before comes again
    add(spark, at, ("a", 2, "expired", 1), ("a", 3, "running", 2), ("a", 4, "JOB_STATE_SUCCEEDED", 3), ("c", 9, "completed", 9), ("b", 2, "completed", 1))
    assert run(spark, at) == sorted([*first, ("a", "done", 1)])


def test_silent_jobs_time_out(spark, tmp_path, store):
    at = str(tmp_path)
    add(spark, at, ("a", 1, "running", 0), ("b", 1, "running", 0))
    add(spark, at, ("b", 2, "completed", 20), ("z", 1, "running", 600))
    add(spark, at, ("z", 2, "running", 1200))
    got = run(spark, at, most=1, patience="1 hour")
    # a has been silent for an hour when the watermark passes; b was heard of, z still runs
    assert ("a", "given_up", 1) in got and ("b", "done", 0) in got


def test_two_calls_of_the_store_for_a_paper():
    from pyspark.sql import Row

    calls = []

    class Held:
        def exists(self):
            calls.append("exists")
            return False

        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append("update")

    job = jobs._Jobs(2, None)
    job.held = Held()
    events = [Row(seq=2, state="failed", at=None), Row(seq=1, state="failed", at=None)]
    assert list(job.handleInputRows(("a",), iter(events), None)) == [Row(paper_id="a", outcome="given_up", attempts=2)]
    assert calls == ["get", "update"]


ROWS = "paper_id string, v int"


def test_batches_open_only_files_of_their_keys(spark, tmp_path):
    from attesta.streaming import indexed

    at = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, ROWS)
    held = lambda: sorted(tuple(r) for r in indexed.read(spark, at, ROWS).collect())
    assert indexed.append(spark.range(500).selectExpr("concat('k', id) paper_id", "0 v"), 0, at, "paper_id", buckets=16) == 500
    files = len(list((tmp_path / "t" / "keys").rglob("*.parquet")))
    assert files == 16
    few = rows(("k7", 1), ("new", 1), ("new", 1), (None, 1))
    opened = indexed.known(spark, few.where("paper_id is not null"), "paper_id", at, buckets=16)
    assert 1 <= len(opened.inputFiles()) <= 2
    assert indexed.append(few, 1, at, "paper_id", buckets=16) == 1 and len(held()) == 501
    # the same batch again, also after a death between rows and keys, changes nothing
    for path in (tmp_path / "t" / "keys").rglob("batch=1"):
        for f in path.iterdir():
            f.unlink()
    assert indexed.append(few, 1, at, "paper_id", buckets=16) == 1 and len(held()) == 501
    assert indexed.append(rows(("new", 2), ("k9", 2)), 2, at, "paper_id", buckets=16) == 0 and len(held()) == 501


def test_files_lie_in_one_folder(spark, tmp_path):
    from attesta.plans import files

    at = tmp_path / "out"
    files._as_files(spark.createDataFrame([(f"text {i}",) for i in range(9)], "value string").coalesce(2), str(at))
    assert not [f for f in at.iterdir() if f.is_dir()]
    assert sorted(f.read_text() for f in at.glob("part-*")) == [f"text {i}\n" for i in range(9)]
