"""Provider jobs as a stream of status events, with one state per paper."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from attesta.streaming.incremental import job_state

#: The state store that keeps values and timers; a setting of the session.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Jobs(StatefulProcessor):
    """attempts: submissions that ended badly; over: done or given up, and whatever comes later is ignored."""

    def __init__(self, most: int, patience_ms: int | None):
        self.most, self.patience = most, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("job", "attempts int, over boolean, place long, due long")

    def _state(self) -> list:
        held = self.held.get()  # one call of the store for a paper, where a frame and its look-ups took several
        return [0, False, None, None] if held is None else list(held)

    def _out(self, key, outcome: str, attempts: int) -> Row:
        return Row(paper_id=key[0], outcome=outcome, attempts=attempts)

    def _failed(self, state: list) -> str | None:
        state[0] += 1
        state[1] = state[0] >= self.most
        return "given_up" if state[1] else None

    def _wait(self, state: list, due: int | None) -> None:
        if state[3] is not None and state[3] != due:
            self.handle.deleteTimer(state[3])
        if due is not None and state[3] != due:
            self.handle.registerTimer(due)
        state[3] = due

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, outcome = self._state(), None
        for e in sorted(rows, key=lambda r: r.seq):
            if state[1] or (state[2] is not None and e.seq <= state[2]):
                continue  # over, or told before: a replayed event changes nothing
            state[2] = int(e.seq)
            if e.state == "running" and self.patience is not None:
                self._wait(state, int(e.at.timestamp() * 1000) + self.patience)
            else:
                self._wait(state, None)
            if e.state == "done":
                outcome, state[1] = "done", True
            elif e.state == "failed":
                outcome = self._failed(state)
        if state[1]:
            self._wait(state, None)
        self.held.update(tuple(state))
        if outcome:
            yield self._out(key, outcome, state[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self._state()
        state[3] = None
        outcome = None if state[1] else self._failed(state)
        self.held.update(tuple(state))
        if outcome:
            yield self._out(key, outcome, state[0])


def outcomes(events: DataFrame, most: int = 2, patience: str | None = None, late: str = "10 minutes") -> DataFrame:
    """A stream of events (paper_id, seq, status, at) as a stream (paper_id, outcome, attempts), a row when a paper is
    done or given up, after ``most`` failed attempts. Statuses are what providers call them; seq is their order within a
    paper, and an event that is not after the last one known changes nothing, so a replay is harmless. With ``patience``, a job
    that runs without news for so long in the time of ``at``, by a watermark of ``late``, counts as failed.

    State and timers stand in the session's state store (``STORE`` must be set); a restart from the checkpoint goes on."""
    told = events.select("paper_id", "seq", job_state(F.col("status")).alias("state"), F.col("at").cast("timestamp").alias("at")).where("state <> 'none'")
    ms = None
    if patience is not None:
        told = told.withWatermark("at", late)
        ms = int(pd.Timedelta(patience).total_seconds() * 1000)
    return told.groupBy("paper_id").transformWithState(
        statefulProcessor=_Jobs(most, ms), outputStructType=f"paper_id {dict(told.dtypes)['paper_id']}, outcome string, attempts int", outputMode="Append", timeMode="None" if ms is None else "EventTime"
    )
