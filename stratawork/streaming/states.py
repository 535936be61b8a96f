"""States of scans as a stream: allowed transitions, and an end for those that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stratawork.operators.config import STATES

#: What a stream of states needs of the session.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUTPUT = "scan string, state string, rows bigint, accepted boolean, reason string"
#: Seconds without an event after which a running scan is closed with the rows that it has; a fixed value.
IDLE = 60


def prepare(spark: SparkSession) -> None:
    spark.conf.set(*PROVIDER)


class ScanStates(StatefulProcessor):
    """One state machine a scan: its state and rows, and a timer while it runs.

    An event (scan, state, rows) moves the state if that may follow the last;
    a running scan may report running again, which adds its rows. Whatever may
    not follow is given back as not accepted and changes nothing. A running
    scan without an event for the idle time becomes done with its rows so far.
    """

    def __init__(self, idle: float = IDLE):
        self.idle = int(idle * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "state string, rows bigint, due bigint")

    def _due(self, now: int) -> int:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(now + self.idle)
        return now + self.idle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, total, due = self.last.get() if self.last.exists() else (None, 0, 0)
        events = pd.concat(list(rows)).sort_values("seq", kind="stable")
        out = []
        for wanted, more in zip(events["state"], events["rows"], strict=True):
            more = 0 if pd.isna(more) else int(more)
            if wanted in STATES.get(state, ()) or (wanted == state == "running"):
                total = more if state in (None, "error", "stopped") else total + more
                state = wanted
                out.append((key[0], state, total, True, None))
            else:
                out.append((key[0], state, total, False, f"{wanted} may not follow {state}"))
        if any(o[3] for o in out):
            if state == "running":
                due = self._due(timerValues.getCurrentProcessingTimeInMs())
            self.last.update((state, total, due))
        yield pd.DataFrame(out, columns=["scan", "state", "rows", "accepted", "reason"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, total, due = self.last.get()
        if state == "running" and expiredTimerInfo.getExpiryTimeInMs() >= due:
            self.last.update(("done", total, 0))
            yield pd.DataFrame([(key[0], "done", total, True, "idle")], columns=["scan", "state", "rows", "accepted", "reason"])

    def close(self) -> None:
        pass


def scan_states(events: DataFrame, idle: float = IDLE) -> DataFrame:
    """(scan, state, rows, accepted, reason): each event of a stream (scan, state, rows, seq) as it was taken, and the ends of idle scans.

    Events of a scan are taken in the order of ``seq`` within a micro-batch.
    State is kept by scan in the checkpoint: a query that is started again goes on
    from it, timers included.
    """
    prepare(events.sparkSession)
    return events.groupBy("scan").transformWithStateInPandas(ScanStates(idle), OUTPUT, "Update", "ProcessingTime")
