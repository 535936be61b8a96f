"""Rows into a database by two steps: tasks stage theirs under their attempt, one commit takes what the winning attempts staged."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from stratawork.sources.sinks import checked_header


@dataclass
class Staged(WriterCommitMessage):
    """What a task tells the driver: its attempt and the number of its rows."""

    attempt: str
    rows: int


class _Steps:
    """The statements of a run.

    ``{table}_staged`` has the target's columns after the run and the attempt,
    ``{table}_won`` the attempts to take, ``{table}_commits`` the runs that are
    done with their rows. A commit is one transaction, so a run is in the
    target whole or not at all, and once: a run that is already among the
    commits is passed over.
    """

    def __init__(self, connect: Callable, table: str, columns: list[str], verb: str, mark: str, batch: int):
        self.connect, self.table, self.columns, self.verb, self.mark, self.batch = connect, table, columns, verb, mark, batch
        self.names = ", ".join(f'"{c}"' for c in columns)

    def _run(self, *work) -> list:
        con = self.connect()
        try:
            cur = con.cursor()
            out = [w(cur) for w in work]
            con.commit()
            return out
        except BaseException:
            con.rollback()
            raise
        finally:
            con.close()

    def prepare(self) -> None:
        """Checks the target's header and makes the tables of runs where they are missing."""

        def tables(cur):
            cur.execute(f"select * from {self.table} where 1 = 0")
            checked_header([d[0] for d in cur.description], self.columns, self.table)
            cur.execute(f"create table if not exists {self.table}_staged as select cast('' as varchar(200)) as run_name, cast('' as varchar(200)) as attempt_name, {self.names} from {self.table} where 1 = 0")
            cur.execute(f"create table if not exists {self.table}_won (run_name varchar(200), attempt_name varchar(200))")
            cur.execute(f"create table if not exists {self.table}_commits (run_name varchar(200) primary key, n_rows bigint)")

        self._run(tables)

    def stage(self, run: str, rows) -> Staged:
        """A task's rows, a batch a transaction; what a lost attempt left is never taken."""
        attempt, n, held = uuid.uuid4().hex, 0, []
        statement = f"insert into {self.table}_staged (run_name, attempt_name, {self.names}) values ({', '.join([self.mark] * (len(self.columns) + 2))})"
        for r in rows:
            held.append((run, attempt, *r))
            n += 1
            if len(held) == self.batch:
                self._run(lambda cur: cur.executemany(statement, held))
                held = []
        if held:
            self._run(lambda cur: cur.executemany(statement, held))
        return Staged(attempt, n)

    def commit(self, run: str, messages: list[Staged]) -> None:
        won = [(run, m.attempt) for m in messages if m is not None and m.rows]
        rows = sum(m.rows for m in messages if m is not None)
        theirs = f"from {self.table}_staged s where s.run_name = {self.mark} and exists (select 1 from {self.table}_won w where w.run_name = s.run_name and w.attempt_name = s.attempt_name)"

        def take(cur):
            cur.execute(f"select count(*) from {self.table}_commits where run_name = {self.mark}", (run,))
            if not cur.fetchone()[0]:
                if won:
                    cur.executemany(f"insert into {self.table}_won values ({self.mark}, {self.mark})", won)
                cur.execute(f"select count(*) {theirs}", (run,))
                if (found := cur.fetchone()[0]) != rows:
                    raise RuntimeError(f"{run} staged {found} rows of {rows}")
                cur.execute(f"{self.verb} {self.table} ({self.names}) select {self.names} {theirs}", (run,))
                cur.execute(f"insert into {self.table}_commits values ({self.mark}, {self.mark})", (run, rows))
            self._clean(cur, run)

        self._run(take)

    def _clean(self, cur, run: str) -> None:
        for part in ("staged", "won"):
            cur.execute(f"delete from {self.table}_{part} where run_name = {self.mark}", (run,))

    def abort(self, run: str) -> None:
        self._run(lambda cur: self._clean(cur, run))


class _Writer(DataSourceWriter):
    def __init__(self, steps: _Steps, run: str):
        self.steps, self.name = steps, run

    def write(self, iterator):
        return self.steps.stage(self.name, iterator)

    def commit(self, messages):
        self.steps.commit(self.name, messages)

    def abort(self, messages):
        self.steps.abort(self.name)


class _StreamWriter(DataSourceStreamWriter):
    """A micro-batch is a run of its number; a staged row carries the stream alone, as tasks do not know the number."""

    def __init__(self, steps: _Steps, run: str):
        self.steps, self.name = steps, run

    def write(self, iterator):
        return self.steps.stage(self.name, iterator)

    def commit(self, messages, batchId):
        def renamed(cur):
            m = self.steps.mark
            for x in messages:
                if x is not None:
                    cur.execute(f"update {self.steps.table}_staged set run_name = {m} where run_name = {m} and attempt_name = {m}", (f"{self.name}/{batchId}", self.name, x.attempt))

        self.steps._run(renamed)
        self.steps.commit(f"{self.name}/{batchId}", messages)
        self.steps.abort(self.name)  # what lost attempts staged

    def abort(self, messages, batchId):
        self.steps.abort(self.name)


def _register(df: DataFrame, connect: Callable, table: str, run: str, verb: str, mark: str, batch: int) -> str:
    steps = _Steps(connect, table, df.columns, verb, mark, batch)
    steps.prepare()

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return "committed_rows"

        def writer(self, schema, overwrite):
            return _Writer(steps, run)

        def streamWriter(self, schema, overwrite):
            return _StreamWriter(steps, run)

    df.sparkSession.dataSource.register(Sink)
    return "committed_rows"


def insert_committed(df: DataFrame, connect: Callable, table: str, run: str | None = None, verb: str = "insert into", mark: str = "?", batch: int = 50) -> None:
    """``df`` into a table of the same columns, all rows or none, each once however often tasks run.

    ``connect`` gives a DB-API connection, on executors and the driver.
    ``run`` names the load: one that was committed under a name is not taken
    again. ``verb`` may pass over or replace keys that are there. Rows go from
    tasks to the database; the driver sees attempts and counts. A table with
    other columns raises before any row goes.
    """
    df.write.format(_register(df, connect, table, run or uuid.uuid4().hex, verb, mark, batch)).mode("append").save()


def stream_committed(stream: DataFrame, connect: Callable, table: str, run: str, checkpoint: str, verb: str = "insert into", mark: str = "?", batch: int = 50):
    """A stream into a table, each micro-batch as a run of its number: a batch that runs again after its commit adds nothing. One stream a name at a time."""
    return stream.writeStream.format(_register(stream, connect, table, run, verb, mark, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
