"""Loads into other stores over JDBC that are exact when tasks run again.

Every task writes its rows to a staging table, with its partition and the number of its attempt beside them. Of a partition's attempts the fullest
one counts, so rows that a lost or repeated task left behind do not. Then one transaction of the store, from one connection, takes the
staged rows into the table, and notes the run in a table of runs whose key refuses it a second time: a driver that asks again
after a failure learns that the rows are there. The statements are plain SQL that all stores have.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, ATTEMPT = "C_PART", "C_ATTEMPT"
RUNS = "CONCORDAT_RUNS"


class StoreError(RuntimeError):
    """The store does not hold what was sent to it; the table is as it was."""


def _name(text: str) -> str:
    """Column and table names go into statements as they are, so they have to be names."""
    if not re.fullmatch(r"[A-Za-z_][\w$#]*(\.[A-Za-z_][\w$#]*){0,2}", text):
        raise ValueError(f"not a plain name: {text!r}")
    return text


class Store:
    """A store behind a JDBC url. options: those of Spark's JDBC source, with the driver's class, user and password among them."""

    def __init__(self, spark: SparkSession, url: str, **options: str):
        self.spark, self.url = spark, url
        self.options = {k: str(v) for k, v in options.items() if k.lower() != "dbtable"}

    def _connect(self):
        jvm = self.spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, v)
        if "driver" in self.options:
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            driver = jvm.java.lang.Class.forName(self.options["driver"], True, loader).getDeclaredConstructor(self.spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)).newInstance(self.spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0))
            return driver.connect(self.url, properties)
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def _run(self, *statements: str, quiet: bool = False) -> list[int]:
        """Statements in one transaction: all of them or none. Returns the rows that each has changed."""
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            try:
                done = []
                for s in statements:
                    statement = connection.createStatement()
                    done.append(statement.executeUpdate(s))
                    statement.close()
                connection.commit()
                return done
            except Exception:
                connection.rollback()
                if quiet:
                    return []
                raise
        finally:
            connection.close()

    def _rows(self, query: str, columns: int) -> list[tuple]:
        connection = self._connect()
        try:
            found, out = connection.createStatement().executeQuery(query), []
            while found.next():
                out.append(tuple(found.getLong(i + 1) for i in range(columns)))
            connection.commit() if not connection.getAutoCommit() else None
            return out
        finally:
            connection.close()

    def merged_runs(self, run: str) -> int:
        """How many times a run stands in the table of runs: 0 or 1."""
        self._run(f"CREATE TABLE {RUNS} (RUN_ID VARCHAR(120) NOT NULL PRIMARY KEY)", quiet=True)
        return self._rows(f"SELECT COUNT(*) FROM {RUNS} WHERE RUN_ID = '{_run_name(run)}'", 1)[0][0]

    def stage(self, df: DataFrame, staging: str) -> None:
        """Write rows with their task's partition and attempt. A task that runs again writes its rows again."""
        schema = T.StructType([*df.schema.fields, T.StructField(PART, T.LongType()), T.StructField(ATTEMPT, T.LongType())])

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            part, attempt = task.partitionId(), task.taskAttemptId()
            for b in batches:
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int64()), pa.array([attempt] * n, pa.int64())], names=schema.names)

        df.mapInArrow(told, schema).write.format("jdbc").options(**({"url": self.url, "batchsize": "10000"} | self.options | {"dbtable": _name(staging)})).mode("append").save()

    def settle(self, staging: str) -> int:
        """Leave one attempt of each partition, the fullest, and of equals the first; returns the rows that stand then."""
        best: dict[int, tuple[int, int]] = {}
        attempts = self._rows(f"SELECT {PART}, {ATTEMPT}, COUNT(*) FROM {_name(staging)} GROUP BY {PART}, {ATTEMPT}", 3)  # as many as tasks
        for part, attempt, n in attempts:
            best[part] = max(best.get(part, (-1, 0)), (n, -attempt))
        lost = [(p, a) for p, a, _ in attempts if best[p][1] != -a]
        if lost:
            self._run(*(f"DELETE FROM {staging} WHERE {PART} = {p} AND {ATTEMPT} = {a}" for p, a in lost))
        return sum(n for n, _ in best.values())

    def merge(self, staging: str, table: str, columns: list[str], keys: list[str], mode: str, run: str) -> dict[str, int]:
        """Take staged rows into the table in one transaction, which also notes the run. mode: append, replace, upsert (rows with a key that is there take
        the new values, others are added; a null key is never there) or delete_insert."""
        s, t, names = _name(staging), _name(table), [_name(c) for c in columns]
        listed = ", ".join(names)
        on = " AND ".join(f"S.{_name(k)} = {t}.{k}" for k in keys)
        insert = f"INSERT INTO {t} ({listed}) SELECT {listed} FROM {s}"
        note = f"INSERT INTO {RUNS} VALUES ('{_run_name(run)}')"
        if mode == "append":
            work = [insert]
        elif mode == "replace":
            work = [f"DELETE FROM {t}", insert]
        elif mode == "delete_insert":
            work = [f"DELETE FROM {t} WHERE EXISTS (SELECT 1 FROM {s} S WHERE {on})", insert]
        elif mode == "upsert":
            rest = [c for c in names if c not in keys]
            update = [f"UPDATE {t} SET " + ", ".join(f"{c} = (SELECT S.{c} FROM {s} S WHERE {on})" for c in rest) + f" WHERE EXISTS (SELECT 1 FROM {s} S WHERE {on})"] if rest else []
            # what is new is what no row of the table has the key of; it is told before the table changes, as rows just added would have it
            fresh = f"INSERT INTO {t} ({listed}) SELECT {', '.join('S.' + c for c in names)} FROM {s} S WHERE NOT EXISTS (SELECT 1 FROM {t} WHERE {on})"
            work = [*update, fresh]
        else:
            raise ValueError(f"no such mode: {mode}")
        done = self._run(note, *work)
        return {"rows": done[-1], "changed": sum(done[1:-1])}

    def load(self, df: DataFrame, table: str, run: str, mode: str = "append", keys: list[str] = ()) -> dict[str, int]:
        """Rows into a table, once: {rows: inserted, changed: updated or deleted, staged}. A run that has been merged before changes nothing and gives
        {"done": 1}; staging that an earlier try of it left is made anew. Upserts want each key once."""
        if self.merged_runs(run):
            return {"rows": 0, "changed": 0, "staged": 0, "done": 1}
        columns = df.columns
        staging = f"{_name(table)}_C{uuid.uuid5(uuid.NAMESPACE_URL, run).hex[:10].upper()}"
        one = f"SELECT {', '.join(_name(c) for c in columns)}, CAST(0 AS BIGINT) AS {PART}, CAST(0 AS BIGINT) AS {ATTEMPT} FROM {table}"
        self._run(f"DROP TABLE {staging}", quiet=True)
        try:
            self._run(f"CREATE TABLE {staging} AS {one} WITH NO DATA")
        except Exception:  # in the words of other stores
            self._run(f"CREATE TABLE {staging} AS SELECT * FROM ({one}) X WHERE 1 = 0")
        try:
            # rows that a task reads again are those it read first: they are counted by what stands, not by what was sent
            sent = df.observe(seen := Observation(f"store-{uuid.uuid4().hex[:8]}"), F.count(F.lit(1)).alias("rows"))
            self.stage(sent, staging)
            staged, expected = self.settle(staging), seen.get["rows"]
            if staged != expected:
                raise StoreError(f"{table}: {expected} rows were sent, {staged} stand in {staging}")
            return self.merge(staging, table, columns, list(keys), mode, run) | {"staged": staged, "done": 0}
        finally:
            self._run(f"DROP TABLE {staging}", quiet=True)


def _run_name(run: str) -> str:
    return re.sub(r"[^\w.:-]", "_", run)[:120]
