"""What runs leave behind: runs, events, chunks, watermarks, rollback actions and failures, on the driver.

A few records a run that need compare-and-set, which file tables lack; rows of user tables never come here.
"""

from __future__ import annotations

import json
import sqlite3
import threading
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "runs": "run_id TEXT PRIMARY KEY, direction TEXT, job TEXT, mode TEXT, status TEXT, started TEXT, finished TEXT, error TEXT",
    "events": "seq INTEGER PRIMARY KEY AUTOINCREMENT, run_id TEXT, at TEXT, table_name TEXT, phase TEXT, status TEXT, message TEXT, details TEXT",
    "chunks": "run_id TEXT, table_name TEXT, chunk_key TEXT, chunk_start INTEGER, chunk_end INTEGER, status TEXT, attempts INTEGER DEFAULT 0, rows INTEGER, error TEXT, PRIMARY KEY (run_id, table_name, chunk_key)",
    "watermarks": "direction TEXT, table_name TEXT, strategy TEXT, column_name TEXT, value TEXT, at TEXT, PRIMARY KEY (direction, table_name, strategy, column_name)",
    "rollbacks": "run_id TEXT, table_name TEXT, action TEXT, target TEXT, backup TEXT, staging TEXT, status TEXT, notes TEXT, seq INTEGER PRIMARY KEY AUTOINCREMENT",
    "breakers": "job TEXT PRIMARY KEY, failures INTEGER, cooldown_until TEXT, last_error TEXT",
}


class Ledger:
    def __init__(self, path: str = ":memory:"):
        self._db = sqlite3.connect(path, check_same_thread=False, isolation_level=None)
        self._db.row_factory = sqlite3.Row
        self._lock = threading.RLock()
        self._db.execute("PRAGMA journal_mode=WAL")
        for name, columns in TABLES.items():
            self._db.execute(f"CREATE TABLE IF NOT EXISTS {name} ({columns})")

    def _do(self, text: str, *values) -> sqlite3.Cursor:
        with self._lock:
            return self._db.execute(text, values)

    @staticmethod
    def _now() -> str:
        return datetime.now(UTC).isoformat(timespec="seconds")

    def rows(self, table: str, where: str = "1=1", *values, order: str = "rowid") -> list[dict]:
        return [dict(r) for r in self._do(f"SELECT * FROM {table} WHERE {where} ORDER BY {order}", *values)]

    def frame(self, spark: SparkSession, table: str) -> DataFrame:
        """A ledger table as a DataFrame with a fixed schema."""
        columns = [(r["name"], "long" if r["type"].startswith("INTEGER") else "string") for r in self._do(f"PRAGMA table_info({table})")]
        return spark.createDataFrame([tuple(r[c] for c, _ in columns) for r in self.rows(table)], ", ".join(f"`{c}` {t}" for c, t in columns))

    def history(self, spark: SparkSession) -> DataFrame:
        """What ended of loads, a row for each run and table: source_run, started, table_name, status, rows_loaded, elapsed_seconds."""
        began = {(e["run_id"], e["table_name"]): e["at"] for e in self.rows("events", "phase='load' AND status='started'")}
        out = []
        for e in self.rows("events", "phase='load' AND status IN ('success','failed')"):
            start = began.get((e["run_id"], e["table_name"]), e["at"])
            seconds = (datetime.fromisoformat(e["at"]) - datetime.fromisoformat(start)).total_seconds()
            out.append((e["run_id"], start, e["table_name"], e["status"].upper(), json.loads(e["details"] or "{}").get("rows", 0), seconds))
        return spark.createDataFrame(out, "source_run string, started string, table_name string, status string, rows_loaded long, elapsed_seconds double")

    # runs and events
    def start_run(self, run: str, direction: str = "", job: str = "", mode: str = "") -> None:
        self._do("INSERT OR IGNORE INTO runs (run_id, direction, job, mode, status, started) VALUES (?,?,?,?,'running',?)", run, direction, job, mode, self._now())

    def finish_run(self, run: str, status: str, error: str = "") -> None:
        self._do("UPDATE runs SET status=?, finished=?, error=? WHERE run_id=?", status, self._now(), error, run)

    def reset_run(self, run: str) -> None:
        for table in ("chunks", "runs", "events", "rollbacks"):
            self._do(f"DELETE FROM {table} WHERE run_id=?", run)

    def event(self, run: str, phase: str, status: str, table: str = "", message: str = "", details: dict | None = None) -> None:
        self._do("INSERT INTO events (run_id, at, table_name, phase, status, message, details) VALUES (?,?,?,?,?,?,?)", run, self._now(), table, phase, status, message, json.dumps(details or {}))

    def events(self, run: str) -> list[dict]:
        return self.rows("events", "run_id=?", run, order="at, table_name, phase, seq")

    # chunks
    def add_chunk(self, run: str, table: str, key: str, start: int | None = None, end: int | None = None) -> None:
        self._do("INSERT OR IGNORE INTO chunks (run_id, table_name, chunk_key, chunk_start, chunk_end, status) VALUES (?,?,?,?,?,'pending')", run, table, key, start, end)

    def claim(self, run: str, table: str, key: str) -> bool:
        """Take a pending or failed chunk; only one of several claimants gets it."""
        return self._do("UPDATE chunks SET status='running', attempts=attempts+1 WHERE run_id=? AND table_name=? AND chunk_key=? AND status IN ('pending','failed')", run, table, key).rowcount == 1

    def finish(self, run: str, table: str, key: str, status: str, rows: int = 0, error: str = "") -> None:
        self._do("UPDATE chunks SET status=?, rows=?, error=? WHERE run_id=? AND table_name=? AND chunk_key=?", status, rows, error, run, table, key)

    def release(self, run: str) -> None:
        """Chunks that a dead run held can be claimed again."""
        self._do("UPDATE chunks SET status='failed' WHERE run_id=? AND status='running'", run)

    def successful(self, run: str, table: str) -> set[str]:
        return {r["chunk_key"] for r in self.rows("chunks", "run_id=? AND table_name=? AND status='success'", run, table)}

    # watermarks
    def watermark(self, direction: str, table: str, strategy: str, column: str) -> str | None:
        found = self.rows("watermarks", "direction=? AND table_name=? AND strategy=? AND column_name=?", direction, table, strategy, column)
        return found[0]["value"] if found else None

    def set_watermark(self, direction: str, table: str, strategy: str, column: str, value: str) -> None:
        self._do("INSERT INTO watermarks VALUES (?,?,?,?,?,?) ON CONFLICT DO UPDATE SET value=excluded.value, at=excluded.at", direction, table, strategy, column, value, self._now())

    def reset_watermark(self, table: str) -> int:
        return self._do("DELETE FROM watermarks WHERE table_name=?", table).rowcount

    # rollbacks
    def add_rollback(self, run: str, table: str, action: str, target: str, backup: str | None, staging: str = "") -> bool:
        """Remember how to undo a load; without a backup there is nothing to go back to."""
        if not backup:
            return False
        self._do("INSERT INTO rollbacks (run_id, table_name, action, target, backup, staging, status) VALUES (?,?,?,?,?,?,'ready')", run, table, action, target, backup, staging)
        return True

    def rollbacks(self, run: str) -> list[dict]:
        """The newest first: what was done last is undone first."""
        return self.rows("rollbacks", "run_id=? AND status='ready'", run, order="seq DESC")

    def mark_rollback(self, seq: int, status: str, notes: str = "") -> None:
        self._do("UPDATE rollbacks SET status=?, notes=? WHERE seq=?", status, notes, seq)

    # circuit breaker
    def failed(self, job: str, cooldown_minutes: int, error: str = "") -> int:
        until = (datetime.now(UTC) + timedelta(minutes=cooldown_minutes)).isoformat(timespec="seconds")
        self._do("INSERT INTO breakers VALUES (?,1,?,?) ON CONFLICT DO UPDATE SET failures=failures+1, cooldown_until=excluded.cooldown_until, last_error=excluded.last_error", job, until, error)
        return self.rows("breakers", "job=?", job)[0]["failures"]

    def cleared(self, job: str | None = None) -> None:
        self._do("DELETE FROM breakers" + (" WHERE job=?" if job else ""), *([job] if job else []))

    def blocked(self, job: str, max_failures: int = 3) -> bool:
        """True while a job has failed so often and its time of rest is not over."""
        found = self.rows("breakers", "job=?", job)
        return bool(found) and found[0]["failures"] >= max_failures and found[0]["cooldown_until"] > self._now()


def blocked_jobs(breakers: DataFrame, now: str, max_failures: int = 3) -> DataFrame:
    """Jobs that must not start: job, failures, blocked. breakers: job, failures, cooldown_until (ISO texts sort as times)."""
    return breakers.select("job", "failures", ((F.col("failures") >= max_failures) & (F.col("cooldown_until") > F.lit(now))).alias("blocked"))


def watermark_moves(watermarks: DataFrame, results: DataFrame) -> DataFrame:
    """What watermarks become after a run: the new values if every table succeeded, else the old ones.

    watermarks: table_name, value; results: table_name, status, watermark.
    """
    all_good = results.agg(F.coalesce(F.bool_and(F.col("status") == "SUCCESS"), F.lit(True)).alias("_good"))
    both = watermarks.join(results.select("table_name", "watermark"), "table_name", "full_outer").crossJoin(all_good)
    return both.select("table_name", F.when(F.col("_good"), F.coalesce("watermark", "value")).otherwise(F.col("value")).alias("value")).where("value IS NOT NULL")
