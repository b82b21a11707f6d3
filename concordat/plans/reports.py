"""What runs did, as tables: dashboards, metrics, errors, consolidation; and as HTML, JSON and workbooks."""

from __future__ import annotations

import hashlib
import html
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.text import masked

SLOW_SECONDS = 300
CELL_LIMIT = 32_767  # fixed by the workbook format


def _is(c: str, *values: str) -> Column:
    return F.count_if(F.upper(c).isin(*values))


def dashboard(results: DataFrame, checksums: DataFrame | None = None, diffs: DataFrame | None = None, long: DataFrame | None = None) -> DataFrame:
    """One row of counts over a run's results, checksums, schema differences and long columns."""
    out = results.agg(
        F.count(F.lit(1)).alias("total_tables"),
        _is("status", "SUCCESS", "MATCH").alias("success"),
        _is("status", "FAILED", "MISMATCH", "MISSING").alias("failed"),
        _is("status", "WARNING").alias("warning"),
        _is("status", "DRY_RUN").alias("dry_run"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_processed"),
        F.round(F.coalesce(F.sum("elapsed_seconds"), F.lit(0)), 3).alias("duration_seconds"),
        F.count_if(F.col("elapsed_seconds") >= SLOW_SECONDS).alias("slow_tables"),
    )
    if checksums is not None:
        out = out.crossJoin(checksums.agg(_is("status", "MATCH").alias("checksum_pass"), _is("status", "MISMATCH").alias("checksum_fail")))
    if diffs is not None:
        out = out.crossJoin(diffs.agg(*(_is("severity", s).alias(f"schema_diff_{s.lower()}") for s in ("ERROR", "WARNING", "INFO"))))
    if long is not None:
        out = out.crossJoin(long.agg(_is("classification", "LOB-HEAVY").alias("lob_heavy_tables")))
    return out


def metrics(results: DataFrame) -> DataFrame:
    """One row: workers, average duration, the slowest table, and lists of tables by outcome."""
    names = lambda *s: F.array_sort(F.collect_list(F.when(F.col("status").isin(*s), F.col("table_name"))))
    return results.agg(
        F.count_distinct(F.nullif("worker_name", F.lit(""))).alias("workers"),
        F.round(F.avg(F.coalesce("elapsed_seconds", F.lit(0.0))), 3).alias("avg_table_duration"),
        F.max_by("table_name", F.struct("elapsed_seconds", "table_name")).alias("slowest_table"),
        F.array_join(names("SUCCESS"), ";").alias("success_tables"),
        F.array_join(names("FAILED"), ";").alias("failed_tables"),
        F.array_join(names("SKIPPED", "DRY_RUN"), ";").alias("skipped_tables"),
    )


def by_worker(results: DataFrame) -> DataFrame:
    """Rows, seconds and rows a second of each worker."""
    sums = results.where("worker_name <> ''").groupBy("worker_name").agg(F.sum(F.coalesce("rows_loaded", F.lit(0))).alias("rows_loaded"), F.sum(F.coalesce("elapsed_seconds", F.lit(0.0))).alias("elapsed_seconds"))
    return sums.withColumn("rows_per_second", F.when(F.col("elapsed_seconds") > 0, F.round(F.col("rows_loaded") / F.col("elapsed_seconds"), 3)).otherwise(0.0))


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def top_tables(counts: DataFrame, column: str, n: int = 10) -> DataFrame:
    return counts.orderBy(F.col(column).desc(), "table_name").limit(n)


def errors(results: DataFrame, diffs: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Failed loads, schema errors and failed repairs under one set of columns."""
    part = lambda df, kind, where, name, text: df.where(where).select(F.lit(kind).alias("kind"), F.col("table_name"), F.col(name).alias("item"), F.col(text).alias("message"))
    return (
        part(results, "load", "upper(status) = 'FAILED'", "mode", "message")
        .unionByName(part(diffs, "schema", "severity = 'ERROR'", "column_name", "reason"))
        .unionByName(part(maintenance, "maintenance", "maintenance_status = 'failed'", "object_name", "validation_status"))
    )


def consolidated(archive: DataFrame, fresh: DataFrame) -> DataFrame:
    """The archive and the rows of runs that it does not have yet; adding a run twice changes nothing."""
    return archive.unionByName(fresh.join(archive.select("source_run").distinct(), "source_run", "left_anti"), allowMissingColumns=True)


def best_variants(timings: DataFrame) -> DataFrame:
    """For each database the fastest query variant and its gain over the original in percent. timings: database, variant, status, runtime_ms."""
    ok = timings.where("status = 'OK'")
    out = ok.groupBy("database").agg(F.min_by("variant", F.struct("runtime_ms", "variant")).alias("recommended_variant"), F.min("runtime_ms").alias("best"), F.max(F.when(F.col("variant") == "original", F.col("runtime_ms"))).alias("original"))
    gain = F.coalesce((F.col("original") - F.col("best")) / F.nullif("original", F.lit(0.0)) * 100, F.lit(0.0))
    advice = F.when(F.col("recommended_variant") == "original", "keep").when(gain > 5, "use").otherwise("optional")
    return out.select("database", "recommended_variant", F.round("best", 3).alias("runtime_ms"), F.round("original", 3).alias("original_runtime_ms"), F.round(gain, 2).alias("improvement_percent"), advice.alias("recommendation"))


def manifest(run_id: str, settings: dict, frames: dict[str, DataFrame], path: str) -> dict:
    """A run's record as JSON: settings without secrets, and counts by status of each report."""
    clean = masked(settings)
    out = {"run_id": run_id, "settings": clean, "settings_hash": hashlib.sha256(json.dumps(clean, sort_keys=True).encode()).hexdigest(), "reports": {}}
    for name, df in frames.items():
        state = next((c for c in ("status", "severity", "classification") if c in df.columns), None)
        out["reports"][name] = {str(r[0]): r[1] for r in df.groupBy(state).count().collect()} if state else {"rows": df.count()}  # a row for each status
    Path(path).write_text(json.dumps(out, indent=2, sort_keys=True))
    return out


def html_page(title: str, frames: dict[str, DataFrame], path: str, limit: int = 200) -> None:
    """Reports as one page; each shows its first rows."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in frames.items():
        rows = df.limit(limit).collect()
        if not rows:
            continue
        cells = lambda values, tag: "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in values)
        parts.append(f"<h2>{html.escape(name)}</h2><table border=1><tr>{cells(df.columns, 'th')}</tr>" + "".join(f"<tr>{cells(r, 'td')}</tr>" for r in rows) + "</table>")
    Path(path).write_text("\n".join(parts))


SHEET_ROWS = 1_048_575  # fixed by the workbook format


def workbook(frames: dict[str, DataFrame], path: str) -> bool:
    """Reports as sheets, empty ones left out, repeated rows once, long cells cut; False where the writer is not installed. A sheet holds the rows that the
    format allows, and says so where there are more."""
    try:
        from openpyxl import Workbook
    except ImportError:
        return False
    book = Workbook()
    book.remove(book.active)
    for name, df in named_sheets(frames).items():
        sheet = book.create_sheet(name[:31])
        sheet.append(df.columns)
        for i, r in enumerate(df.distinct().toLocalIterator()):
            if i == SHEET_ROWS - 1:
                sheet.append(["more rows than a sheet holds"])
                break
            sheet.append([v[:CELL_LIMIT] if isinstance(v, str) else v for v in r])
    book.save(path)
    return True


def compacted(history: DataFrame, keep_runs: int = 30) -> tuple[DataFrame, DataFrame]:
    """A history in two parts: the rows of the latest runs as they are, and of each older day, table and status the number of runs, rows and seconds.

    history: source_run, started (ISO text), table_name, status, rows_loaded, elapsed_seconds. Runs are few beside their rows: their order is a table of one
    row a run.
    """
    runs = history.groupBy("source_run").agg(F.max("started").alias("_last")).orderBy(F.desc("_last"), F.desc("source_run")).limit(keep_runs).select("source_run")
    recent = history.join(runs, "source_run", "left_semi")
    old = history.join(runs, "source_run", "left_anti").groupBy(F.substring("started", 1, 10).alias("day"), "table_name", "status")
    return recent, old.agg(F.count_distinct("source_run").alias("runs"), F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"), F.round(F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)), 3).alias("elapsed_seconds"))


def log_rollup(events: DataFrame) -> DataFrame:
    """For each run and phase: tables, events, failures, first and last time, and the first failure's message. events: run_id, at, table_name, phase, status, message."""
    bad = F.lower("status").isin("failed", "rejected")
    return events.groupBy("run_id", "phase").agg(
        F.count_distinct("table_name").alias("tables"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(bad).alias("failures"),
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.coalesce(F.min_by(F.when(bad, F.col("message")), F.when(bad, F.struct("at", "table_name"))), F.lit("")).alias("first_error"),
    )


SHEETS = ("inventory", "column_diff", "rowcount", "checksum", "missing_keys", "lob_analysis", "dependencies", "dependency_summary", "sequences", "sync_result", "events", "watermarks", "chunks", "rollbacks", "query_perf", "recommendation", "simulation", "doctor")


def named_sheets(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Reports in the usual order of sheets, others after them, without those that have no rows."""
    order = [n for n in SHEETS if n in frames] + [n for n in frames if n not in SHEETS]
    return {n: frames[n] for n in order if not frames[n].isEmpty()}


def alert(event: str, payload: dict, events: set[str], send) -> bool:
    """Hand an event to a callable if it is one that was asked for."""
    if event not in events:
        return False
    send(event, masked(payload))
    return True
