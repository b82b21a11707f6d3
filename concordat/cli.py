"""Commands: audit, validate, checksum, missing-keys, audit-objects, dependencies, sequences, sync, resume, rollback, watermarks, reset-watermark,
circuit, query-perf, lob, simulate, doctor, repair, history, report, changed-keys, find-keys, tables, profile, discard.

Settings name a schema and tables, each with `source` and `target` (a Parquet path, a catalog name or a JDBC url, with source_options and target_options
such as dbtable). The target of a sync is a versioned folder, or a JDBC url for appends and full loads. `constraints`, `objects` and `sequences` have the
Parquet paths of both sides' catalogs, {"source": .., "target": ..}. The exit code is 1 when something differs or fails.
"""

from __future__ import annotations

import argparse
import fcntl
import json
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.model import LoadResult
from concordat.operators import digest_tree, key_search, long_columns, objects, profile, sequences
from concordat.operators.reconcile import checksum_columns
from concordat.plans import audit, doctor, load, queryperf, repairs, reports
from concordat.sources import catalog, config, files
from concordat.sources.versions import VersionedTable
from concordat.streaming.ledger import Ledger


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser("concordat", description=__doc__)
    p.add_argument("command", choices="audit validate checksum missing-keys audit-objects dependencies sequences sync resume rollback watermarks reset-watermark circuit query-perf lob simulate doctor repair history report changed-keys find-keys tables profile discard".split())
    p.add_argument("--config")
    p.add_argument("--env-file")
    p.add_argument("--tables", nargs="*")
    p.add_argument("--tables-file", help="a name on each line; # begins a comment")
    p.add_argument("--direction", choices=["forward", "reverse"], default="forward")
    p.add_argument("--profile", choices=["daily", "every_5min"], help="daily: full loads; every_5min: keyed tables with a watermark only")
    p.add_argument("--chunk-key", help="whole-number column whose ranges are digested one by one")
    p.add_argument("--chunk-size", type=int, default=50_000)
    p.add_argument("--retries", type=int, default=0, help="tries after a failed sync, each five seconds later than the last")
    p.add_argument("--require-unique-target", action="store_true", help="refuse keyed loads into tables that repeat a key")
    p.add_argument("--require-whole", action="store_true", help="refuse tables with skip_failed")
    p.add_argument("--schema", default="default", help="catalog schema, for repair")
    p.add_argument("--skip-matching", action="store_true", help="leave out full loads whose row counts agree")
    p.add_argument("--require-bounds", action="store_true", help="refuse increments by a column that the source's files have no bounds of")
    p.add_argument("--guard-schema", help="roll a sync back if it breaks a view of this catalog schema")
    p.add_argument("--hints", nargs="*", help="for profile: parts of the names of the columns to look at")
    p.add_argument("--pattern", default="*", help="for tables")
    p.add_argument("--keep-runs", type=int, default=30)
    p.add_argument("--limit", type=int)
    p.add_argument("--execute", action="store_true", help="without it, sync only plans")
    p.add_argument("--allow-swap", action="store_true")
    p.add_argument("--run-id")
    p.add_argument("--ledger", default="concordat-ledger.db")
    p.add_argument("--reports", default="reports")
    p.add_argument("--workers", type=int, default=4)
    p.add_argument("--sql", help="file with one query, for query-perf")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    spark = SparkSession.builder.appName("concordat").getOrCreate()
    tree = config.load(a.config, a.env_file) if a.config else {}
    specs = config.table_specs(tree)
    names = a.tables or []
    if a.tables_file:
        names = names + [n for line in Path(a.tables_file).read_text().splitlines() if (n := line.partition("#")[0].strip())]
    wanted = config.chosen(specs, names, a.limit)
    directions = {".".join(config.split_name(t["name"], tree.get("schema", "public"))): t.get("directions", ["forward", "reverse"]) for t in tree.get("tables", []) if isinstance(t, dict)}
    wanted = [s for s in wanted if a.direction in directions.get(s.name, ["forward", "reverse"])]
    if a.profile == "every_5min":
        wanted = [s for s in wanted if s.incremental and s.mode in load.KEYED]
    elif a.profile == "daily":
        wanted = [s for s in wanted if s.mode in load.FULL]
    places = {".".join(config.split_name(t["name"], tree.get("schema", "public"))): t for t in tree.get("tables", []) if isinstance(t, dict)}
    ledger = Ledger(a.ledger)
    folder = Path(a.reports)
    folder.mkdir(parents=True, exist_ok=True)
    run = a.run_id or uuid.uuid4().hex[:12]

    def side(name: str, which: str) -> DataFrame:
        where = places[name][which]
        options = places[name].get(f"{which}_options", {})
        if which == "target" and (there := VersionedTable(spark, where).read() if "/" in where and not where.startswith("jdbc:") else None) is not None:
            return there
        return files.read(spark, where, **options)

    def listed(kind: str) -> tuple[DataFrame | None, DataFrame | None]:
        """The two sides' catalogs of a kind, where the settings have them."""
        at = tree.get(kind, {})
        return tuple(spark.read.parquet(at[s]) if s in at else None for s in ("source", "target"))

    pairs = lambda: {s.name: (side(s.name, "source"), side(s.name, "target")) for s in wanted}

    def finish(frames: dict[str, DataFrame]) -> int:
        for name, df in frames.items():
            files.write_csv(df, str(folder / name))
        reports.workbook(frames, str(folder / "report.xlsx"))
        reports.manifest(run, tree, frames, str(folder / "manifest.json"))
        reports.html_page(f"{a.command} {run}", frames, str(folder / "report.html"))
        return int(audit.failed(frames))

    if a.command == "audit":
        return finish(audit.audit(spark, pairs(), specs))
    if a.command == "validate":
        frames = audit.audit(spark, pairs(), specs)
        return finish({"rowcount": frames["rowcount"], "checksum": audit.checksums(pairs(), specs)})
    if a.command == "checksum":
        return finish({"checksum": audit.checksums(pairs(), specs, a.chunk_key, a.chunk_size)})
    if a.command == "missing-keys":
        constraints = listed("constraints")
        return finish({"missing_keys": audit.missing_keys(pairs(), {s.name: objects.resolve_keys(s.name.rpartition(".")[2], s.keys, *constraints)[0] for s in wanted})})
    if a.command == "find-keys":  # the least sets of columns that are unique in the source
        found = [(s.name, ",".join(k)) for s in wanted for k in key_search.least_keys(side(s.name, "source"))]
        return finish({"keys": spark.createDataFrame(found, "table_name string, key_columns string")})
    if a.command == "changed-keys":
        frames = []
        for s in wanted:
            one, two = side(s.name, "source"), side(s.name, "target")
            keys = objects.resolve_keys(s.name.rpartition(".")[2], s.keys, *listed("constraints"), rows=one)[0]
            apart = digest_tree.changed_keys(one, two, keys, checksum_columns(one, s.exclude))
            frames.append(apart.select(F.lit(s.name).alias("table_name"), F.concat_ws(";", *(F.col(k).cast("string") for k in keys)).alias("key_values"), "source_rows", "target_rows", "status"))
        out = files.union_all(frames)
        finish({"changed_keys": out})
        return int(not out.isEmpty())
    if a.command == "audit-objects":
        one, two = listed("objects")
        return finish({"objects": objects.compare(one, two)})
    if a.command == "dependencies":
        tables = spark.createDataFrame([(s.name.rpartition(".")[2],) for s in wanted], "table_name string")
        edges = files.union_all([objects.dependency_edges(o, tables) for o in listed("objects") if o is not None])
        return finish({"dependencies": edges, "dependency_summary": objects.health(edges)})
    if a.command == "sequences":
        state, there = listed("sequences")
        if there is not None:  # both catalogs: sequences are matched, and the largest keys are taken of the tables
            top = lambda df, s: df.agg(F.max(F.col(s.keys[0]).cast("long"))).select(F.lit(s.name.rpartition(".")[2]).alias("table_name"), F.col("*"))
            maxima = [top(side(s.name, "source"), s).toDF("table_name", "source_table_max").join(top(side(s.name, "target"), s).toDF("table_name", "target_table_max"), "table_name") for s in wanted if s.keys]
            none = spark.createDataFrame([], "table_name string, source_table_max long, target_table_max long")
            state = sequences.scanned(there, state, files.union_all([none, *maxima]))
        return finish({"sequences": sequences.planned(state)})
    if a.command == "tables":
        catalog.list_tables(spark, a.schema, a.pattern).show(1000, False)
        return 0
    if a.command == "profile":
        frames = []
        for s in wanted:
            df = side(s.name, "source")
            listed_columns = catalog.columns_of({s.name: df}, spark)
            names = [r["column_name"] for r in (profile.hinted(listed_columns, tuple(a.hints)) if a.hints else listed_columns).orderBy("ordinal").collect()]
            if names:
                order = {n.lower(): i for i, n in enumerate(names)}
                place = F.array_position(F.array(*map(F.lit, order)), F.lower("column_name")).cast("int")
                frames.append(profile.profile(df, names).withColumn("table_name", F.lit(s.name)).withColumn("ordinal", place))
        if not frames:
            return finish({})
        found = files.union_all(frames)
        return finish({"profile": found, "key_candidates": profile.key_candidates(found), "watermark_candidates": profile.watermark_candidates(found)})
    if a.command == "discard":  # what the run --run-id has staged and not published
        gone = [(s.name, v) for s in wanted for v in VersionedTable(spark, places[s.name]["target"]).discard_run(run)]
        return finish({"discarded": spark.createDataFrame(gone, "table_name string, folder string")})
    if a.command == "doctor":
        checks = doctor.examined(spark, wanted, side, ledger, constraints=listed("constraints"), allow_swap=a.allow_swap)
        finish({"doctor": checks})
        return int(not checks.where("status = 'FAIL'").isEmpty())
    if a.command == "repair":
        done = repairs.repaired(spark, lambda: catalog.objects_of(spark, a.schema), repairs.refresh(spark), edges=catalog.resolved_edges(spark, a.schema))
        finish({"maintenance": done})
        return int(not done.where("outcome = 'failed'").isEmpty())
    if a.command == "history":
        history = ledger.history(spark)
        recent, old = reports.compacted(history, a.keep_runs)
        return finish({"recent_runs": recent, "older_runs": old, "log_rollup": reports.log_rollup(ledger.frame(spark, "events"))})
    if a.command == "report":
        return finish({n: ledger.frame(spark, n) for n in ("runs", "events", "chunks", "watermarks", "rollbacks")} | {"log_rollup": reports.log_rollup(ledger.frame(spark, "events"))})
    if a.command == "lob":
        return finish({"lob_analysis": long_columns.analyzed(catalog.columns_of({s.name: side(s.name, "target") for s in wanted}, spark))})
    if a.command == "simulate":
        rows = [(s.name, s.mode, side(s.name, "source").count(), catalog.size_bytes(spark, places[s.name]["target"]), 0) for s in wanted]
        return finish({"simulation": profile.simulated(spark.createDataFrame(rows, "table_name string, mode string, estimated_rows long, size_bytes long, dependents long"))})
    if a.command == "query-perf":
        timings = queryperf.measured(spark, Path(a.sql).read_text())
        return finish({"query_perf": timings, "recommendation": reports.best_variants(timings)})
    if a.command == "watermarks":
        ledger.frame(spark, "watermarks").show(1000, False)
        return 0
    if a.command == "reset-watermark":
        return int(sum(ledger.reset_watermark(s.name) for s in wanted) == 0)
    if a.command == "circuit":
        ledger.frame(spark, "breakers").show(1000, False)
        return 0
    if a.command == "rollback":
        return int(any(r["status"] != "SUCCESS" for r in load.roll_back(spark, ledger, run)))

    job = "sync:" + ",".join(s.name for s in wanted)
    if ledger.blocked(job):
        print(f"{job} has failed too often and rests", file=sys.stderr)
        return 2
    with (folder / "sync.lock").open("w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
        stores = [s for s in wanted if places[s.name]["target"].startswith("jdbc:")]
        chunked = [s for s in wanted if s not in stores and a.command == "resume"]
        loads = [(s, side(s.name, "source"), VersionedTable(spark, places[s.name]["target"])) for s in wanted if s not in stores and s not in chunked]
        guards = {"execute": a.execute, "allow_swap": a.allow_swap, "skip_matching": a.skip_matching, "require_unique_target": a.require_unique_target, "require_whole": a.require_whole, "require_bounds": a.require_bounds}
        if a.guard_schema and a.execute:
            def scan() -> DataFrame:
                return catalog.objects_of(spark, a.guard_schema)

            edges = catalog.resolved_edges(spark, a.guard_schema)
            guards["guarded"] = load.guard(spark, scan, edges, [s.name for s in wanted], lambda: repairs.repaired(spark, scan, repairs.refresh(spark), edges=edges))
        results = load.run_all(spark, loads, ledger, run, a.workers, a.direction, **guards)
        for again in range(1, a.retries + 1):
            left = [i for i, r in enumerate(results) if r.status == "FAILED"]
            if not left:
                break
            time.sleep(5 * again)
            for i, r in zip(left, load.run_all(spark, [loads[i] for i in left], ledger, f"{run}-{again}", a.workers, a.direction, **guards), strict=True):
                results[i] = r
        for s in chunked:  # an append by ranges goes on where the run with this id stopped
            n = load.append_chunks(spark, s, side(s.name, "source"), VersionedTable(spark, places[s.name]["target"]), ledger, run, list(s.keys))
            results.append(LoadResult(s.name, "append", "SUCCESS", rows_written=n))
        if a.execute:
            sent = [load.write_out(spark, s, side(s.name, "source"), places[s.name]["target"], ledger, run, a.direction, **places[s.name].get("target_options", {})) for s in stores]
            results += sent
            if all(r.status != "FAILED" for r in results):
                for s, r in zip(stores, sent, strict=True):
                    if r.watermark is not None:
                        ledger.set_watermark(a.direction, s.name, s.incremental.strategy, s.incremental.column, r.watermark)
    bad = [r for r in results if r.status == "FAILED"]
    doubtful = [r for r in results if r.verdict == "WARN" or r.rows_failed]
    event, about = ("failed", bad) if bad else ("warning", doubtful) if doubtful else ("success", results)
    if bad:
        ledger.failed(job, 30, bad[0].message)
    else:
        ledger.cleared(job)
    payload = {"run_id": run, "job": job, "direction": a.direction, "error": bad[0].message if bad else "", "tables": [r.table_name for r in about], "rows_written": sum(r.rows_written for r in results), "rows_failed": sum(r.rows_failed for r in results)}
    reports.alert(event, payload, set(tree.get("alerts", ["failed"])), lambda kind, what: print(json.dumps({"event": kind} | what), file=sys.stderr))
    fields = "table_name string, mode string, status string, rows_read long, rows_written long, rows_failed long, checksum_status string, version string, backup string, message string, watermark string, verdict string, bytes_written long, long_bytes long, seconds double, files_rewritten long, rejects string, rows_per_second double, bytes_per_second double"
    return finish({"sync_result": spark.createDataFrame([(*r.__dict__.values(), r.rows_per_second, r.bytes_per_second) for r in results], fields), "events": ledger.frame(spark, "events").where(F.col("run_id") == run)})


if __name__ == "__main__":
    sys.exit(main())
