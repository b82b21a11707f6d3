"""Loads: the source's rows, mapped and cleaned, staged as a new version, checked, and published.

Every mode is a way to make the next version from the current one and the incoming rows. So all are safe in the same way: nothing is
seen before it is checked, the version before is the backup, and a failure leaves the table as it was. An append adds a folder; a keyed
load reads and writes only the files that hold one of its keys. Loads of one table that meet all stand: the later one of two keyed
loads merges again into what the earlier one has left.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.canon import table_digest
from concordat.model import LoadResult, TableSpec
from concordat.operators import chunks, incremental, mapping, objects, upsert
from concordat.operators.reconcile import checksum_columns
from concordat.sources import files
from concordat.sources.catalog import is_bounded
from concordat.sources.store import Store, StoreError
from concordat.sources.versions import REJECTED, ConflictError, VersionedTable
from concordat.streaming.ledger import Ledger

FULL = ("truncate", "truncate_safe", "swap", "swap_safe", "delete")
KEYED = ("upsert", "incremental_safe", "delete_insert")
MODES = (*FULL, "append", *KEYED)
TRIES = 6  # of a keyed load that meets others


class LoadError(RuntimeError):
    """The load must not go on; the table is as it was."""


def verdict(read: int, written: int, failed: int, checksum: str, counts_match: bool | None, reverse: bool = False, keyed_increment: bool = False) -> str:
    """PASS, WARN, FAIL or UNKNOWN: rows lost or digests apart fail; counts apart warn, and fail in the reverse direction."""
    if failed or read != written or checksum == "MISMATCH":
        return "FAIL"
    if keyed_increment and reverse and counts_match is None:
        return "PASS"
    if counts_match is None:
        return "UNKNOWN"
    return "PASS" if counts_match else "FAIL" if reverse else "WARN"


def verdicts(results: DataFrame) -> DataFrame:
    """verdict() for a table of results: rows_read, rows_written, rows_failed, checksum_status, row_count_match, direction."""
    lost = (F.col("rows_failed") > 0) | (F.col("rows_read") != F.col("rows_written")) | F.coalesce(F.col("checksum_status") == "MISMATCH", F.lit(False))
    back = F.col("direction") == "reverse"
    out = F.when(lost, "FAIL").when(F.col("row_count_match").isNull(), "UNKNOWN").when(F.col("row_count_match"), "PASS").when(back, "FAIL").otherwise("WARN")
    return results.withColumn("verdict", out)


def _pairs(spec: TableSpec, source: DataFrame, target: DataFrame, reverse: bool) -> list[mapping.Pair]:
    pairs = mapping.column_map(source, target, spec.rename, "source" if reverse else "target")
    long = {c.lower() for c, d in target.dtypes if mapping.is_long(d)}
    return mapping.with_long_policy(pairs, spec.name, long, spec.lob, spec.lob_default)


def _wanted(spec: TableSpec, source: DataFrame, watermark: str | None) -> DataFrame:
    rows = source.where(spec.where) if spec.where else source
    if spec.incremental:
        i = spec.incremental
        incremental.parse_column(i.column, source.columns)
        rows = rows.where(incremental.newer(i.column, i.strategy, watermark or i.initial, i.overlap_minutes))
    return rows


def incoming(spec: TableSpec, source: DataFrame, target: DataFrame, watermark: str | None = None, reverse: bool = False) -> DataFrame:
    """The rows to load in the target's shape."""
    return mapping.projected(_wanted(spec, source, watermark), _pairs(spec, source, target, reverse), mapping.fixed_length(source), reverse)


def attempted(spec: TableSpec, source: DataFrame, target: DataFrame, watermark: str | None = None, reverse: bool = False) -> DataFrame:
    """incoming() with a _failed column, for rows that cannot be cast, and for incremental loads with what the watermark is taken of as _mark."""
    mark = incremental.source_expression(spec.incremental.column) if spec.incremental else None
    return mapping.attempted(_wanted(spec, source, watermark), _pairs(spec, source, target, reverse), mapping.fixed_length(source), reverse, mark, spec.keys)


def _counted(tried: DataFrame, long: list[str]) -> tuple[DataFrame, Observation]:
    """The rows of attempted() without _mark, and what is seen of them on the way: read, failed, bytes, long_bytes, and the watermark."""
    seen = Observation(f"load-{uuid.uuid4().hex[:8]}")
    plain = [c for c, d in tried.dtypes if c not in ("_failed", "_mark", *long) and not mapping.is_long(d)]

    def size(columns: list[str]) -> Column:
        total = F.lit(0).cast("long")
        for c in columns:
            total = total + F.coalesce(F.octet_length(F.col(c).cast("string") if c in plain else F.to_json(F.struct(c)).cast("string")), F.lit(0))
        return F.coalesce(F.sum(F.when(F.col("_failed").isNull(), total)), F.lit(0).cast("long"))

    marks = [F.max(F.when(F.col("_failed").isNull(), F.col("_mark"))).cast("string").alias("mark")] if "_mark" in tried.columns else []
    counted = tried.observe(seen, F.count(F.lit(1)).alias("read"), F.count("_failed").alias("failed"), size(plain).alias("bytes"), size(long).alias("long_bytes"), *marks)
    return counted.drop("_mark"), seen


def _parted(counted: DataFrame) -> DataFrame:
    """Rows with what stage_parted() parts them by; a rejected row says in which task (chunk) and at which place of it (row, from 0) it was read."""
    place = F.monotonically_increasing_id()  # the task's number above 33 bits of place
    told = F.struct(F.shiftright(place, 33).cast("int").alias("chunk"), place.bitwiseAND((1 << 33) - 1).alias("row"), "_failed.*")
    return counted.withColumn(REJECTED, F.when(F.col("_failed").isNotNull(), told)).drop("_failed")


def check(spec: TableSpec, allow_swap: bool = False, require_filter: bool = False, require_whole: bool = False) -> None:
    """Refuse what would lose rows or cannot work."""
    if spec.mode not in MODES:
        raise LoadError(f"no such mode: {spec.mode}")
    if spec.mode in FULL and (spec.incremental or (spec.where and spec.mode in ("truncate", "delete"))):
        raise LoadError(f"{spec.mode} with a filter would keep the filtered rows only")
    if spec.mode in KEYED and not spec.keys:
        raise LoadError(f"{spec.mode} needs keys")
    if spec.mode in KEYED and spec.on_duplicate == "last" and not spec.order_by:
        raise LoadError("the last of repeated keys needs order_by")
    if spec.mode.startswith("swap") and not allow_swap:
        raise LoadError("swap has to be allowed")
    if require_whole and spec.skip_failed:
        raise LoadError("rows that cannot be cast must not be left out here")
    if require_filter and not (spec.where or spec.incremental):
        raise LoadError("a filter is required")


def next_version(spec: TableSpec, now: DataFrame, rows: DataFrame) -> DataFrame:
    """The table after the load."""
    if spec.mode in FULL:
        return now.limit(0).unionByName(rows, allowMissingColumns=True)
    if spec.mode == "append":
        return now.unionByName(rows, allowMissingColumns=True)
    if spec.mode == "delete_insert":
        return upsert.deleted_then_inserted(now, rows, list(spec.keys))
    return upsert.upserted(now, rows, list(spec.keys), on_duplicate=spec.on_duplicate, order=[F.col(c) for c in spec.order_by])


def run(spark: SparkSession, spec: TableSpec, source: DataFrame, table: VersionedTable, ledger: Ledger, run_id: str | None = None, execute: bool = True, validate: bool = True, direction: str = "forward", skip_matching: bool = False, require_unique_target: bool = False, require_bounds: bool = False, **guards: bool) -> LoadResult:
    """Load one table. A dry run plans and counts only.

    The increment is staged first, so its watermark, its digest and the merge all see the same rows; rows that cannot be cast are counted
    on the way, written beside the table by the same job (VersionedTable.rejects), sampled into the ledger, and fail the load unless the table's
    skip_failed is set. skip_matching: a full load of a table whose row
    counts agree already is skipped. What was written is counted in the staged version. A watermark is returned, and is for the
    caller to publish once all tables of the run have succeeded.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    reverse = direction == "reverse"
    result, began = LoadResult(spec.name, spec.mode, "PENDING"), time.monotonic()
    state = table.state()
    now = table.read(state=state)
    if now is None:
        raise LoadError(f"{spec.name}: the target does not exist")
    check(spec, **guards)
    if require_bounds and spec.incremental and is_bounded(source, spec.incremental.column.strip()) is False:
        raise LoadError(f"{spec.name}: the source's files have no bounds of {spec.incremental.column}, so each increment would scan them all")
    if require_unique_target and spec.mode in KEYED and not upsert.is_unique(now, list(spec.keys)):
        raise LoadError(f"{spec.name}: the target repeats a key of {', '.join(spec.keys)}")
    mark = ledger.watermark(direction, spec.name, spec.incremental.strategy, spec.incremental.column) if spec.incremental else None
    if not execute:
        return replace(result, status="DRY_RUN", rows_read=_wanted(spec, source, mark).count(), message=f"{spec.mode} from {len(source.columns)} columns")
    if skip_matching and spec.mode in FULL and not spec.where and not spec.incremental:
        n = source.count()
        if n == now.count():
            ledger.event(run_id, "load", "skipped", spec.name, "row counts agree")
            return replace(result, status="SKIPPED", rows_read=n, message="row counts agree")
    ledger.event(run_id, "load", "started", spec.name)
    staged = [f"{run_id}-delta", run_id]
    try:
        tried = attempted(spec, source, now, mark, reverse)
        values = [c for c in tried.columns if c not in ("_failed", "_mark")]
        counted, seen = _counted(tried, [c for c, d in tried.dtypes if c in values and mapping.is_long(d)])
        parted = _parted(counted)
        # an append's rows are a folder of the table, so they have all its columns
        delta, rejects = table.stage_parted(now.limit(0).unionByName(parted, allowMissingColumns=True) if spec.mode == "append" else parted, staged[0], run_id)
        read, failed = seen.get["read"], seen.get["failed"]
        if failed:
            sample = [r.asDict() for r in rejects.select("chunk", "row", "key_values", F.explode("failures").alias("f")).select("chunk", "row", "key_values", "f.*").orderBy("key_values", "chunk", "row").limit(20).collect()]
            ledger.event(run_id, "load", "rejected", spec.name, f"{failed} rows cannot be cast", {"sample": sample})
            if not spec.skip_failed:
                raise LoadError(f"{failed} of {read} rows cannot be cast, as {sample[0]['column_name']} = {sample[0]['value']!r}")
        got, new, touched = delta.count(), None, []
        if spec.mode in FULL:
            new = table.stage(next_version(spec, now, delta), run_id)
        superseded = got - delta.select(*spec.keys).distinct().count() if spec.mode in KEYED and spec.on_duplicate == "last" and spec.mode != "delete_insert" else 0
        for attempt in range(TRIES if spec.mode in KEYED else 1):
            if spec.mode in KEYED:
                state = table.state() if attempt else state
                touched = table.touched(delta, list(spec.keys), state)
                new = table.stage(next_version(spec, table.read_files(touched, now), delta), run_id)
            written = got if new is None else new.count() if spec.mode in FULL else arrived(spec, delta, new).count()
            status = ""
            if validate:
                # an append is checked against its source, the others' versions against the rows that were staged for them
                good = same_rows(incoming(spec, source, now, mark, reverse), delta.select(*values), spec) if spec.mode == "append" and not failed else agrees(spec, delta, new)
                status = "MATCH" if good else "MISMATCH"
                if not good:
                    raise LoadError("the staged rows differ from the source's")
            whole = spec.mode in FULL and not spec.where
            outcome = verdict(read, written + superseded + failed, 0 if spec.skip_failed else failed, status, (written == read - failed) if whole else None, reverse, bool(spec.incremental) and spec.mode in KEYED)
            if outcome == "FAIL":
                raise LoadError(f"{read} rows were read, {written} written")
            try:
                if spec.mode == "append":
                    backup = table.append(run_id, [staged[0]])
                elif spec.mode in FULL:
                    backup = table.publish(run_id)
                else:
                    backup = table.rewrite(run_id, state["version"], touched)
                break
            except ConflictError:
                ledger.event(run_id, "load", "conflict", spec.name, "another load was first")
                if attempt == TRIES - 1:
                    raise
        ledger.add_rollback(run_id, spec.name, spec.mode, table.path, backup, staged[0])
        if spec.mode != "append":
            table.discard(staged[0])
        table.retain()
    except Exception as e:
        for folder in staged:
            table.discard(folder)
        table.discard_rejects(run_id)
        ledger.event(run_id, "load", "failed", spec.name, str(e)[:500])
        if isinstance(e, (LoadError, upsert.DuplicateKeyError, ConflictError)):
            return replace(result, status="FAILED", message=str(e))
        raise
    took = time.monotonic() - began
    result = replace(
        result, status="SUCCESS", rows_read=read, rows_written=written + superseded, rows_failed=failed, checksum_status=status, version=run_id, backup=backup, watermark=seen.get.get("mark"), verdict=outcome,
        bytes_written=seen.get["bytes"], long_bytes=seen.get["long_bytes"], seconds=took, files_rewritten=len(touched), rejects=table.rejects_path(run_id) if failed else "",
    )
    ledger.event(run_id, "load", "success", spec.name, details={"rows": written, "verdict": outcome, "bytes": result.bytes_written, "long_bytes": result.long_bytes, "seconds": round(took, 3), "rows_per_second": round(result.rows_per_second, 1), "bytes_per_second": round(result.bytes_per_second, 1), "files_rewritten": len(touched)})
    return result


def write_out(spark: SparkSession, spec: TableSpec, source: DataFrame, target: str, ledger: Ledger, run_id: str | None = None, direction: str = "reverse", **options) -> LoadResult:
    """Load into a store that is not ours to version: over JDBC by store.Store in any mode, exactly once for a run id; else by files.write(), where `append`
    adds and full modes replace. Rows that cannot be cast fail the load before anything is written unless skip_failed is set; counts say whether all arrived. An incremental append sends what is past the
    watermark, and returns the new one for the caller to publish."""
    run_id, reverse = run_id or uuid.uuid4().hex[:12], direction == "reverse"
    check(spec, **{k: options.pop(k) for k in ("allow_swap", "require_filter", "require_whole") if k in options})
    mark = ledger.watermark(direction, spec.name, spec.incremental.strategy, spec.incremental.column) if spec.incremental else None
    over_jdbc = target.startswith("jdbc:")
    if spec.mode in KEYED and not over_jdbc:
        raise LoadError(f"{spec.mode} cannot be done in {target}: use append or a full mode")
    began = time.monotonic()
    there = lambda: files.read(spark, target, **options)
    shape = there()
    tried = attempted(spec, source, shape, mark, reverse)
    failed = tried.where("_failed IS NOT NULL").count()
    if failed and not spec.skip_failed:
        return LoadResult(spec.name, spec.mode, "FAILED", rows_failed=failed, message=f"{failed} rows cannot be cast")
    ledger.event(run_id, "load", "started", spec.name)
    counted, seen = _counted(tried, [c for c, d in tried.dtypes if c not in ("_failed", "_mark") and mapping.is_long(d)])
    passed = counted.where("_failed IS NULL").drop("_failed")
    superseded = 0
    if over_jdbc:
        if spec.mode in ("upsert", "incremental_safe"):
            if spec.on_duplicate == "last":
                passed = upsert.last_wins(passed, list(spec.keys), [F.col(c) for c in spec.order_by])
            elif not upsert.duplicate_keys(tried.where("_failed IS NULL"), list(spec.keys)).isEmpty():
                return LoadResult(spec.name, spec.mode, "FAILED", message=f"changes repeat a key of {', '.join(spec.keys)}")
        kind = "replace" if spec.mode in FULL else "upsert" if spec.mode in ("upsert", "incremental_safe") else spec.mode
        try:
            told = Store(spark, target, **options).load(passed, options["dbtable"], f"{run_id}:{spec.name}", kind, list(spec.keys))
        except StoreError as e:
            ledger.event(run_id, "load", "failed", spec.name, str(e)[:500])
            return LoadResult(spec.name, spec.mode, "FAILED", message=str(e))
        if told["done"]:
            return LoadResult(spec.name, spec.mode, "SKIPPED", message="this run has been merged before")
        rows, written = seen.get["read"] - failed, told["staged"]
        superseded = rows - written
    else:
        before = shape.count() if spec.mode == "append" else 0
        rows = files.write(passed, target, "append" if spec.mode == "append" else "overwrite", **options)["rows"]
        if "/" not in target:  # a table of the catalog: its statistics are out of date
            spark.sql(f"ANALYZE TABLE {target} COMPUTE STATISTICS")
        written = there().count() - before
    outcome = verdict(rows, written + superseded, 0, "", None if spec.mode == "append" or spec.mode in KEYED else True, reverse, bool(spec.incremental) and spec.mode in KEYED)
    state = "FAILED" if outcome == "FAIL" else "SUCCESS"
    ledger.event(run_id, "load", state.lower(), spec.name, details={"rows": written, "verdict": outcome})
    return LoadResult(
        spec.name, spec.mode, state, rows + failed, written + superseded, failed, verdict=outcome, message="" if state == "SUCCESS" else f"{rows} rows were sent, {written} arrived",
        watermark=seen.get.get("mark"), bytes_written=seen.get["bytes"], long_bytes=seen.get["long_bytes"], seconds=time.monotonic() - began,
    )


def arrived(spec: TableSpec, delta: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of a keyed load's version that have one of the incoming keys; a null key is no key, and its row is one of its own."""
    keyed = new.join(delta.select(*spec.keys).distinct(), list(spec.keys), "left_semi")
    null = F.lit(False)
    for k in spec.keys:
        null = null | F.col(k).isNull()
    loose = delta.where(null)
    return keyed.unionByName(loose, allowMissingColumns=True) if not loose.isEmpty() else keyed


def same_rows(a: DataFrame, b: DataFrame, spec: TableSpec) -> bool:
    """Whether two frames hold the same rows, by their digests over the columns that can be digested."""
    columns = checksum_columns(a, spec.exclude)
    one, two = (table_digest(df.select(*columns), columns).first() for df in (a, b))
    return (one["rows"], one["digest"]) == (two["rows"], two["digest"])


def agrees(spec: TableSpec, delta: DataFrame, new: DataFrame | None) -> bool:
    """Whether the incoming rows stand in the staged version unchanged: by digests, for keyed loads of the rows with the incoming keys."""
    if new is None:
        return True  # an append with rows left out: what was staged is what is published
    if spec.mode not in KEYED:
        return same_rows(delta, new, spec)
    rows = upsert.last_wins(delta, list(spec.keys), [F.col(c) for c in spec.order_by]) if spec.on_duplicate == "last" and spec.mode != "delete_insert" else delta
    return same_rows(rows, arrived(spec, delta, new).select(*delta.columns), spec)


WAVE = 64  # ranges that are staged by one job


def _ranges(spec: TableSpec, rows: DataFrame, expected: int, keys: list[str], ledger: Ledger, run_id: str) -> list[tuple]:
    """Bounds of ranges of about chunk_size rows, over keys of any type; a run that goes on takes those that it has begun with."""
    plan = [r for r in ledger.rows("chunks", "run_id=? AND table_name=?", run_id, spec.name, order="chunk_start") if "#[" in r["chunk_key"] and r["chunk_start"] > 0]
    types = [rows.schema[k].dataType for k in keys]
    if not plan:
        return chunks.bounds(rows, keys, max(1, min(4096, -(-expected // spec.chunk_size))))
    texts = rows.sparkSession.createDataFrame([(r["chunk_start"], *json.loads(r["chunk_key"].partition("#")[2])) for r in plan], ", ".join(["n long", *(f"c{i} string" for i in range(len(keys)))]))
    return [tuple(r) for r in texts.orderBy("n").select(*(F.col(f"c{i}").cast(t) for i, t in enumerate(types))).collect()]


def append_chunks(spark: SparkSession, spec: TableSpec, source: DataFrame, table: VersionedTable, ledger: Ledger, run_id: str, key: str | list[str]) -> int:
    """Append key range by key range; a second call with the same run id goes on after the ranges that succeeded.

    Ranges are of equal depth, over one key or several of any type that can be ordered, half open, so no key falls between two; rows with a null key
    are a range of their own. They are staged in waves, a job and a folder for each, that read the wave's keys only; the ledger has each
    range's rows and its lower bound. A range counts as done only while the folder that holds it is there. All folders are
    published together, and nothing is copied again. The rows of all ranges must be as many as the source has. Returns the table's rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    now = table.read()
    rows = incoming(spec, source, now)
    shape = now.limit(0)
    ledger.release(run_id)
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    expected, nulls = rows.agg(F.count(F.lit(1)), F.count_if(null)).first()
    at = _ranges(spec, rows, expected, keys, ledger, run_id)
    spell = F.to_json(F.array(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)))
    told = spark.createDataFrame([(i, *t) for i, t in enumerate(at)], T.StructType([T.StructField("_n", T.IntegerType()), *(T.StructField(k, rows.schema[k].dataType) for k in keys)]))
    names = ["", *(r[0] for r in told.orderBy("_n").select(spell).collect())]
    # range 0 is what lies below the first bound, range i begins at bound i - 1, NULLS comes last
    parts = [*range(len(at) + 1), *([chunks.NULLS] if nulls else [])]
    name = lambda i: f"{','.join(keys)}#{json.dumps(['<']) if i == 0 else names[i] if i > 0 else 'null'}"
    there, done = set(table.versions()), ledger.successful(run_id, spec.name)
    for i in parts:
        ledger.add_chunk(run_id, spec.name, name(i), i, i + 1)
    folders = []
    for w in range(0, len(parts), WAVE):
        staged, wave = f"{run_id}-part{w:06d}", parts[w : w + WAVE]
        folders.append(staged)
        if staged in there and all(name(i) in done for i in wave):
            continue
        for i in wave:
            if name(i) in done:
                ledger.finish(run_id, spec.name, name(i), "failed", error="its staged rows are not whole")
        if len([i for i in wave if ledger.claim(run_id, spec.name, name(i))]) < len(wave):
            raise LoadError(f"{spec.name}: another run holds ranges of {staged}")
        live = [i for i in wave if i >= 0]
        mine = F.lit(False)
        if live:
            mine = chunks.within(rows, keys, at[live[0] - 1] if live[0] > 0 else None, at[live[-1]] if live[-1] < len(at) else None)
        if chunks.NULLS in wave:
            mine = mine | null
        part = table.stage(shape.unionByName(rows.where(mine), allowMissingColumns=True), staged)
        inner = at[live[0] : live[-1]] if live else []
        n = {r["r"]: r["n"] for r in part.groupBy(chunks.range_of(part, keys, inner, live[0] if live else 0).alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most WAVE rows
        for i in wave:
            ledger.finish(run_id, spec.name, name(i), "success", n.get(i, 0))
    staged_rows = sum(r["rows"] or 0 for r in ledger.rows("chunks", "run_id=? AND table_name=?", run_id, spec.name))
    if staged_rows != expected:
        raise LoadError(f"{spec.name}: the ranges hold {staged_rows} rows, the source {expected}")
    ledger.add_rollback(run_id, spec.name, "append", table.path, table.append(run_id, folders))
    table.retain()
    return table.read().count()


def guard(spark: SparkSession, scan: Callable[[], DataFrame], edges: DataFrame, tables: list[str], mend: Callable[[], object] | None = None) -> Callable[[], str]:
    """What run_all() asks before it accepts a run: names of the dependents of `tables` that the run has broken, or nothing.

    scan gives the objects as they are, as objects.newly_broken() takes them; it is called now and after the loads. edges (object, uses) are read now. mend is tried
    before a dependent counts as broken, as a view may only need what is cached of it to be read again. Objects of a catalog are few.
    """
    kept = lambda df: spark.createDataFrame(df.collect(), df.schema)
    before, uses = kept(scan().select("object_schema", "object_name", "object_type", "status", "details")), kept(edges.select("object", "uses"))
    loaded = spark.createDataFrame([(t,) for t in tables], "table_name string")

    def broken() -> str:
        found = objects.newly_broken(before, scan(), uses, loaded).select("object", "details").distinct().orderBy("object").limit(20).collect()
        return "; ".join(f"{r['object']}: {r['details']}" for r in found)

    def asked() -> str:
        if (found := broken()) and mend:
            mend()
            found = broken()
        return found

    return asked


def run_all(spark: SparkSession, loads: list[tuple[TableSpec, DataFrame, VersionedTable]], ledger: Ledger, run_id: str, workers: int = 4, direction: str = "forward", guarded: Callable[[], str] | None = None, **options) -> list[LoadResult]:
    """Load several tables at once, results in the order asked for. Watermarks move only if every table succeeded, and nothing is told against the
    run by `guarded` (see guard()), which else is rolled back as a whole."""
    ledger.start_run(run_id, direction)

    def one(item: tuple[TableSpec, DataFrame, VersionedTable]) -> LoadResult:
        spec, source, table = item
        try:
            return run(spark, spec, source, table, ledger, run_id, direction=direction, **options)
        except Exception as e:
            return LoadResult(spec.name, spec.mode, "FAILED", message=str(e)[:500])

    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(one, loads))
    good = all(r.status in ("SUCCESS", "DRY_RUN", "SKIPPED") for r in results)
    if good and guarded and any(r.status == "SUCCESS" for r in results) and (told := guarded()):
        good, undone = False, roll_back(spark, ledger, run_id)
        ledger.event(run_id, "dependents", "failed", message=told[:500], details={"undone": [a["table_name"] for a in undone if a["status"] == "SUCCESS"]})
        results = [replace(r, status="FAILED", message=f"rolled back, as dependents broke: {told[:500]}") if r.status == "SUCCESS" else r for r in results]
    if good:
        for (spec, _, _), r in zip(loads, results, strict=True):
            if r.watermark is not None:
                ledger.set_watermark(direction, spec.name, spec.incremental.strategy, spec.incremental.column, r.watermark)
    ledger.finish_run(run_id, "SUCCESS" if good else "FAILED", next((r.message for r in results if r.status == "FAILED"), ""))
    return results


def roll_back(spark: SparkSession, ledger: Ledger, run_id: str) -> list[dict]:
    """Undo a run's loads, the last first."""
    out = []
    for action in ledger.rollbacks(run_id):
        try:
            VersionedTable(spark, action["target"]).rollback(action["backup"])
            status, notes = "SUCCESS", ""
        except Exception as e:
            status, notes = "FAILED", str(e)[:500]
        ledger.mark_rollback(action["seq"], status, notes)
        out.append(action | {"status": status, "notes": notes})
    return out
