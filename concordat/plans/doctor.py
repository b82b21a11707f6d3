"""Whether a job could run: settings, stores, keys, ledger and dependencies, as rows of check, status and message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from concordat.model import TableSpec
from concordat.operators.objects import NoKeyError, health, resolve_keys
from concordat.plans.load import KEYED, LoadError, check
from concordat.sources.catalog import is_bounded
from concordat.streaming.ledger import Ledger


def examined(spark: SparkSession, specs: list[TableSpec], side: Callable[[str, str], DataFrame], ledger: Ledger | None = None, edges: DataFrame | None = None, constraints: tuple[DataFrame | None, DataFrame | None] = (None, None), **guards: bool) -> DataFrame:
    """check, status (OK, WARN, FAIL) and message. side(name, "source" or "target") gives a table's frame; only schemas are read."""
    rows: list[tuple[str, str, str]] = []

    def tried(name: str, fn: Callable[[], str], bad: str = "FAIL") -> bool:
        try:
            rows.append((name, "OK", fn() or ""))
            return True
        except Exception as e:
            rows.append((name, bad, str(e).splitlines()[0][:300]))
            return False

    rows.append(("settings", "OK" if specs else "FAIL", f"{len(specs)} tables"))
    for spec in specs:
        def mode(spec: TableSpec = spec) -> str:
            check(spec, **guards)
            return spec.mode

        def columns(which: str, spec: TableSpec = spec) -> list[str]:
            return [c.lower() for c in side(spec.name, which).columns]

        def keys(spec: TableSpec = spec) -> str:
            found, origin = resolve_keys(spec.name, spec.keys, *constraints)
            missing = [k for k in found if k.lower() not in columns("target")]
            if missing:
                raise LoadError(f"the target lacks {', '.join(missing)}")
            return f"{','.join(found)} by {origin}"

        tried(f"{spec.name}: mode", mode)
        there = [tried(f"{spec.name}: {which}", lambda w=which: f"{len(columns(w))} columns") for which in ("source", "target")]
        if all(there):
            tried(f"{spec.name}: keys", keys, "FAIL" if spec.mode in KEYED else "WARN")
        if there[0] and spec.incremental:
            def bounds(spec: TableSpec = spec) -> str:
                column = spec.incremental.column.strip()
                if is_bounded(side(spec.name, "source"), column) is False:
                    raise LoadError(f"files have no bounds of {column}: each increment scans them all")
                return f"{column} is bounded in files"

            tried(f"{spec.name}: watermark", bounds, "WARN")
    if ledger:
        def work() -> str:
            ledger.start_run("doctor")
            ledger.reset_run("doctor")
            stuck = ledger.rows("runs", "status='running'")
            if stuck:
                raise LoadError(f"{len(stuck)} runs have not ended: {', '.join(r['run_id'] for r in stuck[:5])}")
            return "can be written"

        tried("ledger", work, "WARN")
    if edges is not None:
        def sound() -> str:
            broken = health(edges).where("broken_count > 0").count()
            if broken:
                raise NoKeyError(f"{broken} tables have broken dependents")
            return "no broken dependents"

        tried("dependencies", sound, "WARN")
    return spark.createDataFrame(rows, "`check` string, status string, message string")
