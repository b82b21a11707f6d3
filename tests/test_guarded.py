"""Runs that are rolled back when dependents break, guards on bounds, sequences of both sides, staged folders that are dropped."""

import json

import pytest
from pyspark.sql import functions as F

from concordat import cli
from concordat.model import Incremental, TableSpec
from concordat.operators import objects, sequences
from concordat.plans import load
from concordat.sources import catalog
from concordat.sources.versions import VersionedTable
from concordat.streaming.ledger import Ledger
from tests.conftest import rows

OBJECTS = "object_schema string, object_name string, object_type string, status string, details string"


def states(spark, **status):
    return spark.createDataFrame([("s", n, "VIEW", v, "why") for n, v in status.items()], OBJECTS)


def test_newly_broken(spark):
    edges = spark.createDataFrame([("S.A", "s.t"), ("s.b", "s.a"), ("s.c", "s.other"), ("s.a", "s.b"), (None, "s.t")], "object string, uses string")
    before = states(spark, a="VALID", b="INVALID", c="VALID", gone="VALID")
    after = states(spark, a="INVALID", b="INVALID", c="INVALID")
    loaded = spark.createDataFrame([("S.T",), (None,)], "table_name string")
    assert rows(objects.newly_broken(before, after, edges, loaded)) == [("s.a", "S.T", 1, "why")]
    assert objects.newly_broken(before, before, edges, loaded).isEmpty() and objects.newly_broken(before.limit(0), after.limit(0), edges.limit(0), loaded).isEmpty()


@pytest.mark.parametrize("case", ["broken", "mended", "sound"])
def test_a_run_that_breaks_a_dependent_is_rolled_back(spark, tmp_path, case):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.stage(spark.createDataFrame([(1, 1)], "id long, at long"), "v0")
    table.publish("v0")
    source = spark.createDataFrame([(2, 5)], "id long, at long")
    mended = []

    def scan():
        whole = table.current() == "v0" or case == "sound" or bool(mended)
        return states(spark, v="VALID" if whole else "INVALID")

    edges = spark.createDataFrame([("s.v", "s.t")], "object string, uses string")
    asked = load.guard(spark, scan, edges, ["s.t"], (lambda: mended.append(1)) if case == "mended" else None)
    ledger = Ledger()
    spec = TableSpec("s.t", keys=("id",), mode="upsert", incremental=Incremental("at", "numeric_key", initial="0"))
    (r,) = load.run_all(spark, [(spec, source, table)], ledger, "r1", guarded=asked)
    if case == "broken":
        assert r.status == "FAILED" and "s.v: why" in r.message and rows(table.read()) == [(1, 1)] and table.current() == "v0"
        assert ledger.watermark("forward", "s.t", "numeric_key", "at") is None
        assert [e["phase"] for e in ledger.rows("events", "status='failed'")] == ["dependents"]
    else:
        assert r.status == "SUCCESS" and rows(table.read(), "id") == [(1,), (2,)] and ledger.watermark("forward", "s.t", "numeric_key", "at") == "5"


def test_increments_need_bounds_where_that_is_asked(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.stage(spark.createDataFrame([(1, 1)], "id long, at long"), "v0")
    table.publish("v0")
    spec = TableSpec("t", keys=("id",), mode="upsert", incremental=Incremental("at", "numeric_key", initial="0"))
    df = spark.range(10).select("id", F.col("id").alias("at")).coalesce(1)
    df.write.parquet(str(tmp_path / "with"))
    df.write.option("parquet.column.statistics.enabled", "false").parquet(str(tmp_path / "without"))
    assert catalog.is_bounded(spark.read.parquet(str(tmp_path / "with")), "AT") is True and catalog.is_bounded(df, "at") is None
    assert catalog.is_bounded(spark.read.parquet(str(tmp_path / "with")), "none") is False
    assert load.run(spark, spec, spark.read.parquet(str(tmp_path / "with")), table, Ledger(), "r1", require_bounds=True).status == "SUCCESS"
    if catalog.is_bounded(spark.read.parquet(str(tmp_path / "without")), "at") is False:
        with pytest.raises(load.LoadError, match="no bounds"):
            load.run(spark, spec, spark.read.parquet(str(tmp_path / "without")), table, Ledger(), "r2", require_bounds=True)


def test_sequences_of_both_sides(spark):
    target = spark.createDataFrame([("t", "t_seq", 5, True, 1, 100), ("u", "u_id", 5, False, 1, 100)], "table_name string, target_sequence string, target_last long, target_is_called boolean, increment long, max_value long")
    source = spark.createDataFrame([("T_SEQ", 9)], "name string, source_last long")
    maxima = spark.createDataFrame([("t", 20, None), ("u", 7, 7)], "table_name string, source_table_max long, target_table_max long")
    got = sequences.planned(sequences.scanned(target.unionByName(target), source, maxima))
    assert rows(got, "target_sequence", "match", "set_to", "compare_status") == [("t_seq", "exact", 21, "NEEDS_SET"), ("u_id", "none", 8, "SKIPPED")]
    assert sequences.scanned(target.limit(0), source, maxima).isEmpty()


def test_staged_folders_of_a_run_are_dropped(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for v in ("v0", "r1", "r1-delta", "r1-part000000", "r1-partial", "r10-delta"):
        t.stage(spark.range(1), v)
    t.publish("v0")
    assert t.discard_run("r1") == ["r1", "r1-delta", "r1-part000000"] and t.versions() == ["r1-partial", "r10-delta", "v0"]
    assert t.discard_run("v0") == [] and t.read().count() == 1


def test_commands(spark, tmp_path, capsys):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.createDataFrame([(1, "5"), (2, "bad")], "id long, amount string").write.parquet(source)
    t = VersionedTable(spark, target)
    t.stage(spark.createDataFrame([], "id long, amount int"), "v0")
    t.publish("v0")
    settings = tmp_path / "tables.json"
    settings.write_text(json.dumps({"schema": "s", "alerts": ["warning"], "tables": [{"name": "t", "keys": ["id"], "mode": "upsert", "skip_failed": True, "source": source, "target": target}]}))
    common = ["--config", str(settings), "--ledger", str(tmp_path / "l.db"), "--reports", str(tmp_path / "out")]
    assert cli.main(["sync", "--execute", "--run-id", "r1", *common]) == 0
    told = json.loads(capsys.readouterr().err.strip().splitlines()[-1])
    assert (told["event"], told["rows_failed"]) == ("warning", 1)
    head = next((tmp_path / "out" / "sync_result").glob("*.csv")).read_text().splitlines()[0]
    assert head.endswith("rejects,rows_per_second,bytes_per_second")
    assert cli.main(["profile", "--hints", "id", *common]) == 0 and cli.main(["discard", "--run-id", "r0", *common]) == 0
    assert "id" in next((tmp_path / "out" / "key_candidates").glob("*.csv")).read_text()
    assert cli.main(["tables", *common]) == 0
