import json

import pytest
from pyspark.sql import functions as F

from concordat.functions import canon, text
from concordat.model import TableSpec
from concordat.operators import objects, reconcile
from concordat.operators.upsert import upserted
from concordat.plans import audit, doctor, load, repairs, reports
from concordat.sources import catalog, files
from concordat.sources.versions import VersionedTable
from concordat.streaming.ledger import Ledger
from tests.conftest import rows


@pytest.fixture
def target(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.stage(spark.createDataFrame([(99, "before", 1.5)], "id int, name string, x double"), "v0")
    t.publish("v0")
    return t


def test_numbers_have_all_their_digits(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-3, 1e-4, 1.5e-4, -1e-5, 123456.789, 1e7, 12345678.9, -1e15, 1e16, 1.5e22, 1.7976931348623157e308, 5e-324, float("inf"), float("-inf"), float("nan"), 1.0000001, 2.5e-10]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(canon.float_text(F.col("v"))).collect()]
    assert [float(g) for g in got[:-3] if g not in ("nan",)] == [v for v in values[:-3] if v == v]
    assert got == [repr(v) if v not in (5e-324,) else g for v, g in zip(values, got, strict=True)]


def test_tables_equal_themselves(spark):
    odd = spark.createDataFrame([(None, float("nan"), None), (None, 1e40, b"x"), (1, -0.0, None), (1, 1e-9, None)], "id int, x double, b binary")
    assert {r["status"] for r in reconcile.checksum(odd, odd, ["id", "x"], F.col("id")).collect()} == {"MATCH"}
    assert rows(reconcile.value_diff(odd, odd, ["id"], ["x"]), "column_name") == 2 * [(reconcile.REPEATED,)]
    with pytest.raises(ValueError):
        reconcile.checksum(odd, odd, ["id"], strict=True)
    frames = audit.audit(spark, {"odd": (odd, odd)})
    assert frames["inventory"].first()["status"] == "MATCH" and not audit.failed(frames) and frames["column_diff"].isEmpty()
    wide = audit.audit(spark, {"odd": (odd.withColumn("x", F.col("x").cast("decimal(30,9)")), odd)})["column_diff"]
    assert rows(wide, "column_name", "severity") == [("x", "WARNING")]


def test_strict_digests_are_in_utc(spark):
    df = spark.createDataFrame([(1, "2024-05-01 00:00:00")], "id int, t string").selectExpr("id", "to_timestamp(t || ' UTC', 'yyyy-MM-dd HH:mm:ss z') AS t")
    kept = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(canon.strict_digest(df, ["id", "t"], F.lit(0).alias("c")).first()["digest"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert len(seen) == 1


def test_the_last_needs_an_order(spark, target):
    change = spark.createDataFrame([(1, s) for s in range(2000)], "id int, seq int")
    with pytest.raises(ValueError):
        upserted(change.limit(0), change, ["id"], on_duplicate="last")
    assert rows(upserted(change.limit(0), change.repartition(7), ["id"], on_duplicate="last", order=[F.col("seq")])) == [(1, 1999)]
    with pytest.raises(load.LoadError):
        load.check(TableSpec("t", mode="upsert", keys=("id",), on_duplicate="last"))


def test_rows_that_cannot_be_cast(spark, target):
    source = spark.createDataFrame([("1", "a", "0.5"), ("x", "b", "1"), ("3", "c", "no")], "ID string, NAME string, X string")
    ledger = Ledger()
    r = load.run(spark, TableSpec("t", keys=("id",)), source, target, ledger, "r1")
    assert r.status == "FAILED" and "2 of 3 rows" in r.message and rows(target.read()) == [(99, "before", 1.5)]
    assert json.loads(ledger.rows("events", "status='rejected'")[0]["details"])["sample"][0]["value"] in ("x", "no")
    r = load.run(spark, TableSpec("t", keys=("id",), skip_failed=True), source, target, ledger, "r2")
    assert (r.status, r.rows_read, r.rows_written, r.rows_failed, r.verdict) == ("SUCCESS", 3, 1, 2, "PASS") and rows(target.read()) == [(1, "a", 0.5)]
    assert target.versions() == ["r2", "v0"]  # what failed or was staged is gone


def test_an_append_adds_a_folder(spark, target):
    row = lambda i: spark.createDataFrame([(i, "n")], "id int, name string")
    ledger = Ledger()
    for i in (1, 2):
        assert load.run(spark, TableSpec("t", mode="append"), row(i), target, ledger, f"r{i}").checksum_status == "MATCH"
    assert target.folders() == ["v0", "r1-delta", "r2-delta"] and rows(target.read(), "id") == [(1,), (2,), (99,)]
    assert target.rollback() == "r1" and rows(target.read(), "id") == [(1,), (99,)]
    target.stage(row(5), "other-delta")  # another load's
    assert target.retain(0) == ["r2-delta"] and "other-delta" in target.versions() and rows(target.read(), "id") == [(1,), (99,)]


def test_keyed_loads_are_checked(spark, target):
    source = spark.createDataFrame([(99, "new", 2.0), (99, "newer", 3.0), (None, "n", 1.0)], "id int, name string, x double")
    spec = TableSpec("t", keys=("id",), mode="upsert", on_duplicate="last", order_by=("x",))
    r = load.run(spark, spec, source, target, Ledger(), "r1")
    assert (r.status, r.rows_read, r.checksum_status) == ("SUCCESS", 3, "MATCH") and rows(target.read()) == [(99, "newer", 3.0), (None, "n", 1.0)]


def test_full_loads_of_matching_counts_are_skipped(spark, target):
    source = spark.createDataFrame([(1, "x", 1.0)], "id int, name string, x double")
    assert load.run(spark, TableSpec("t"), source, target, Ledger(), skip_matching=True).status == "SKIPPED" and target.current() == "v0"
    assert load.run(spark, TableSpec("t"), source.union(source), target, Ledger(), skip_matching=True).status == "SUCCESS"


def test_reverse_loads_clean_texts(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.stage(spark.createDataFrame([], "NAME string, N decimal(20,12)"), "v0")
    t.publish("v0")
    source = spark.createDataFrame([("", "1.50000000000000001"), (None, "-0")], "name string, n string")
    assert load.run_all(spark, [(TableSpec("t"), source, t)], Ledger(), "r", direction="reverse")[0].verdict == "PASS"
    assert [(n, str(float(v))) for n, v in rows(t.read())] == [(" ", "1.5"), (None, "0.0")]


def test_a_store_over_jdbc(spark, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/db;create=true", {"dbtable": "ORDERS", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("n"), "id").alias("NAME"))
    assert files.write(df, url, "overwrite", **options)["rows"] == 100
    part = files.read(spark, url, ["NAME"], "ID < 10", partitionColumn="ID", lowerBound=0, upperBound=100, numPartitions=4, **options)
    assert part.count() == 10 and part.columns == ["NAME"]
    more = spark.createDataFrame([("100", "x"), ("no", "y")], "id string, name string")
    r = load.write_out(spark, TableSpec("orders", mode="append", skip_failed=True), more, url, Ledger(), **options)
    assert (r.status, r.rows_read, r.rows_written, r.rows_failed) == ("SUCCESS", 2, 1, 1)
    assert load.write_out(spark, TableSpec("orders", mode="append"), more, url, Ledger(), **options).status == "FAILED"
    r = load.write_out(spark, TableSpec("orders"), more.where("id <> 'no'"), url, Ledger(), **options)
    assert (r.verdict, rows(files.read(spark, url, **options))) == ("PASS", [(100, "x")])


def test_keys_are_resolved(spark):
    c = lambda *data: spark.createDataFrame(list(data), "table_name string, constraint_name string, constraint_type string, column_name string, position int")
    one, two = c(("A", "u", "U", "X", 1), ("A", "p", "P", "K2", 2), ("A", "p", "P", "K1", 1)), c(("b", "u", "U", "Y", 1))
    assert objects.resolve_keys("a", ("z",), one, two) == (["z"], "settings")
    assert objects.resolve_keys("a", (), one, two) == (["k1", "k2"], "source constraint p")
    assert objects.resolve_keys("B", (), one, two) == (["y"], "target constraint u")
    with pytest.raises(objects.NoKeyError):
        objects.resolve_keys("c", (), one, two)


def test_dependencies_are_found(spark):
    pieces = spark.createDataFrame(
        [
            ("s", "app", "v1", "VIEW", "", 'select * from app."Orders" o join ORDER_LINES l', "VALID"),
            ("s", "app", "trg", "TRIGGER", "orders", "begin :new.id := app.ids.nextval; end;", "INVALID"),
            ("s", "app", "IDS", "SEQUENCE", "", None, "VALID"),
            ("s", "app", "SEQ_ORDER_LINES_ID", "SEQUENCE", "", None, "VALID"),
            ("s", "app", "reorders", "VIEW", "", "select * from my_orders", "VALID"),
        ],
        "source_db string, object_schema string, object_name string, object_type string, parent_name string, definition string, status string",
    )
    edges = objects.dependency_edges(pieces, spark.createDataFrame([("orders",), ("order_lines",)], "table_name string"))
    assert rows(edges, "table_name", "object_name", "dependency_kind") == [
        ("order_lines", "SEQ_ORDER_LINES_ID", "sequence name"),
        ("order_lines", "v1", "reference"),
        ("orders", "IDS", "sequence use"),
        ("orders", "trg", "parent"),
        ("orders", "v1", "reference"),
    ]
    assert rows(objects.health(edges).where("table_name = 'orders'"), "object_count", "broken_count") == [(3, 1)]


def test_objects_of_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS inv")
    spark.range(3).write.mode("overwrite").saveAsTable("inv.base")
    spark.sql("CREATE OR REPLACE VIEW inv.top AS SELECT id FROM inv.base WHERE id > 1")
    found = catalog.objects_of(spark, "inv")
    assert rows(found, "object_name", "object_type") == [("base", "TABLE"), ("top", "VIEW")]
    edges = objects.dependency_edges(found, spark.createDataFrame([("base",)], "table_name string"))
    assert rows(edges, "table_name", "object_name") == [("base", "top")]


def test_doctor(spark, tmp_path):
    there = spark.createDataFrame([(1, "a")], "id int, name string")
    frames = {("good", "source"): there, ("good", "target"): there, ("bad", "source"): there}
    ledger = Ledger()
    ledger.start_run("stuck")
    specs = [TableSpec("good", keys=("id",), mode="upsert"), TableSpec("bad", mode="upsert")]
    got = {r["check"]: r["status"] for r in doctor.examined(spark, specs, lambda n, s: frames[n, s], ledger).collect()}
    assert got == {"settings": "OK", "good: mode": "OK", "good: source": "OK", "good: target": "OK", "good: keys": "OK", "bad: mode": "FAIL", "bad: source": "OK", "bad: target": "FAIL", "ledger": "WARN"}


def test_histories(spark, target):
    ledger = Ledger()
    for i in range(3):
        load.run(spark, TableSpec("t", mode="append"), spark.createDataFrame([(i, "n")], "id int, name string"), target, ledger, f"r{i}")
    history = ledger.history(spark)
    assert rows(history, "source_run", "status", "rows_loaded") == [(f"r{i}", "SUCCESS", 1) for i in range(3)]
    recent, old = reports.compacted(history, 2)
    assert rows(recent, "source_run") == [("r1",), ("r2",)] and old.first()["runs"] == 1
    assert rows(reports.log_rollup(ledger.frame(spark, "events")), "run_id", "events", "failures") == [(f"r{i}", 2, 0) for i in range(3)]
    assert list(reports.named_sheets({"x": history, "events": history, "none": history.limit(0)})) == ["events", "x"]


def test_more_commands(spark, tiny, tmp_path):
    from concordat import cli

    t = VersionedTable(spark, str(tmp_path / "orders"))
    t.stage(spark.read.parquet(f"{tiny}/orders.parquet").limit(0), "v0")
    t.publish("v0")
    spark.createDataFrame([("orders", "pk", "P", "O_ORDERKEY", 1)], "table_name string, constraint_name string, constraint_type string, column_name string, position int").write.parquet(str(tmp_path / "constraints"))
    settings = {"tables": [{"name": "orders", "mode": "append", "keys": [], "chunk_size": 500, "source": f"{tiny}/orders.parquet", "target": str(tmp_path / "orders")}], "constraints": {"source": str(tmp_path / "constraints")}}
    (tmp_path / "c.json").write_text(json.dumps(settings))
    (tmp_path / "names").write_text("orders  # the only one\n")
    run = lambda *args: cli.main([*args, "--config", str(tmp_path / "c.json"), "--ledger", str(tmp_path / "l.db"), "--reports", str(tmp_path / "out")])
    assert run("checksum") == 1 and run("missing-keys", "--tables-file", str(tmp_path / "names")) == 1 and run("doctor") == 0
    assert run("sync", "--execute", "--run-id", "r1") == 0
    assert run("checksum", "--chunk-key", "o_orderkey", "--chunk-size", "300") == 0 and run("validate") == 0 and run("audit") == 0
    assert run("history") == 0 and run("report") == 0
    settings["tables"][0]["keys"] = ["o_orderkey"]
    (tmp_path / "c.json").write_text(json.dumps(settings))
    assert run("resume", "--execute", "--run-id", "r2") == 0
    assert t.read().count() == 2 * spark.read.parquet(f"{tiny}/orders.parquet").count()


def test_names_in_routines(spark):
    found = lambda t: spark.range(1).select(text.sequence_names(F.lit(t)), text.mentions_table(F.lit(t), "orders")).first()
    assert tuple(found('x := a."S$1" . nextval; nextval.b; b.c.nextval; B.C.NEXTVAL')) == (["S$1", "C"], False)
    assert tuple(found("")) == ([], False) and found('SELECT 1 FROM x."Orders"')[1] and not found("my_orders orders2 orders$")[1]


def test_repairs_go_on_while_they_help(spark):
    broken, need = {"a", "b", "c", "d"}, {"b": "a", "c": "b", "d": "gone"}

    def scan():
        return spark.createDataFrame([("s", n, "VIEW", "INVALID" if n in broken else "VALID") for n in "abcde"], "object_schema string, object_name string, object_type string, status string")

    def act(schema, name, kind):
        if need.get(name) in broken or need.get(name) == "gone":
            raise RuntimeError(f"{need[name]} is missing")
        broken.discard(name)

    got = rows(repairs.repaired(spark, scan, act), "object_name", "rounds", "outcome", "message")
    assert got == [("a", 1, "fixed", ""), ("b", 1, "fixed", ""), ("c", 1, "fixed", ""), ("d", 2, "failed", "gone is missing")]
    assert rows(repairs.repaired(spark, lambda: scan().where("object_name = 'e'"), act)) == []


def test_a_broken_view_is_found_and_mended(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS rep")
    spark.range(3).write.mode("overwrite").saveAsTable("rep.base")
    spark.sql("CREATE OR REPLACE VIEW rep.top AS SELECT id FROM rep.base")
    spark.sql("DROP TABLE rep.base")
    scan = lambda: catalog.objects_of(spark, "rep")
    assert rows(scan(), "object_name", "status") == [("top", "INVALID")]
    assert rows(repairs.repaired(spark, scan, repairs.refresh(spark)), "outcome") == [("failed",)]


def test_guards(spark, target):
    twice = target.read().union(target.read())
    target.stage(twice, "v1")
    target.publish("v1")
    row = spark.createDataFrame([(5, "x", 1.0)], "id int, name string, x double")
    with pytest.raises(load.LoadError, match="repeats a key"):
        load.run(spark, TableSpec("t", keys=("id",), mode="upsert"), row, target, Ledger(), require_unique_target=True)
    with pytest.raises(load.LoadError):
        load.check(TableSpec("t", skip_failed=True), require_whole=True)
