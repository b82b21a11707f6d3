import pytest
from pyspark.sql import functions as F

from concordat.model import Incremental, TableSpec
from concordat.operators.mapping import LongColumnError, Pair, column_map, strategy_of, with_long_policy
from concordat.operators.upsert import DuplicateKeyError, merged, upserted
from concordat.plans import load
from concordat.sources.versions import VersionedTable
from concordat.streaming.ledger import Ledger
from tests.conftest import rows


@pytest.fixture
def target(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.stage(spark.createDataFrame([(99, "before")], "id int, name string"), "v0")
    t.publish("v0")
    return t


def people(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ID int, NAME string")


def test_truncate_then_roll_back_then_swap(spark, target):
    ledger = Ledger()
    r = load.run(spark, TableSpec("t", mode="truncate_safe"), people(spark, (1, "Alice"), (2, "Bob")), target, ledger, "r1")
    assert (r.status, r.rows_written, r.backup) == ("SUCCESS", 2, "v0")
    assert rows(target.read()) == [(1, "Alice"), (2, "Bob")]
    assert [a["status"] for a in load.roll_back(spark, ledger, "r1")] == ["SUCCESS"]
    assert rows(target.read()) == [(99, "before")]
    with pytest.raises(load.LoadError):
        load.run(spark, TableSpec("t", mode="swap_safe"), people(spark, (10, "Swap")), target, ledger, "r2")
    load.run(spark, TableSpec("t", mode="swap_safe"), people(spark, (10, "Swap"), (11, "Safe")), target, ledger, "r3", allow_swap=True)
    assert rows(target.read()) == [(10, "Swap"), (11, "Safe")]


def test_dry_run_writes_nothing(spark, target):
    r = load.run(spark, TableSpec("t"), people(spark, (1, "a")), target, Ledger(), execute=False)
    assert r.status == "DRY_RUN" and r.rows_read == 1 and target.versions() == ["v0"]


def test_upsert_twice_with_a_watermark(spark, target):
    ledger, spec = Ledger(), TableSpec("t", keys=("id",), mode="upsert", incremental=Incremental("id", "numeric_key"))
    first = load.run_all(spark, [(spec, people(spark, (1, "a"), (99, "new")), target)], ledger, "r1")
    assert first[0].status == "SUCCESS" and rows(target.read()) == [(1, "a"), (99, "new")]
    assert ledger.watermark("forward", "t", "numeric_key", "id") == "99"
    again = load.run_all(spark, [(spec, people(spark, (1, "changed"), (100, "more")), target)], ledger, "r2")
    assert again[0].rows_read == 1
    assert rows(target.read()) == [(1, "a"), (99, "new"), (100, "more")]


def test_a_failed_table_keeps_all_watermarks(spark, target, tmp_path):
    ledger, spec = Ledger(), TableSpec("t", keys=("id",), mode="upsert", incremental=Incremental("id", "numeric_key"))
    bad = TableSpec("u", keys=("id",), mode="upsert")
    results = load.run_all(spark, [(spec, people(spark, (1, "a")), target), (bad, people(spark, (5, "x"), (5, "y")), target)], ledger, "r1", workers=1)
    assert [r.status for r in results] == ["SUCCESS", "FAILED"]
    assert ledger.watermark("forward", "t", "numeric_key", "id") is None


@pytest.mark.parametrize("spec", [TableSpec("t", mode="truncate", where="id > 1"), TableSpec("t", mode="swap_safe", incremental=Incremental("id")), TableSpec("t", mode="upsert"), TableSpec("t", mode="merge")])
def test_refused(spec):
    with pytest.raises(load.LoadError):
        load.check(spec, allow_swap=True)


def test_append_resumes_by_key_range(spark, target):
    ledger, spec = Ledger(), TableSpec("t", mode="append", chunk_size=10)
    source = spark.range(1, 36).select(F.col("id").cast("int").alias("ID"), F.lit("n").alias("NAME"))
    ledger.add_chunk("r1", "t", "id:1:10", 1, 10)
    ledger.claim("r1", "t", "id:1:10")  # held by a run that died
    assert load.append_chunks(spark, spec, source, target, ledger, "r1", "id") == 36
    assert target.read().count() == 36 and len(ledger.successful("r1", "t")) == 4


def test_retention_spares_the_current_version(spark, target):
    for i in range(1, 7):
        target.stage(target.read(), f"v{i}")
        target.publish(f"v{i}")
    assert target.retain(2) == ["v0", "v1", "v2", "v3"]
    assert target.rollback() == "v5" and target.current() == "v5"


def test_upsert_edges(spark):
    t = spark.createDataFrame([(1, "a", 1), (None, "n", 2)], "id int, name string, kept int")
    s = spark.createDataFrame([(1, None), (None, "m"), (2, "b")], "id int, name string")
    assert set(rows(merged(t, s, ["id"]))) == {(1, None, 1), (None, "n", 2), (None, "m", None), (2, "b", None)}
    assert set(rows(merged(t, s, ["id"], insert_only=True))) == {(1, "a", 1), (None, "n", 2), (None, "m", None), (2, "b", None)}
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id int, name string")
    with pytest.raises(DuplicateKeyError):
        upserted(t, twice, ["id"])
    assert (1, "y", 1) in rows(upserted(t, twice, ["id"], on_duplicate="last", order=[F.col("name")]))


def test_long_columns_need_a_strategy(spark):
    d = spark.createDataFrame([(1, b"x")], "id int, payload binary")
    pairs = column_map(d, d)
    with pytest.raises(LongColumnError):
        with_long_policy(pairs, "app.t", {"payload"}, {})
    assert with_long_policy(pairs, "app.t", {"payload"}, {"T.PAYLOAD": "skip"}) == [Pair("id", "id", "int")]
    assert with_long_policy(pairs, "app.t", {"payload"}, {}, "null")[1].source is None
    assert strategy_of("app.t", "payload", {"payload": "stream", "app.t.payload": "skip"}) == "skip"


def test_verdicts():
    assert load.verdict(3, 3, 0, "", True) == "PASS"
    assert load.verdict(3, 3, 0, "", False) == "WARN"
    assert load.verdict(3, 3, 0, "", False, reverse=True) == "FAIL"
    assert load.verdict(3, 3, 0, "", None) == "UNKNOWN"
    assert load.verdict(3, 3, 0, "", None, reverse=True, keyed_increment=True) == "PASS"
    assert load.verdict(3, 2, 0, "", True) == load.verdict(3, 3, 1, "", True) == load.verdict(3, 3, 0, "MISMATCH", True) == "FAIL"


def test_stream_of_files(spark, tmp_path, target):
    from concordat.streaming.upsert_stream import upsert_available

    folder = str(tmp_path / "in")
    schema = target.read().schema
    spark.createDataFrame([(1, "a"), (99, "b")], schema).write.parquet(folder)
    run = lambda: upsert_available(spark, folder, schema, target, ["id"], [F.col("name")], str(tmp_path / "cp"))
    assert run() == 1 and rows(target.read()) == [(1, "a"), (99, "b")]
    assert run() == 0


def test_all_events_enter_the_stream(spark, tiny, monkeypatch):
    from concordat.plans import queries

    sizes, read = [], VersionedTable.read
    monkeypatch.setattr(VersionedTable, "read", lambda self, **at: (df := read(self, **at), sizes.append(df.count() if df is not None else 0))[0])
    got = queries.QUERIES["stream_upsert_available_now"](spark, tiny)
    assert sizes[-1] == queries.table(spark, tiny, "events").count()
    events = queries.table(spark, tiny, "events").withColumn("value", F.col("value").cast("decimal(18,6)"))
    columns = ["event_id", "user_id", "event_type", "value"]
    assert rows(got, *columns) == rows(events, *columns)


@pytest.mark.parametrize("mode", ["append", "upsert", "truncate"])
def test_rejected_rows_are_written_by_the_job_that_stages_the_others(spark, tmp_path, mode):
    source = spark.createDataFrame([("1", "x", "7"), ("2", "5", "bad"), ("3", "4", "6"), (None, "none", "no")], "id string, a string, b string").repartition(2)
    table = VersionedTable(spark, str(tmp_path / mode))
    table.stage(spark.createDataFrame([(3, 1, 1)], "id long, a int, b int"), "v0")
    table.publish("v0")
    reads = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda v: (reads.add(1), v)[1]).asNondeterministic()
    spec = TableSpec("t", keys=("id",), mode=mode, skip_failed=True)
    r = load.run(spark, spec, source.withColumn("b", seen("b")), table, Ledger(), "r1", validate=False)
    assert (r.status, r.rows_read, r.rows_failed) == ("SUCCESS", 4, 3) and reads.value == 4
    left = table.rejects()
    assert rows(left.select("key_values", F.explode("failures").alias("f")), "key_values", "f.column_name", "f.value", "f.target_type") == [("", "a", "none", "int"), ("", "b", "no", "int"), ("1", "a", "x", "int"), ("2", "b", "bad", "int")]
    assert left.select("chunk", "row").distinct().count() == 3 and left.where("source_row IS NULL").isEmpty()
    kept = {"append": [(3, 1, 1), (3, 4, 6)], "upsert": [(3, 4, 6)], "truncate": [(3, 4, 6)]}[mode]
    assert table.read().columns == ["id", "a", "b"] and rows(table.read()) == kept
    assert r.rejects == table.rejects_path("r1") and not [n for n in table._names("") if n.startswith("_parting")]


def test_rejects_go_with_their_version_and_with_a_load_that_fails(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.stage(spark.createDataFrame([(3,)], "id long"), "v0")
    table.publish("v0")
    bad = spark.createDataFrame([("x",)], "id string")
    ledger = Ledger()
    refused = load.run(spark, TableSpec("t", mode="append"), bad, table, ledger, "r0")
    assert refused.status == "FAILED" and "id = 'x'" in refused.message and table._names("_rejects") == []
    for i in range(6):
        assert load.run(spark, TableSpec("t", mode="append", skip_failed=True), bad, table, ledger, f"r{i + 1}").status == "SUCCESS"
    assert sorted(table._names("_rejects")) == ["v=r3", "v=r4", "v=r5", "v=r6"] and rows(table.read()) == [(3,)]
    assert rows(table.rejects("r4"), "source_row") == [('{"id":"x"}',)]
