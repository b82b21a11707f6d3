import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordat.functions import text
from concordat.functions.canon import table_digest
from concordat.operators import incremental, reconcile
from concordat.plans import audit, queryperf, reports
from concordat.sources import catalog, config, files
from concordat.streaming.ledger import Ledger
from tests.conftest import rows


def keys(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


def test_key_diff(spark):
    s = reconcile.key_diff_summary(keys(spark, [1, 2, 3, 4, 5]), keys(spark, [1, 2, 3, 4, 6]), ["id"], 1).first()
    assert (s.source_only, s.target_only, s.sample_truncated, s.status) == (1, 1, False, "MISMATCH")
    s = reconcile.key_diff_summary(keys(spark, [1, 2, 3]), keys(spark, []), ["id"], 2).first()
    assert (s.source_only, s.source_sample, s.sample_truncated) == (3, 2, True)
    assert rows(reconcile.keys_only(keys(spark, [9, 10]), keys(spark, [10]), ["id"], "source")) == [(9,)]


def test_null_is_not_the_empty_text(spark):
    s = reconcile.key_diff_summary(keys(spark, [None, ""], "string"), keys(spark, ["", ""], "string"), ["id"]).first()
    assert (s.source_only, s.target_only) == (1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.integers(0, 5), max_size=12), b=st.lists(st.integers(0, 5), max_size=12))
def test_key_diff_is_a_multiset_difference(spark, a, b):
    from collections import Counter

    got = reconcile.key_balance(keys(spark, a), keys(spark, b), ["id"]).collect()
    want = Counter(a)
    want.subtract(b)
    assert {r["id"]: r["balance"] for r in got} == {k: v for k, v in want.items() if v}


def test_digests(spark):
    make = lambda data, kind="int": spark.createDataFrame(data, f"id int, name string, x {kind}")
    a = make([(1, "Alice", None), (2, "Bob", 10)])
    same = lambda x, y: reconcile.checksum(x, y, x.columns).first()["status"]
    assert same(a, make([(2, "Bob", 10), (1, "Alice", None)])) == "MATCH"
    assert same(a, make([(2, "Bob", 10), (1, "Alicia", None)])) == "MISMATCH"
    assert same(a.withColumn("x", F.col("x").cast("decimal(10,1)")), a.withColumn("x", F.col("x").cast("decimal(10,2)"))) == "MATCH"
    assert same(a, a.union(a.limit(1))) == "MISMATCH"
    assert same(a.limit(0), a.limit(0)) == "MATCH"
    assert table_digest(a.repartition(5), a.columns).first() == table_digest(a.coalesce(1), a.columns).first()
    assert reconcile.checksum_columns(spark.createDataFrame([(1, b"x", "n")], "id int, blob binary, note string"), exclude=("note",)) == ["id"]


def test_value_diff_tells_null_from_a_value(spark):
    a, b = (spark.createDataFrame([(1, v)], "id int, v string") for v in (None, "x"))
    assert rows(reconcile.value_diff(a, b, ["id"], ["v"])) == [(1, "v", "\\N", "x")]
    assert rows(reconcile.value_diff(a, a, ["id"], ["v"])) == []


def test_samples_meet(spark):
    d = spark.range(5000)
    s = reconcile.sample_rows(d, ["id"], 10)
    assert 350 < s.count() < 650 and reconcile.sample_rows(d.where("id < 2500"), ["id"], 10).exceptAll(s).isEmpty()


def test_watermark_columns():
    assert incremental.parse_column("coalesce(a, B)") == ["a", "b"]
    for wrong in ("updated_at + interval '1 day'", "", "coalesce(a)", "a;b"):
        with pytest.raises(ValueError):
            incremental.parse_column(wrong)
    with pytest.raises(ValueError):
        incremental.parse_column("gone", ["here"])
    with pytest.raises(NotImplementedError):
        incremental.newer("a", "scn", "1")


def test_ledger(spark):
    ledger = Ledger()
    ledger.add_chunk("r", "t", "id:1:10")
    ledger.add_chunk("r", "t", "id:11:20")
    assert ledger.claim("r", "t", "id:1:10") and not ledger.claim("r", "t", "id:1:10")
    ledger.finish("r", "t", "id:1:10", "success", 10)
    ledger.claim("r", "t", "id:11:20")
    ledger.finish("r", "t", "id:11:20", "failed")
    assert ledger.successful("r", "t") == {"id:1:10"} and ledger.claim("r", "t", "id:11:20")
    ledger.set_watermark("forward", "t", "updated_at", "ts", "2026-01-01")
    ledger.set_watermark("forward", "t", "updated_at", "ts", "2026-01-02")
    assert ledger.watermark("forward", "t", "updated_at", "ts") == "2026-01-02" and ledger.reset_watermark("t") == 1
    for _ in range(3):
        ledger.failed("job", 30)
    assert ledger.blocked("job") and not ledger.blocked("job", 4) and not ledger.blocked("other")
    ledger.cleared("job")
    assert not ledger.blocked("job") and not ledger.add_rollback("r", "t", "append", "x", None)
    assert ledger.frame(spark, "chunks").count() == 2
    ledger.start_run("r")
    ledger.event("r", "load", "started", "t")
    assert [e["phase"] for e in ledger.events("r")] == ["load"]
    ledger.reset_run("r")
    assert ledger.rows("chunks") == []


def test_names_sizes_and_secrets():
    assert text.split_name('"App".Orders') == ("app", "orders") and text.split_name("t") == ("public", "t")
    with pytest.raises(ValueError):
        text.split_name("a.b.c")
    assert text.parse_size("20GiB") == 20 << 30 and text.parse_size("1.5 kb") == 1500 and text.format_size(3 << 30) == "3.0 GiB"
    assert len(text.bounded_name("stg", "t" * 80, "run1").encode()) <= 63 and text.bounded_name("a" * 90, "b").endswith("__b")
    assert text.masked({"key_columns": ["id"], "password": "x", "db": {"url": "jdbc://u:p@h/d"}}) == {"key_columns": ["id"], "password": "***", "db": {"url": "jdbc://u:***@h/d"}}


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("A", "1")
    assert config.expanded({"x": ["${A}", "${B:-two}"]}, {"A": "1"}) == {"x": ["1", "two"]}
    with pytest.raises(KeyError):
        config.expanded("${NOT_SET}", {})
    (tmp_path / "e").write_text("# no\nexport B='q'\n")
    assert config.environment(str(tmp_path / "e")) == {"B": "q"}
    specs = config.table_specs({"schema": "app", "tables": ["Orders", {"name": "x.part", "keys": ["id"], "mode": "upsert"}]})
    assert [s.name for s in config.chosen(specs, ["ORDERS", "part"])] == ["app.orders", "x.part"]
    with pytest.raises(KeyError):
        config.chosen(specs, ["none"])
    with pytest.raises(ValueError):
        config.table_specs({"tables": [{"name": "a", "delete_detection": True}]})


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("connection timed out")
        return "ok"

    assert files.with_retry(flaky, delay=0) == "ok" and len(calls) == 3
    with pytest.raises(OSError):
        files.with_retry(lambda: (_ for _ in ()).throw(OSError("no such user")), delay=0)


def test_csv_round_trip_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", {"k": 1}, ["x", "y"], False)], "id int, t string, m map<string,int>, l array<string>, ok boolean")
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), "id int, t string, m string, l string, ok boolean")
    assert rows(back) == [(1, "a,b", "k:1", "x;y", False)]
    seen_df, seen = files.counted(df.select("id", "t"), "n", ["t"])
    seen_df.write.parquet(str(tmp_path / "p"))
    assert seen.get == {"rows": 1, "bytes": 4, "long_bytes": 3}
    assert catalog.footer_count(spark, str(tmp_path / "p")).first()["rows"] == 1 and catalog.size_bytes(spark, str(tmp_path / "p")) > 0


def test_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cat")
    spark.range(3).write.mode("overwrite").saveAsTable("cat.some_table")
    assert catalog.exists(spark, "cat.some_table") and catalog.resolve(spark, "cat", "SOME_TABLE") == "some_table" and catalog.resolve(spark, "cat", "none") is None
    assert rows(catalog.list_tables(spark, "cat", "some*")) == [("some_table",)]
    assert catalog.statistics_count(spark, "cat.some_table", refresh=True) == 3


def test_audit(spark, tiny):
    o, c = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("orders", "customer"))
    frames = audit.audit(spark, {"orders": (o, o), "customer": (c, c.drop("c_name"))})
    status = dict(rows(frames["inventory"], "table_name", "status"))
    assert status["customer"] == "MISMATCH" and audit.failed(frames)
    assert audit.missing_keys({"orders": (o, o)}, {"orders": ["o_orderkey"]}).first()["status"] == "MATCH"


def test_query_variants(spark):
    v = queryperf.variants("SELECT a FROM t WHERE a NOT IN (SELECT b FROM u WHERE c = 1);")
    assert v["not_exists"] == "SELECT a FROM t WHERE NOT EXISTS (SELECT 1 FROM u x WHERE x.b = a AND (c = 1))"
    for wrong in ("DELETE FROM t", "SELECT 1; SELECT 2"):
        with pytest.raises(ValueError):
            queryperf.one_query(wrong)
    spark.range(5).createOrReplaceTempView("five")
    r = queryperf.measured(spark, "SELECT id FROM five WHERE id > 1 ORDER BY id").first()
    assert (r.status, r.row_count) == ("OK", 3)
    assert queryperf.measured(spark, "SELECT nope FROM five").first().status == "ERROR"


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", "MATCH"), ("b", "MISMATCH")], "table_name string, status string")
    out = reports.manifest("r", {"password": "x"}, {"rowcount": df}, str(tmp_path / "m.json"))
    assert out["reports"]["rowcount"] == {"MATCH": 1, "MISMATCH": 1} and "***" in (tmp_path / "m.json").read_text()
    reports.html_page("Run <1>", {"rowcount": df, "none": df.limit(0)}, str(tmp_path / "r.html"))
    page = (tmp_path / "r.html").read_text()
    assert "Run &lt;1&gt;" in page and "none" not in page
    sent = []
    assert reports.alert("failed", {"token": "t"}, {"failed"}, lambda e, p: sent.append(p)) and sent == [{"token": "***"}]


def test_commands(spark, tiny, tmp_path):
    import json

    from concordat import cli
    from concordat.sources.versions import VersionedTable

    t = VersionedTable(spark, str(tmp_path / "orders"))
    t.stage(spark.read.parquet(f"{tiny}/orders.parquet").where("o_orderkey < 5"), "v0")
    t.publish("v0")
    (tmp_path / "c.json").write_text(json.dumps({"tables": [{"name": "orders", "keys": ["o_orderkey"], "mode": "upsert", "source": f"{tiny}/orders.parquet", "target": str(tmp_path / "orders")}]}))
    run = lambda *args: cli.main([*args, "--config", str(tmp_path / "c.json"), "--ledger", str(tmp_path / "l.db"), "--reports", str(tmp_path / "out")])
    assert run("missing-keys") == 1
    assert run("sync") == 0 and t.current() == "v0"
    assert run("sync", "--execute", "--run-id", "r1") == 0 and t.current() == "r1"
    assert run("missing-keys") == 0 and run("validate") == 0 and run("simulate") == 0
    assert run("rollback", "--run-id", "r1") == 0 and t.current() == "v0"
