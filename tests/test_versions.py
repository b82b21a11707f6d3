"""Commits that meet, upserts that touch only what they must, ranges of equal depth."""

import datetime
import random
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concordat.model import Incremental, TableSpec
from concordat.operators import chunks
from concordat.plans import load
from concordat.sources.versions import ConflictError, VersionedTable
from concordat.streaming.ledger import Ledger
from tests.conftest import rows


def started(spark, path, df, run="v0"):
    t = VersionedTable(spark, str(path))
    t.stage(df, run)
    t.publish(run)
    return t


def test_four_appends_at_once_all_stand(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(3).select(F.col("id").cast("int"), F.lit("v").alias("name")))

    def one(i):
        rows_ = spark.range(100).select((F.col("id") + 1000 * (i + 1)).cast("int").alias("id"), F.lit(f"w{i}").alias("name"))
        return load.run(spark, TableSpec("t", mode="append"), rows_, VersionedTable(spark, t.path), Ledger(), f"r{i}")

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(one, range(4)))
    assert [r.status for r in results] == ["SUCCESS"] * 4
    assert t.read().count() == 403 and t.state()["commit"] >= 5


def test_two_upserts_of_a_file_at_once_both_stand(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(200).select("id", F.lit("old").alias("name")).coalesce(1))
    spec = TableSpec("t", keys=("id",), mode="upsert")

    def one(i):
        changes = spark.range(50 * i, 50 * i + 60).select("id", F.lit(f"new{i}").alias("name"))
        return load.run(spark, spec, changes, VersionedTable(spark, t.path), Ledger(), f"r{i}")

    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(one, range(3)))
    assert [r.status for r in results] == ["SUCCESS"] * 3
    now = dict(rows(t.read(), "id", "name"))
    assert len(now) == 200 and all(now[i].startswith("new") for i in range(160)) and all(now[i] == "old" for i in range(160, 200))


def test_a_rewrite_of_what_is_gone_is_refused(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(5).toDF("id"))
    base = t.current()
    t.stage(spark.range(5, 6).toDF("id"), "a")
    t.append("a", ["a"])
    t.stage(spark.range(1).toDF("id"), "b")
    with pytest.raises(ConflictError):
        t.rewrite("b", base, t.files(base))
    assert t.current() == "a" and t.read().count() == 6


def test_a_number_is_given_once(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(1).toDF("id"))
    state = t.state()
    assert t._create({**state, "commit": state["commit"] + 1}) and not t._create({**state, "commit": state["commit"] + 1})
    for i in range(70):
        t.commit(lambda s, i=i: {"applied": {"x": i}})
    assert t.state()["applied"] == {"x": 69} and len(t._names("_log")) <= 60


def test_untouched_files_are_the_same_files(spark, tmp_path):
    keys = ["a", "b"]
    df = spark.range(4000).select((F.col("id") / 40).cast("int").alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") % 40).cast("string"), 2, "0")).alias("b"), F.lit(0).alias("x"))
    t = started(spark, tmp_path / "t", df.repartitionByRange(10, *keys))
    before = t.files()
    changes = spark.createDataFrame([(3, "k07", 1), (3, "k99", 1), (98, "k00", 1), (None, "k00", 9), (500, "z", 1)], "a int, b string, x int")
    r = load.run(spark, TableSpec("t", keys=("a", "b"), mode="upsert"), changes, t, Ledger(), "r1")
    assert r.status == "SUCCESS" and r.files_rewritten == 2
    assert len(set(before) & set(t.files())) == 8
    got = t.read()
    assert got.count() == 4003 and rows(got.where("x > 0")) == sorted([(3, "k07", 1), (3, "k99", 1), (98, "k00", 1), (500, "z", 1), (None, "k00", 9)], key=lambda r: [(v is None, "" if v is None else v) for v in r])
    # only the candidates are read: their key ranges meet the changes'
    assert len(t.candidates(spark.createDataFrame([(3, "k07")], "a int, b string"), keys)) == 1
    assert t.touched(spark.createDataFrame([(3, "k07x")], "a int, b string"), keys) == []
    load.run(spark, TableSpec("t", keys=("a", "b"), mode="delete_insert"), spark.createDataFrame([(3, "k07", 5), (3, "k07", 6)], "a int, b string, x int"), t, Ledger(), "r2")
    assert rows(t.read().where("a = 3 AND b = 'k07'"), "x") == [(5,), (6,)] and t.read().count() == 4004
    assert t.rollback() == "r1" and t.read().count() == 4003
    assert t.rollback("v0") == "v0" and t.read().count() == 4000 and t.read().where("x > 0").count() == 0


def test_retention_drops_files_that_nobody_reads(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(100).select("id", F.lit("old").alias("name")).repartitionByRange(4, "id"))
    n = len(t._names("v=v0"))
    for i in range(5):
        load.run(spark, TableSpec("t", keys=("id",), mode="upsert"), spark.range(1).select("id", F.lit(f"n{i}").alias("name")), t, Ledger(), f"r{i}")
    assert dict(rows(t.read(), "id", "name"))[0] == "n4" and t.read().count() == 100
    assert len([x for x in t._names("v=v0") if x.endswith(".parquet")]) == 3 and n >= 4 and "r0" not in t.versions()


def test_every_file_touched_and_all_rows_gone(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.range(3).select("id", F.lit(None).cast("string").alias("name")))
    t.stage(t.read().limit(0), "none")
    t.rewrite("none", "v0", t.files())
    assert t.read().count() == 0 and t.read().columns == ["id", "name"]


def ranged(spark, values, kind, parts=8):
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    out = chunks.equal_depth(df, ["k"], parts).orderBy("chunk_id").collect()
    assert sum(r["rows"] for r in out) == len(values)
    live = [r for r in out if r["chunk_id"] >= 0]
    assert all(a["last_key"] < b["first_key"] for a, b in zip(live, live[1:], strict=False))
    return {r["chunk_id"]: r["rows"] for r in out}


def test_ranges_of_any_key(spark):
    rng = random.Random(3)
    n = 4000
    for kind, values in {
        "string": [f"{rng.random():.9f}" for _ in range(n)],
        "date": [datetime.date(1970, 1, 1) + datetime.timedelta(days=rng.randint(0, 20000)) for _ in range(n)],
        "decimal(20,6)": [Decimal(rng.randint(0, 10**12)) / 10**6 for _ in range(n)],
        "double": [rng.gauss(0, 1) for _ in range(n)],
        "timestamp": [datetime.datetime(2000, 1, 1) + datetime.timedelta(seconds=rng.randint(0, 10**8)) for _ in range(n)],
    }.items():
        got = ranged(spark, [*values, None, None], kind)
        assert got[chunks.NULLS] == 2 and max(v for k, v in got.items() if k >= 0) <= 1.5 * n / 8, kind


def test_a_hot_key_is_a_range_of_its_own_and_nothing_is_lost(spark):
    got = ranged(spark, ["m"] * 900 + [f"z{i}" for i in range(300)], "string")
    assert max(got.values()) >= 900
    assert ranged(spark, [None] * 5, "int") == {chunks.NULLS: 5} and ranged(spark, [], "int") == {} and ranged(spark, [1], "int") == {0: 1}


def test_append_of_null_fraction_and_text_keys_resumes(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.createDataFrame([], "k double, s string"))
    source = spark.createDataFrame([(0.0, "a"), (1.5, "b"), (3.7, "c"), (None, "d"), (3.7, None), (float("inf"), "e"), (float("nan"), "f")], "k double, s string")
    assert load.append_chunks(spark, TableSpec("t", mode="append", chunk_size=2), source, t, Ledger(), "r1", "k") == 7
    assert len(rows(t.read())) == 7
    ledger, wide = Ledger(), spark.range(500).select((F.col("id") / 7).alias("k"), F.concat(F.lit('x"#'), F.col("id").cast("string")).alias("s"))
    first, stage, seen = load.WAVE, t.stage, []
    load.WAVE = 3
    try:
        t.stage = lambda df, run: (_ for _ in ()).throw(OSError("lost")) if seen.append(run) or len(seen) == 2 else stage(df, run)
        with pytest.raises(OSError):
            load.append_chunks(spark, TableSpec("t", mode="append", chunk_size=60), wide, t, ledger, "r2", ["s", "k"])
        assert t.read().count() == 7
        t.stage = lambda df, run: seen.append(run) or stage(df, run)
        assert load.append_chunks(spark, TableSpec("t", mode="append", chunk_size=60), wide, t, ledger, "r2", ["s", "k"]) == 507
        assert seen.count("r2-part000000") == 1 and seen.count("r2-part000003") == 2
    finally:
        load.WAVE = first
    assert t.read().where("s LIKE 'x%'").distinct().count() == 500


def test_a_watermark_that_the_target_lacks(spark, tmp_path):
    t = started(spark, tmp_path / "t", spark.createDataFrame([(1, "a")], "id int, name string"))
    source = spark.createDataFrame([(1, "b", 5), (2, "c", 9), (3, "d", None)], "id int, name string, seq int")
    r = load.run(spark, TableSpec("t", keys=("id",), mode="upsert", incremental=Incremental("seq", "numeric_key")), source, t, Ledger(), "r1")
    assert (r.status, r.watermark) == ("SUCCESS", "9") and r.bytes_written > 0 and r.rows_per_second > 0
    assert t.read().columns == ["id", "name"]


def test_writes_to_a_catalog_table_move_a_watermark(spark):
    spark.sql("CREATE TABLE marks (id INT, name STRING) USING parquet")
    try:
        ledger, spec = Ledger(), TableSpec("marks", mode="append", incremental=Incremental("id", "numeric_key"))
        source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
        first = load.write_out(spark, spec, source, "marks", ledger)
        assert (first.status, first.watermark, first.rows_written) == ("SUCCESS", "2", 2)
        ledger.set_watermark("reverse", "marks", "numeric_key", "id", first.watermark)
        again = load.write_out(spark, spec, source.union(spark.createDataFrame([(3, "c")], source.schema)), "marks", ledger)
        assert (again.rows_written, spark.table("marks").count()) == (1, 3)
    finally:
        spark.sql("DROP TABLE marks")
