from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from concordat.sources import table_source
from concordat.sources.versions import VersionedTable
from tests.conftest import rows


def table_of(spark, path, df, parts, *keys):
    t = VersionedTable(spark, str(path))
    t.stage(df.repartitionByRange(parts, *keys), "v0")
    t.publish("v0")
    return t


@pytest.fixture(scope="module")
def source(spark):
    table_source.register(spark)
    return lambda **o: spark.read.format("concordat").options(**o)


def reader(t, *filters, columns=""):
    source = table_source.TableSource({"path": t.path, "columns": columns, "bundle_bytes": "1"})
    out = source.reader(source.schema())
    assert list(out.pushFilters(list(filters))) == list(filters)
    return out


def test_bounds_answer_filters():
    a = ("a",)
    for f, want in [(EqualTo(a, 5), True), (EqualTo(a, 11), False), (EqualNullSafe(a, 1), False), (In(a, (1, 7)), True), (In(a, (1, 70)), False), (GreaterThan(a, 10), False), (GreaterThanOrEqual(a, 10), True), (LessThan(a, 2), False), (LessThanOrEqual(a, 2), True), (EqualTo(a, "x"), True), (EqualTo(a, 11.0), True), (EqualNullSafe(a, None), True)]:
        assert table_source.may_hold(f, 2, 10) is want, f
    assert not table_source.may_hold(EqualTo(a, "b"), "c", "d") and not table_source.may_hold(LessThan(a, date(2020, 1, 1)), date(2020, 1, 1), date(2021, 1, 1))
    assert table_source.may_hold(GreaterThan(a, 1.0), float("nan"), float("nan"))


def test_filters_leave_out_files_and_row_groups(spark, tmp_path, source):
    df = spark.range(1000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("s"))
    t = table_of(spark, tmp_path / "t", df, 8, F.col("k"))
    everything = len(reader(t).chosen())
    assert len(reader(t, EqualTo(("k",), 555)).chosen()) == everything  # nothing is kept yet: row groups are left out in the task
    r = reader(t, EqualTo(("k",), 555))
    assert sum(1 for p in r.partitions() for _ in r.read(p)) == 1
    assert t.index(["k"]) == everything
    assert len(reader(t, EqualTo(("k",), 555)).chosen()) <= 2  # its file, and the one with nulls
    assert len(reader(t, EqualTo(("s",), "555")).chosen()) == everything
    for cond in ("k = 555", "k IN (3, 998)", "k > 900 AND k <= 905", "k IS NULL", "k <=> NULL", "s = '555'", "k < 0", "NOT k > 5", "k = 555 OR s = '7'"):
        assert rows(source().load(t.path).where(cond)) == rows(t.read().where(cond)), cond
    largest = max(size for _, size in reader(t).chosen())
    assert source(bundle_bytes=largest).load(t.path).where("k = 555").rdd.getNumPartitions() <= 2 < source(bundle_bytes=largest).load(t.path).rdd.getNumPartitions()
    assert rows(source(bundle_bytes=largest // 3).load(t.path)) == rows(t.read())  # several tasks a file
    assert source(columns="s").load(t.path).columns == ["s"] and source().load(t.path).count() == 1000


def test_versions_times_and_what_upserts_rewrite(spark, tmp_path, source):
    t = table_of(spark, tmp_path / "t", spark.range(100).select("id", F.lit("old").alias("v")), 4, F.col("id"))
    then = t.state()["at"]
    changes = spark.createDataFrame([(3, "new"), (200, "new")], "id long, v string")
    hit = t.touched(changes, ["id"])
    t.stage(t.read_files(hit, t.read()).where("id <> 3").unionByName(changes), "v1")
    t.rewrite("v1", "v0", hit)
    assert rows(source().load(t.path)) == rows(t.read()) and source().load(t.path).count() == 101
    assert source(version="v0").load(t.path).where("v = 'new'").isEmpty() and source(as_of=repr(then)).load(t.path).count() == 100
    for bad in ({"version": "none"}, {"as_of": "1999-01-01"}, {"version": "v0", "as_of": "2999-01-01"}):
        with pytest.raises(Exception, match="not kept|nothing is known|not both"):
            source(**bad).load(t.path).count()
    assert source(as_of="2999-01-01T00:00:00").load(t.path).count() == 101


def test_types_nulls_empty_tables_and_odd_names(spark, tmp_path, source):
    df = spark.sql("SELECT timestamp'2020-02-03 04:05:06.123456' AS t, timestamp_ntz'2020-01-01 00:00:00' AS n, date'2021-01-01' AS d, 1.25BD AS x, array(1, null) AS a, named_struct('b', 'c') AS s, map('k', 1) AS m, binary('z') AS z, CAST('NaN' AS DOUBLE) AS f, 1 AS `a-b`")
    t = table_of(spark, tmp_path / "t", df.unionByName(df.select(*(F.lit(None).cast(d).alias(c) for c, d in df.dtypes))), 1, F.col("d"))
    t.index(["a-b"])
    got = source().load(t.path)
    assert got.dtypes == t.read().dtypes and sorted(map(str, got.collect())) == sorted(map(str, t.read().collect()))
    assert got.where("`a-b` = 1").count() == 1 and got.where(F.col("x") == Decimal("1.25")).count() == 1 and got.where("f > 3").count() == 1
    empty = table_of(spark, tmp_path / "e", df.limit(0), 1, F.col("d"))
    assert source().load(empty.path).isEmpty() and source().load(empty.path).columns == df.columns
    with pytest.raises(Exception, match="is no table"):
        source().load(str(tmp_path / "none")).count()
