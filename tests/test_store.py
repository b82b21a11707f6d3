"""Loads into an embedded store: exact when tasks run again, when a run is asked for twice, and in every mode."""

import os
import subprocess
import sys

import pytest

from concordat.model import Incremental, TableSpec
from concordat.plans import load
from concordat.sources.store import Store, StoreError
from concordat.streaming.ledger import Ledger
from tests.conftest import ROOT, rows

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"jdbc:derby:{tmp_path}/db;create=true", driver=DRIVER)
    s._run("CREATE TABLE T (ID INT, NAME VARCHAR(20), KEPT INT)", "INSERT INTO T VALUES (1, 'old', 7), (2, 'old', 8), (NULL, 'none', 9)")
    return s


def held(store):
    return rows(store.spark.read.format("jdbc").options(url=store.url, dbtable="T", driver=DRIVER).load())


def people(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ID int, NAME string").repartition(3)


def test_rows_of_a_repeated_task_count_once(spark, store):
    store._run("CREATE TABLE S (ID INT, NAME VARCHAR(20), C_PART BIGINT, C_ATTEMPT BIGINT)")
    df = people(spark, *((i, f"n{i}") for i in range(50)))
    store.stage(df, "S")
    store.stage(df, "S")  # all tasks again
    part = store._rows("SELECT MIN(C_PART) FROM S", 1)[0][0]
    store._run(f"INSERT INTO S VALUES (5, 'half', {part}, -1)")  # an attempt that was lost on its way
    assert store._rows("SELECT COUNT(*) FROM S", 1) == [(101,)]
    assert store.settle("S") == 50 and store._rows("SELECT COUNT(*), COUNT(DISTINCT ID) FROM S", 2) == [(50, 50)]


def test_modes(spark, store):
    assert store.load(people(spark, (5, "e"), (5, "e")), "T", "r1")["rows"] == 2
    assert held(store).count((5, "e", None)) == 2
    assert store.load(people(spark, (5, "e"), (6, "f")), "T", "r1")["done"] == 1 and len(held(store)) == 5  # asked for again
    got = store.load(people(spark, (1, "new"), (9, "i"), (None, "n")), "T", "r2", "upsert", ["ID"])
    assert got["changed"] == 1 and got["rows"] == 2
    assert held(store) == [(1, "new", 7), (2, "old", 8), (5, "e", None), (5, "e", None), (9, "i", None), (None, "n", None), (None, "none", 9)]
    store.load(people(spark, (5, "x"), (5, "y")), "T", "r3", "delete_insert", ["ID"])
    assert [r[1] for r in held(store) if r[0] == 5] == ["x", "y"]
    store.load(people(spark, (1, "only")), "T", "r4", "replace")
    assert held(store) == [(1, "only", None)]
    with pytest.raises(ValueError):
        store.load(people(spark, (1, "a")), "T; DROP TABLE T", "r5")


def test_a_failure_in_the_store_leaves_all_as_it_was(spark, store):
    store._run("CREATE TABLE U (ID INT NOT NULL PRIMARY KEY, NAME VARCHAR(20))", "INSERT INTO U VALUES (1, 'a')")
    with pytest.raises(Exception, match="(?i)duplicate|constraint|unique"):
        store.load(people(spark, (2, "b"), (1, "c")), "U", "r1")
    assert store._rows("SELECT COUNT(*) FROM U", 1) == [(1,)] and store.merged_runs("r1") == 0
    store.settle = lambda staging: 1
    with pytest.raises(StoreError):
        store.load(people(spark, (2, "b"), (3, "c")), "U", "r1")
    assert store._rows("SELECT COUNT(*) FROM U", 1) == [(1,)]


def test_loads_with_a_watermark_and_keys(spark, store):
    ledger, options = Ledger(), {"dbtable": "T", "driver": DRIVER}
    spec = TableSpec("t", mode="append", incremental=Incremental("ID", "numeric_key", initial="2"))
    first = load.write_out(spark, spec, people(spark, (2, "b"), (3, "c")), store.url, ledger, "r1", **options)
    assert (first.status, first.rows_read, first.watermark) == ("SUCCESS", 1, "3")
    ledger.set_watermark("reverse", "t", "numeric_key", "ID", first.watermark)
    again = load.write_out(spark, spec, people(spark, (2, "b"), (3, "c"), (4, "d")), store.url, ledger, "r2", **options)
    assert (again.rows_written, len(held(store))) == (1, 5)
    keyed = TableSpec("t", keys=("ID",), mode="upsert", on_duplicate="last", order_by=("NAME",))
    r = load.write_out(spark, keyed, people(spark, (1, "x"), (1, "y"), (8, "z")), store.url, ledger, "r3", **options)
    assert (r.status, r.rows_written) == ("SUCCESS", 3) and (1, "y", 7) in held(store) and (8, "z", None) in held(store)
    twice = load.write_out(spark, TableSpec("t", keys=("ID",), mode="upsert"), people(spark, (1, "x"), (1, "y")), store.url, ledger, "r4", **options)
    assert twice.status == "FAILED"


SCRIPT = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from concordat.sources.store import Store
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
store = Store(spark, "jdbc:derby:" + sys.argv[1] + "/db;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", isolationLevel="NONE", batchsize="200")
store._run("CREATE TABLE T (ID BIGINT)")
def failing(batches):
    task = TaskContext.get()
    for i, b in enumerate(batches):
        yield b
        if i == 3 and task.partitionId() == 1 and task.attemptNumber() == 0:
            raise OSError("lost on its way")
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "400")
staged = {}
settle = store.settle
store.settle = lambda s: staged.update(n=len(store._rows(f"SELECT C_PART, C_ATTEMPT FROM {s} GROUP BY C_PART, C_ATTEMPT", 2))) or settle(s)
told = store.load(spark.range(0, 3000, 1, 2).toDF("ID").mapInArrow(failing, "ID long"), "T", "r1")
print("RESULT", told["rows"], store._rows("SELECT COUNT(*), COUNT(DISTINCT ID) FROM T", 2), staged["n"])
"""


def test_a_task_that_fails_once(tmp_path):
    """Its second attempt writes its rows; the table gets every row once. (What an attempt leaves behind is tested above.)"""
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": str(ROOT)}, cwd=tmp_path)
    assert "RESULT 3000 [(3000, 3000)]" in done.stdout, done.stdout + done.stderr[-2000:]
