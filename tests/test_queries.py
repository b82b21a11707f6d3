"""Every registered query against its SQL, over whole small tables."""

import ast
import decimal
from pathlib import Path

import duckdb
import pytest

from concordat.plans import queries as Q


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in Q._TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_same_as_sql(spark, duck, tiny, name):
    df = Q.QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    relation = duck.sql(Q.SQL[name])
    assert sorted(relation.columns) == columns
    theirs = duck.sql(f"SELECT {', '.join(columns)} FROM ({Q.SQL[name]})").fetchall()
    assert ours == sorted(repr(tuple(map(plain, r))) for r in theirs)


def test_names_are_given_once():
    """A query reads its text when it runs: a name given again further down would change it, but not its SQL."""
    given = [n for x in ast.parse(Path(Q.__file__).read_text()).body for n in ([x.name] if isinstance(x, ast.FunctionDef) else [t.id for t in x.targets] if isinstance(x, ast.Assign) else [])]
    assert [n for n in set(given) if given.count(n) > 1] == []


def test_one_shuffle_for_a_key_diff(spark, tiny):
    from concordat.operators.reconcile import key_balance

    plan = key_balance(*Q.pair(spark, tiny), ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_watermarks_reach_the_scan(spark, tiny):
    from concordat.operators.incremental import newer

    plan = Q.table(spark, tiny, "events").where(newer("ts", "updated_at", "2024-01-15 00:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-14T23:55" in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).first()["source_only"] == 18
    assert set(entry.oracle_sql()) <= set(entry.queries())
