"""Dependencies from analysed plans, their closure, and repairs in its order."""

import random

import pytest
from pyspark.sql import functions as F

from concordat.operators import objects
from concordat.plans.repairs import repaired
from concordat.sources import catalog
from tests.conftest import rows


@pytest.fixture
def schema(spark):
    spark.sql("CREATE DATABASE deps")
    spark.sql("CREATE TABLE deps.base (id INT, name STRING) USING parquet")
    spark.sql("CREATE TABLE deps.other (id INT) USING parquet")
    spark.sql("CREATE VIEW deps.one AS WITH other2 AS (SELECT * FROM deps.base) SELECT b.id, 'other' AS text FROM other2 AS b -- from deps.other")
    spark.sql("CREATE VIEW deps.two AS SELECT one.id FROM deps.one WHERE id IN (SELECT id FROM deps.other)")
    spark.sql("CREATE VIEW deps.three AS SELECT a.id FROM deps.two AS a JOIN deps.base AS b ON a.id = b.id")
    yield "deps"
    spark.sql("DROP DATABASE deps CASCADE")


def test_edges_of_plans(spark, schema):
    want = [("deps.one", "deps.base"), ("deps.three", "deps.base"), ("deps.three", "deps.two"), ("deps.two", "deps.one"), ("deps.two", "deps.other")]
    assert rows(catalog.resolved_edges(spark, schema)) == want
    spark.sql("DROP TABLE deps.base")
    assert {("deps.one", "deps.base"), ("deps.two", "deps.one"), ("deps.three", "deps.two")} <= set(rows(catalog.resolved_edges(spark, schema)))
    closed = objects.closure(catalog.resolved_edges(spark, schema))
    assert {r.uses: r.depth for r in closed.where("object = 'deps.three'").collect()}["deps.base"] == 1
    assert sorted(r.uses for r in closed.where("object = 'deps.two'").collect()) == ["deps.base", "deps.one", "deps.other"]


def test_repairs_in_order_take_one_round(spark):
    """A view on a view on a table: each can be mended only once what it uses is whole."""
    uses = {"a3": ["z2", "m1"], "z2": ["m1"], "m1": [], "fine": []}
    for edges in (None, spark.createDataFrame([(f"s.{k}", f"s.{v}") for k, vs in uses.items() for v in vs], "object string, uses string")):
        state = {k: k == "fine" for k in uses}

        def scan(state=state):
            return spark.createDataFrame([("s", k, "VIEW", "VALID" if v else "INVALID") for k, v in state.items()], "object_schema string, object_name string, object_type string, status string")

        def act(schema, name, kind, state=state):
            if not all(state[u] for u in uses[name]):
                raise RuntimeError("not yet")
            state[name] = True

        out = repaired(spark, scan, act, edges=edges)
        assert all(state.values()) and out.where("outcome = 'failed'").count() == 0
        most = out.agg(F.max("rounds")).first()[0]
        assert most == (1 if edges is not None else 2)


def test_closure_against_plain(spark):
    rng = random.Random(2)
    for n in (0, 1, 30):
        edges = [(f"o{rng.randint(0, n)}", f"o{rng.randint(0, n)}") for _ in range(n * 2)] + ([(None, "o1"), ("o1", None)] if n else [])
        reach = {k: set() for k in {a for a, b in edges if a and b}}
        for a in reach:
            todo = [a]
            while todo:
                x = todo.pop()
                for p, q in edges:
                    if p == x and q and q not in reach[a]:
                        reach[a].add(q)
                        todo.append(q)
        got = objects.closure(spark.createDataFrame(edges, "object string, uses string")).collect()
        assert sorted((r.object, r.uses) for r in got) == sorted((a, b) for a, bs in reach.items() for b in bs)
        assert all(r.cyclic == (r.object in reach[r.object]) for r in got)


def test_closure_by_layers(spark, monkeypatch):
    """Rounds over all pairs found are left for what stands on cycles or below them; the rest takes one join a layer, with the depths of the shortest ways."""
    closed = []
    monkeypatch.setattr(objects, "_closed", lambda e, rounds, real=objects._closed: closed.append(e.count()) or real(e, rounds))
    tree = [(f"o{i}", f"o{i // 2}") for i in range(2, 60)] + [(f"o{i}", f"o{i // 3}") for i in range(5, 60, 5)]
    for edges, most in ((tree, 0), ([*tree, ("o2", "o29"), ("o40", "o40")], 30)):
        uses = {}
        for a, b in edges:
            uses.setdefault(a, set()).add(b)
        want = set()
        for a in uses:
            depth, ring, seen = 1, uses[a], {}
            while ring:
                seen |= dict.fromkeys(ring, depth)
                depth, ring = depth + 1, {c for b in ring for c in uses.get(b, ())} - set(seen)
            want |= {(a, b, d, a in seen) for b, d in seen.items()}
        got = objects.closure(spark.createDataFrame(edges, "object string, uses string"), few=0).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)
        assert closed.pop() <= most


def test_commands_for_keys(spark, tmp_path):
    import json

    from concordat import cli

    df = spark.range(40).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"), F.col("id").alias("v"))
    df.select("a", "b", (F.col("v") % 3).alias("v")).write.parquet(str(tmp_path / "s"))
    df.select("a", "b", F.when((F.col("a") == 3) & (F.col("b") == 2), 9).otherwise(F.col("v") % 3).alias("v")).write.parquet(str(tmp_path / "t"))
    (tmp_path / "c.json").write_text(json.dumps({"tables": [{"name": "x", "source": str(tmp_path / "s"), "target": str(tmp_path / "t")}]}))
    run = lambda *args: cli.main([*args, "--config", str(tmp_path / "c.json"), "--ledger", str(tmp_path / "l.db"), "--reports", str(tmp_path / "out")])
    assert run("find-keys") == 0 and rows(spark.read.csv(str(tmp_path / "out" / "keys"), header=True), "key_columns") == [("a,b",)]
    assert run("changed-keys") == 1
    assert rows(spark.read.csv(str(tmp_path / "out" / "changed_keys"), header=True), "key_values", "status") == [("3;2", "changed")]
