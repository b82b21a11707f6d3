"""Digest trees, comparisons across types, key search, profiles that add up."""

import datetime
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concordat.functions.canon import NoCommonTypeError
from concordat.model import TableSpec
from concordat.operators import digest_tree, key_search, profile, reconcile
from concordat.operators.objects import resolve_keys
from concordat.plans import load
from concordat.sources.versions import VersionedTable
from concordat.streaming.ledger import Ledger
from tests.conftest import rows


def status(source, target, columns):
    return reconcile.checksum(source, target, columns).first()["status"]


def test_texts_that_hold_the_separator(spark):
    a = spark.createDataFrame([("a\x1fb", "c")], "x string, y string")
    b = spark.createDataFrame([("a", "b\x1fc")], "x string, y string")
    assert status(a, b, ["x", "y"]) == "MISMATCH" and status(a, a, ["x", "y"]) == "MATCH"
    for x, y in (("\\", "\x1f"), ("\\u", ""), ("\x1f", ""), ("\\\x1f", ""), (None, "\\N")):
        one, two = (spark.createDataFrame([v], "x string, y string") for v in ((x, y), (y, x)))
        assert status(one, two, ["x", "y"]) == "MISMATCH", (x, y)


@pytest.mark.parametrize(
    "kinds,same,apart",
    [
        (("int", "double"), [(1, 1.0), (-7, -7.0), (None, None)], [(1, 1.5), (0, float("nan"))]),
        (("bigint", "double"), [(2**53, float(2**53))], [(2**53 + 1, float(2**53))]),
        (("int", "decimal(10,2)"), [(1, Decimal("1.00"))], [(1, Decimal("1.01"))]),
        (("decimal(18,2)", "double"), [(Decimal("1.10"), 1.1)], [(Decimal("1.10"), 1.1000001)]),
        (("float", "double"), [(0.5, 0.5)], [(0.1, 0.1)]),
        (("date", "timestamp_ntz"), [(datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2))], [(datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 5))]),
        (("string", "int"), [("12", 12), (None, None)], [("12a", 12), ("", None)]),
        (("string", "timestamp_ntz"), [("2024-01-02 03:04:05", datetime.datetime(2024, 1, 2, 3, 4, 5))], [("soon", datetime.datetime(2024, 1, 2))]),
        (("map<string,int>", "map<string,int>"), [({"a": 1, "b": 2}, {"b": 2, "a": 1})], [({"a": 1}, {"a": 2})]),
        (("array<map<string,int>>", "array<map<string,int>>"), [([{"a": 1, "b": 2}], [{"b": 2, "a": 1}])], [([{"a": 1}], [{"b": 1}]), (None, [])]),
    ],
)
def test_types_meet_in_one_that_both_fit(spark, kinds, same, apart):
    for pairs, want in ((same, "MATCH"), (apart, "MISMATCH")):
        for x, y in pairs:
            one, two = (spark.createDataFrame([(1, v)], f"id int, v {kind}") for v, kind in ((x, kinds[0]), (y, kinds[1])))
            for a, b in ((one, two), (two, one)):
                assert status(a, b, ["id", "v"]) == want, (x, y)
                assert (reconcile.value_diff(a, b, ["id"], ["v"]).count() > 0) == (want == "MISMATCH"), (x, y)


def test_types_without_one_are_told(spark):
    a, b = spark.createDataFrame([(1, b"x")], "id int, v binary"), spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(NoCommonTypeError, match="v: "):
        reconcile.checksum(a, b, ["id", "v"])


def test_keys_are_not_narrowed(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(1.5, "y"), (1.0, "x")], "id double, v string")
    assert reconcile.value_diff(a, b, ["id"], ["v"]).count() == 0


def plain_changes(one, two):
    count = lambda t: {k: sorted(map(repr, g)) for k, g in ((k, [r for r in t if r[:2] == k]) for k in {r[:2] for r in t})}
    a, b = count(one), count(two)
    return {k: "changed" if k in a and k in b else "source only" if k in a else "target only" for k in {*a, *b} if a.get(k) != b.get(k)}


@pytest.mark.parametrize("seed", range(4))
def test_changed_keys_against_plain(spark, seed):
    rng = random.Random(seed)
    one = [(rng.choice([None, *range(200)]), rng.choice("abc"), rng.random()) for _ in range(1500)]
    two = [(k, n, v if rng.random() > 0.01 else v + 1) for k, n, v in one if rng.random() > 0.01] + [(rng.randint(-5, 300), "z", 1.0) for _ in range(seed)]
    a, b = (spark.createDataFrame(t, "k int, n string, v double") for t in (one, two))
    got = digest_tree.changed_keys(a, b, ["k", "n"], ["k", "n", "v"], leaves=40)
    assert {(r.k, r.n): r.status for r in got.collect()} == plain_changes(one, two)
    assert digest_tree.changed_keys(a, a.repartition(3), ["k", "n"], ["k", "n", "v"], leaves=40).count() == 0
    assert digest_tree.changed_keys(a.limit(0), b.limit(0), ["k", "n"], ["v"]).count() == 0


def test_nothing_is_compared_below_equal_nodes(spark):
    leaves = [spark.createDataFrame([(i, 10, i, i + (i == x)) for i in range(256)], "node int, rows long, a long, b long") for x in (-1, 77)]
    one, two = map(digest_tree.tree, leaves)
    assert len(one) == 3 and one[2] == {0: (2560, sum(range(256)), sum(range(256)))}
    assert digest_tree.differing(one, two) == ([77], 1 + 16 + 16)
    assert digest_tree.spans([0, 1, 2, 9, -1], [(i,) for i in range(20)]) == [(None, (2,)), ((8,), (9,))]


def test_kept_trees_read_only_what_changed(spark, tmp_path):
    df = spark.range(5000).select("id", (F.col("id") * 3).alias("v"))
    tables = []
    for n in "ab":
        t = VersionedTable(spark, str(tmp_path / n))
        t.stage(df.repartitionByRange(10, "id"), "v0")
        t.publish("v0")
        tables.append(t)
    first = digest_tree.KeptTree(*tables, ["id"], ["id", "v"], leaves=50)
    assert first.nodes() == []
    changes = spark.createDataFrame([(7, 0), (4990, 1), (6000, 2)], "id long, v long")
    load.run(spark, TableSpec("t", keys=("id",), mode="upsert"), changes, tables[1], Ledger(), "r1")
    made, kept = [], VersionedTable.kept
    tree = digest_tree.KeptTree(*tables, ["id"], ["id", "v"], leaves=50)
    assert tree.name == first.name
    for t in tables:
        t.kept = lambda folder, name, make, t=t: kept(t, folder, name, lambda rows: made.append(folder) or make(rows))
    nodes = tree.nodes()
    assert set(made) == {"r1"} and 0 < len(nodes) <= 3
    assert len(tree.files(0, nodes)) == 2 and len(tree.files(1, nodes)) <= 3
    assert sorted((r.id, r.status) for r in tree.changed_keys().collect()) == [(7, "changed"), (4990, "changed"), (6000, "target only")]


@pytest.mark.parametrize("seed", range(3))
def test_least_keys_against_all_sets(spark, seed):
    rng = random.Random(seed)
    data = [(i // 20, i % 20, rng.randint(0, 3), None if i == 5 else i, f"x{i}", rng.randint(0, 2000)) for i in range(800)]
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(data, "a int, b int, c int, d int, e string, f int")

    def want(columns, nulls):
        found = []
        for n in (1, 2, 3):
            for s in itertools.combinations(columns, n):
                at = [names.index(c) for c in s]
                if not any(set(k) <= set(s) for k in found) and (nulls or all(r[i] is not None for r in data for i in at)) and len({tuple(r[i] for i in at) for r in data}) == len(data):
                    found.append(s)
        return found

    assert key_search.least_keys(df) == want(names, False)
    assert key_search.least_keys(df, ["a", "b", "c", "f"]) == want(["a", "b", "c", "f"], False)
    assert key_search.least_keys(df, ["d", "b"], nulls=True) == want(["d", "b"], True)
    assert key_search.least_keys(df.limit(0)) == [] and key_search.least_keys(df, ["c"]) == []


def test_keys_fall_back_to_the_rows(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (2, 1, "x")], "a int, b int, c string")
    assert resolve_keys("t", rows=df) == (["a", "b"], "unique in the rows")


def test_profiles_add_up(spark, tmp_path):
    rng = random.Random(2)
    data = [(i, rng.randint(0, 3000), rng.choice(["a", "a", "a", "b", None]), rng.gauss(0, 1)) for i in range(9000)]
    df = spark.createDataFrame(data, "id int, k int, s string, x double")
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.stage(df.where("id < 6000"), "v0")
    t.publish("v0")
    columns = ["id", "k", "s", "x"]
    profile.of_versions(t, columns)
    t.stage(df.where("id >= 6000"), "v1")
    t.append("v1", ["v1"])
    made, kept = [], VersionedTable.kept
    t.kept = lambda folder, name, make: kept(t, folder, name, lambda rows: made.append(folder) or make(rows))
    got = {r.column_name: r for r in profile.of_versions(t, columns).collect()}
    assert made == ["v1"]
    for i, c in enumerate(columns):
        values = [r[i] for r in data if r[i] is not None]
        assert (got[c].non_null, got[c].nulls) == (len(values), 9000 - len(values))
        assert abs(got[c].distinct_count - len(set(values))) <= max(1, 5 * profile.ERROR_DISTINCT * len(set(values)))
        assert got[c].min_value == spark.createDataFrame([(min(values),)], [c]).select(F.col(c).cast("string")).first()[0]
    for i, c in ((0, "id"), (1, "k"), (3, "x")):
        values = sorted(r[i] for r in data)
        for p, q in zip((0.25, 0.5, 0.75), got[c].quartiles, strict=True):
            assert values[int(9000 * (p - 0.04))] <= q <= values[int(9000 * (p + 0.04))]
    assert got["s"].quartiles is None and [f["value"] for f in got["s"].frequent[:2]] == ["a", "b"]
    assert abs(got["s"].frequent[0]["count"] - sum(r[2] == "a" for r in data)) < 90
    assert rows(profile.summed(profile.sketches(df.limit(0), columns), columns), "column_name", "non_null", "nulls") == [(c, 0, 0) for c in sorted(columns)]
