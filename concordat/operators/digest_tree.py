"""Which keys differ between two copies of a table, found by digests of key ranges that add up level by level.

A leaf is a range of keys of about equal depth (chunks.bounds); its digest is two sums of hash slices and a count, so a node's is the sum of
its FAN children's. Two trees are compared from the root down, and only what lies below nodes that differ is looked at; rows are read of
the leaves that differ, and of these rows keys alone are paired. Digests of tables of versions are kept for each file: after an
upsert, only the new folder is read for the tree, and only files that reach into a differing range for the keys.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.canon import row_hash, slice_sum
from concordat.operators import chunks
from concordat.operators.reconcile import comparable
from concordat.sources.versions import VersionedTable

FAN, BITS = 16, 4
LEAVES = 256
SPANS = 32  # ranges of neighbouring leaves that rows are read of; more are joined where the gap between two is least


def leaf_sums(df: DataFrame, keys: list[str], columns: list[str], at: list[tuple], *groups: str) -> DataFrame:
    """node, rows, a, b of each leaf (and group): one partial aggregation, whatever the table's size."""
    hashed = df.select(*groups, chunks.range_of(df, keys, at).alias("node"), row_hash(df, columns).alias("_h"))
    return hashed.groupBy(*groups, "node").agg(F.count(F.lit(1)).alias("rows"), slice_sum(F.col("_h"), 1).alias("a"), slice_sum(F.col("_h"), 16).alias("b"))


def added(sums: DataFrame, *groups: str) -> DataFrame:
    return sums.groupBy(*groups).agg(F.sum("rows").alias("rows"), F.sum("a").cast("decimal(38,0)").alias("a"), F.sum("b").cast("decimal(38,0)").alias("b"))


Sums = tuple[int, int, int]


def tree(leaves: DataFrame) -> list[dict[int, Sums]]:
    """Levels of node -> (rows, a, b): leaves first, the root last; rows with a null key are node NULLS on every level. On the driver: there are as
    many nodes as leaves, which the caller has chosen, and a fifteenth more."""
    levels = [{r["node"]: (r["rows"], int(r["a"]), int(r["b"])) for r in leaves.collect()}]
    while max(levels[-1], default=0) > 0:
        above: dict[int, Sums] = {}
        for node, x in levels[-1].items():
            up = node >> BITS  # NULLS stays itself
            above[up] = tuple(map(sum, zip(above.get(up, (0, 0, 0)), x, strict=True)))
        levels.append(above)
    return levels


def differing(one: list[dict[int, Sums]], two: list[dict[int, Sums]]) -> tuple[list[int], int]:
    """The leaves that differ of two trees, and how many nodes were compared: below a node that is equal none is."""
    deepest = max(len(one), len(two)) - 1
    for t in (one, two):
        while len(t) <= deepest:  # a tree whose rows all lie in the first leaves
            t.append({n >> BITS: x for n, x in t[-1].items()})
    apart, looked = sorted(set(one[deepest]) | set(two[deepest])), 0
    for level in range(deepest, -1, -1):
        a, b = one[level], two[level]
        looked += len(apart)
        apart = [n for n in apart if a.get(n) != b.get(n)]
        if level:
            apart = [c for n in apart for c in ([n] if n < 0 else range(n << BITS, (n + 1) << BITS)) if c in one[level - 1] or c in two[level - 1]]
    return apart, looked


def spans(nodes: list[int], at: list[tuple]) -> list[tuple[tuple | None, tuple | None]]:
    """Bounds of the runs of neighbouring leaves, at most SPANS of them."""
    runs: list[list[int]] = []
    for n in sorted(x for x in nodes if x >= 0):
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    while len(runs) > SPANS:
        i = min(range(len(runs) - 1), key=lambda k: runs[k + 1][0] - runs[k][1])
        runs[i : i + 2] = [[runs[i][0], runs[i + 1][1]]]
    return [(at[lo - 1] if lo > 0 else None, at[hi] if hi < len(at) else None) for lo, hi in runs]


def _inside(df: DataFrame, keys: list[str], parts: list[tuple[tuple | None, tuple | None]], nulls: bool) -> Column:
    out = F.lit(False)
    for low, high in parts:
        out = out | chunks.within(df, keys, low, high)
    for k in keys if nulls else []:
        out = out | F.col(k).isNull()
    return out


def paired(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, source_rows, target_rows, status (source only, target only, changed) of keys whose rows are not the same on both sides; null equals null,
    repeated keys are compared as bags of rows."""
    side = lambda df, n: df.select(*keys, F.lit(n).alias("_side"), row_hash(df, columns).alias("_h"))
    of = lambda n, x: F.when(F.col("_side") == n, x)
    sums = []
    for n in (0, 1):
        sums += [F.count(of(n, F.lit(1))).alias(f"_n{n}"), slice_sum(of(n, F.col("_h")), 1).alias(f"_a{n}"), slice_sum(of(n, F.col("_h")), 16).alias(f"_b{n}")]
    both = side(source, 0).unionByName(side(target, 1)).groupBy(*keys).agg(*sums)
    same = (F.col("_n0") == F.col("_n1")) & F.col("_a0").eqNullSafe(F.col("_a1")) & F.col("_b0").eqNullSafe(F.col("_b1"))
    status = F.when(F.col("_n1") == 0, "source only").when(F.col("_n0") == 0, "target only").otherwise("changed")
    return both.where(~same).select(*keys, F.col("_n0").alias("source_rows"), F.col("_n1").alias("target_rows"), status.alias("status"))


def changed_keys(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], leaves: int = LEAVES) -> DataFrame:
    """paired() of the leaves that differ: each side is read once for its tree, and then only in the differing ranges, which reach the scans as limits of the
    leading key. Keys must be of one type on both sides; columns of two types are compared as by reconcile.checksum()."""
    one, two, names = comparable(source, target, columns)
    at = chunks.bounds(one, keys, leaves)
    nodes, _ = differing(*(tree(leaf_sums(df, keys, names, at)) for df in (one, two)))
    parts, nulls = spans(nodes, at), chunks.NULLS in nodes
    return paired(one.where(_inside(one, keys, parts, nulls)), two.where(_inside(two, keys, parts, nulls)), keys, names)


class KeptTree:
    """The trees of two tables of versions over the same leaves, from digests kept beside each file of theirs."""

    def __init__(self, source: VersionedTable, target: VersionedTable, keys: list[str], columns: list[str], leaves: int = LEAVES):
        self.tables, self.keys, self.columns = (source, target), keys, columns
        self.states = tuple(t.state() for t in self.tables)
        self.rows = tuple(t.read(state=s) for t, s in zip(self.tables, self.states, strict=True))
        name = hashlib.sha256(json.dumps([keys, columns, leaves]).encode()).hexdigest()[:16]
        # bounds hold as long as the source has this file; they need not be even for the digests to add up
        texts = source.remembered(f"bounds-{name}", lambda: json.dumps([[None if v is None else str(v) for v in r] for r in chunks.bounds(self.rows[0], keys, leaves)]))
        kinds = [self.rows[0].schema[k].dataType for k in keys]
        told = source.spark.createDataFrame([(i, *r) for i, r in enumerate(json.loads(texts))], ", ".join(["_n int", *(f"c{i} string" for i in range(len(keys)))]))
        self.at = [tuple(r) for r in told.orderBy("_n").select(*(F.col(f"c{i}").cast(k) for i, k in enumerate(kinds))).collect()]
        self.name = f"sums-{name}-{hashlib.sha256(texts.encode()).hexdigest()[:16]}"

    def _sums(self, side: int) -> DataFrame:
        table, out = self.tables[side], None
        for p in table.parts(state=self.states[side]):
            part = table.kept(p["folder"], self.name, lambda rows: leaf_sums(rows, self.keys, self.columns, self.at, "_file"))
            part = part.where(~F.col("_file").isin(p["without"])) if p["without"] else part
            out = part if out is None else out.unionByName(part)
        return added(out, "node")

    def nodes(self) -> list[int]:
        """The leaves that differ. No row is read of a file whose digests are kept."""
        return differing(*(tree(self._sums(i)) for i in (0, 1)))[0]

    def files(self, side: int, nodes: list[int]) -> list[tuple[str, str]]:
        """The files of a side with rows in some leaves, as their kept digests tell."""
        table, out = self.tables[side], []
        for p in table.parts(state=self.states[side]):
            held = table.kept(p["folder"], self.name, lambda rows: leaf_sums(rows, self.keys, self.columns, self.at, "_file"))
            out += [(p["folder"], r["_file"]) for r in held.where(F.col("node").isin(nodes)).select("_file").distinct().collect() if r["_file"] not in p["without"]]
        return sorted(out)

    def changed_keys(self) -> DataFrame:
        """paired() of the leaves that differ, read from the files that have rows in them."""
        nodes = self.nodes()
        parts, nulls = spans(nodes, self.at), chunks.NULLS in nodes
        one, two = (t.read_files(self.files(i, nodes), self.rows[i]) for i, t in enumerate(self.tables))
        return paired(one.where(_inside(one, self.keys, parts, nulls)), two.where(_inside(two, self.keys, parts, nulls)), self.keys, self.columns)
