"""K-d tree partitioning of documents into shards of near equal bytes.

Every node is split at the weighted median (or the share its two sides' leaf counts ask for) of its widest metadata dimension.
The thresholds are found by grouped histograms that are refined around the crossing bin, so a level of the tree costs a few
aggregations of a narrow metadata table, and no row moves before its leaf is known. The tree is a handful of arrays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import cut, gapless_rank

BINS, PASSES = 4096, 8
FINE = 1000  # a threshold is refined until what it may be off by is this part of a leaf, or one row


@dataclass
class Tree:
    """A k-d tree as arrays, a node in each place; the first is the root. Leaves have dim -1 and their number in first."""

    dims: list[str]
    leaves: list[int]
    first: list[int]
    dim: list[int]
    at: list[float]
    left: list[int]
    right: list[int]
    depth: int = 0

    @classmethod
    def root(cls, dims: list[str], leaves: int) -> Tree:
        return cls(dims, [leaves], [0], [-1], [math.nan], [-1], [-1])

    def split(self, node: int, dim: int, at: float) -> None:
        half = self.leaves[node] // 2
        self.dim[node], self.at[node], self.left[node], self.right[node] = dim, at, len(self.dim), len(self.dim) + 1
        for leaves, first in ((half, self.first[node]), (self.leaves[node] - half, self.first[node] + half)):
            for column, x in ((self.leaves, leaves), (self.first, first), (self.dim, -1), (self.at, math.nan), (self.left, -1), (self.right, -1)):
                column.append(x)

    def open(self) -> list[int]:
        return [i for i, n in enumerate(self.leaves) if n > 1 and self.dim[i] < 0]

    def node(self) -> Column:
        """The node that a row is in: a walk of `depth` steps over literal arrays, so an expression of one size whatever the tree's."""
        if not self.depth:
            return F.lit(0)
        values, dim, at, left, right = F.array(*self.dims), _literal(self.dim), _literal(self.at, "double"), _literal(self.left), _literal(self.right)
        step = lambda n, _: F.when(F.get(dim, n) < 0, n).when(F.get(values, F.get(dim, n)) < F.get(at, n), F.get(left, n)).otherwise(F.get(right, n))
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), step)

    def leaf(self) -> Column:
        return F.get(_literal(self.first), self.node())


def _literal(numbers: list, kind: str = "int") -> Column:
    """A constant array, from one text: a literal for each number would be a call to the JVM each."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast(f"array<{kind}>")


@dataclass
class _Cut:
    """A node's threshold being looked for: between lo and hi in a dimension; `before` weight lies below lo, `inside` between both."""

    dim: int
    lo: float
    hi: float
    goal: float
    before: float = 0.0
    inside: float = math.inf
    rows: int = 2


def kd_tree(meta: DataFrame, dims: list[str], weight: str, leaves: int = 0, target: int = 0) -> tuple[Tree, int]:
    """Grow the tree over a metadata table whose dims are doubles without ties (see metadata()).

    leaves: their number, or else as many as bring them to `target` weight. Returns the tree and the number of rows. The driver gets a row
    for each node of a level, and at most BINS bins of each are summed in a task.
    """
    spread = [f(d).alias(f"{d}_{n}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]
    whole = meta.agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n"), *spread).first()
    tree = Tree.root(dims, leaves or max(1, math.ceil((whole["w"] or 0) / max(1, target))))
    if not whole["n"]:
        return Tree.root(dims, 1), 0
    fine = whole["w"] / tree.leaves[0] / FINE
    scale = [(whole[f"{d}_hi"] - whole[f"{d}_lo"]) or 1.0 for d in dims]
    while nodes := tree.open():
        at = tree.node()
        stats = {r["node"]: r for r in meta.groupBy(at.alias("node")).agg(F.sum(weight).alias("w"), *spread).collect()}  # a row for each node
        cuts: dict[int, _Cut] = {}
        for node in nodes:
            if r := stats.get(node):
                widest = max(range(len(dims)), key=lambda k: (r[f"{dims[k]}_hi"] - r[f"{dims[k]}_lo"]) / scale[k])
                cuts[node] = _Cut(widest, r[f"{dims[widest]}_lo"], math.nextafter(r[f"{dims[widest]}_hi"], math.inf), r["w"] * (tree.leaves[node] // 2) / tree.leaves[node])
        for _ in range(PASSES):
            wide = {n: c for n, c in cuts.items() if c.inside > fine and c.rows > 1 and c.lo + (c.hi - c.lo) / BINS > c.lo}
            if not wide:
                break
            of = lambda pick, kind="double": F.get(_literal([pick(wide[n]) if n in wide else -1 if kind == "int" else math.nan for n in range(len(tree.dim))], kind), F.col("node"))  # noqa: B023, E731
            inside = meta.select(at.alias("node"), *dims, F.col(weight).alias("w")).where(of(lambda c: c.dim, "int") >= 0)
            inside = inside.select("node", "w", F.get(F.array(*dims), of(lambda c: c.dim, "int")).alias("v"), of(lambda c: c.lo).alias("lo"), of(lambda c: (c.hi - c.lo) / BINS).alias("width"))
            bins = inside.where((F.col("v") >= F.col("lo")) & (F.col("v") < F.col("lo") + F.col("width") * BINS)).groupBy("node", F.least(F.floor((F.col("v") - F.col("lo")) / F.col("width")), F.lit(BINS - 1)).alias("bin")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
            upto = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")) + of(lambda c: c.before))  # at most BINS rows a node
            crossing = upto.where(F.col("upto") >= of(lambda c: c.goal)).groupBy("node").agg(F.min_by(F.struct("bin", "upto", "w", "n"), "bin").alias("x")).select("node", "x.*")
            found = {r["node"]: r for r in crossing.collect()}  # a row for each node
            for n, c in wide.items():
                if r := found.get(n):
                    size = (c.hi - c.lo) / BINS
                    c.lo, c.hi = c.lo + r["bin"] * size, c.lo + (r["bin"] + 1) * size
                    c.before, c.inside, c.rows = r["upto"] - r["w"], r["w"], r["n"]
                else:  # rounding left the rows of the last bin out
                    c.inside = 0.0
        for node in nodes:
            if c := cuts.get(node):
                tree.split(node, c.dim, c.lo if c.goal - c.before < c.before + c.inside - c.goal else c.hi)
            else:
                tree.split(node, 0, 0.0)
        tree.depth += 1
    return tree, whole["n"]


def metadata(docs: DataFrame, numbers: list[str], names: list[str], whole: bool = False) -> tuple[DataFrame, list[str]]:
    """The narrow table that the tree is grown on: doc_id, size, text_crc32, row, and a double for each dimension.

    Numbers are taken as they are (null: -1), names as a hash. Each row gets a fraction of its own below one, so that ties,
    even a third of all rows with one value, have an order to be split in. Copies of a row differ by their row number. whole: keep the
    document as a struct, `doc`.
    """
    empty = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(empty) + 16).cast("long").alias("size"),
        F.crc32(empty.cast("binary")).alias("text_crc32"),
        *(F.coalesce(F.floor(F.col(c).cast("double")), F.lit(-1.0)).cast("double").alias(f"d_{c}") for c in numbers),
        *(F.pmod(F.xxhash64(F.col(c)), F.lit(1 << 20)).cast("double").alias(f"d_{c}") for c in names),
        F.monotonically_increasing_id().alias("row"),
        *([F.struct("*").alias("doc")] if whole else []),
    )
    dims = [f"d_{c}" for c in [*numbers, *names]]
    fraction = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(1 << 16)) / (1 << 16) + F.pmod(F.xxhash64("row"), F.lit(1 << 12)) / (1 << 28)
    return base.withColumns({d: F.col(d) + fraction for d in dims}), dims


def kd_shards(docs: DataFrame, shards: int = 0, target_bytes: int = 0, numbers: tuple[str, ...] = ("n_chars", "doc_id"), names: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Put every document into a leaf of the tree: doc_id, size, text_crc32, shard (from 0), slot (gapless from 0 in a shard).

    size is the text's UTF-8 bytes (null: none) plus 16. Repeated rows each get a slot; an empty table gives no rows. Columns of
    docs other than those named do not matter.
    """
    narrow, dims = metadata(docs, list(numbers), list(names))
    meta = cut(narrow, "shards-meta")
    tree, rows = kd_tree(meta, dims, "size", shards, target_bytes)
    placed = meta.withColumn("shard", tree.leaf())
    ranked = gapless_rank(placed, "shard", [F.col("row")], rows, F.col("row"), "slot", groups=max(1, tree.leaves[0]))
    return ranked.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 0, target_bytes: int = 0, numbers: tuple[str, ...] = ("n_chars", "doc_id"), names: tuple[str, ...] = ("source", "lang"), salts: int = 16) -> str:
    """Write documents, each once, in one folder for each leaf of their tree, in up to `salts` files; returns the name of the folders' column.

    The tree is grown on the narrow metadata and then applied to the documents as an expression, so no row is looked up by its id: rows that repeat a doc_id, copies
    and rows without a doc_id all stand. The folders' column is `shard`, with underscores before it where documents have a column of that
    name. An empty table writes no folder.
    """
    narrow, dims = metadata(docs, list(numbers), list(names))
    tree, _ = kd_tree(cut(narrow, "shards-meta"), dims, "size", shards, target_bytes)
    column, taken = "shard", {c.lower() for c in docs.columns}
    while column in taken:
        column = f"_{column}"
    placed = metadata(docs, list(numbers), list(names), whole=True)[0].withColumn("_leaf", tree.leaf())
    spread = placed.repartition("_leaf", F.pmod(F.xxhash64("row"), F.lit(salts)))
    spread.select("doc.*", F.col("_leaf").alias(column)).write.partitionBy(column).parquet(path)
    return column
