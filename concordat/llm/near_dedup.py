"""Near-duplicate documents by bottom-k sketches of one hash function.

Every document keeps the k smallest hashes of its shingle set. Documents with equal sets are one class and go on as one of
its rows; rows are told apart by their own number, so a doc_id may stand for several texts. Inverted lists of the retained values give the candidates. Two sets at the similarity bound share at least
`overlap(size)` retained values but for a chance below 1e-7, so only the rarest `size - overlap + 1` values of a sketch need
to be looked up, and values that very many documents share hardly ever are. The union sketch estimates each candidate's
similarity, and full sets decide.

Components need links, not all pairs: first each list's documents are held against a few pivots of that list. Then only
documents from different components are: as pairs in short lists, block by block in long ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import components, cut, ship, sieve, sifted, spread_join
from concordat.llm.shingles import text_sets
from concordat.llm.vectors import group_changes, whole_groups

K = 64
PIVOTS = 3
LONG = 64  # lists up to this length are open to pairs; longer ones go by blocks
DENSE_BLOCK = 1024  # documents, and
DENSE_SHINGLES = 1 << 21  # shingles that a block holds at most, but for one document of more
SLACK = 0.30  # the estimate from 64 values has a standard deviation of 0.054 at similarity 0.75


def overlap_needed(size: int, percent: int) -> int:
    """Least number of retained values that two sets at the bound share, for a sketch of `size` values.

    Sets that fit their sketch together with any partner's share percent/100 of it for certain. Else the number shared is
    about binomial (K, percent/100); 5.8 standard deviations below the mean are 28 of 64 at 75 percent.
    """
    if size <= K * percent // 100:
        return max(1, -(-size * percent // 100))
    p = percent / 100
    return max(1, int(K * p - 5.8 * (K * p * (1 - p)) ** 0.5))


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """doc_id, text_hash, n_shingles, key1 and key2 (they stand for the whole set) and sketch (its K smallest hashes, ascending)."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, kept = [], [], [], []
            for s in text_sets(batch.column(2), words):
                key = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                sizes.append(len(s))
                one.append(key[0])
                two.append(key[1])
                kept.append(s[:K])
            ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *kept])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists], names=["doc_id", "text_hash", "n_shingles", "key1", "key2", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(run, "doc_id long, text_hash long, n_shingles long, key1 long, key2 long, sketch array<long>")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are as similar as asked: 100 * intersection >= percent * union.

    texts: doc_id, text. A pivot's text goes once to each group of about 256 of its partners; a group is streamed, so memory
    holds one set and one batch.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    dealt = spread_join(pairs, counts, ["a"], F.col("b")).select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / 256)).alias("salt"))
    member = dealt.join(texts, dealt["b"] == texts["doc_id"]).select("a", "salt", F.lit(1).alias("role"), "b", "text")
    pivot = dealt.select("a", "salt").distinct().join(texts, F.col("a") == texts["doc_id"]).select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.empty(0, np.int64)
        for batch in batches:
            a, b = [], []
            for x, salt, role, y, s in zip(*(batch.column(i).to_pylist() for i in range(4)), text_sets(batch.column(4), words), strict=True):
                if role == 0:
                    held, own = (x, salt), s
                elif held == (x, salt):
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(s) - both):
                        a.append(x)
                        b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    together = member.unionByName(pivot).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return together.mapInArrow(run, "a long, b long")


def estimated(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Add est, the share of the union sketch's values that both sketches hold, to pairs (a, b); drop the hopeless."""
    left, right = (sketch.select(F.col("doc_id").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
    est = F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))) / F.size(union)
    return both.select(*pairs.columns, est.alias("est")).where(F.col("est") >= percent / 100 - SLACK)


def dense_links(long: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (a, b) that join different components among the documents of long lists: enough of them, not all.

    Documents that long lists connect form a bundle. Its documents fall into classes by the size of their sets. In a class,
    large components are cut into blocks of their own and the other documents into mixed ones, by a hash, and each pair of blocks that can hold a new link goes to a task with the
    documents' texts. There the intersections of all full sets are products of 0-1 matrices, and the links found are reduced
    to a forest over components. So no pair is ever a row, and two blocks of one component never meet.

    long: v, first (a document of the list), doc_id, n, c (component so far).
    """
    edges = long.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct()
    bundle = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("g"))
    docs = cut(long.select("doc_id", "n", "c").distinct().join(bundle, "doc_id"), "dense-documents")
    # sizes of linked sets differ by the bound at most, so by one size class at most
    docs = docs.withColumn("class", F.floor(F.log("n") / math.log(100 / percent)))
    large = docs.groupBy("g", "c", "class").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= DENSE_BLOCK)
    own = docs.join(large, ["g", "c", "class"], "left").withColumn("part", F.when(F.col("size").isNotNull(), F.col("c")))
    counts = own.groupBy(F.col("g").alias("h"), F.col("part").alias("p"), F.col("class").alias("q")).agg(F.ceil(F.greatest(F.count(F.lit(1)) / DENSE_BLOCK, F.sum("n") / DENSE_SHINGLES)).alias("blocks"))
    salted = own.join(counts, (F.col("g") == F.col("h")) & F.col("part").eqNullSafe(F.col("p")) & (F.col("class") == F.col("q"))).withColumn("k", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    placed = cut(salted.select("g", "part", "class", "doc_id", "n", "c", F.xxhash64("part", "class", "k").alias("block")), "dense-blocks")
    blocks = placed.groupBy("g", "class", "block").agg(F.first("part").alias("part"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    x, y = (blocks.select(F.col("g").alias(f"g{k}"), F.col("class").alias(f"class{k}"), *(F.col(c).alias(f"{c}{k}") for c in ("block", "part", "lo", "hi"))) for k in "xy")
    y = y.withColumn("near", F.explode(F.array(F.col("classy") - 1, F.col("classy"), F.col("classy") + 1)))
    sizes = (F.col("hix") * 100 >= F.col("loy") * percent) & (F.col("hiy") * 100 >= F.col("lox") * percent)
    new = (F.col("blockx") < F.col("blocky")) & F.coalesce(F.col("partx") != F.col("party"), F.lit(True)) | (F.col("blockx") == F.col("blocky")) & F.col("partx").isNull()
    meets = x.join(y, (F.col("gx") == F.col("gy")) & (F.col("classx") == F.col("near")) & new & sizes).select(F.col("gx").alias("g"), "blockx", "blocky")
    sides = meets.select("g", "blockx", "blocky", F.explode(F.array_distinct(F.array("blockx", "blocky"))).alias("block"))
    filled = sides.join(placed, ["g", "block"]).join(texts, "doc_id").select("g", "blockx", "blocky", "block", "doc_id", "c", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            starts = np.flatnonzero(np.r_[True, group_changes(table, 3)])
            for lo, hi in zip(starts, np.r_[starts[1:], len(table)], strict=True):
                part = table.slice(lo, hi - lo).combine_chunks()
                left = np.flatnonzero(part.column(3).to_numpy() == part.column(1)[0].as_py())
                right = np.flatnonzero(part.column(3).to_numpy() == part.column(2)[0].as_py())
                ids, groups, sets = part.column(4).to_numpy(), part.column(5).to_numpy(), list(text_sets(part.column(6), words))
                a, b = forest(ids, groups, sets, left, right, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    together = filled.repartition("g", "blockx", "blocky").sortWithinPartitions("g", "blockx", "blocky", "block")
    return together.mapInArrow(run, "a long, b long")


def forest(ids: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Links between rows of left and right that join different groups, as a forest over the groups."""
    sizes = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    values, at, often = np.unique(flat, return_inverse=True, return_counts=True)
    common = np.flatnonzero(often > 1)
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    at = place[at]
    row, at = row[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    one = np.zeros((len(sets), 2048), np.float32)
    for lo in range(0, len(common), 2048):
        p, q = np.searchsorted(at, (lo, lo + 2048))
        one[:] = 0
        one[row[p:q], at[p:q] - lo] = 1
        both += one[left] @ one[right].T
    near = (100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both)) & (groups[left][:, None] != groups[right][None, :]) & (both > 0)
    root = {g: g for g in set(groups.tolist())}

    def find(g):
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    a, b = [], []
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = left[i], right[j]
        gx, gy = find(groups[x].item()), find(groups[y].item())
        if gx != gy:
            root[gx] = gy
            a.append(int(ids[x]))
            b.append(int(ids[y]))
    return a, b


def grouped(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """near_groups() with text_hash, and first: whether the row's doc_id and text are the least of its group."""
    found = cut(sketches(docs, words).withColumn("row", F.monotonically_increasing_id()), "sketches")
    some = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = cut(some.groupBy("key1", "key2").agg(F.min(F.struct("doc_id", "text_hash", "row")).alias("x")).select("key1", "key2", F.col("x.doc_id").alias("rep"), F.col("x.text_hash").alias("rep_hash"), F.col("x.row").alias("node")), "classes", free=True)
    # from here on doc_id is the row number of a class's representative
    single = some.join(reps.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("doc_id"), F.col("n_shingles").alias("n"), "sketch")

    needed = F.create_map(*(F.lit(x) for s in range(1, K + 1) for x in (s, s - overlap_needed(s, percent) + 1)))
    posts = single.select("doc_id", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    often = posts.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = posts.join(often, "v")
    of_doc = Window.partitionBy("doc_id")
    # values that no other document holds come first in the order by rarity: they take places, but need no list
    place = F.col("size") - F.count(F.lit(1)).over(of_doc) + F.row_number().over(of_doc.orderBy("f", "v"))
    lists = cut(shared.withColumn("place", place).where(F.col("place") <= needed[F.col("size")]).select("v", "doc_id", "n"), "lists", free=True)
    ids = lists.select("doc_id").distinct()
    sketch = cut(single.join(ids, "doc_id", "left_semi"), "near-sketches", free=True)
    wanted = cut(reps.join(ids, reps["node"] == ids["doc_id"]).select("rep", "rep_hash", "node"), "near-wanted")
    of_text = F.xxhash64("rep", "rep_hash")
    likely = sifted(docs.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64("text").alias("rep_hash"), "text"), of_text, sieve(wanted.select(of_text.alias("at")), wanted.count())).where("_likely")
    texts = cut(likely.join(wanted, ["rep", "rep_hash"]).select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"]), "near-texts", free=True)

    fits = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    ends = [F.min_by(F.struct(F.col("doc_id").alias("p"), F.col("n").alias("m")), F.xxhash64("doc_id", F.lit(seed)) if seed else F.col("doc_id")).alias(f"p{seed}") for seed in range(PIVOTS)]
    pivots = lists.groupBy("v").agg(F.count(F.lit(1)).alias("f"), *ends).where("f > 1").select("v", F.explode(F.array_distinct(F.array(*(f"p{s}" for s in range(PIVOTS))))).alias("x")).select("v", "x.p", "x.m")
    star = lists.join(pivots, "v").where(fits & (F.col("doc_id") != F.col("p"))).select(F.col("p").alias("a"), F.col("doc_id").alias("b")).distinct()
    best = Window.partitionBy("b").orderBy(F.col("est").desc(), "a")
    first = estimated(star, sketch, percent).withColumn("k", F.row_number().over(best)).where("k <= 2").select("a", "b")
    links = cut(verified(cut(first, "first-pairs", free=True), texts, percent, words), "links", free=True)
    group = components(links)

    known = lists.join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id"))
    mixed = known.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("f"), F.min("doc_id").alias("first")).where("lo < hi").select("v", "f", "first")
    open_ = cut(known.join(mixed, "v").select("v", "f", "first", "doc_id", "n", "c"), "open-lists", free=True)
    few = open_.where(F.col("f") <= LONG)
    other = few.select(F.col("v").alias("w"), F.col("doc_id").alias("q"), F.col("n").alias("m"), F.col("c").alias("d"))
    rest = few.join(other, (F.col("v") == F.col("w")) & (F.col("doc_id") < F.col("q")) & (F.col("c") != F.col("d")) & fits).select(F.col("doc_id").alias("a"), F.col("q").alias("b")).distinct()
    more = cut(verified(cut(estimated(rest, sketch, percent).select("a", "b"), "more-pairs", free=True), texts, percent, words), "links", free=True)
    dense = cut(dense_links(open_.where(F.col("f") > LONG), texts, percent, words), "dense-links", free=True)
    final = components(links.unionByName(more).unionByName(dense))

    # a component takes the least doc_id, and of its texts the least hash, of its classes
    joined = reps.join(final, "node")
    least = joined.groupBy("component").agg(F.min(F.struct("rep", "rep_hash")).alias("low"))
    labels = spread_join(final, least, ["component"], F.col("node")).select("node", "low")
    by_class = reps.join(labels, "node", "left").select("key1", "key2", F.coalesce("low", F.struct("rep", "rep_hash")).alias("low"))
    linked = some.select("doc_id", "text_hash", "n_shingles", "key1", "key2").join(by_class, ["key1", "key2"]).select("doc_id", "text_hash", "n_shingles", F.col("low.rep").alias("component_id"), (F.struct("doc_id", "text_hash") == F.col("low")).alias("first"))
    alone = found.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def near_groups(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id = component_id), for every row of docs.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and return, A-Z in lower case. Texts
    that are null or blank have an empty set and link with nothing. Rows are linked by their texts alone: rows that repeat a doc_id with
    another text are documents of their own. A row without doc_id links with nothing and is not kept. An empty table gives no rows.
    """
    return grouped(docs, percent, words).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """Of each group of near copies one row: that of the smallest doc_id, and of its texts the one of the smallest hash.

    Rows without words or without doc_id are in no group and all stay. Of rows that repeat both doc_id and text one stays, any of
    them. All columns of docs pass through, whatever their names.
    """
    groups = cut(grouped(docs, percent, words).where("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "first"), "near-groups", free=True)
    lost = cut(groups.where("NOT first").select("_d", "_t").distinct(), "near-lost")
    again = groups.where("first").groupBy("_d", "_t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_d", "_t")
    place = F.xxhash64("_d", "_t")
    base = sifted(docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t")), place, sieve(lost.select(place.alias("at")), lost.count()))
    left = base.where("NOT _likely").unionByName(base.where("_likely").join(lost, ["_d", "_t"], "left_anti").select(*base.columns)).drop("_likely")
    if not again.isEmpty():
        again = cut(again, "near-again")
        left = left.join(again, ["_d", "_t"], "left_anti").unionByName(left.join(again, ["_d", "_t"], "left_semi").dropDuplicates(["_d", "_t"]))
    return left.select("_row.*")
