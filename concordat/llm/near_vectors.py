"""Near-duplicate embeddings by cross-polytope hashing.

A table of the index rotates vectors three times by fast Hadamard rotations. The largest component of each rotation, with its
sign, is a letter; three letters and the label are a vector's own bucket. Multiprobe: the vector is looked up in the buckets
of its 16 likeliest letter combinations too. Two vectors are a candidate pair when one's own bucket is among the other's
probes. For random pairs at cosine 0.98 in 64 dimensions a table finds 97 percent, so four tables miss one in a million.

Every candidate pair is held against the bound. A pair counts in the first bucket it shares only, so tables and probes add
no links twice. A task gets blocks of a bucket and gives a count for each vector, never a row for each pair. Equal vectors
are one class and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import components, cut, ship, sieve, sifted
from concordat.llm.vectors import group_changes, inner, matrix, rotate, usable, whole_groups

TABLES, LETTERS, PROBES, BLOCK = 4, 3, 16, 1024
_RUNNERS = 6


def codes(x: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """For each row its bucket numbers, tables x probes of them, all different but for -1 where there are no more; a table's own bucket comes first."""
    n, out = len(x), []
    mixes = np.array(list(product(range(_RUNNERS), repeat=LETTERS)))
    for t in range(tables):
        letters, loss = [], []
        for part in range(LETTERS):
            y = rotate(x, 7919 * t + part + 1)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :_RUNNERS]
            best = np.take_along_axis(y, top, 1)
            letters.append(2 * top + (best < 0))
            loss.append(np.abs(best[:, :1]) - np.abs(best))
        usual = mixes[(mixes < top.shape[1]).all(axis=1)]
        cost = sum(loss[k][:, usual[:, k]] for k in range(LETTERS))
        pick = usual[np.argsort(cost, axis=1, kind="stable")[:, :probes]]
        code = np.full(pick.shape[:2], t, np.int64)
        for k in range(LETTERS):
            code = code * (2 * y.shape[1]) + letters[k][np.arange(n)[:, None], pick[:, :, k]]
        if code.shape[1] < probes:  # short vectors have fewer letters
            code = np.hstack([code, np.full((n, probes - code.shape[1]), -1)])
        out.append(code)
    return np.hstack(out)


def near_vectors(vectors: DataFrame, cosine: float = 0.98, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Rows are compared when their labels are equal and not null. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do rows without vec_id. Vectors of another length than a partner's do not link with it.
    Repeated vectors are all linked to each other and to each one's partners. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    base = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    good = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # -0.0 and 0.0 are one number but two bit patterns
    keyed = base.where(good).withColumn("embedding", F.transform("embedding", lambda v: v + 0.0)).withColumn("key", F.sha2(F.concat_ws(" ", F.col("label"), F.to_json("embedding")), 256))
    counts = cut(keyed.groupBy("key", "label").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("embedding").alias("embedding")), "vector-classes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                for lo in range(0, part.num_rows, 2048):
                    some = part.slice(lo, 2048)
                    own = codes(matrix(some.column(3)), tables, probes)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, own.size + 1, own.shape[1], dtype=np.int32)), pa.array(own.ravel()))
                    yield pa.RecordBatch.from_arrays([*some.columns, lists], names=["rep", "label", "copies", "embedding", "codes"])

    index = cut(counts.select("rep", "label", "copies", "embedding").mapInArrow(hashed, "rep long, label string, copies long, embedding array<double>, codes array<long>"), "vector-codes")
    bucket = ["label", "dims", "code"]
    posts = index.select("rep", "label", F.size("embedding").alias("dims"), F.posexplode("codes").alias("at", "code")).where("code >= 0").withColumn("own", F.pmod("at", F.lit(probes)) == 0).drop("at")
    # most probes meet a bucket that is no vector's own: a sieve of the own buckets keeps them out of the shuffle
    own = posts.where("own").select(F.xxhash64(*bucket).alias("at")).distinct()
    posts = sifted(posts, F.xxhash64(*bucket), sieve(own, index.count() * tables)).where("_likely").drop("_likely")
    # a bucket of more than BLOCK vectors is cut into blocks by a hash; each pair of blocks is a task's worth
    sizes = posts.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.bool_or("own").alias("own")).where("n > 1 AND own").select(*bucket, F.ceil(F.col("n") / BLOCK).alias("blocks"))
    mine = posts.drop("own").join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pairs = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*bucket, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep")
    bundle = F.xxhash64(*bucket, "i", "j").alias("bundle")
    together = pairs.join(index.select("rep", "copies", "embedding", "codes"), "rep").select(bundle, "code", "i", "j", "block", "rep", "copies", "embedding", "codes").repartition("bundle").sortWithinPartitions("bundle", "code", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 4):
            code, i, j, block, rep, copies = (table.column(c).to_numpy() for c in (1, 2, 3, 4, 5, 6))
            lengths = pa.compute.list_value_length(table.column(7)).to_numpy()
            own = matrix(table.column(8)).astype(np.int64).reshape(len(rep), tables, probes)
            starts = np.flatnonzero(np.r_[True, group_changes(table, 4)])
            ends = np.r_[starts[1:], len(rep)]
            out = []
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                x = np.zeros((len(rep), d))
                x[rows] = matrix(table.column(7).take(pa.array(rows)))
                x[rows] /= np.sqrt(inner(x[rows], x[rows]))[:, None]
                here = lengths[starts] == d
                for p, q in pairs_within(starts[here], ends[here]):
                    close = np.einsum("ij,ij->i", x[p], x[q]) >= cosine - 1e-9
                    out.append(checked(p[close], q[close], x, own, code, i, j, block, cosine))
                for lo, hi in zip(starts[here], ends[here], strict=True):
                    if hi - lo > SMALL:
                        for at in range(lo, hi, 256):
                            p, q = np.nonzero(x[at : min(hi, at + 256)] @ x[lo:hi].T >= cosine - 1e-9)
                            p, q = p + at, q + lo
                            out.append(checked(p[p < q], q[p < q], x, own, code, i, j, block, cosine))
            p, q = (np.concatenate([np.empty(0, np.int64), *(o[k] for o in out)]) for k in (0, 1))
            if not len(p):
                continue
            both, with_ = np.concatenate([p, q]), np.concatenate([q, p])
            links = np.zeros(len(rep), np.int64)
            np.add.at(links, both, copies[with_])
            low = united(rep.copy(), p, q)
            rows = np.unique(both)
            yield pa.RecordBatch.from_arrays([pa.array(rep[rows]), pa.array(links[rows]), pa.array(low[rows])], names=["rep", "links", "low"])

    found = cut(together.mapInArrow(compare, "rep long, links long, low long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    group = components(found.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    classes = counts.select("key", "rep", "copies").join(links, "rep", "left").join(group.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = classes.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = keyed.select("vec_id", "key").join(per_class, "key").select("vec_id", "n_links", "component_id")
    alone = base.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


SMALL = 48


def pairs_within(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs p < q inside each group of at most SMALL rows, a few groups at a time."""
    fit = (ends - starts > 1) & (ends - starts <= SMALL)
    starts, sizes = starts[fit], (ends - starts)[fit]
    for lo in range(0, len(starts), 256):
        s, n = starts[lo : lo + 256], sizes[lo : lo + 256]
        square = n * n
        first = np.repeat(np.cumsum(square) - square, square)
        inside = np.arange(square.sum()) - first
        width, base = np.repeat(n, square), np.repeat(s, square)
        p, q = base + inside // width, base + inside % width
        yield p[p < q], q[p < q]


def checked(p: np.ndarray, q: np.ndarray, x: np.ndarray, own: np.ndarray, code: np.ndarray, i: np.ndarray, j: np.ndarray, block: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are as near as asked and whose first shared bucket this is, each pair of blocks having its own part."""
    keep_p, keep_q = [], []
    for lo in range(0, len(p), 8192):
        a, b = p[lo : lo + 8192], q[lo : lo + 8192]
        right = (i[a] == j[a]) | (block[a] != block[b])
        a, b = a[right], b[right]
        mine = first_shared(own[a], own[b]) == code[a]
        a, b = a[mine], b[mine]
        exact = inner(x[a], x[b]) >= cosine
        keep_p.append(a[exact])
        keep_q.append(b[exact])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *keep_p]), np.concatenate([none, *keep_q])


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the bucket of the first table in which one's own bucket is among the other's probes, the lesser of two; -1 for none."""
    out = np.full(len(a), -1)
    big = np.iinfo(np.int64).max
    for t in range(a.shape[1]):
        one = np.where((b[:, t] == a[:, t, :1]).any(axis=1), a[:, t, 0], big)
        two = np.where((a[:, t] == b[:, t, :1]).any(axis=1), b[:, t, 0], big)
        least = np.minimum(one, two)
        out = np.where((out < 0) & (least < big), least, out)
    return out


def united(low: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each row the least value that it reaches by the links (p, q)."""
    while True:
        least = np.minimum(low[p], low[q])
        new = low.copy()
        np.minimum.at(new, p, least)
        np.minimum.at(new, q, least)
        if (new == low).all():
            return new
        low = new
