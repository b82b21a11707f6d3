"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is padded with zeros to SPREAD times its length, rotated, and kept as the signs of the components (packed bits) and two
scalars: its length and how well the sign vector stands for the direction. A query's rotated components are rounded to PLANES bits; the
inner product with a sign vector is then a sum of population counts of ANDed words. That gives an unbiased estimate of the inner
product of vector and query, and a bound on the estimate's error.

Every vector lies in one block, and only queries go to all blocks. In the first pass each block scores, in double precision, the k
vectors that a query's estimates put first; the k-th largest score of all blocks is the query's threshold, and k vectors do reach it.
The second pass scores those whose upper bound reaches the threshold; the rest cannot be among the k nearest but with the chance that the
bound's width allows. What leaves a block is a few rows for each query, and thresholds are put together in two levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import cut, ship
from concordat.llm.vectors import inner, matrix, rotate, usable

SEED = 41
SPREAD = 4  # bits for each component of a vector
WIDTH = 2.5  # of the error bound in standard deviations of the estimate
PLANES = 4  # bits of a query's component
BLOCK, BLOCK_BYTES, BLOCKS = 65_536, 64 << 20, 24  # most vectors and bytes of a block; least number of blocks, where each then has 1024 vectors at least


def _wide(x: np.ndarray, seed: int) -> np.ndarray:
    size = max(64, SPREAD << max(1, (x.shape[1] - 1).bit_length()))
    return rotate(np.hstack([x, np.zeros((len(x), size - x.shape[1]))]), seed)


def one_bit(x: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs (64 to a word), lengths, and the inner product of each direction with its sign vector."""
    norm = np.sqrt(inner(x, x))
    y = _wide(x / norm[:, None], seed)
    return np.packbits(y > 0, axis=1, bitorder="little").view(np.uint64), norm, np.abs(y).sum(axis=1) / np.sqrt(y.shape[1])


def planes(queries: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rotated queries in PLANES bits a component: words of each bit (queries x planes x words), least value, step and sum of the rounded values."""
    q = _wide(queries, seed)
    low = q.min(axis=1)
    step = np.maximum((q.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
    level = np.rint((q - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([np.packbits(level >> j & 1, axis=1, bitorder="little").view(np.uint64) for j in range(PLANES)], axis=1)
    return bits, low, step, low * q.shape[1] + step * level.sum(axis=1)


class Codes:
    """The codes of a block, with a word's column contiguous, and what an estimate needs of them."""

    def __init__(self, bits: np.ndarray, norm: np.ndarray, fit: np.ndarray):
        self.words = np.ascontiguousarray(bits.T)
        self.ones = np.bitwise_count(self.words).sum(axis=0, dtype=np.float32)
        size = 64 * len(self.words)
        self.scale = (norm / (fit * np.sqrt(size))).astype(np.float32)
        # standard deviation for a query of length one: of the code, and of the query's rounding (added by step)
        self.spread = (norm * np.sqrt(np.maximum(0, 1 - fit**2)) / fit / np.sqrt(max(1, size - 1))).astype(np.float32)

    def bounds(self, bits: np.ndarray, low: float, step: float, total: float, length: float, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with one query, and the half-width of the interval around each."""
        counts = np.bitwise_count(self.words[None] & bits[:, :, None]).sum(axis=1, dtype=np.uint16)
        inside = np.exp2(np.arange(PLANES, dtype=np.float32)) @ counts.astype(np.float32)
        # the sign vector is +1 where a bit is set and -1 elsewhere
        estimate = (np.float32(2 * low) * self.ones + np.float32(2 * step) * inside - np.float32(total)) * self.scale
        rounding = step / np.sqrt(12) * np.sqrt(64 * len(self.words))
        return estimate, np.float32(width) * np.sqrt((np.float32(length) * self.spread) ** 2 + (np.float32(rounding) * self.scale) ** 2)


def search(vectors: DataFrame, is_query: Column, k: int = 20, width: float = WIDTH) -> DataFrame:
    """For each row of vectors (vec_id, embedding) that is_query holds for, its k nearest others: query_id, rank, vec_id, score.

    score is the inner product in double precision, summed in order; the nearest come first, ties go to the smaller vec_id.
    Rows whose vector is null, empty, zero or holds null or non-finite components, or whose vec_id is null, take no part;
    vectors of different lengths do not meet. Only the query's own row is not its neighbour: rows that repeat a vec_id are each a
    candidate, and each a query with k neighbours of its own. An empty table, or one without queries, gives no rows.
    """
    ship(vectors.sparkSession)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                bits, norm, fit = one_bit(matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r.tobytes() for r in bits], pa.binary()), pa.array(norm), pa.array(fit)], names=["vec_id", "embedding", "asks", "row", "bits", "norm", "fit"])

    coded = base.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).mapInArrow(code, "vec_id long, embedding array<double>, asks boolean, row long, bits binary, norm double, fit double")
    index = cut(coded.withColumn("embedding", F.col("embedding").cast(kind)).withColumn("dims", F.size("embedding")), "one-bit-codes")
    # a row for each length of vectors; lengths are few
    sizes = index.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked"))
    most = F.least(F.lit(BLOCK), F.greatest(F.lit(1024), F.lit(BLOCK_BYTES) / (8 * F.col("dims"))))
    blocks = sizes.where("asked > 0").select("dims", F.greatest(F.ceil(F.col("n") / most), F.least(F.ceil(F.col("n") / 1024), F.lit(BLOCKS))).cast("int").alias("blocks"))
    placed = index.join(blocks, "dims").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    every = placed.where("asks").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]

    def told(role: int, df: DataFrame, *columns) -> DataFrame:
        return df.select("dims", "block", F.lit(role).alias("role"), "row", *columns)

    together = lambda a, b: a.unionByName(b).repartition("dims", "block").sortWithinPartitions("dims", "block", "role")
    full = told(0, placed, "bits", "norm", "fit", "embedding", "vec_id", *none(("least", "double")))
    asking = told(1, every, *none(("bits", "binary"), ("norm", "double"), ("fit", "double")), "embedding", "vec_id", *none(("least", "double")))

    def first_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (own, have, x, _), part in by_block(batches, _block):
            rows, q, found = part.column(3).to_numpy(), matrix(part.column(7)), []
            for i, (estimate, _half) in enumerate(_each(q, have, width)):
                other = np.flatnonzero(own != rows[i])
                if len(other) > k:
                    other = other[np.argpartition(estimate[other], len(other) - k)[len(other) - k :]]
                found.append(x[other] @ q[i])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([part.column(3), pa.compute.bit_wise_and(part.column(1).cast(pa.int64()), 63), lists], names=["row", "part", "scores"])

    scores = together(full, asking).mapInArrow(first_scores, "row long, part long, scores array<double>")
    # the k-th largest of the blocks' largest; a query with fewer candidates has no threshold
    best = F.slice(F.sort_array(F.flatten(F.collect_list("scores")), asc=False), 1, k).alias("scores")
    kth = F.when(F.size("scores") >= k, F.element_at("scores", k)).otherwise(float("-inf")).alias("least")
    thresholds = cut(scores.groupBy("row", "part").agg(best).groupBy("row").agg(best).select("row", kth), "one-bit-thresholds")

    known = every.join(thresholds, "row")
    knowing = told(1, known, *none(("bits", "binary"), ("norm", "double"), ("fit", "double")), "embedding", "vec_id", "least")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (own, have, x, ids), part in by_block(batches, _block):
            rows, names, least, q = part.column(3).to_numpy(), part.column(8).to_numpy(), part.column(9).to_numpy(), matrix(part.column(7))
            out = []
            for i, (estimate, half) in enumerate(_each(q, have, width)):
                # a little below, as the threshold is a product of matrices and rounds otherwise than sums in order
                pick = np.flatnonzero((estimate + half >= least[i] - 1e-6 * (1 + abs(least[i]))) & (own != rows[i])) if np.isfinite(least[i]) else np.flatnonzero(own != rows[i])
                if len(pick) > k:  # rounding differs between a product of matrices and sums in order, so all near the k-th stay
                    score = x[pick] @ q[i]
                    edge = np.partition(score, len(score) - k)[len(score) - k]
                    pick = pick[score >= edge - 1e-9 * (1 + abs(edge))]
                if len(pick):
                    score = inner(x[pick], np.broadcast_to(q[i], (len(pick), q.shape[1])))
                    top = np.lexsort((ids[pick], -score))[:k]
                    out.append((np.full(len(top), rows[i]), np.full(len(top), names[i]), ids[pick][top], score[top]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["row", "query_id", "vec_id", "score"])

    near = together(full, knowing).mapInArrow(rerank, "row long, query_id long, vec_id long, score double")
    first = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(t: pa.Table) -> tuple[np.ndarray, Codes, np.ndarray, np.ndarray]:
    """Row numbers, codes, vectors and ids of a block's vectors."""
    bits = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint64).reshape(len(t), -1)
    return t.column(3).to_numpy(), Codes(bits, t.column(5).to_numpy(), t.column(6).to_numpy()), matrix(t.column(7)), t.column(8).to_numpy()


def _each(queries: np.ndarray, have: Codes, width: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.sqrt(inner(queries, queries))
    for bits, low, step, total, length in zip(*planes(queries), lengths, strict=True):
        yield have.bounds(bits, low, step, total, length, width)


def by_block(batches: Iterator[pa.RecordBatch], hold) -> Iterator[tuple]:
    """(what hold makes of a block's vectors, some of its queries), from rows sorted by dims, block and role (0: vectors, 1: queries).

    A block's vectors are held, its queries pass through batch by batch.
    """
    block, parts, held = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        for lo, hi in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
            part, own = batch.slice(lo, hi - lo), tuple(keys[lo, :2])
            if own != block:
                block, parts, held = own, [], None
            if keys[lo, 2] == 0:
                parts.append(part)
            elif parts or held is not None:
                if held is None:
                    held, parts = hold(pa.Table.from_batches(parts).combine_chunks()), []
                for at in range(0, part.num_rows, 512):
                    yield held, part.slice(at, 512)
