"""Quality of documents: a classifier's evidence combined with what the rest of the document's site shows (empirical Bayes).

Evidence: boosted stumps over shares of character classes, repetition, single words and their beginnings, fitted on a bounded sample of labelled
documents (MAX_LABELLED) and applied to whole texts. Sites: the evidence is summed by host and by path within the host. A host's
rate is drawn towards the global one and a path's towards its host's, the more the fewer documents there are; how much is
estimated from the variance between and within groups (one-way analysis of variance, method of moments). A document's own
evidence is left out of its site's rate, and the site's rate takes the place of the global one as the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import cut, ship
from concordat.llm.shingles import buffers, shingles, words

MAX_LABELLED = 8000  # labelled documents that the classifier is fitted on: those whose doc_id has the smallest hashes
VOCABULARY = 10_000
MIN_DOCUMENTS = 8  # that a word must be in to count
PREFIXES = (4, 5, 6)  # bytes at the beginning of a word that count as a feature: inflected words share them
ROUNDS, RATE, STEPS = 160, 0.8, 24
EDGE = 1e-4  # evidence stays this far from 0 and 1

_APART = np.ones(256, bool)  # words for the classifier are runs of letters and digits
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _APART[_lo:_hi] = False
_CLASSES = np.zeros((7, 256), np.int8)
_CLASSES[0, [32, *range(9, 14)]] = 1
_CLASSES[1, 65:91] = 1
_CLASSES[2, 48:58] = 1
_CLASSES[3, list(b"!*#$%&")] = 1
_CLASSES[4, list(b"|<>{}[]\\/")] = 1
_CLASSES[5, 10] = 1
_CLASSES[6] = _APART
_CLASSES[6, [32, *range(9, 14)]] = 0


def measure(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each text its numbers, the hashes of its distinct words and of its words' beginnings (these with repeats), and the least
    hash of its shingles (-1: none)."""
    for data, bounds in buffers(texts):
        sums = (np.concatenate([[0], np.cumsum(row[data], dtype=np.int64)]) for row in _CLASSES)  # one at a time
        counts = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
        sizes = np.maximum(1, np.diff(bounds))
        hashes, before = words(data, bounds, _APART, PREFIXES)
        for i, (lo, hi) in enumerate(zip(before[:-1], before[1:], strict=True)):
            own = hashes[0, lo:hi]
            distinct, often = np.unique(own, return_counts=True)
            n = max(1, len(own))
            repeated = int((own[1:] == own[:-1]).sum())
            numbers = np.array([*(counts[i] / sizes[i]), np.log1p(len(own)), len(distinct) / n, (often.max() if len(often) else 0) / n, repeated / n, sizes[i] / n])
            some = shingles(own, 5)
            yield numbers, np.concatenate([distinct, hashes[1:, lo:hi].ravel()]).view(np.int64), int(some[0]) if len(some) else -1


@dataclass
class Stumps:
    """Log odds: a start, steps for numbers above thresholds, and steps for words that occur."""

    start: float = 0.0
    numbers: list[tuple[int, float, float]] = field(default_factory=list)
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    def chance(self, numbers: np.ndarray, distinct: np.ndarray) -> float:
        total = self.start + sum(w for k, t, w in self.numbers if numbers[k] > t)
        if len(self.words) and len(distinct):
            at = np.searchsorted(self.words, distinct)
            at[at == len(self.words)] = 0
            total += self.weights[np.unique(at[self.words[at] == distinct])].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(numbers: np.ndarray, rows: np.ndarray, cols: np.ndarray, vocabulary: np.ndarray, y: np.ndarray) -> Stumps:
    """Boosting by Newton steps on the log loss; each round takes the indicator with the largest gain."""
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Stumps(float(np.log(base / (1 - base))))
    if y.min() == y.max():
        return model
    cuts = [(k, t) for k in range(numbers.shape[1]) for t in np.unique(np.quantile(numbers[:, k], np.linspace(0, 1, STEPS + 1)[:-1]))]
    above = np.stack([numbers[:, k] > t for k, t in cuts], axis=1).astype(np.float32)
    score, steps, weights = np.full(len(y), model.start), np.zeros(len(cuts)), np.zeros(len(vocabulary))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        model.start += (shift := RATE * g.sum() / (h.sum() + 1))
        score += shift
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        gs = np.concatenate([above.T @ g.astype(np.float32), np.bincount(cols, g[rows], len(vocabulary))])
        hs = np.concatenate([above.T @ h.astype(np.float32), np.bincount(cols, h[rows], len(vocabulary))])
        gain = gs**2 / (hs + 1)
        best = int(gain.argmax())
        if gain[best] < 6:
            break
        step = float(np.clip(RATE * gs[best] / (hs[best] + 1), -4, 4))
        if best < len(cuts):
            steps[best] += step
            score += step * above[:, best]
        else:
            weights[best - len(cuts)] += step
            score[rows[cols == best - len(cuts)]] += step
    used = np.flatnonzero(weights)
    model.numbers = [(k, float(t), float(s)) for (k, t), s in zip(cuts, steps, strict=True) if s]
    model.words, model.weights = vocabulary[used], weights[used]
    return model


def train(docs: DataFrame, labels: DataFrame) -> tuple[Stumps, Stumps] | None:
    """Models for quality and toxicity, or None without labelled documents.

    Of the sample, documents that share their least shingle hash count once, so that copies do not outvote the rest.
    """
    ship(docs.sparkSession)
    some = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    # of labels that contradict each other the worse holds
    some = some.groupBy("label_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).orderBy(F.xxhash64("label_id"), "label_id").limit(MAX_LABELLED)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(measure(batch.column(3)))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([f[0].tolist() for f in found]), pa.array([np.unique(f[1]) for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found])], names=["doc_id", "quality", "toxic", "numbers", "words", "least"])

    # at most MAX_LABELLED rows of three numbers are broadcast
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), F.col("doc_id") == F.col("label_id"))
    sample = cut(joined.select("doc_id", "quality", "toxic", "text").mapInArrow(measured, "doc_id long, quality int, toxic int, numbers array<double>, words array<long>, least long"), "labelled")
    once = cut(sample.groupBy("least").agg(F.min_by(F.struct("doc_id", "quality", "toxic", "numbers", "words"), "doc_id").alias("x")).select("x.*"), "labelled-once")
    per_word = once.select("quality", "toxic", F.explode("words").alias("word")).where("word <> 0").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("q"), F.sum("toxic").alias("t")).where(F.col("n") >= MIN_DOCUMENTS)
    totals = once.agg(F.count(F.lit(1)).alias("n"), F.avg("quality").alias("q"), F.avg("toxic").alias("t")).first()
    if not totals["n"]:
        return None
    far = lambda c: F.abs(F.col(c) - F.col("n") * totals[c]) / F.sqrt(F.col("n") * max(totals[c] * (1 - totals[c]), 1e-6))
    chosen = per_word.orderBy(F.greatest(far("q"), far("t")).desc(), "word").limit(VOCABULARY)
    vocabulary = np.array(sorted(r["word"] for r in chosen.select("word").collect()), dtype=np.int64)  # at most VOCABULARY numbers

    if not len(vocabulary):
        vocabulary = np.array([-1], np.int64)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            flat, ends = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_numpy()])
            at = np.searchsorted(vocabulary, flat)
            at[(at == len(vocabulary)) | (vocabulary[np.minimum(at, len(vocabulary) - 1)] != flat)] = -1
            kept = [(own := at[lo:hi])[own >= 0].astype(np.int32) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(kept, pa.list_(pa.int32()))], names=["doc_id", "quality", "toxic", "numbers", "words"])

    # at most MAX_LABELLED rows of a few numbers and of indexes into the vocabulary come to the driver
    table = once.mapInArrow(known, "doc_id long, quality int, toxic int, numbers array<double>, words array<int>").orderBy("doc_id").toArrow()
    numbers = np.array(table.column("numbers").to_pylist())
    lists = table.column("words").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    rows, cols = np.repeat(np.arange(len(lists), dtype=np.int32), lengths), lists.flatten().to_numpy()
    models = tuple(fit(numbers, rows, cols, vocabulary, table.column(c).to_numpy().astype(np.float64)) for c in ("quality", "toxic"))
    del numbers, table, lists, lengths, rows, cols  # Arrow would keep the sample's memory for the driver's lifetime
    pa.default_memory_pool().release_unused()
    return models


def evidence(docs: DataFrame, models: tuple[Stumps, Stumps] | None, host: Column, path: Column) -> DataFrame:
    """doc_id, text_hash, host, path, quality and toxic (chances from the text alone) and n_words (0 or 1: whether there are any)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, bad, n = [], [], []
            for numbers, distinct, _ in measure(batch.column(4)):
                good.append(models[0].chance(numbers, distinct) if models else 0.5)
                bad.append(models[1].chance(numbers, distinct) if models else 0.0)
                n.append(int(numbers[7] > 0))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(good, pa.float64()), pa.array(bad, pa.float64()), pa.array(n, pa.int64())], names=["doc_id", "text_hash", "host", "path", "quality", "toxic", "n_words"])

    keys = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((host, "host"), (path, "path"))]
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), *keys, "text").mapInArrow(run, "doc_id long, text_hash long, host string, path string, quality double, toxic double, n_words long")
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(EDGE)), F.lit(1 - EDGE))
    return raw.withColumns({c: inside(c) for c in ("quality", "toxic")})


def strength(n: float, groups: int, squares: float, between: float, within: float, mean: float) -> float:
    """How many documents the prior of a group is worth: mean (1 - mean) / variance between groups - 1.

    n documents in groups; squares: sum of squared group sizes over the size of what they are part of; between, within: sums of squares.
    """
    if groups < 2 or n <= groups:
        return 1e6
    size = (n - squares) / (groups - 1)
    variance = (between / (groups - 1) - within / (n - groups)) / max(size, 1e-9)
    spread = mean * (1 - mean)
    return float(np.clip(spread / variance - 1, 1.0, 1e6)) if variance > 0 and spread > 0 else 1e6


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, text_hash, host, path, quality, toxic (posterior chances), host_quality, path_quality (rates without the document) and kept.

    kept: quality at least one half and toxicity below it. A text that is null or has no words is not kept. Null hosts and
    paths are the group ''. Rows that repeat a doc_id each count. Without labels every text with words has evidence 0.5 and is
    kept. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    own = cut(evidence(docs, train(docs, labels), host, path), "evidence")
    some = own.where("n_words > 0")
    sums = [F.count(F.lit(1)).alias("n"), *(f(c if k == 1 else F.col(c) * F.col(c)).alias(f"{c}{k}") for c in ("quality", "toxic") for k, f in ((1, F.sum), (2, F.sum)))]
    paths = cut(some.groupBy("host", "path").agg(*sums), "paths")
    add = [F.sum(c).alias(c) for c in ("n", "quality1", "quality2", "toxic1", "toxic2")]
    hosts = paths.groupBy("host").agg(*add, F.count(F.lit(1)).alias("paths"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("quality1") ** 2 / F.col("n")).alias("quality_p"), F.sum(F.col("toxic1") ** 2 / F.col("n")).alias("toxic_p"))
    total = hosts.agg(*add, F.count(F.lit(1)).alias("hosts"), F.sum("paths").alias("paths"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("nn") / F.col("n")).alias("nnp"), *(f for c in ("quality", "toxic") for f in (F.sum(F.col(f"{c}1") ** 2 / F.col("n")).alias(f"{c}_h"), F.sum(f"{c}_p").alias(f"{c}_p")))).first()
    n = total["n"] or 0
    mean, for_host, for_path = {}, {}, {}
    for c in ("quality", "toxic"):
        mean[c] = min(1 - EDGE, max(EDGE, total[f"{c}1"] / n)) if n else 0.5
        if n:
            for_host[c] = strength(n, total["hosts"], total["nn"] / n, total[f"{c}_h"] - n * mean[c] ** 2, total[f"{c}2"] - total[f"{c}_h"], mean[c])
            # paths within hosts: each host loses one degree of freedom
            groups = total["paths"] - total["hosts"] + 1
            for_path[c] = strength(n - total["hosts"] + 1, groups, total["nnp"] - total["hosts"] + 1, total[f"{c}_p"] - total[f"{c}_h"], total[f"{c}2"] - total[f"{c}_p"], mean[c])
        else:
            for_host[c] = for_path[c] = 1e6
    sites = paths.select("host", "path", F.col("n").alias("pn"), *(F.col(f"{c}1").alias(f"p_{c}") for c in mean)).join(hosts.select("host", F.col("n").alias("hn"), *(F.col(f"{c}1").alias(f"h_{c}") for c in mean)), "host")
    joined = own.join(sites, ["host", "path"], "left")
    odds = lambda x: F.log(x / (1 - x))
    inside = lambda x: F.least(F.greatest(x, F.lit(EDGE)), F.lit(1 - EDGE))
    here = F.when(F.col("n_words") > 0, 1).otherwise(0)
    out = {}
    for c in mean:
        x = F.col(c) * here
        out[f"host_{c}"] = inside((F.coalesce(f"h_{c}", F.lit(0.0)) - x + for_host[c] * mean[c]) / (F.coalesce("hn", F.lit(0)) - here + for_host[c]))
        out[f"path_{c}"] = inside((F.coalesce(f"p_{c}", F.lit(0.0)) - x + for_path[c] * F.col(f"host_{c}")) / (F.coalesce("pn", F.lit(0)) - here + for_path[c]))
        out[f"post_{c}"] = 1 / (1 + F.exp(-(odds(F.col(c)) + odds(F.col(f"path_{c}")) - float(np.log(mean[c] / (1 - mean[c]))))))
    for name, column in out.items():
        joined = joined.withColumn(name, column)
    # with no labels the posterior is a half up to rounding
    kept = (F.col("n_words") > 0) & (F.col("post_quality") >= 0.5 - 1e-9) & (F.col("post_toxic") < 0.5)
    return joined.select("doc_id", "text_hash", "host", "path", F.col("post_quality").alias("quality"), F.col("post_toxic").alias("toxic"), "host_quality", "path_quality", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score() keeps, by source as host and language as path. Rows without doc_id go.

    Rows that repeat a doc_id with another text are each judged; of rows that repeat both, which may have different sources, all
    stay if one does. All columns of docs pass through, whatever their names.
    """
    found = score(docs, labels, F.col("source"), F.col("lang"))
    good = found.where("kept").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    base = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"))
    return base.join(good, ["_d", "_t"], "left_semi").select("_row.*")
