"""Mixing sources to target weights: budgets for a domain-language-source tree, with DataFrame functions only.

A node's budget is shared among its children by weight. A child cannot get more than its subtree holds; what it cannot take goes
to its siblings by weight, and only what all of them cannot take is missing from the parent's own capacity, so it has been
shared among the parent's siblings already. Each leaf then takes whole epochs and the prefix of one more, in an order
that a seed and the epoch's number fix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import cut


def shared_out(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """Add target: each node's part of its parent's budget, by weight, none above cap (weighted water-filling).

    Children stand in order of cap / weight. Those whose fair part of what is left exceeds their cap get the cap; the rest share
    what remains at one level. nodes: parent columns, node, weight (long), cap (long).
    """
    order = [F.col("cap") / F.col("weight"), F.col("node")]
    w = Window.partitionBy(*parent).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = nodes.withColumns({"_c": F.coalesce(F.sum("cap").over(before), F.lit(0)), "_w": F.sum("weight").over(after), "_b": budget})
    level = (F.col("_b") - F.col("_c")) / F.col("_w")
    ranked = ranked.withColumn("_level", F.when(F.col("cap") <= F.col("weight") * level, None).otherwise(level))
    full = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.first("_level", ignorenulls=True).over(full)
    return ranked.withColumn("target", F.when(at.isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * at))).drop("_c", "_w", "_b", "_level")


def leaf_targets(stats: DataFrame, weights: dict[str, Column], total: float, max_epochs: int) -> DataFrame:
    """Targets of the leaves. stats: one column for each level (the keys of weights), tokens (long); weights are expressions over a
    level's columns and those above it, with whole values; a weight that is null or below one counts as one."""
    levels = list(weights)
    nodes = None
    for k, name in enumerate(levels):
        path = levels[: k + 1]
        here = stats.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumns({"weight": F.greatest(F.coalesce(weights[name].cast("long"), F.lit(1)), F.lit(1)), "node": F.col(name)})
        if nodes is None:
            got = shared_out(here.withColumn("_root", F.lit(0)), ["_root"], F.lit(float(total)))
        else:
            got = shared_out(here.join(nodes, path[:-1]), path[:-1], F.col("budget"))
        nodes = got.select(*path, F.col("target").alias("budget"))
    return nodes.withColumnRenamed("budget", "target")


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, Column], share: float, max_epochs: int, seed: int = 17, carry: dict[str, Column] | None = None) -> DataFrame:
    """Choose documents so that the leaves' tokens meet their targets: doc_id, the levels, tokens, epoch, leaf_target, and what to carry.

    levels: name -> expression, from the root's children to the leaves; nulls count as ''. tokens are a quarter of the text's
    bytes, rounded up (null: 0). The total budget is share x all tokens. A row of the result is a document in an epoch. A leaf's
    documents stand in the order of md5(seed, epoch, doc_id); the prefix whose tokens do not exceed the rest of the target
    is taken. Ties go by doc_id and tokens. Rows that repeat a doc_id are each a document. Documents without tokens cost
    nothing and are taken with the prefix they stand in. An empty table gives no rows.
    """
    names, more = list(levels), carry or {}
    narrow = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(e.alias(n) for n, e in more.items()), *(F.coalesce(e.cast("string"), F.lit("")).alias(n) for n, e in levels.items()), F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4).cast("long").alias("tokens")), "mix-documents")
    stats = cut(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = stats.agg(F.sum("tokens")).first()[0] or 0  # one row
    targets = leaf_targets(stats, weights, total * share, max_epochs).join(stats.withColumnRenamed("tokens", "_leaf"), names)
    goal = targets.withColumn("_whole", F.when(F.col("_leaf") > 0, F.floor(F.col("target") / F.col("_leaf"))).otherwise(0).cast("int")).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("_leaf"))
    # few leaves, but not provably few: the planner may broadcast this table if it is small
    keyed = narrow.join(goal, names).withColumn("_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    # a leaf can hold a third of all rows: sums by the key's first digits, then a running sum inside such a bucket
    bucketed = keyed.withColumn("_bucket", F.substring("_key", 1, 3))
    sums = bucketed.groupBy(*names, "_bucket").agg(F.sum("tokens").alias("_sum"))
    upto = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*names, "_bucket", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*names, "_bucket").orderBy("_key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # both sides are dealt by leaf and bucket: by leaf alone a hot leaf would be one task's
    part = [*names, "_bucket"]
    running = bucketed.repartition(*part).withColumn("_in", F.sum("tokens").over(inside)).join(offsets.repartition(*part), part)
    last = F.when(F.col("_in") + F.col("_before") <= F.col("_rest"), F.col("_whole")).otherwise(F.col("_whole") - 1)
    epochs = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda e: (e <= last) & (e < max_epochs))
    return running.select("doc_id", *names, "tokens", F.explode(epochs).alias("epoch"), F.col("target").alias("leaf_target"), *more)


def domain_of(source: Column) -> Column:
    """A source's name as far as its first digit."""
    return F.regexp_extract(source, "^([^0-9]*[0-9]?)", 1)


def document_tree() -> tuple[dict[str, Column], dict[str, Column]]:
    """Levels and weights for the documents table: equal domains, English above other languages, equal sources."""
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    language = F.when(F.col("lang") == "en", 4).when(F.col("lang").isin("de", "fr", "es"), 2).otherwise(1)
    return levels, {"domain": F.lit(1), "lang": language, "source": F.lit(1)}
