"""Do two tables agree: row counts, keys on one side only, digests, and values that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.canon import SEPARATOR, NoCommonTypeError, against, canonical, strict_digest, table_digest


def rowcounts(pairs: dict[str, tuple[DataFrame, DataFrame]], where: dict[str, str] | None = None) -> DataFrame:
    """One row for each table: counts of both sides, their difference (target - source) and MATCH or MISMATCH.

    where filters the source side only. All counts are one job: a union of one-row aggregates.
    """
    parts = []
    for name, (source, target) in pairs.items():
        condition = (where or {}).get(name)
        one = source.where(condition) if condition else source
        for side, df in ((1, one), (2, target)):
            parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    both = out.groupBy("table_name").agg(F.sum(F.when(F.col("side") == 1, F.col("n"))).alias("source_count"), F.sum(F.when(F.col("side") == 2, F.col("n"))).alias("target_count"))
    same = F.col("source_count") == F.col("target_count")
    return both.select("table_name", "source_count", "target_count", (F.col("target_count") - F.col("source_count")).alias("row_count_diff"), same.alias("row_count_match"), F.when(same, "MATCH").otherwise("MISMATCH").alias("status"))


def key_balance(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Each key that does not occur equally often on both sides, with balance: how much more often in the source.

    Every row counts +1 or -1 and one aggregation by key adds up, so there is one shuffle, combined before it; keys keep their
    types, nulls equal nulls only, and repeated keys pair off one to one.
    """
    signed = lambda df, sign: df.select(*keys, F.lit(sign).cast("long").alias("_sign"))
    total = signed(source, 1).unionByName(signed(target, -1)).groupBy(*keys).agg(F.sum("_sign").alias("balance"))
    return total.where("balance <> 0")


def key_diff_summary(source: DataFrame, target: DataFrame, keys: list[str], sample_limit: int = 1000) -> DataFrame:
    """One row: keys only in the source and only in the target, the sample sizes, whether samples are cut short, and a status."""
    b = key_balance(source, target, keys)
    one = F.coalesce(F.sum(F.when(F.col("balance") > 0, F.col("balance"))), F.lit(0))
    two = F.coalesce(F.sum(F.when(F.col("balance") < 0, -F.col("balance"))), F.lit(0))
    out = b.agg(one.alias("source_only"), two.alias("target_only"))
    limit = F.lit(sample_limit).cast("long")
    return out.select(
        "source_only",
        "target_only",
        F.least("source_only", limit).alias("source_sample"),
        F.least("target_only", limit).alias("target_sample"),
        ((F.col("source_only") > limit) | (F.col("target_only") > limit)).alias("sample_truncated"),
        F.when((F.col("source_only") == 0) & (F.col("target_only") == 0), "MATCH").otherwise("MISMATCH").alias("status"),
    )


def keys_only(source: DataFrame, target: DataFrame, keys: list[str], side: str) -> DataFrame:
    """The keys that one side ("source" or "target") has more often, each as often as it is ahead."""
    b = key_balance(source, target, keys)
    ahead = F.col("balance") if side == "source" else -F.col("balance")
    return b.where(ahead > 0).withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), ahead))).select(*keys)


def key_sample(source: DataFrame, target: DataFrame, keys: list[str], side: str, limit: int) -> DataFrame:
    """The first `limit` of keys_only(), a top-k without a full sort."""
    return keys_only(source, target, keys, side).orderBy(*keys).limit(limit)


def comparable(source: DataFrame, target: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with what their values are compared by, and its names: columns of one type as they are, those of two types as texts by
    canon.against(); a column that the target lacks is null there."""
    a, b, names, odd = source, target, [], []
    for c in columns:
        mine = source.schema[c].dataType
        other = target.schema[c].dataType if c in target.columns else None
        if other is None:
            b = b.withColumn(c, F.lit(None).cast(mine))
        if other is None or mine == other:
            names.append(c)
            continue
        try:
            a, b = a.withColumn(f"{c} (as text)", against(F.col(c), mine, other)), b.withColumn(f"{c} (as text)", against(F.col(c), other, mine))
            names.append(f"{c} (as text)")
        except NoCommonTypeError as e:
            odd.append(f"{c}: {e}")
    if odd:
        raise NoCommonTypeError("; ".join(odd))
    return a, b, names


def checksum(source: DataFrame, target: DataFrame, columns: list[str], chunk: Column | None = None, strict: bool = False) -> DataFrame:
    """Digests of both sides, for the table or for each chunk, with a status; a chunk of one side only is a MISMATCH.

    Columns of two types are compared in a form that both fit, never by narrowing one; types that have none are refused. Rows without a
    chunk key are a chunk of their own. strict compares exact sorted rows and needs chunks, of bounded size.
    """
    source, aligned, columns = comparable(source, target, columns)
    digest = strict_digest if strict else table_digest
    # without groups an empty table has a digest too
    one = lambda df: digest(df, columns).withColumn("chunk_key", F.lit("table")) if chunk is None else digest(df, columns, chunk.cast("string").alias("chunk_key"))
    a, b = (one(df).select("chunk_key", F.col("rows").alias(f"row_count_{side}"), F.col("digest").alias(f"{side}_hash")) for df, side in ((source, "source"), (aligned, "target")))
    both = a.join(b.withColumnRenamed("chunk_key", "_chunk"), F.col("chunk_key").eqNullSafe(F.col("_chunk")), "full_outer").withColumn("chunk_key", F.coalesce("chunk_key", "_chunk"))
    zero = {f"row_count_{s}": F.coalesce(f"row_count_{s}", F.lit(0)) for s in ("source", "target")}
    same = F.coalesce(F.col("source_hash") == F.col("target_hash"), F.lit(False))
    return both.withColumns(zero).select("chunk_key", "source_hash", "target_hash", "row_count_source", "row_count_target", F.when(same, "MATCH").otherwise("MISMATCH").alias("status"))


def checksum_summary(chunks: DataFrame) -> DataFrame:
    """Chunks of a table in one row: MISMATCH if any, total rows, the single hash or how many chunks there were."""
    n = F.count(F.lit(1))
    text = lambda c: F.when(n == 1, F.max(c)).otherwise(F.concat(n.cast("string"), F.lit(" chunks")))
    return chunks.agg(
        n.alias("chunks"),
        F.coalesce(F.sum("row_count_source"), F.lit(0)).alias("row_count_source"),
        F.coalesce(F.sum("row_count_target"), F.lit(0)).alias("row_count_target"),
        text("source_hash").alias("source_hash"),
        text("target_hash").alias("target_hash"),
        F.when(F.coalesce(F.bool_or(F.col("status") == "MISMATCH"), F.lit(False)), "MISMATCH").otherwise("MATCH").alias("status"),
    )


def checksum_columns(df: DataFrame, exclude: tuple[str, ...] = (), only: tuple[str, ...] = ()) -> list[str]:
    """Columns that a checksum covers: those asked for, or all but long binary and nested ones, without the excluded."""
    out = {c.lower() for c in exclude}
    plain = lambda d: d != "binary" and not d.startswith(("array", "map", "struct", "variant"))
    return [c for c, d in df.dtypes if c.lower() not in out and (c in only if only else plain(d))]


def sample_rows(df: DataFrame, keys: list[str], percent: float) -> DataFrame:
    """The same share of keys on either side: chosen by a hash of the keys, so equal keys meet in both samples."""
    h = F.conv(F.substring(F.md5(F.concat_ws(SEPARATOR, *(canonical(F.col(k), df.schema[k].dataType) for k in keys))), 1, 8), 16, 10).cast("long")
    return df.where(F.pmod(h, F.lit(10_000)) < F.lit(int(percent * 100)))


REPEATED = "(rows with the key)"


def value_diff(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A row for each common key and column whose values differ: keys, column_name, source_value, target_value (canonical texts).

    Columns of two types are compared as by checksum(), keys in the wider type, and null keys equal null keys. Rows of a key that a side has more than once cannot be paired: such a
    key gives one row, with column_name REPEATED and the numbers of rows. One aggregation by key, combined before the shuffle.
    """
    one, two, names = comparable(source, target, columns)
    cells = lambda df: F.array(*(canonical(F.col(c), df.schema[c].dataType) for c in names))
    wide = source.select(*keys).union(target.select(*keys)).schema  # whose types fit both sides' keys
    texts = lambda df, side: df.select(*(F.col(k).cast(wide[k].dataType).alias(k) for k in keys), F.lit(side).alias("_side"), cells(df).alias("_cells"))
    of = lambda side, c: F.when(F.col("_side") == side, c)
    both = texts(one, 0).unionByName(texts(two, 1)).groupBy(*keys).agg(*(f.alias(f"_{n}{side}") for side in (0, 1) for n, f in (("n", F.count(of(side, F.lit(1)))), ("c", F.max(of(side, F.col("_cells")))))))
    once = (F.col("_n0") == 1) & (F.col("_n1") == 1)
    row = lambda name, a, b: F.struct(F.lit(name).alias("column_name"), a.alias("source_value"), b.alias("target_value"))
    apart = F.filter(F.array(*(row(c, F.col("_c0")[i], F.col("_c1")[i]) for i, c in enumerate(columns))), lambda x: x["source_value"] != x["target_value"])
    rows = F.when(once, apart).otherwise(F.array(row(REPEATED, F.col("_n0").cast("string"), F.col("_n1").cast("string"))))
    return both.where("_n0 > 0 AND _n1 > 0").select(*keys, F.explode(rows).alias("_x")).select(*keys, "_x.*")


def value_diff_by_column(diff: DataFrame) -> DataFrame:
    return diff.groupBy("column_name").agg(F.count(F.lit(1)).alias("differences"))
