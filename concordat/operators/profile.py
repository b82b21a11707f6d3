"""Profiles of columns and what they recommend: keys, watermarks, load modes; and what a load would cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names preferred as keys and as watermarks, the best first, and parts of names that hint at them.
KEY_NAMES = ("rec_id", "batch_id", "id")
WATERMARK_NAMES = ("updated_date", "last_update", "update_date", "created_date", "rec_id", "batch_id")
WATERMARK_HINTS = ("update", "last", "date", "time", "rec_id", "batch_id")
APPEND_KEYS = ("batch_id", "rec_id")
SMALL_TABLE, ROWS_PER_SECOND, SWAP_FACTOR = 50_000, 10_000, 2.5


def profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """column_name, non_null, nulls, distinct_count, is_unique, min_value, max_value of each column, from one scan.

    Exact distinct counts of many columns multiply rows before the shuffle; approximate uses a sketch of constant size instead, and
    then is_unique is null unless the sketch rules it out.
    """
    names = columns or df.columns
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        aggs += [F.count(c).alias(f"c{i}"), distinct(c).alias(f"d{i}"), F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"h{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"), (F.col("n") - F.col(f"c{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct_count"), F.col(f"l{i}").alias("min_value"), F.col(f"h{i}").alias("max_value")) for i, c in enumerate(names))))
    out = one.select("n", rows.alias("x")).select("x.*", "n")
    unique = (F.col("n") > 0) & (F.col("distinct_count") == F.col("n"))
    if approximate:
        unique = F.when(F.col("distinct_count") < F.col("n") * 0.8, F.lit(False))
    return out.select("column_name", "non_null", "nulls", "distinct_count", unique.alias("is_unique"), "min_value", "max_value")


ERROR_DISTINCT, ERROR_RANK, FREQUENT = 0.016, 0.0165, 64  # standard error of a distinct count; error of a quantile's rank (99 percent); values followed


def sketches(df: DataFrame, columns: list[str] | None = None, *groups: str) -> DataFrame:
    """What a profile is made of, for all rows or each group, in a form that adds up: for column i of `columns` count (n<i>), least and largest value (l, h),
    a distinct-count sketch (d), a quantile sketch of numbers (q) and one of frequent values (t); and the rows (n)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns or [c for c in df.columns if c not in groups]):
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"), F.hll_sketch_agg(F.xxhash64(c), F.lit(12)).alias(f"d{i}")]
        aggs += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"q{i}")] if is_number(df, c) else []
        aggs += [F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {16 * FREQUENT})").alias(f"t{i}")]
    return df.groupBy(*groups).agg(*aggs)


def is_number(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))


def summed(parts: DataFrame, columns: list[str]) -> DataFrame:
    """One profile of any number of sketches(): column_name, non_null, nulls, distinct_count, min_value, max_value, quartiles (of numbers), frequent
    (values as texts with their counts, the most frequent first).

    distinct_count has a standard error of ERROR_DISTINCT, a quartile's rank is off by ERROR_RANK at most in 99 of 100; counts, least and largest values are exact.
    """
    out = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    for i, _ in enumerate(columns):
        out += [F.sum(f"n{i}").alias(f"n{i}"), F.min(f"l{i}").cast("string").alias(f"l{i}"), F.max(f"h{i}").cast("string").alias(f"h{i}"), F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}")]
        if f"q{i}" in parts.columns:
            out += [F.kll_merge_agg_double(f"q{i}").alias(f"q{i}")]
        out += [F.expr(f"approx_top_k_estimate(approx_top_k_combine(t{i}, {16 * FREQUENT}), {FREQUENT})").alias(f"t{i}")]
    one = parts.agg(*out)
    quartiles = lambda i: F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"q{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    null = F.lit(None).cast("array<double>")
    kind = "array<struct<value: string, count: bigint>>"
    rows = [F.struct(F.lit(c).alias("column_name"), F.coalesce(f"n{i}", F.lit(0)).alias("non_null"), (F.col("n") - F.coalesce(f"n{i}", F.lit(0))).alias("nulls"), F.coalesce(f"d{i}", F.lit(0)).alias("distinct_count"), F.col(f"l{i}").alias("min_value"), F.col(f"h{i}").alias("max_value"), (quartiles(i) if f"q{i}" in parts.columns else null).alias("quartiles"), F.filter(F.col(f"t{i}"), lambda x: x["item"].isNotNull()).cast(kind).alias("frequent")) for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("_x")).select("_x.*")


def of_versions(table, columns: list[str]) -> DataFrame:
    """summed() of the current version of a VersionedTable. Sketches are kept for each file beside its folder, so after an append or an upsert only
    the new folder is read."""
    state, out = table.state(), None
    for p in table.parts(state=state):
        part = table.kept(p["folder"], f"profile-{'-'.join(columns)}", lambda rows: sketches(rows, columns, "_file"))
        part = part.where(~F.col("_file").isin(p["without"])) if p["without"] else part
        out = part if out is None else out.unionByName(part)
    return summed(out, columns)


def hinted(columns: DataFrame, hints: tuple[str, ...], limit: int = 12) -> DataFrame:
    """Columns whose name holds a hint, the first `limit` by place. columns: column_name, ordinal."""
    return columns.where(F.lower("column_name").rlike("|".join(hints))).orderBy("ordinal").limit(limit)


def key_candidates(profiles: DataFrame) -> DataFrame:
    """Unique columns without nulls, the preferred names first. profiles: profile() with table_name and ordinal."""
    at = F.array_position(F.array(*map(F.lit, KEY_NAMES)), F.lower("column_name"))
    return profiles.where("is_unique AND nulls = 0").select("table_name", "column_name", F.when(at > 0, at).otherwise(F.lit(100) + F.col("ordinal")).cast("int").alias("preference"))


def watermark_candidates(profiles: DataFrame) -> DataFrame:
    """Columns with values whose name hints at growth, or that are unique, the preferred names first."""
    name = F.lower("column_name")
    at = F.array_position(F.array(*map(F.lit, WATERMARK_NAMES)), name)
    return profiles.where((F.col("non_null") > 0) & name.rlike("|".join(WATERMARK_HINTS))).select("table_name", "column_name", F.when(at > 0, at).otherwise(F.lit(100) + F.col("ordinal")).cast("int").alias("preference"))


def recommendation(counts: DataFrame, profiles: DataFrame) -> DataFrame:
    """table_name, best_key, best_watermark, mode, reason. counts: table_name, source_count, target_count."""
    best = lambda df, name: df.groupBy("table_name").agg(F.min_by("column_name", "preference").alias(name))
    out = counts.join(best(key_candidates(profiles), "best_key"), "table_name", "left").join(best(watermark_candidates(profiles), "best_watermark"), "table_name", "left")
    ready = F.col("best_key").isNotNull() & F.col("best_watermark").isNotNull()
    apart = ~F.col("source_count").eqNullSafe(F.col("target_count"))
    small = (F.col("source_count") > 0) & (F.col("source_count") <= SMALL_TABLE)
    mode = F.when(~apart & ready, "incremental_candidate").otherwise("truncate")
    reason = (
        F.when(apart, "row counts differ")
        .when(ready & F.lower("best_watermark").isin(*APPEND_KEYS), "unique growing number")
        .when(ready, "unique key and a watermark column")
        .when(small, "small table")
        .otherwise("no safe key and watermark")
    )
    return out.select("table_name", "source_count", "target_count", "best_key", "best_watermark", mode.alias("mode"), reason.alias("reason"))


def simulated(tables: DataFrame, default_mode: str = "truncate") -> DataFrame:
    """Expected duration, space and risk of loads. tables: table_name, mode, estimated_rows, size_bytes, dependents."""
    mib = 1 << 20
    risk = F.when((F.col("dependents") > 10) | (F.col("size_bytes") > 1024 * mib), "high").when((F.col("size_bytes") > 100 * mib) | (F.col("dependents") > 0), "medium").otherwise("low")
    return tables.select(
        "table_name",
        F.coalesce("mode", F.lit(default_mode)).alias("mode"),
        F.coalesce("estimated_rows", F.lit(0)).alias("estimated_rows"),
        F.round(F.coalesce("estimated_rows", F.lit(0)) / ROWS_PER_SECOND, 3).alias("estimated_seconds"),
        (F.coalesce("size_bytes", F.lit(0)) * SWAP_FACTOR).cast("long").alias("swap_bytes"),
        F.coalesce("dependents", F.lit(0)).alias("dependency_impact"),
        risk.alias("risk_level"),
    )
