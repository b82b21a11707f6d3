"""Long columns: which there are, how large their values are, and how to load them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names of long columns, and those of them that hold bytes.
LONG_TYPES = ("BLOB", "CLOB", "NCLOB", "LONG", "LONG RAW", "BYTEA")
BINARY_TYPES = ("BLOB", "LONG RAW", "BYTEA", "RAW")


def long_type(kind: Column, short: Column) -> Column:
    """The long type of a column, or null."""
    k, s = F.upper(F.coalesce(kind, F.lit(""))), F.upper(F.coalesce(short, F.lit("")))
    return F.when(k.isin(*LONG_TYPES), k).when(s.isin(*LONG_TYPES), s).when(k.contains("NCLOB"), "NCLOB").when(k.contains("CLOB"), "CLOB").when(k.contains("BLOB"), "BLOB")


def analyzed(columns: DataFrame, strategies: DataFrame | None = None) -> DataFrame:
    """A row for each long column, or one for a table that has none: classification, target type, strategy, warning, recommendation.

    columns: model.COLUMNS_SCHEMA; strategies: table_name, column_name, strategy. LOB-heavy: long columns are over half of all;
    binary-heavy: at least half of them (one at least) hold bytes.
    """
    typed = columns.withColumn("lob_type", long_type(F.col("data_type"), F.col("udt_name")))
    n, binary = F.count("lob_type"), F.count_if(F.col("lob_type").isin("BLOB", "LONG RAW", "BYTEA"))
    per = typed.groupBy("table_name").agg(F.count(F.lit(1)).alias("total"), n.alias("n"), binary.alias("binary"))
    kind = F.when(F.col("n") == 0, "normal").when(F.col("n") / F.col("total") > 0.5, "LOB-heavy").when(F.col("binary") >= F.greatest(F.lit(1), F.floor(F.col("n") / 2)), "binary-heavy").otherwise("normal")
    per = per.withColumn("classification", kind)
    found = per.join(typed.where("lob_type IS NOT NULL").select("table_name", "column_name", "lob_type"), "table_name", "left")
    if strategies is not None:
        s = strategies.select(F.lower("table_name").alias("_t"), F.lower("column_name").alias("_c"), F.lower("strategy").alias("strategy"))
        found = found.join(s, (F.lower("table_name") == F.col("_t")) & (F.lower("column_name") == F.col("_c")), "left").drop("_t", "_c")
    else:
        found = found.withColumn("strategy", F.lit(None).cast("string"))
    some, heavy, by_bytes = F.col("lob_type").isNotNull(), F.col("classification") == "LOB-heavy", F.col("classification") == "binary-heavy"
    strategy = F.coalesce("strategy", F.lit("error"))
    kept = strategy.isin("stream", "include")
    percent = F.round(F.col("n") * 100 / F.col("total")).cast("int").cast("string")
    warning = F.when(heavy, F.concat(percent, F.lit("% of the columns are long"))).when(by_bytes, "long columns hold bytes").when(F.col("lob_type").isin("LONG", "LONG RAW"), "this type depends on the reader").otherwise("")
    advice = F.when(heavy, "exclude").when(by_bytes, "partial_columns").when(kept, "stream").when(strategy == "skip", "partial_columns").otherwise("stream")
    return found.select(
        "table_name", "classification", "column_name", "lob_type", F.when(some, F.when(F.col("lob_type").isin(*BINARY_TYPES), "bytea").otherwise("text")).alias("target_type"),
        F.when(some, strategy).alias("strategy"), F.when(some, warning).otherwise("").alias("warning"), F.when(some, advice).otherwise("none").alias("recommendation"),
    )


def size_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, rows, nulls, total_bytes, max_bytes, avg_bytes of long columns' values in UTF-8 or raw bytes."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        size = F.octet_length(F.col(c)) if dict(df.dtypes)[c] in ("string", "binary") else F.octet_length(F.to_json(c))
        aggs += [F.count(c).alias(f"c{i}"), F.sum(size).alias(f"s{i}"), F.max(size).alias(f"m{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("nulls"), F.coalesce(f"s{i}", F.lit(0)).alias("total_bytes"), F.coalesce(f"m{i}", F.lit(0)).cast("long").alias("max_bytes"), F.col(f"c{i}").alias("_c")) for i, c in enumerate(columns))))
    return one.select("n", rows.alias("x")).select("x.column_name", F.col("n").alias("rows"), "x.nulls", "x.total_bytes", "x.max_bytes", F.round(F.when(F.col("x._c") > 0, F.col("x.total_bytes") / F.col("x._c")), 3).alias("avg_bytes"))


def value_digests(df: DataFrame, keys: list[str], column: str, algorithm: str = "sha256") -> DataFrame:
    """Keys, size and digest of each value of a long column, for a join with the other side's."""
    raw = F.col(column) if dict(df.dtypes)[column] == "binary" else F.col(column).cast("binary")
    digest = {"sha256": lambda: F.sha2(raw, 256), "sha1": lambda: F.sha1(raw), "md5": lambda: F.md5(raw)}[algorithm]()
    return df.select(*keys, F.octet_length(raw).alias("bytes"), digest.alias("digest"))


SEGMENT = 64 << 10  # bytes of a segment


def segments(df: DataFrame, keys: list[str], column: str, size: int = SEGMENT) -> DataFrame:
    """keys, segment (from 0), bytes and digest (SHA-256) of each `size` bytes of a long value; an empty value has one empty segment, a null value one
    without a digest. What is sent on is digests, however long the values are."""
    raw = F.col(column) if dict(df.dtypes)[column] == "binary" else F.col(column).cast("binary")
    last = F.greatest(F.ceil(F.octet_length(raw) / size) - 1, F.lit(0))
    parts = df.select(*keys, raw.alias("_raw"), F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0)).cast("int"))).alias("segment"))
    piece = F.substring(F.col("_raw"), F.col("segment") * size + 1, F.lit(size))
    return parts.select(*keys, "segment", F.octet_length(piece).alias("bytes"), F.sha2(piece, 256).alias("digest"))


def first_differences(source: DataFrame, target: DataFrame, keys: list[str], column: str, size: int = SEGMENT) -> DataFrame:
    """keys, segment, differing, status of the values that are not the same on both sides: the first segment that differs, how many do, and whether the key is on
    one side only (source only, target only) or its value changed. Keys must be unique on each side; null keys equal null keys."""
    side = lambda df, n: segments(df, keys, column, size).withColumn("_side", F.lit(n))
    of = lambda n: F.max(F.when(F.col("_side") == n, F.struct(F.lit(1).alias("there"), "bytes", "digest"))).alias(f"_s{n}")
    both = side(source, 0).unionByName(side(target, 1)).groupBy(*keys, "segment").agg(of(0), of(1))
    apart = ~F.col("_s0").eqNullSafe(F.col("_s1"))
    # a key that a side lacks has no segment 0 there
    missing = lambda n: F.max(F.when((F.col("segment") == 0) & F.col(f"_s{n}").isNull(), 1))
    out = both.groupBy(*keys).agg(F.min(F.when(apart, F.col("segment"))).alias("segment"), F.count_if(apart).alias("differing"), missing(0).alias("_m0"), missing(1).alias("_m1"))
    status = F.when(F.col("_m1") == 1, "source only").when(F.col("_m0") == 1, "target only").otherwise("changed")
    return out.where("differing > 0").select(*keys, "segment", "differing", status.alias("status"))
