"""Key ranges as units of work: planning, counting, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 256  # rows sampled for each range of equal depth
NULLS = -1  # the range of rows without a key


def plan(df: DataFrame, key: str, size: int) -> DataFrame:
    """chunk_key, chunk_start, chunk_end of ranges of `size` keys from the least to the largest; an empty table has none.

    Bounds come from Parquet statistics; the ranges are made by the executors.
    """
    ends = df.agg(F.min(key).cast("long").alias("lo"), F.max(key).cast("long").alias("hi")).where("lo IS NOT NULL")
    starts = ends.select(F.explode(F.sequence("lo", "hi", F.lit(size).cast("long"))).alias("chunk_start"), "hi")
    end = F.least(F.col("chunk_start") + size - 1, F.col("hi"))
    return starts.select(F.concat_ws(":", F.lit(key), F.col("chunk_start").cast("string"), end.cast("string")).alias("chunk_key"), "chunk_start", end.alias("chunk_end"))


def chunk_of(key: str, size: int, low: int) -> Column:
    """The number of a row's range: ranges join and group by equality, never by comparison."""
    return F.floor((F.col(key) - low) / size).cast("long")


def rows_of(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    return df.where(F.col(key).between(start, end))


def counts(df: DataFrame, key: str, size: int, low: int = 0) -> DataFrame:
    return df.groupBy(chunk_of(key, size, low).alias("chunk_id")).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def pending(planned: DataFrame, ledger: DataFrame) -> DataFrame:
    """Chunks that no run has brought to success. ledger: chunk_key, status."""
    return planned.join(ledger.where("status = 'success'").select("chunk_key").distinct(), "chunk_key", "left_anti")


def bounds(df: DataFrame, keys: list[str], parts: int, seed: int = 7) -> list[tuple]:
    """At most parts - 1 keys that part the rows into ranges of about equal depth, in order: range i has the keys from bound i - 1 up to below bound i.

    Keys may be of any type that can be ordered, and several columns; rows with a null in them have a range of their own (NULLS). The bounds
    are ranks of a sample of SAMPLE rows a range. A rank of the sample is off by a part of the rows with a standard deviation of
    1 / sqrt(SAMPLE) of a range, so a range of keys that do not repeat has less than half more rows than it should, but once in
    10^12. A key that has more rows than a range is never parted: ranges of whole keys are what can be loaded again one by one.
    """
    size = parts * SAMPLE
    some = df.dropna(subset=keys).select(*keys).orderBy(F.rand(seed)).limit(size)
    ranked = some.select("*", F.percent_rank().over(Window.orderBy(*keys)).alias("_p"))  # one task for a sample of bounded size
    ranked = ranked.withColumn("_slot", F.floor(F.col("_p") * parts).cast("int")).where(F.col("_slot").between(1, parts - 1))
    found = ranked.groupBy("_slot").agg(F.min(F.struct(*keys)).alias("key")).select("key.*").distinct().orderBy(*keys).collect()
    return [tuple(r) for r in found]


def _literal(v: object, kind: str) -> str:
    """A value in SQL, as the type of its column."""
    if isinstance(v, (bytes, bytearray)):
        return f"CAST(X'{bytes(v).hex()}' AS {kind})"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def _spelled(df: DataFrame, keys: list[str], at: tuple | None = None) -> str:
    """The key of a row, or a bound, in SQL: one expression, however many bounds there are, is parsed faster than it is put together."""
    types = dict(df.dtypes)
    parts = [f"`{k.replace('`', '``')}`" if at is None else _literal(at[i], types[k]) for i, k in enumerate(keys)]
    return parts[0] if len(keys) == 1 else f"named_struct({', '.join(f"'k{i}', {p}" for i, p in enumerate(parts))})"


def range_of(df: DataFrame, keys: list[str], at: list[tuple], first: int = 0) -> Column:
    """The number of a row's range, by a search that halves the bounds; NULLS for a key with a null. Ranges group and join by equality."""
    key = _spelled(df, keys)

    def among(lo: int, hi: int) -> str:
        if lo == hi:
            return str(first + lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {key} < {_spelled(df, keys, at[mid])} THEN {among(lo, mid)} ELSE {among(mid + 1, hi)} END"

    null = " OR ".join(f"{_spelled(df, [k])} IS NULL" for k in keys)
    return F.expr(f"CASE WHEN {null} THEN {NULLS} ELSE {among(0, len(at))} END")


def within(df: DataFrame, keys: list[str], low: tuple | None, high: tuple | None) -> Column:
    """Rows from a bound up to below another; None: no bound. The leading key's limits stand alone too, so they reach the scan."""
    out = [f"{_spelled(df, [k])} IS NOT NULL" for k in keys]
    for at, lead, whole in ((low, ">=", ">="), (high, "<=", "<")):
        if at is not None:
            out += [f"{_spelled(df, keys[:1])} {lead} {_spelled(df, keys[:1], at[:1])}", f"{_spelled(df, keys)} {whole} {_spelled(df, keys, at)}"]
    return F.expr(" AND ".join(out))


def equal_depth(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Rows, first and last key (structs of the keys) of each range of equal depth: chunk_id (NULLS for rows with a null key), rows, first_key, last_key."""
    at = bounds(df, keys, parts)
    key = F.struct(*keys)
    return df.groupBy(range_of(df, keys, at).alias("chunk_id")).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
