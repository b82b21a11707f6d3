"""Changed rows into a table: keyed upsert as one outer join, and its ways with repeated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The changes hold a key more than once."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def last_wins(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of the rows of a key the last in `order`. Rows are combined before the shuffle, so a hot key costs one row a task."""
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*changes.columns), F.struct(*order)).alias("_row")).select("_row.*")


def merged(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str] | None = None, insert_only: bool = False) -> DataFrame:
    """The target after an upsert. Matched rows take the changes' values in `columns` (default: all that both have), nulls too, and keep their
    others; unmatched changes are added. A null key matches nothing. Changes must hold each key once."""
    mapped = [c for c in (columns or changes.columns) if c not in keys and c in target.columns]
    if insert_only or not mapped:
        fresh = changes.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(fresh.select(*keys, *mapped), allowMissingColumns=True)
    t = target.withColumn("_t", F.lit(True)).select(F.struct(*target.columns).alias("t"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_t")
    s = changes.select(F.struct(*keys, *mapped).alias("s"), *(F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)), F.lit(True).alias("_s"))
    on = F.lit(True)
    for i in range(len(keys)):
        on = on & (F.col(f"_k{i}") == F.col(f"_j{i}"))
    both = t.join(s, on, "full_outer")
    types = dict(target.dtypes)

    def value(c: str) -> Column:
        if c in keys or c in mapped:
            return F.when(F.col("_s"), F.col(f"s.{c}").cast(types[c])).otherwise(F.col(f"t.{c}")).alias(c)
        return F.col(f"t.{c}").alias(c)

    return both.select(*(value(c) for c in target.columns))


def upserted(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str] | None = None, on_duplicate: str = "error", order: list[Column] | None = None) -> DataFrame:
    """merged() after the rule for repeated keys: `error`, or `last` in the given order, without which no row is the last."""
    if on_duplicate == "last":
        if not order:
            raise ValueError("the last of repeated keys needs an order")
        changes = last_wins(changes, keys, order)
    elif not duplicate_keys(changes, keys).isEmpty():
        raise DuplicateKeyError(f"changes repeat a key of {', '.join(keys)}")
    return merged(target, changes, keys, columns)


def deleted_then_inserted(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The target without the changes' keys, and all changes, repeated ones too."""
    return target.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def is_unique(df: DataFrame, keys: list[str]) -> bool:
    return duplicate_keys(df.dropna(subset=keys), keys).isEmpty()


def first_wins(rows: DataFrame, on: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each group of equal `on` expressions."""
    w = Window.partitionBy(*on).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
