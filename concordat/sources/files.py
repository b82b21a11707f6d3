"""Reading and writing tables: Parquet, catalogs, JDBC and CSV, with counts of what passed."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any, TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from concordat.sources import catalog

Result = TypeVar("Result")

# Parts of messages of connections that may work a moment later.
TRANSIENT = ("temporary failure in name resolution", "failed to resolve host", "could not translate host name", "name or service not known", "nodename nor servname", "getaddrinfo", "connection timed out", "timeout expired", "server closed the connection unexpectedly", "could not connect to server", "ora-12154", "ora-12514", "ora-12541", "ora-12545")


def with_retry(fn: Callable[[], Result], attempts: int = 8, delay: float = 1.0, longest: float = 30.0, transient: tuple[str, ...] = TRANSIENT) -> Result:
    """Call fn again, each time after about twice the wait, while it fails for a passing reason."""
    for attempt in range(attempts):
        try:
            return fn()
        except Exception as e:
            if attempt == attempts - 1 or not any(t in str(e).lower() for t in transient):
                raise
            time.sleep(min(longest, delay * 2**attempt) * random.uniform(0.8, 1.2))
    raise AssertionError("unreachable")


def read(spark: SparkSession, source: str, columns: list[str] | None = None, where: str | None = None, order: list[str] | None = None, **options: Any) -> DataFrame:
    """A table by name, a Parquet path, or a JDBC url with dbtable in the options; projection and filter reach the scan.

    JDBC reads are parallel with partitionColumn, lowerBound, upperBound and numPartitions, which also bounds connections.
    """
    if source.startswith("jdbc:"):
        df = with_retry(lambda: spark.read.format("jdbc").options(url=source, **({"fetchsize": 10_000} | options)).load())
    elif "/" in source:
        df = spark.read.options(**options).parquet(source)
    else:
        schema, _, name = source.rpartition(".")
        if schema and "." not in schema and not spark.catalog.tableExists(source):
            source = f"{schema}.{catalog.resolve(spark, schema, name) or name}"  # as the catalog spells it
        df = spark.table(source)
    if where:
        df = df.where(F.expr(where))
    if columns:
        df = df.select(*columns)
    return df.orderBy(*order) if order else df


def conjoined(df: DataFrame, *conditions: str | None) -> DataFrame:
    """Rows for which every given condition holds."""
    return reduce(lambda d, c: d.where(F.expr(c)), filter(None, conditions), df)


def counted(df: DataFrame, name: str, long: list[str] = ()) -> tuple[DataFrame, Observation]:
    """df, and an observation that has rows, bytes and long_bytes once df has been written."""
    seen = Observation(name)
    size = lambda cs: reduce(lambda a, b: a + b, (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cs), F.lit(0))
    plain = [c for c, d in df.dtypes if d != "binary" and not d.startswith(("array", "map", "struct"))]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size(plain)), F.lit(0)).alias("bytes"), F.coalesce(F.sum(size(list(long))), F.lit(0)).alias("long_bytes")), seen


def write(df: DataFrame, target: str, mode: str = "append", **options: Any) -> dict[str, int]:
    """Write rows to a table by name, a Parquet path, or a JDBC url with dbtable in the options; returns rows, bytes and long_bytes, counted on the way.

    JDBC writes go in batches from every task, numPartitions of them at once at most. `overwrite` empties a JDBC table and keeps its definition. A
    task that is run again after its batches were committed would write them twice, so compare counts before relying on a JDBC append.
    """
    passed, seen = counted(df, f"write-{uuid.uuid4().hex[:8]}")
    if target.startswith("jdbc:"):
        passed.write.format("jdbc").options(url=target, **({"batchsize": 10_000, "truncate": True} | options)).mode(mode).save()
    elif "/" in target:
        passed.write.options(**options).mode(mode).parquet(target)
    else:
        passed.write.options(**options).mode(mode).saveAsTable(target)
    return seen.get


def rejected(df: DataFrame, types: dict[str, str], keys: list[str], limit: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rows that can be cast as asked, cast; and of the others a sample: keys (200 characters of each), column, value."""
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()}
    any_bad = reduce(lambda a, b: a | b, bad.values())
    first = F.coalesce(*(F.when(b, F.struct(F.lit(c).alias("column_name"), F.substring(F.col(c).cast("string"), 1, 200).alias("value"))) for c, b in bad.items()))
    sample = df.where(any_bad).select(F.concat_ws(";", *(F.substring(F.col(k).cast("string"), 1, 200) for k in keys)).alias("key_values"), first.alias("x")).select("key_values", "x.*").orderBy("key_values").limit(limit)
    return df.where(~any_bad).select(*(F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns)), sample


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows under all columns, in order of first appearance; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_csv(df: DataFrame, path: str) -> None:
    """A report of one file with a header. Maps and lists become `k:v;k:v` and `a;b`."""
    flat = []
    for c, d in df.dtypes:
        if d.startswith("map"):
            flat.append(F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ";").alias(c))
        elif d.startswith("array"):
            flat.append(F.array_join(F.col(c).cast("array<string>"), ";").alias(c))
        else:
            flat.append(F.col(c))
    df.select(*flat).coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report with its types, so "false" is not a text that counts as true."""
    return spark.read.csv(path, header=True, schema=schema)
