"""All of a comparison at once: schemas, counts, keys, digests and long columns of many table pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.model import TableSpec
from concordat.operators import long_columns, reconcile, schema_diff
from concordat.operators.chunks import chunk_of
from concordat.sources.catalog import columns_of
from concordat.sources.files import union_all


def audit(spark: SparkSession, pairs: dict[str, tuple[DataFrame, DataFrame]], specs: dict[str, TableSpec] | None = None) -> dict[str, DataFrame]:
    """inventory, column_diff, rowcount, lob_analysis of the pairs.

    The source is described in the source's dialect and the target in the target's, and the rules for types judge pairs that differ. Columns of one
    and the same type on both sides agree, whatever the rules say of its names.
    """
    specs = specs or {}
    source, target = (columns_of({n: p[k] for n, p in pairs.items()}, spark, d) for k, d in ((0, "source"), (1, "target")))
    renames = [(n, a, b) for n, s in specs.items() for a, b in s.rename.items()]
    rename = spark.createDataFrame(renames, "table_name string, source_column string, target_column string") if renames else None
    counts = reconcile.rowcounts(pairs, {n: s.where for n, s in specs.items() if s.where})
    same = [(n, c) for n, (s, t) in pairs.items() for c in _same_types(s, t, specs[n].rename if n in specs else {})]
    diff = schema_diff.column_diff(source, target, rename)
    agreed = spark.createDataFrame(same, "table_name string, column_name string").withColumn("diff_type", F.explode(F.array(F.lit("type_mismatch"), F.lit("type_difference"))))
    diff = diff.join(agreed, ["table_name", "column_name", "diff_type"], "left_anti").select(*diff.columns)
    return {
        "column_diff": diff,
        "inventory": schema_diff.inventory(source, target, diff, counts.select("table_name", "source_count", "target_count")),
        "rowcount": counts,
        "lob_analysis": long_columns.analyzed(target),
    }


def _same_types(source: DataFrame, target: DataFrame, rename: dict[str, str]) -> list[str]:
    """Target columns, in lower case, that have their source column's type and declared length."""
    kind = lambda f: (f.dataType.simpleString(), f.metadata.get("__CHAR_VARCHAR_TYPE_STRING"))
    there = {f.name.lower(): kind(f) for f in target.schema}
    named = {k.lower(): v.lower() for k, v in rename.items()}
    here = {named.get(f.name.lower(), f.name.lower()): kind(f) for f in source.schema}
    return [c for c, k in here.items() if there.get(c) == k]


def checksums(pairs: dict[str, tuple[DataFrame, DataFrame]], specs: dict[str, TableSpec] | None = None, chunk_key: str | None = None, chunk_size: int = 50_000) -> DataFrame:
    """Digests of each pair's tables, or of ranges of a whole-number key, over the columns that can be digested: table_name and reconcile.checksum()."""
    parts = []
    for n, (s, t) in pairs.items():
        spec = (specs or {}).get(n)
        one = s.where(spec.where) if spec and spec.where else s
        chunk = chunk_of(chunk_key, chunk_size, 0) if chunk_key else None
        parts.append(reconcile.checksum(one, t, reconcile.checksum_columns(one, spec.exclude if spec else ()), chunk).select(F.lit(n).alias("table_name"), "*"))
    return union_all(parts)


def missing_keys(pairs: dict[str, tuple[DataFrame, DataFrame]], keys: dict[str, list[str]], sample_limit: int = 1000) -> DataFrame:
    """key_diff_summary() of each pair."""
    parts = [reconcile.key_diff_summary(s, t, keys[n], sample_limit).select(F.lit(n).alias("table_name"), F.lit(";".join(keys[n])).alias("key_columns"), "*") for n, (s, t) in pairs.items()]
    return union_all(parts)


def failed(frames: dict[str, DataFrame]) -> bool:
    """Whether any report holds a MISMATCH, MISSING or FAILED: the exit code of a command."""
    return any(not df.where(F.upper("status").isin("MISMATCH", "MISSING", "FAILED")).isEmpty() for df in frames.values() if "status" in df.columns)
