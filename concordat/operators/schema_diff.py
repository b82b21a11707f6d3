"""Differences between two schemas, what they mean for a load, and the statements that would mend them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.types import INCOMPATIBLE, WARNED, assessed, source_label, suggested_type, target_label
from concordat.model import COLUMNS_SCHEMA


def column_diff(source: DataFrame, target: DataFrame, rename: DataFrame | None = None) -> DataFrame:
    """Differences of columns, an outer join by table and lower-case name: missing, extra, type and ordinal differences.

    source, target: model.COLUMNS_SCHEMA; rename: table_name, source_column, target_column in lower case. A pair of columns gives a
    type_mismatch or compatible_difference row unless it is exact or plainly compatible, and an ordinal_difference row besides.
    """
    one = source.withColumn("key", F.lower("column_name"))
    if rename is not None:
        r = rename.select(F.lower("table_name").alias("_t"), F.lower("source_column").alias("_s"), F.lower("target_column").alias("_to"))
        one = one.join(r, (F.lower("table_name") == F.col("_t")) & (F.col("key") == F.col("_s")), "left").withColumn("key", F.coalesce("_to", "key")).drop("_t", "_s", "_to")
    fields = [f.name for f in COLUMNS_SCHEMA]
    pack = lambda df, side: df.select(F.col("table_name").alias("t"), F.col("key").alias("k"), F.struct(*fields).alias(side))
    both = pack(one, "s").join(pack(target.withColumn("key", F.lower("column_name")), "g"), ["t", "k"], "full_outer")
    a = assessed(F.col("s"), F.col("g"))
    row = lambda kind, status, severity, reason, action: F.struct(kind.alias("diff_type"), status.alias("compatibility_status"), severity.alias("severity"), reason.alias("reason"), action.alias("suggested_action"))
    lit, missing, extra = F.lit, F.col("g").isNull(), F.col("s").isNull()
    on_type = F.when(missing, row(lit("missing_in_target"), lit(INCOMPATIBLE), lit("ERROR"), lit("column is in the source only"), lit("add the column")))
    on_type = on_type.when(extra, row(lit("extra_in_target"), lit(INCOMPATIBLE), lit("ERROR"), lit("column is in the target only"), lit("check whether it is needed")))
    kind = F.when(F.col("a.status") == INCOMPATIBLE, "type_mismatch").otherwise("type_difference")
    on_type = on_type.when(F.col("a.severity") != "OK", row(kind, F.col("a.status"), F.col("a.severity"), F.col("a.reason"), F.col("a.action")))
    on_place = F.when(~missing & ~extra & (F.col("s.ordinal") != F.col("g.ordinal")), row(lit("ordinal_difference"), lit(WARNED), lit("INFO"), lit("columns stand in another order"), lit("")))
    diffs = both.withColumn("a", F.when(~missing & ~extra, a)).withColumn("d", F.explode(F.filter(F.array(on_type, on_place), lambda x: x.isNotNull())))
    return diffs.select(
        F.col("t").alias("table_name"),
        F.col("k").alias("column_name"),
        F.when(~extra, source_label(F.col("s"))).alias("source_type"),
        F.when(~missing, target_label(F.col("g"))).alias("target_type"),
        F.col("s.ordinal").alias("source_ordinal"),
        F.col("g.ordinal").alias("target_ordinal"),
        "d.*",
        F.when(~extra, suggested_type(F.col("s"))).alias("suggested_target_type"),
    )


def inventory(source: DataFrame, target: DataFrame, diff: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """A row for each table: existence, column counts, differences by severity, and MISSING, MISMATCH, WARNING or MATCH.

    counts: table_name, source_count, target_count.
    """
    sides = [df.groupBy("table_name").agg(F.count(F.lit(1)).alias(f"{n}_column_count")) for df, n in ((source, "source"), (target, "target"))]
    hits = lambda c: F.count_if(c)
    kinds = diff.groupBy("table_name").agg(
        hits(F.col("severity") == "ERROR").alias("error_count"),
        hits(F.col("severity") == "WARNING").alias("warning_count"),
        hits(F.col("severity") == "INFO").alias("info_count"),
        hits(F.col("diff_type") == "type_mismatch").alias("type_mismatch_count"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("diff_type") == "missing_in_target", F.col("column_name")))), ";").alias("missing_columns"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("diff_type") == "extra_in_target", F.col("column_name")))), ";").alias("extra_columns"),
    )
    out = sides[0].join(sides[1], "table_name", "full_outer").join(kinds, "table_name", "left")
    out = out.join(counts, "table_name", "left") if counts is not None else out.withColumns({"source_count": F.lit(None).cast("long"), "target_count": F.lit(None).cast("long")})
    zero = [f"{s}_column_count" for s in ("source", "target")] + ["error_count", "warning_count", "info_count", "type_mismatch_count"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero} | {c: F.coalesce(c, F.lit("")) for c in ("missing_columns", "extra_columns")})
    apart = F.coalesce(F.col("source_count") != F.col("target_count"), F.lit(False))
    status = (
        F.when((F.col("source_column_count") == 0) | (F.col("target_column_count") == 0), "MISSING")
        .when(F.col("error_count") > 0, "MISMATCH")
        .when((F.col("warning_count") > 0) | apart, "WARNING")
        .otherwise("MATCH")
    )
    return out.withColumns({"source_exists": F.col("source_column_count") > 0, "target_exists": F.col("target_column_count") > 0, "column_structure_match": F.col("error_count") == 0, "status": status})


def ddl_suggestions(diff: DataFrame, schema: str = "public", drop: bool = False) -> DataFrame:
    """table_name, column_name and the ALTER TABLE statement that adds a missing column or, if asked for, drops an extra one."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    table = F.concat(F.lit(f'ALTER TABLE "{schema}".'), quoted(F.col("table_name")))
    add = F.concat(table, F.lit(" ADD COLUMN "), quoted(F.col("column_name")), F.lit(" "), F.col("suggested_target_type"), F.lit(";"))
    gone = F.concat(table, F.lit(" DROP COLUMN "), quoted(F.col("column_name")), F.lit(";"))
    wanted = F.when(F.col("diff_type") == "missing_in_target", add)
    if drop:
        wanted = wanted.when(F.col("diff_type") == "extra_in_target", gone)
    return diff.select("table_name", "column_name", wanted.alias("statement")).where("statement IS NOT NULL")
