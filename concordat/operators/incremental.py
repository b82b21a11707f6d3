"""Which rows are new since the last run, which column says so, and how far a run has come."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names that tell of updates and of creation, the best first.
UPDATE_NAMES = "last_update_date last_updated_date last_update last_updated last_modified_date last_modified updated_at update_at updated_date update_date modified_at modify_date changed_at change_date last_change_date".split()
CREATE_NAMES = "create_date created_date creation_date created_at create_at created create insert_date inserted_at date_create entry_date".split()


def newer(column: str, strategy: str, watermark: str | None, overlap_minutes: int = 5) -> Column:
    """Rows past the watermark: strictly above a number, or from the overlap before a time on. No watermark: every row.

    The bound is a literal, so it reaches the scan as a pushed filter.
    """
    c = source_expression(column)
    if watermark is None:
        return F.lit(True)
    if strategy == "numeric_key":
        return c > F.lit(int(watermark))
    if strategy == "updated_at":
        return c >= F.expr(f"timestamp_ntz'{watermark}' - interval {int(overlap_minutes)} minutes")
    raise NotImplementedError(f"strategy {strategy!r}: use numeric_key or updated_at")


def parse_column(text: str, available: list[str] | None = None) -> list[str]:
    """A column name or coalesce(a, b), as a list of one or two names; anything else is refused."""
    m = re.fullmatch(r"\s*(?:coalesce\(\s*([a-z_]\w*)\s*,\s*([a-z_]\w*)\s*\)|([a-z_]\w*))\s*", text or "", re.I)
    if not m:
        raise ValueError(f"only a column or coalesce(column, column) can be a watermark: {text!r}")
    names = [n.lower() for n in m.groups() if n]
    missing = [n for n in names if available is not None and n not in {a.lower() for a in available}]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return names


def source_expression(text: str) -> Column:
    names = parse_column(text)
    return F.coalesce(*names) if len(names) > 1 else F.col(names[0])


def watermark_of(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest value, taken from the rows that were staged, not from a source that may have moved on."""
    return df.agg(F.max(source_expression(column)).cast("string").alias("watermark"))


def detected_columns(columns: DataFrame) -> DataFrame:
    """For each table the best update and creation columns and the expression they make: table_name, update_column, create_column, expression.

    columns: as model.COLUMNS_SCHEMA. Only date and time columns count; the highest score wins, then the earliest place.
    """
    name, kind, short = F.lower("column_name"), F.lower(F.coalesce("data_type", F.lit(""))), F.lower(F.coalesce("udt_name", F.lit("")))
    temporal = kind.contains("timestamp") | kind.isin("date", "time with time zone", "time without time zone") | short.isin("date", "timestamp", "timestamptz", "time", "timetz")

    def listed(names: list[str]) -> Column:
        at = F.array_position(F.array(*map(F.lit, names)), name)
        return F.when(at > 0, F.lit(1001) - at)

    changed = name.rlike("update|modify|modified|change")
    update = F.coalesce(listed(UPDATE_NAMES), F.when(name.contains("last") & changed, 850), F.when(changed, 750), F.lit(0))
    create = F.coalesce(listed(CREATE_NAMES), F.when(name.contains("creat"), 800), F.when(name.rlike("insert|entry"), 650), F.lit(0))
    scored = columns.where(temporal).select("table_name", name.alias("name"), "ordinal", update.cast("int").alias("u"), create.cast("int").alias("c"))
    best = lambda s: F.max_by(F.when(F.col(s) > 0, F.col("name")), F.when(F.col(s) > 0, F.struct(F.col(s), -F.col("ordinal"))))
    found = scored.groupBy("table_name").agg(best("u").alias("update_column"), best("c").alias("create_column"))
    both = F.col("update_column").isNotNull() & F.col("create_column").isNotNull() & (F.col("update_column") != F.col("create_column"))
    text = F.when(both, F.concat(F.lit("coalesce("), "update_column", F.lit(","), "create_column", F.lit(")"))).otherwise(F.coalesce("update_column", "create_column"))
    return found.select("table_name", "update_column", "create_column", text.alias("expression"))
