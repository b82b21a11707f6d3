"""Type names of the two kinds of store, and the graded rules that say whether one holds the values of the other.

A rule is a condition over a pair of column descriptions (structs with the fields of model.COLUMNS_SCHEMA) and its verdict. Rules are
tried in order; the first that holds decides. The whole list is one `when` chain, so a million column pairs cost one scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT, COMPATIBLE, WARNED, INCOMPATIBLE = "compatible_exact", "compatible", "compatible_with_warning", "incompatible"
# Decimal digits that integer types surely hold.
INTEGER_DIGITS = {"smallint": 4, "int2": 4, "integer": 9, "int": 9, "int4": 9, "bigint": 18, "int8": 18}


def _field(c: Column, name: str) -> Column:
    return c.getField(name)


def _length(c: Column) -> Column:
    some = lambda n: F.when(_field(c, n) != 0, _field(c, n))
    return F.coalesce(some("char_length"), some("data_length"))


def _sized(name: Column, *sizes: Column) -> Column:
    return F.concat(name, F.lit("("), F.concat_ws(",", *(s.cast("string") for s in sizes)), F.lit(")"))


def source_label(c: Column) -> Column:
    """NAME, NAME(length), NUMBER(p) or NUMBER(p,s)."""
    name, p, s = F.upper(_field(c, "data_type")), _field(c, "numeric_precision"), _field(c, "numeric_scale")
    return (
        F.when(name.isin("VARCHAR2", "NVARCHAR2", "CHAR", "NCHAR") & _length(c).isNotNull(), _sized(name, _length(c)))
        .when((name == "NUMBER") & p.isNotNull() & s.isNotNull(), _sized(name, p, s))
        .when((name == "NUMBER") & p.isNotNull(), _sized(name, p))
        .otherwise(name)
    )


def target_label(c: Column) -> Column:
    """varchar(n), char(n), numeric(p,s), or the type's short name."""
    name, short = F.lower(_field(c, "data_type")), F.lower(F.coalesce(_field(c, "udt_name"), F.lit("")))
    n, p, s = _field(c, "char_length"), _field(c, "numeric_precision"), _field(c, "numeric_scale")
    sized = lambda kind: F.when(F.coalesce(n, F.lit(0)) != 0, _sized(F.lit(kind), n)).otherwise(F.lit(kind))
    return (
        F.when(name.isin("character varying", "varchar"), sized("varchar"))
        .when(name.isin("character", "char") | (short == "bpchar"), sized("char"))
        .when(name.isin("numeric", "decimal"), F.when(p.isNotNull() & s.isNotNull(), _sized(F.lit("numeric"), p, s)).otherwise(F.lit("numeric")))
        .otherwise(F.when(short != "", short).otherwise(name))
    )


def suggested_type(c: Column) -> Column:
    """The target type that surely holds the source's values."""
    name, p, s = F.upper(_field(c, "data_type")), _field(c, "numeric_precision"), _field(c, "numeric_scale")
    sized = lambda kind: F.when(_length(c).isNotNull(), _sized(F.lit(kind), _length(c))).otherwise(F.lit(kind))
    whole = F.coalesce(s, F.lit(0)) == 0
    number = F.when(p.isNull(), F.lit("numeric")).when(whole & (p <= 4), F.lit("smallint")).when(whole & (p <= 9), F.lit("integer")).when(whole & (p <= 18), F.lit("bigint")).when(whole, _sized(F.lit("numeric"), p, F.lit(0))).otherwise(_sized(F.lit("numeric"), p, s))
    return (
        F.when(name.isin("VARCHAR", "VARCHAR2", "NVARCHAR2"), sized("varchar"))
        .when(name.isin("CHAR", "NCHAR"), sized("char"))
        .when(name == "NUMBER", number)
        .when((name == "DATE") | name.startswith("TIMESTAMP"), F.lit("timestamp"))
        .when(name.startswith("INTERVAL"), F.lit("interval"))
        .when(name == "BOOLEAN", F.lit("boolean"))
        .when(name.isin("FLOAT", "BINARY_FLOAT"), F.lit("real"))
        .when(name == "BINARY_DOUBLE", F.lit("double precision"))
        .when(name.isin("RAW", "BLOB", "LONG RAW"), F.lit("bytea"))
        .when(name == "JSON", F.lit("jsonb"))
        .otherwise(F.lit("text"))
    )


def assessed(s: Column, t: Column) -> Column:
    """struct(status, severity, reason, action) for a source and a target column.

    In a lambda the rules are interpreted: forty of them are too long to be compiled into one loop.
    """
    return F.element_at(F.transform(F.array(F.struct(s.alias("s"), t.alias("t"))), lambda p: _verdict(p["s"], p["t"])), 1)


def _verdict(s: Column, t: Column) -> Column:
    kind, label = F.upper(_field(s, "data_type")), F.upper(target_label(t))
    has = lambda *words: label.rlike("|".join(words))
    inner = F.regexp_extract(label, r"\((\d+)(?:,(\d+))?\)", 1)
    first = F.when(inner != "", inner.cast("int"))
    second = F.when(inner != "", F.coalesce(F.nullif(F.regexp_extract(label, r"\((\d+)(?:,(\d+))?\)", 2), F.lit("")).cast("int"), F.lit(0)))
    length, p, sc = _length(s), _field(s, "numeric_precision"), _field(s, "numeric_scale")
    digits = F.coalesce(*(F.when(F.lower(label) == k, F.lit(v)) for k, v in INTEGER_DIGITS.items()), *(F.when(label.contains(k.upper()), F.lit(v)) for k, v in INTEGER_DIGITS.items()))

    char, number, floating = kind.isin("VARCHAR", "VARCHAR2", "NVARCHAR2", "CHAR", "NCHAR"), kind == "NUMBER", kind.isin("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE")
    temporal, interval, boolean = (kind == "DATE") | kind.startswith("TIMESTAMP"), kind.startswith("INTERVAL"), kind == "BOOLEAN"
    binary, long_text, rowid, document = kind.isin("RAW", "BLOB", "LONG RAW"), kind.contains("CLOB") | (kind == "LONG"), kind.isin("ROWID", "UROWID"), kind.isin("JSON", "XMLTYPE")
    text_like, exact_number, floats = has("VARCHAR", "CHAR", "TEXT", "BPCHAR"), has("NUMERIC", "DECIMAL"), has("DOUBLE", "REAL", "FLOAT")
    integer = has("SMALLINT", "INTEGER", "INT", "BIGINT")
    fixed_source = kind.isin("CHAR", "NCHAR")
    fixed_target = has("CHAR", "BPCHAR") & ~label.contains("VARCHAR")
    to_text = label.contains("TEXT")

    error, ok = (INCOMPATIBLE, "ERROR"), (COMPATIBLE, "OK")
    same, info, warn = (EXACT, "OK"), (WARNED, "INFO"), (WARNED, "WARNING")
    rules = [
        (char & ~text_like, error, "target is not a character type", "change the target type"),
        (char & (first < length), error, "target is shorter than source", "lengthen the target or use text"),
        (char & ~fixed_target & to_text, ok, "text holds any length", ""),
        (char & (first == length) & (fixed_source == fixed_target), same, "same kind and length", ""),
        (char & (first == length), ok, "same length, other kind", ""),
        (char, ok, "target is as long or longer", ""),
        (number & exact_number & p.isNull() & (second == 0), warn, "unbounded number into whole numbers: fractions are rounded", "use a scale"),
        (number & exact_number & (first < p), error, "target precision is smaller", "raise the precision"),
        (number & exact_number & (second < sc), error, "target scale is smaller", "raise the scale"),
        (number & exact_number & (first == p) & (second == sc), same, "same precision and scale", ""),
        (number & exact_number, ok, "target holds the number", ""),
        (number & integer & (F.coalesce(sc, F.lit(0)) != 0), error, "fractions do not fit an integer type", "use numeric"),
        (number & integer & p.isNull(), ok, "unbounded number taken as whole", "check that values are whole and in range"),
        (number & integer & (p > digits), error, "more digits than the integer type surely holds", "use a wider type"),
        (number & integer, ok, "whole number fits", ""),
        (number & floats, warn, "binary floating point may change the value", "use numeric"),
        (number, error, "target is not a number type", "change the target type"),
        (floating & floats, ok, "floating-point types", ""),
        (floating & exact_number, info, "floating point stored as exact number", ""),
        (floating, error, "target holds no floating point", "use real, double precision or numeric"),
        (temporal & label.contains("TIMESTAMP") & kind.startswith("TIMESTAMP"), same, "timestamps", ""),
        (temporal & label.contains("TIMESTAMP"), info, "date with time stored as timestamp", ""),
        (temporal & label.contains("DATE"), error, "target date loses the time of day", "use timestamp"),
        (temporal & label.contains("TIME"), error, "target time loses the date", "use timestamp"),
        (temporal, error, "target is not a timestamp", "use timestamp"),
        (interval & label.contains("INTERVAL") & (kind == label), same, "intervals", ""),
        (interval & label.contains("INTERVAL"), ok, "intervals", ""),
        (interval, error, "target is not an interval", "use interval"),
        (boolean & label.contains("BOOL"), same, "booleans", ""),
        (boolean, error, "target is not a boolean", "use boolean"),
        (binary & label.contains("BYTEA"), same, "binary", ""),
        (binary, error, "target is not binary", "use bytea"),
        (long_text & to_text, ok, "long text", ""),
        (long_text & label.contains("VARCHAR") & first.isNull(), warn, "long text in varchar without length", "use text"),
        (long_text & label.contains("VARCHAR"), error, "target is shorter than long text", "use text"),
        (long_text, error, "target is not text", "use text"),
        (rowid & text_like, ok, "row address as text", ""),
        (rowid, error, "target is not text", "use text"),
        ((kind == "JSON") & label.contains("JSON"), ok, "JSON", ""),
        (document & has("TEXT", "VARCHAR", "JSON"), info, "document stored as text", "check formatting"),
        (document, error, "target holds no document", "use json, jsonb or text"),
        (kind == label, same, "same name", ""),
    ]
    verdict = lambda v, reason, action: F.struct(F.lit(v[0]).alias("status"), F.lit(v[1]).alias("severity"), F.lit(reason).alias("reason"), F.lit(action).alias("action"))
    out = None
    for condition, v, reason, action in rules:
        holds = F.coalesce(condition, F.lit(False))
        out = out.when(holds, verdict(v, reason, action)) if out is not None else F.when(holds, verdict(v, reason, action))
    return out.otherwise(verdict(error, "types do not correspond", "change the target type"))
