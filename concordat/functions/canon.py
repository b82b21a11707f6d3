"""One text for one value, whichever store it came from, and digests of rows and tables over that text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "\\N"
SEPARATOR = "\x1f"  # between the values of a row; texts hold it escaped


def float_text(c: Column) -> Column:
    """The digits that name a floating-point number and no other: positional from 1e-4 up to 1e16, else as 1.5e+16; nan, inf, -inf, -0.0."""
    raw = c.cast("string")  # as 1.5E16 from 1e7 on and below 1e-3
    mantissa, power = F.regexp_replace(F.regexp_extract(raw, "^(.*)E", 1), r"\.0$", ""), F.regexp_extract(raw, "E(-?[0-9]+)$", 1).try_cast("int")
    sign, digits = F.when(raw.startswith("-"), "-").otherwise(""), F.regexp_replace(mantissa, "[-.]", "")
    whole = F.concat(sign, F.when(F.length(digits) <= power + 1, F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0"))).otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))))
    small = F.concat(sign, F.lit("0.000"), digits)
    wide = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0")))
    size, infinite = F.abs(c), F.lit(float("inf"))
    # most numbers stand as they are, and are turned into text once
    plain = (size >= 1e-3) & (size < 1e7) | (c == 0)
    odd = F.when(F.isnan(c), "nan").when(size == infinite, F.when(c > 0, "inf").otherwise("-inf")).when((power >= 0) & (power < 16), whole).when(power == -4, small).otherwise(wide)
    return F.when(c.isNull(), None).when(plain, raw).otherwise(odd)


def plain_decimal(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def utc_text(c: Column, dtype: T.DataType) -> Column:
    """A time to the microsecond; one with a zone is in UTC, whatever the session's zone."""
    moved = F.to_utc_timestamp(c, F.current_timezone()) if isinstance(dtype, T.TimestampType) else c
    return F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def ordered(c: Column, dtype: T.DataType) -> Column:
    """A nested value whose maps are lists of their entries in order of keys: equal maps have one order."""
    if isinstance(dtype, T.MapType):
        pair = lambda e: F.struct(e["key"].alias("key"), ordered(e["value"], dtype.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(c), pair), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    if isinstance(dtype, T.ArrayType) and _has_map(dtype):
        return F.transform(c, lambda x: ordered(x, dtype.elementType))
    if isinstance(dtype, T.StructType) and _has_map(dtype):
        return F.when(c.isNotNull(), F.struct(*(ordered(c[f.name], f.dataType).alias(f.name) for f in dtype)))
    return c


def _has_map(dtype: T.DataType) -> bool:
    inner = [dtype.elementType] if isinstance(dtype, T.ArrayType) else [f.dataType for f in dtype] if isinstance(dtype, T.StructType) else []
    return isinstance(dtype, T.MapType) or any(map(_has_map, inner))


def canonical(c: Column, dtype: T.DataType) -> Column:
    """Text of a value. Both sides are cast to one type first, so 1 and 1.00 agree; null differs from the empty text.

    Floating-point numbers count by all their digits: no two that differ have one text, NaN equals NaN, and -0.0 is 0.0.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = float_text(c + F.lit(0).cast(dtype))
    elif isinstance(dtype, T.DecimalType):
        text = plain_decimal(c)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = utc_text(c, dtype)
    elif isinstance(dtype, T.BinaryType):
        text = F.sha2(c, 256)
    elif isinstance(dtype, T.StringType):
        text = F.replace(F.replace(F.translate(c, "\0", ""), F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\u"))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(ordered(c, dtype))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL))


class NoCommonTypeError(ValueError):
    """Values of two types that no type holds both of."""


def against(c: Column, mine: T.DataType, other: T.DataType) -> Column:
    """Text of a value that is held against values of another type, so that equal texts are equal values of a type that both fit; neither
    side is narrowed. Whole numbers meet decimals and floating-point numbers by their digits, decimals meet the latter as doubles, dates
    are times at midnight, and against text a time is what the text can be read as, all else its canonical text."""
    whole, floats, times = T.IntegralType, (T.FloatType, T.DoubleType), (T.DateType, T.TimestampType, T.TimestampNTZType)
    exact = (whole, T.DecimalType)
    nested = (T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    if mine == other:
        return canonical(c, mine)
    if isinstance(mine, exact) and isinstance(other, exact):
        return canonical(c, mine)
    if isinstance(mine, whole) and isinstance(other, floats):
        return canonical(c, mine)
    if isinstance(mine, floats) and isinstance(other, whole):
        integral = (c == F.floor(c)) & (F.abs(c) < 9.2e18)
        return F.when(integral, c.cast("long").cast("string")).otherwise(canonical(c, mine))
    if isinstance(mine, (*floats, T.DecimalType)) and isinstance(other, (*floats, T.DecimalType)):
        return canonical(c.cast("double"), T.DoubleType())
    if isinstance(mine, times) and isinstance(other, times):
        kind = T.TimestampType() if T.TimestampType() in (mine, other) else T.TimestampNTZType()
        return canonical(c.cast(kind), kind)
    if isinstance(mine, T.StringType) and isinstance(other, times):
        return F.coalesce(F.when(c.isNotNull(), utc_text(c.try_cast("timestamp_ntz"), T.TimestampNTZType())), canonical(c, mine))
    if isinstance(mine, times) and isinstance(other, T.StringType):
        return canonical(c.cast("timestamp_ntz"), T.TimestampNTZType())
    if T.StringType() in (mine, other) and not isinstance(mine, nested) and not isinstance(other, nested):
        return canonical(c, mine)
    raise NoCommonTypeError(f"{mine.simpleString()} and {other.simpleString()} have no type in common")


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row's canonical values, parted by a character that they hold escaped only."""
    return F.sha2(F.concat_ws(SEPARATOR, *(canonical(F.col(c), df.schema[c].dataType) for c in columns)), 256)


def slice_sum(h: Column, at: int) -> Column:
    """Sum of 15 hex digits of the rows' hashes: an order-free digest that adds up across partitions."""
    return F.sum(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")


def table_digest(df: DataFrame, columns: list[str], *groups: Column) -> DataFrame:
    """rows and digest of the whole table, or of each group. Two sums of 60 bits and the count make up the digest, so any size is one
    partial aggregation with a constant state."""
    hashed = df.select(*groups, row_hash(df, columns).alias("_h"))
    names = hashed.columns[: len(groups)]
    out = (hashed.groupBy(*names) if names else hashed).agg(F.count(F.lit(1)).alias("rows"), slice_sum(F.col("_h"), 1).alias("_a"), slice_sum(F.col("_h"), 16).alias("_b"))
    zero = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    return out.select(*names, "rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), zero("_a"), zero("_b")), 256).alias("digest"))


def tagged(c: Column, dtype: T.DataType) -> Column:
    """A value as tagged JSON, the strict form: null, bytes_sha256, decimal, datetime (UTC), date, float (all digits), str, and value for
    whole numbers and booleans."""
    pair = lambda name, v: F.to_json(F.named_struct(F.lit(name), v))
    if isinstance(dtype, T.BinaryType):
        some = pair("bytes_sha256", F.sha2(c, 256))
    elif isinstance(dtype, T.DecimalType):
        some = pair("decimal", plain_decimal(c))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        some = pair("datetime", utc_text(c, dtype))
    elif isinstance(dtype, T.DateType):
        some = pair("date", c.cast("string"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        some = pair("float", float_text(c))
    elif isinstance(dtype, T.StringType):
        some = pair("str", F.translate(c, "\0", ""))
    elif isinstance(dtype, T.BooleanType):
        some = pair("value", F.initcap(c.cast("string")))
    else:
        some = pair("value", c.cast("string"))
    return F.when(c.isNull(), F.lit('{"null":true}')).otherwise(some)


def strict_digest(df: DataFrame, columns: list[str], *groups: Column) -> DataFrame:
    """rows and an exact digest of sorted tagged rows under a header of column names, for each group. Its state is every row of a group, so
    groups are asked for: chunks of bounded size."""
    if not groups:
        raise ValueError("a strict digest holds all rows of a group at once: give it chunks")
    row = F.concat(F.lit("["), F.concat_ws(",", *(tagged(F.col(c), df.schema[c].dataType) for c in columns)), F.lit("]"))
    lines = df.select(*groups, row.alias("_row"))
    names = lines.columns[: len(groups)]
    header = "[" + ",".join(f'"{c.lower()}"' for c in columns) + "]"
    out = lines.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list("_row")).alias("_rows"))
    return out.select(*names, "rows", F.sha2(F.concat_ws("\n", F.lit(header), F.array_join("_rows", "\n")), 256).alias("digest"))
