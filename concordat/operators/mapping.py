"""Which source column feeds which target column, and what happens to long columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.text import blank_to_space, decimal_text, sanitized

FAILED = "struct<key_values:string,failures:array<struct<column_name:string,value:string,target_type:string>>,source_row:string>"
STRATEGIES = ("error", "null", "skip", "stream", "include")


class LongColumnError(ValueError):
    """A long column has no strategy."""


@dataclass(frozen=True)
class Pair:
    """A target column and the source column that feeds it; None writes nulls."""

    target: str
    source: str | None
    dtype: str


def column_map(source: DataFrame, target: DataFrame, rename: dict[str, str] | None = None, by: str = "target") -> list[Pair]:
    """Pairs in order of the target's columns, or of the source's; names meet in lower case after renaming (source -> target)."""
    names = {(rename or {}).get(c.lower(), c.lower()): c for c in source.columns}
    types = {c.lower(): (c, d) for c, d in target.dtypes}
    order = types if by == "target" else names
    return [Pair(types[n][0], names[n], types[n][1]) for n in order if n in names and n in types]


def is_long(dtype: str) -> bool:
    return dtype == "binary" or dtype.startswith(("array", "map", "struct", "variant"))


def strategy_of(table: str, column: str, rules: dict[str, str], default: str = "error") -> str:
    """The first rule that names the column: by schema, table and column, by parts of that, in any case, or the default."""
    bare = table.rpartition(".")[2]
    for name in dict.fromkeys((f"{table}.{column}", f"{bare}.{column}", column)):
        for key, value in rules.items():
            if key == name or key.lower() == name.lower():
                return value.lower()
    return default.lower()


def with_long_policy(pairs: list[Pair], table: str, long: set[str], rules: dict[str, str], default: str = "error") -> list[Pair]:
    """Pairs after the policy for long columns: skipped, fed nulls, or kept; a column without a strategy is an error."""
    out = []
    for p in pairs:
        if p.target.lower() not in long:
            out.append(p)
            continue
        strategy = strategy_of(table, p.target, rules, default)
        if strategy not in STRATEGIES or strategy == "error":
            raise LongColumnError(f"{table}.{p.target}: choose one of {', '.join(STRATEGIES[1:])} for this long column")
        if strategy != "skip":
            out.append(Pair(p.target, None if strategy == "null" else p.source, p.dtype))
    return out


def _cleaned(p: Pair, types: dict[str, str], trim: set[str], reverse: bool) -> Column:
    """A pair's source value before its cast. The reverse direction writes blank texts as a space and numbers in text without stray digits."""
    c = sanitized(p.source, types[p.source], p.target.lower() in trim)
    if reverse and types[p.source] == "string":
        return decimal_text(c) if p.dtype.startswith("decimal") else blank_to_space(c)
    return c


def projected(source: DataFrame, pairs: list[Pair], trim: set[str] = frozenset(), reverse: bool = False) -> DataFrame:
    """The source in the target's shape: renamed, cast and cleaned. Only the columns needed are read. A value that cannot be cast is an error."""
    types = dict(source.dtypes)
    return source.select(*((F.lit(None) if p.source is None else _cleaned(p, types, trim, reverse)).cast(p.dtype).alias(p.target) for p in pairs))


def attempted(source: DataFrame, pairs: list[Pair], trim: set[str] = frozenset(), reverse: bool = False, mark: Column | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """projected(), with null for values that cannot be cast, and _failed, null for rows that can be: key_values (of the source, 200 characters of each),
    failures (every such column with its value, 200 characters, and its target type), source_row (what the target is fed of, as JSON). mark: an expression
    over the source to keep as _mark, which the target need not have. keys: target columns."""
    types = dict(source.dtypes)
    fed = [p for p in pairs if p.source is not None]
    short = lambda c: F.substring(c.cast("string"), 1, 200)
    bad = []
    for p in fed:
        if types[p.source] != p.dtype and not is_long(types[p.source]):
            c = _cleaned(p, types, trim, reverse)
            bad.append((c.isNotNull() & c.try_cast(p.dtype).isNull(), F.struct(F.lit(p.target).alias("column_name"), short(c).alias("value"), F.lit(p.dtype).alias("target_type"))))
    failed = F.lit(None).cast(FAILED)
    if bad:
        named = {p.target.lower(): p.source for p in fed}
        key = F.concat_ws(";", *(F.coalesce(short(F.col(named[k.lower()])), F.lit("")) for k in keys if k.lower() in named))
        # lists are made of rows that fail only
        failures = F.array_compact(F.array(*(F.when(b, what) for b, what in bad)))
        row = F.to_json(F.struct(*(F.col(c) for c in dict.fromkeys(p.source for p in fed))))
        failed = F.when(reduce(lambda a, b: a | b, (b for b, _ in bad)), F.struct(key.alias("key_values"), failures.alias("failures"), row.alias("source_row")))
    values = [(F.lit(None).cast(p.dtype) if p.source is None else _cleaned(p, types, trim, reverse).try_cast(p.dtype) if not is_long(types[p.source]) else F.col(p.source).cast(p.dtype)).alias(p.target) for p in pairs]
    return source.select(*values, failed.alias("_failed"), *([] if mark is None else [mark.alias("_mark")]))


def fixed_length(df: DataFrame) -> set[str]:
    """Columns declared CHAR(n): their padding is not part of the value."""
    return {f.name.lower() for f in df.schema if str(f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")).startswith("char")}
