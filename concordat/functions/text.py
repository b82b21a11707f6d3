"""Cleaning of values on their way from one store to another."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ENDS = r"(?U)^\s+|\s+$"


def without_nul(c: Column) -> Column:
    return F.translate(c, "\0", "")


def strip(c: Column) -> Column:
    """White space of every kind goes from both ends; trim() takes spaces only."""
    return F.regexp_replace(c, _ENDS, "")


def blank_to_space(c: Column) -> Column:
    """A text of nothing but white space becomes one space, for stores that take an empty text as null."""
    clean = without_nul(c)
    return F.when(strip(clean) == "", F.lit(" ")).otherwise(clean)


def hex_text(c: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(c)))


def decimal_text(c: Column, scale: int = 12) -> Column:
    """A number in text rounded half up to `scale` places without trailing zeros; other texts stay."""
    bare = strip(c)
    number = lambda x: x.try_cast(f"decimal(38,{scale})")
    short = F.regexp_replace(F.regexp_replace(number(bare).cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    plain = F.when(short.rlike(r"^-?0?$"), F.lit("0")).otherwise(short)
    return F.when(bare.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$") & number(bare).isNotNull(), plain).otherwise(c)


def byte_size(c: Column) -> Column:
    return F.octet_length(c.cast("string"))


def sanitized(name: str, dtype: str, trim: bool = False) -> Column:
    """A column as the loader writes it: NULs out, fixed-length text stripped."""
    c = F.col(name)
    if dtype != "string" and not dtype.startswith(("char", "varchar")):
        return c
    c = without_nul(c)
    return strip(c) if trim else c


_WORD = r'"[^"]+"|[A-Za-z0-9_$#]+'


def _bare(token: Column) -> Column:
    return F.upper(F.replace(token, F.lit('"'), F.lit("")))


def sequence_names(c: Column) -> Column:
    """Upper-case names of the sequences that a routine's text draws from, each once: the name, a dot and NEXTVAL, as three tokens."""
    tokens = F.regexp_extract_all(c, F.lit(rf"{_WORD}|\."), 0)
    drawn = lambda t: F.transform(t, lambda x, i: F.when((F.get(t, i + 1) == ".") & (_bare(F.get(t, i + 2)) == "NEXTVAL") & (x != "."), _bare(x)))
    # the tokens are bound once, as the one element of a list
    return F.array_distinct(F.filter(F.transform(F.array(tokens), drawn)[0], lambda x: x.isNotNull()))


def words_of(c: Column) -> Column:
    """The names in a text, bare or quoted, in upper case."""
    return F.transform(F.regexp_extract_all(c, F.lit(_WORD), 0), _bare)


def mentions_table(c: Column, table: str) -> Column:
    """Whether a text names the table, as a whole word, bare or quoted, in any case and with any schema."""
    return F.exists(F.regexp_extract_all(c, F.lit(_WORD), 0), lambda x: _bare(x) == table.upper())


SECRET_NAMES = frozenset(["password", "passwd", "pwd", "secret", "token", "api_key", "access_key", "private_key"])


def masked(value):
    """A settings tree with the values of secrets replaced. Only whole names count, so key_columns stays readable."""
    if isinstance(value, dict):
        return {k: "***" if str(k).lower() in SECRET_NAMES or str(k).lower().endswith(("_password", "_secret", "_token")) else masked(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [masked(v) for v in value]
    return re.sub(r"(?i)(://[^:/\s]+:)[^@\s]+@|((?:password|pwd)=)[^;&\s]+", lambda m: f"{m[1]}***@" if m[1] else f"{m[2]}***", value) if isinstance(value, str) else value


UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1000, "kib": 1 << 10, "m": 1 << 20, "mb": 1000**2, "mib": 1 << 20, "g": 1 << 30, "gb": 1000**3, "gib": 1 << 30, "t": 1 << 40, "tb": 1000**4, "tib": 1 << 40}


def parse_size(text: str | int | None) -> int | None:
    """Bytes of `20GiB`, `1.5 mb` or a number."""
    if text is None or isinstance(text, int):
        return text
    m = re.fullmatch(r"\s*([0-9]+(?:\.[0-9]+)?)\s*([a-zA-Z]*)\s*", text)
    if not m or m[2].lower() not in UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(float(m[1]) * UNITS[m[2].lower()])


def format_size(n: float) -> str:
    for unit in ("B", "KiB", "MiB", "GiB"):
        if abs(n) < 1024:
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TiB"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def split_name(name: str, schema: str = "public") -> tuple[str, str]:
    """Schema and table of a one- or two-part name, in lower case and without quotes."""
    parts = [p.strip().strip('"').lower() for p in name.split(".")]
    if len(parts) > 2 or not all(parts):
        raise ValueError(f"a table name has one or two parts: {name!r}")
    return (parts[0], parts[1]) if len(parts) == 2 else (schema, parts[0])


def bounded_name(*parts: str, limit: int = 63) -> str:
    """Parts joined by `__`, cut so that the whole keeps within a store's limit and the last part stays whole."""
    tail = "__" + parts[-1]
    return "__".join(parts[:-1]).encode()[: limit - len(tail.encode())].decode(errors="ignore") + tail
