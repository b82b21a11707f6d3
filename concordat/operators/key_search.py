"""The least sets of columns that tell all rows apart, where no constraint says so.

Sets are searched level by level: one column, two, three. A level is one scan that feeds a distinct-count sketch for each candidate, so its cost does
not grow with their number of shuffles; sketches merge, and need a few KB each. A set is left out unseen if it holds a key already found, or if its
columns together cannot take as many values as there are rows. What a sketch cannot rule out is counted exactly, one set at a time.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_K = 14  # sketches of 2^14 slots: a standard error of 0.8 percent
RULED_OUT = 0.95  # of the rows; an estimate below is six standard errors short
AT_ONCE = 40  # sketches fed by one scan


def estimates(df: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """About how many distinct rows each set of columns has, null being a value."""
    out = {}
    for lo in range(0, len(sets), AT_ONCE):
        some = sets[lo : lo + AT_ONCE]
        sketch = [F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*(x for c in s for x in (F.col(c), F.col(c).isNull()))), F.lit(LOG_K))).alias(f"e{i}") for i, s in enumerate(some)]
        row = df.agg(*sketch).first()
        out |= {s: row[f"e{i}"] or 0 for i, s in enumerate(some)}
    return out


def is_key(df: DataFrame, columns: tuple[str, ...]) -> bool:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def least_keys(df: DataFrame, columns: list[str] | None = None, most: int = 3, nulls: bool = False) -> list[tuple[str, ...]]:
    """Every set of at most `most` columns that is unique and holds no smaller such set, smaller sets first, then by the columns' places.

    columns: those to search, by default all that can be keys (no nested, binary or floating-point ones). A column with nulls is in no key unless
    `nulls` is set, which takes null as a value. An empty table has no key.
    """
    plain = [c for c, d in df.dtypes if not d.startswith(("array", "map", "struct", "binary", "variant", "float", "double"))]
    names = [c for c in (columns or plain) if c in df.columns]
    if not names:
        return []
    row = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(f"c{i}") for i, c in enumerate(names))).first()
    rows = row["n"]
    if not rows:
        return []
    names = [c for i, c in enumerate(names) if nulls or row[f"c{i}"] == rows]
    found: list[tuple[str, ...]] = []
    single: dict[str, int] = {}
    for size in range(1, most + 1):
        sets = []
        for s in combinations(names, size):
            room = 1
            for c in s:
                room *= single[c] * 1.06 if size > 1 else rows
            if room >= rows and not any(set(k) <= set(s) for k in found):
                sets.append(s)
        counted = estimates(df, sets)
        if size == 1:
            single = {s[0]: n for s, n in counted.items()}
        found += [s for s in sets if counted[s] >= RULED_OUT * rows and is_key(df, s)]
    return found
