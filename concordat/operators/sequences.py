"""Sequences of both sides: which belong together, the next value the target needs, and where it stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PIECE = 3  # letters of a name's piece


def _pieces(name: Column, size: int) -> Column:
    """The distinct pieces of a name of `size` letters."""
    last = F.length(name) - size + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(name, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def holding(wanted: DataFrame, word: str, names: DataFrame, name: str) -> DataFrame:
    """Pairs of a row of `wanted` and a row of `names` whose name holds the row's word (in capitals), by an index of pieces: the names of the word's
    rarest piece are looked up by equality and then held against the whole word. An empty word is in no name."""
    sizes = [1, 2, PIECE]
    index = names.withColumn("_p", F.explode(F.flatten(F.array(*(_pieces(F.upper(name), n) for n in sizes)))))
    often = index.groupBy("_p").agg(F.count(F.lit(1)).alias("_often"))
    up = F.upper(word)
    own = F.when(F.length(up) >= PIECE, _pieces(up, PIECE)).when(F.length(up) == 2, _pieces(up, 2)).otherwise(_pieces(up, 1))
    numbered = wanted.select(F.struct("*").alias("_row"), up.alias("_word"), own.alias("_own"), F.monotonically_increasing_id().alias("_id"))
    asked = numbered.select("_row", "_word", "_id", F.explode("_own").alias("_p")).join(often, "_p", "left")
    # a piece that no name has is the rarest: nothing is looked up then
    rarest = asked.groupBy("_id").agg(F.min_by(F.struct("_row", "_word", "_p"), F.struct(F.coalesce("_often", F.lit(0)), F.col("_p"))).alias("_x")).select("_x.*")
    found = rarest.join(index, "_p").where(F.contains(F.upper(name), F.col("_word")))
    return found.select("_row.*", *names.columns)


def matched(candidates: DataFrame, sequences: DataFrame) -> DataFrame:
    """Target sequences with their source sequence: of the same name, else the only one whose name holds the table's.

    candidates: table_name, target_sequence; sequences: name, source_last. The second way starts from those left without an equal, and
    looks names up by pieces, so no table meets every sequence.
    """
    c = candidates.withColumn("_up", F.upper("target_sequence"))
    s = sequences.select(F.upper("name").alias("source_sequence"), "source_last").dropDuplicates(["source_sequence"])
    equal = c.join(s, F.col("_up") == F.col("source_sequence"), "left")
    done = equal.where("source_sequence IS NOT NULL")
    left = equal.where("source_sequence IS NULL").select(*candidates.columns)
    held = holding(left.distinct(), "table_name", s, "source_sequence").select(*(F.col(x).alias(f"_{x}") for x in candidates.columns), "source_sequence", "source_last")
    same = F.lit(True)
    for x in candidates.columns:
        same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
    only = left.join(held, same, "left").groupBy(*candidates.columns).agg(F.count("source_sequence").alias("_n"), F.min(F.struct("source_sequence", "source_last")).alias("x"))
    one = F.col("_n") == 1
    loose = only.select(*candidates.columns, F.when(one, F.col("x.source_sequence")).alias("source_sequence"), F.when(one, F.col("x.source_last")).alias("source_last"), F.when(one, "contains").otherwise("none").alias("match"))
    return done.select(*candidates.columns, "source_sequence", "source_last", F.lit("exact").alias("match")).unionByName(loose)


def scanned(target: DataFrame, source: DataFrame, maxima: DataFrame) -> DataFrame:
    """The rows that planned() takes, of both catalogs and the tables. target: table_name, target_sequence, target_last, target_is_called, increment, max_value;
    source: name, source_last; maxima: table_name, source_table_max, target_table_max. A sequence without a partner has the status SKIPPED."""
    found = matched(target.select("table_name", "target_sequence").distinct(), source).select("table_name", "target_sequence", "source_sequence", "source_last", "match")
    rows = target.dropDuplicates(["table_name", "target_sequence"]).join(found, ["table_name", "target_sequence"], "left").join(maxima, "table_name", "left")
    return rows.withColumn("buffer", F.lit(0).cast("long")).withColumn("status", F.when(F.col("source_sequence").isNull(), "SKIPPED").otherwise(""))


def current_next() -> Column:
    """The value that the target's sequence gives next."""
    return F.when(F.col("target_is_called"), F.col("target_last") + F.col("increment")).otherwise(F.col("target_last"))


def next_value() -> Column:
    """The value it should give next: past the source's and target's largest, with the buffer above the source's last, up to the maximum."""
    step = F.abs("increment")
    want = F.greatest(F.col("source_last") + F.greatest(F.coalesce("buffer", F.lit(0)), F.lit(0)), current_next(), F.col("source_table_max") + step, F.col("target_table_max") + step, F.lit(1))
    return F.least(want, F.col("max_value"))


def planned(sequences: DataFrame) -> DataFrame:
    """Add current_next, set_to, capped, compare_status and delta. sequences: target_sequence, source_last, source_table_max, target_last,
    target_is_called, target_table_max, increment, max_value, buffer, status."""
    out = sequences.withColumn("current_next", current_next()).withColumn("set_to", next_value())
    state, base = F.upper(F.coalesce("status", F.lit(""))), F.coalesce("source_table_max", "source_last")
    ahead = F.when(F.coalesce("buffer", F.lit(0)) > 0, F.col("current_next") > F.col("set_to")).otherwise(F.col("current_next") > base)
    verdict = (
        F.when((state == "SKIPPED") | F.col("current_next").isNull() | F.col("set_to").isNull(), "SKIPPED")
        .when((F.col("current_next") < F.col("set_to")) & (state == "SET"), "SET_APPLIED")
        .when(F.col("current_next") < F.col("set_to"), "NEEDS_SET")
        .when(F.coalesce(ahead, F.lit(False)), "TARGET_AHEAD")
        .otherwise("ALIGNED")
    )
    return out.withColumns({"capped": F.coalesce(F.col("set_to") == F.col("max_value"), F.lit(False)), "compare_status": verdict, "delta": F.col("current_next") - F.coalesce(F.nullif("source_table_max", F.lit(0)), "source_last")})
