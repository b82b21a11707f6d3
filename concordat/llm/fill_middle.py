"""Fill-in-the-middle transformation by escaped marker injection, on built-in functions alone.

A delimiter is escaped in the text and appended to every unit by one regular expression; the units are then its occurrences, and the parts
before and after a rank are substring_index() of it. Parts lose the delimiters, are unescaped, and stand in a new order behind sentinels.

Nothing is shuffled: a row's form and cuts come from a hash of its id and the seed, so a task run again gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit: a word with the white space before it, or white space at the end of the text. No match gives back what it has taken.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT, ESCAPE = "\x01", "\x02"  # neither is white space to UNIT, so units of an escaped text are the escaped units


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(CUT), F.lit(ESCAPE + "d"))


def unescaped(text: Column) -> Column:
    """A part of an escaped text without delimiters, as it was."""
    return F.replace(F.replace(F.replace(text, F.lit(CUT), F.lit("")), F.lit(ESCAPE + "d"), F.lit(CUT)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def draws(id_: Column, seed: int) -> list[Column]:
    """Four whole numbers from 0 to 2^32 - 1: the first 32 hexadecimal digits of the SHA-256 of `seed:id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _ranked(marked: str, rank: Column) -> Column:
    return F.call_function("substring_index", F.col(marked), F.lit(CUT), rank.cast("int"))


def fill_in_middle(docs: DataFrame, id_: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """Each row of docs with _fim: (n, form, prefix, middle, suffix, output).

    n: units of the whole text. form: plain, spm or psm; plain where the text is null, empty or holds a sentinel, or the row is not among the
    `rate` percent that are cut. Of those `spm_rate` percent are spm (suffix first), the rest psm. Two ranks drawn from 0 to n part the
    units: prefix, middle, suffix; any part may be empty. output: the text of a plain row (null text: empty), else the parts behind
    PREFIX, SUFFIX and MIDDLE. Parts of plain rows are null.

    A null id draws as the empty text does; rows that repeat an id draw alike; texts are taken whole; other columns stay, whatever their
    names, but one called _fim is replaced. An empty table gives an empty one.
    """
    whole = F.coalesce(F.col(f"_row.{text}").cast("string"), F.lit(""))
    base = docs.select(F.struct("*").alias("_row")).select("_row", whole.alias("_text"), *[d.alias(f"_h{i}") for i, d in enumerate(draws(F.col(f"_row.{id_}"), seed), 1)])
    # each step is used more than once, so the optimizer keeps it a step of its own
    marked = base.withColumn("_bare", escaped(F.col("_text"))).withColumn("_marked", F.regexp_replace("_bare", f"({UNIT})", f"$1{CUT}"))
    counted = marked.withColumn("_n", (F.char_length("_marked") - F.char_length("_bare")).cast("long")).drop("_bare")
    sentinel = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    form = F.when((F.col("_text") == "") | sentinel | (F.col("_h3") % 100 >= rate), "plain").when(F.col("_h4") % 100 < spm_rate, "spm").otherwise("psm")
    one, two = F.col("_h1") % (F.col("_n") + 1), F.col("_h2") % (F.col("_n") + 1)
    cuts = counted.select("_row", "_text", "_marked", "_n", form.alias("_form"), F.least(one, two).alias("_lo"), F.greatest(one, two).alias("_hi"))
    # after the last unit stands a delimiter too: n - rank + 1 delimiters from the right begin after the unit of that rank
    cut = lambda part: F.when(F.col("_form") != "plain", unescaped(part))
    parts = cuts.select(
        "_row", "_text", "_n", "_form",
        cut(_ranked("_marked", F.col("_lo"))).alias("_prefix"),
        cut(F.call_function("substring_index", _ranked("_marked", F.col("_hi")), F.lit(CUT), (F.col("_lo") - F.col("_hi")).cast("int"))).alias("_middle"),
        cut(_ranked("_marked", F.col("_hi") - F.col("_n") - 1)).alias("_suffix"),
    )
    p, s, m = (F.concat(F.lit(mark), F.col(part)) for mark, part in ((PREFIX, "_prefix"), (SUFFIX, "_suffix"), (MIDDLE, "_middle")))
    output = F.when(F.col("_form") == "plain", F.col("_text")).when(F.col("_form") == "spm", F.concat(s, p, m)).otherwise(F.concat(p, s, m))
    fields = [F.col("_n").alias("n"), F.col("_form").alias("form"), F.col("_prefix").alias("prefix"), F.col("_middle").alias("middle"), F.col("_suffix").alias("suffix"), output.alias("output")]
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c != "_fim"]
    return parts.select(*kept, F.struct(*fields).alias("_fim"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of. Sentinels stand in outputs at their places only, so the first of each is the right one."""
    first, rest = (lambda x, mark: F.substring_index(x, mark, 1)), (lambda x, mark: F.substr(x, F.locate(mark, x) + F.lit(len(mark))))
    middle = rest(output, MIDDLE)
    prefix_first = F.concat(first(rest(output, PREFIX), SUFFIX), middle, first(rest(output, SUFFIX), MIDDLE))
    suffix_first = F.concat(first(rest(output, PREFIX), MIDDLE), middle, first(rest(output, SUFFIX), PREFIX))
    return F.when(form == "plain", output).when(form == "psm", prefix_first).otherwise(suffix_first)


def digests(done: DataFrame, id_: str = "doc_id") -> DataFrame:
    """Counts of what fill_in_middle() has made, and digests of the output and of the text rebuilt from it."""
    f = lambda name: F.col(f"_fim.{name}")
    sha = lambda x: F.sha2(x.cast("binary"), 256)
    return done.select(
        F.col(id_), f("n").alias("n"), f("form").alias("form"), F.char_length(f("prefix")).cast("long").alias("prefix_chars"), F.char_length(f("middle")).cast("long").alias("middle_chars"),
        sha(f("output")).alias("output_sha256"), sha(restored(f("output"), f("form"))).alias("restored_sha256"),
    )
