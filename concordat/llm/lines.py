"""Removal of repeated and nearly repeated lines by a deletion-neighbourhood join, with DataFrame functions only.

A line is the sequence of its words, runs of other than white space; the edit distance counts words put in, taken out or replaced.
The bound is one edit in NEAR_WORDS words, one at most: shorter lines have only equal ones as neighbours, as a word more or less
makes another line of them. Blank lines are not compared. A line's neighbourhood is the line itself and the line without each one
of its words. Two lines are within the bound exactly when
one is the other without a word, or both are equal once the word at the same place is taken out. So lines that share a
hashed variant need no pairs: the earliest line of a variant is the witness against the others, found by grouped minima, and
the words of each line and its witness are compared before anything goes.

Most lines have no neighbour at all, and a neighbourhood is as large as the square of a line. One edit leaves the first half or
the second half of a line's words alone, so only lines that share a half with another line emit their variants; no line that
has a neighbour is left out by that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import Sieve, cut, sieve, sifted, spread_join

NEAR_WORDS = 8
SPACES = "\t\x0b\x0c\r\xa0\u3000"  # white space besides the blank
HOT = 1000  # a line that occurs more often is spread over tasks


def _halves() -> list[Column]:
    """Hashes of the first and the last words of a line of n words, as if the shorter line of a pair had as many (less = 0) or one fewer (1)."""
    out = []
    for less in (0, 1):
        m = F.col("n") - less
        half = F.floor(m / 2).cast("int")
        for name, k in (("first", half), ("last", half - m)):
            part = F.call_function("substring_index", "line", F.lit(" "), k)
            out.append(F.when(F.col("n") >= NEAR_WORDS, F.xxhash64(m, F.lit(name), part)).alias(f"{name}{less}"))
    return out


def line_table(docs: DataFrame, among: Sieve | None = None) -> DataFrame:
    """doc_id, text_hash, line_no and line (words parted by one space) of every line that is not blank; with a sieve of hashed doc_id and text_hash,
    of the documents that may be in it."""
    # white space is made alike in whole texts, and only in those that need it; the hash is taken below the explosion, once for a text
    odd = reduce(lambda a, b: a | b, (F.contains("text", F.lit(c)) for c in SPACES))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    if among:
        whole = sifted(whole, F.xxhash64("doc_id", "text_hash"), among).where("_likely")
    whole = whole.select("doc_id", "text_hash", F.when(odd, F.translate("text", SPACES, " " * len(SPACES))).otherwise(F.col("text")).alias("text"))
    whole = whole.select("doc_id", "text_hash", F.split(F.when(F.contains("text", F.lit("  ")), F.regexp_replace("text", " {2,}", " ")).otherwise(F.col("text")), "\n", -1).alias("lines"))
    # outer, as Spark would else put a filter (not null, not empty) below the explosion that does all of the above a second time
    every = whole.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("line_no", "line"))
    return every.withColumn("line", F.trim("line")).where("line <> ''")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no of each line that has an equal line, or one within the bound, earlier in that order.

    The rule looks at original lines: a line goes when an earlier neighbour exists, even if that neighbour goes itself. Rows
    that repeat a doc_id with another text are documents of their own; rows that repeat both are one.
    """
    lines = line_table(docs).where("doc_id IS NOT NULL")
    where = ["doc_id", "text_hash", "line_no"]
    key = [F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")]
    parts = [f"{name}{less}" for less in (0, 1) for name in ("first", "last")]
    n_words = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    seen = cut(lines.withColumn("n", n_words).select(*key, *where, *_halves()), "lines", free=True)
    firsts = cut(seen.groupBy("h1", "h2").agg(F.min(F.struct(*where)).alias("first"), F.count(F.lit(1)).alias("n"), *(F.min(p).alias(p) for p in parts)), "line-firsts", free=True)

    # a line is known by h1 here: two lines with one hash would only be looked at more closely
    halves = firsts.where("first0 IS NOT NULL").select("h1", F.explode(F.array(*parts)).alias("half"))
    met = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    likely = halves.join(met, "half").select("h1").distinct()
    own = cut(firsts.select("h1", "first").join(likely, "h1").select("first.*").distinct(), "likely", free=True)
    # the text of a likely line comes from its first place only; few lines are, so most stay out of the join, and documents without one are not split
    place, n_own = F.xxhash64(*where), own.count()
    among = line_table(docs, sieve(own.select(F.xxhash64("doc_id", "text_hash").alias("at")), n_own)).where("doc_id IS NOT NULL")
    some = sifted(among, place, sieve(own.select(place.alias("at")), n_own)).where("_likely").drop("_likely")
    # repeated rows give a line twice
    texts = cut(some.dropDuplicates(where).join(own, where).select(*key, F.struct(*where).alias("p"), F.split("line", " ", -1).alias("words")), "likely-lines", free=True)
    # a sequence's hash is the xor of its words' hashes with their places, so a running xor gives every variant in one pass
    by_line = texts.select("p", "words").repartition("p")
    words = by_line.select("p", F.size("words").alias("n"), F.posexplode("words").alias("i", "word")).select("p", "n", "i", F.xxhash64("word", "i").alias("a"), F.xxhash64("word", F.col("i") - 1).alias("b"))
    line = Window.partitionBy("p")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left, right = F.bit_xor("a").over(upto).bitwiseXOR(F.col("a")), F.bit_xor("b").over(line).bitwiseXOR(F.bit_xor("b").over(upto))
    hashed = words.select("p", "n", "i", F.bit_xor("a").over(line).alias("whole"), left.bitwiseXOR(right).alias("cut"))
    variants = F.array(F.struct(F.xxhash64("cut", F.col("n") - 1).alias("v"), F.col("i")), F.when(F.col("i") == 0, F.struct(F.xxhash64("whole", "n").alias("v"), F.lit(-1).alias("i"))))
    entries = cut(hashed.select(F.col("p").alias("first"), F.explode_outer(F.filter(variants, lambda x: x.isNotNull())).alias("x")).select("first", "x.v", "x.i"), "variants", free=True)
    often = entries.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("v")
    shared = cut(entries.join(often, "v").select("v", "i", "first"), "shared-variants", free=True)
    is_self = F.col("i") < 0
    by_place = shared.groupBy("v", "i").agg(F.min("first").alias("place_first"))
    by_variant = by_place.groupBy("v").agg(F.min(F.when(is_self, F.col("place_first"))).alias("self_first"), F.min(F.when(~is_self, F.col("place_first"))).alias("cut_first"))
    whole = spread_join(spread_join(shared, by_place, ["v", "i"], F.col("first")), by_variant, ["v"], F.col("first"), 4)
    witness = F.explode(F.when(is_self, F.array("cut_first")).otherwise(F.array("place_first", "self_first")))
    claims = whole.select(F.col("first").alias("p"), witness.alias("witness")).where("witness < p").distinct()
    checked = claims.join(texts, "p").join(texts.select(F.col("p").alias("witness"), F.col("words").alias("w")), "witness").where(within_one(F.col("words"), F.col("w")))
    near = checked.select("h1", "h2").distinct().withColumn("near", F.lit(True))

    fate = firsts.select("h1", "h2", "first", "n").join(near, ["h1", "h2"], "left").where("n > 1 OR near").select("h1", "h2", "first", "n", F.coalesce("near", F.lit(False)).alias("near"))
    fate = cut(fate, "line-fates", free=True)
    # a line that stands in very many places is not one task's: its places and its fate are dealt to several
    hot = fate.where(F.col("n") > HOT).select("h1")
    here, there = (sifted(df, F.col("h1"), sieve(hot, hot.count()), "_hot") for df in (seen.select("h1", "h2", *where), fate))
    ways = F.lit(64)
    here = here.withColumn("_way", F.when(F.col("_hot"), F.pmod(F.xxhash64(*where), ways)).otherwise(0)).drop("_hot")
    there = there.withColumn("_way", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"), ways - 1)).otherwise(F.array(F.lit(0).cast("long"))))).drop("_hot", "n")
    gone = here.join(there, ["h1", "h2", "_way"]).where(F.col("near") | (F.struct(*where) != F.col("first")))
    return cut(gone.select(*where).distinct(), "dropped-lines", free=True)


def within_one(a: Column, b: Column) -> Column:
    """True if one word put in, taken out or replaced makes the words of a those of b."""
    n, m = F.size(a), F.size(b)
    apart = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    # with one word more, both agree up to some place and from there on with the longer one moved by one
    shift = lambda long, short: F.exists(
        F.sequence(F.lit(0), F.size(short)), lambda i: (F.slice(long, F.lit(1), i) == F.slice(short, F.lit(1), i)) & (F.slice(long, i + 2, F.size(short)) == F.slice(short, i + 1, F.size(short)))
    )
    return F.when(n == m, apart <= 1).when(n == m + 1, shift(a, b)).when(m == n + 1, shift(b, a)).otherwise(False)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with the dropped lines taken out of text, and n_lines and n_dropped (long) added; every row stays.

    A null text stays null with no lines; an empty text has one empty line. Rows that repeat a doc_id with another text are each
    compared; rows that repeat both lose the same lines, and are not copies of each other. A row without doc_id keeps all its lines. An
    n_chars column is brought up to date. All other columns pass through, whatever their names; columns of docs named n_lines,
    n_dropped are replaced. An empty table gives no rows.
    """
    dropped = dropped_lines(docs)
    gone = dropped.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).agg(F.collect_set("line_no").alias("_gone"))
    docs = docs.drop("n_lines", "n_dropped")
    place = F.xxhash64("_d", "_t")
    base = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"))
    # only documents that may have lost a line go through the join
    losers = dropped.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    parted = sifted(base, place, sieve(losers.select(place.alias("at")), losers.count()))
    out = parted.where("_likely").join(gone, ["_d", "_t"], "left").unionByName(parted.where("NOT _likely"), allowMissingColumns=True)
    split = F.split("_row.text", "\n", -1)
    # the split text is bound once, as the one element of a list; array_except hashes, so a text takes time in proportion to its lines
    kept = F.transform(F.array(split), lambda s: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(s) - 1), F.col("_gone")), lambda i: F.get(s, i)), "\n"))[0]
    untouched = F.col("_gone").isNull()
    out = out.select("_row", "_gone", F.when(untouched, F.col("_row.text")).otherwise(kept).alias("_text"))
    n_lines = F.when(F.col("_row.text").isNull(), F.lit(0)).otherwise(F.size(split))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(untouched, F.col("_row.n_chars")).otherwise(F.char_length("_text")).cast(docs.schema["n_chars"].dataType)
    same = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    return out.select(*(c.alias(n) for n, c in (same | new).items()), n_lines.cast("long").alias("n_lines"), F.coalesce(F.when(untouched, 0).otherwise(F.size("_gone")), F.lit(0)).cast("long").alias("n_dropped"))
