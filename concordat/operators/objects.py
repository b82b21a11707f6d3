"""Catalog objects and what depends on what: compare, dedupe, summarise, and the outcome of repairs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.operators import key_search

# Words in a status that mean trouble, and other names of object types.
BROKEN = ("BROKEN", "DISABLED", "FAILED", "INVALID", "MISSING", "UNUSABLE")
TYPE_ALIASES = {"MVIEW": "MATERIALIZED VIEW", "MATERIALIZED_VIEW": "MATERIALIZED VIEW", "PROC": "PROCEDURE", "SP": "PROCEDURE", "PKG": "PACKAGE"}
STATUS_FIELDS = ("status", "validation_status", "maintenance_status", "compile_status", "dependency_status")
COUNT_FIELDS = ("broken_count", "invalid_count", "missing_count", "failed_count")


def object_type(c: Column) -> Column:
    """A type's usual name."""
    name = F.upper(c)
    out = F.replace(name, F.lit("_"), F.lit(" "))
    for alias, usual in TYPE_ALIASES.items():
        out = F.when(F.replace(name, F.lit("-"), F.lit("_")) == alias, usual).otherwise(out)
    return out


def compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """Objects of both sides by type, parent and name in lower case: MATCH, MISSING_IN_SOURCE or MISSING_IN_TARGET.

    source, target: object_type, object_name, parent_name, status, details, seq. Of equal keys the row with the largest seq counts; the
    arguments of overloaded routines are not part of the key.
    """
    key = [F.lower(F.coalesce(c, F.lit(""))).alias(f"k_{c}") for c in ("object_type", "parent_name", "object_name")]
    names = [f"k_{c}" for c in ("object_type", "parent_name", "object_name")]
    one = lambda df, side: df.select(*key, F.struct("seq", "object_type", "object_name", "parent_name", "status", "details").alias(side)).groupBy(*names).agg(F.max(side).alias(side))
    both = one(source, "s").join(one(target, "t"), names, "full_outer")
    has_s, has_t = F.col("s").isNotNull(), F.col("t").isNotNull()
    either = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
    status = F.when(has_s & has_t, "MATCH").when(has_s, "MISSING_IN_TARGET").otherwise("MISSING_IN_SOURCE")
    return both.select(
        either("object_type"), either("object_name"), either("parent_name"), has_s.alias("source_exists"), has_t.alias("target_exists"), status.alias("status"),
        F.col("s.status").alias("source_status"), F.col("t.status").alias("target_status"), F.col("s.details").alias("source_details"), F.col("t.details").alias("target_details"),
    )


EDGE_KEY = ("source_db", "table_name", "object_schema", "object_name", "object_type", "dependency_kind")


def distinct_edges(edges: DataFrame) -> DataFrame:
    """The first of edges that agree in six names, upper or lower case. edges: EDGE_KEY, seq and others."""
    lower = [F.lower(F.coalesce(c, F.lit(""))).alias(f"_{c}") for c in EDGE_KEY]
    others = [c for c in edges.columns if c != "seq"]
    return edges.groupBy(*lower).agg(F.min_by(F.struct(*others), "seq").alias("x")).select("x.*")


def _has(c: Column, *words: str) -> Column:
    return F.coalesce(F.upper(c).rlike("|".join(words)), F.lit(False))


def is_broken(df: DataFrame) -> Column:
    """A count above zero, a word of trouble in a status, or `status=WORD` in the details."""
    out = F.lit(False)
    for c in COUNT_FIELDS:
        if c in df.columns:
            out = out | (F.coalesce(F.col(c).cast("long"), F.lit(0)) > 0)
    for c in STATUS_FIELDS:
        if c in df.columns:
            out = out | _has(F.col(c), *BROKEN)
    return out | _has(F.col("details"), *(f"STATUS={w}" for w in BROKEN)) if "details" in df.columns else out


def health(edges: DataFrame, maintenance: DataFrame | None = None) -> DataFrame:
    """Counts for each phase, store and table: object_count, broken_count, invalid_count, missing_count, failed_count.

    Maintenance rows are a phase of their own.
    """
    flag = lambda c: F.when(c, 1).otherwise(0)
    phase = F.coalesce(F.nullif(F.col("phase"), F.lit("")), F.lit("dependency")) if "phase" in edges.columns else F.lit("dependency")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = edges.select(phase.alias("phase"), text("source_db"), text("table_name"), flag(is_broken(edges)).alias("b"), flag(_has(F.col("status"), *BROKEN)).alias("i"), F.lit(0).alias("m"), F.lit(0).alias("f"))
    if maintenance is not None:
        failed = _has(F.col("maintenance_status"), "FAILED") | _has(F.col("compile_status"), "FAILED")
        rows = rows.unionByName(maintenance.select(F.lit("maintenance").alias("phase"), text("source_db"), text("table_name"), flag(is_broken(maintenance)).alias("b"), F.lit(0).alias("i"), flag(_has(F.col("validation_status"), "MISSING")).alias("m"), flag(failed).alias("f")))
    sums = {"broken_count": "b", "invalid_count": "i", "missing_count": "m", "failed_count": "f"}
    return rows.groupBy("phase", "source_db", "table_name").agg(F.count(F.lit(1)).alias("object_count"), *(F.sum(c).alias(n) for n, c in sums.items()))


def repair_outcome(attempted: DataFrame, still_invalid: DataFrame, keys: list[str]) -> DataFrame:
    """Attempted repairs: failed where the object is still invalid, else fixed."""
    bad = still_invalid.select(*keys).distinct().withColumn("_bad", F.lit(True))
    return attempted.join(bad, keys, "left").select(*attempted.columns, F.when(F.col("_bad"), "failed").otherwise("fixed").alias("outcome"))


def object_counts(objects: DataFrame) -> DataFrame:
    """For each table how many indexes, triggers, constraints and sequences it has, and distinct views and routines that use it."""
    n = lambda *kinds: F.count_if(object_type(F.col("object_type")).isin(*kinds))
    d = lambda *kinds: F.count_distinct(F.when(object_type(F.col("object_type")).isin(*kinds), F.lower("object_name")))
    return objects.groupBy("table_name").agg(n("INDEX").alias("index_count"), d("VIEW", "MATERIALIZED VIEW").alias("view_count"), n("SEQUENCE").alias("sequence_count"), d("PROCEDURE", "FUNCTION", "PACKAGE").alias("routine_count"), n("TRIGGER").alias("trigger_count"), n("CONSTRAINT").alias("constraint_count"))


def preferred_key(constraints: DataFrame) -> DataFrame:
    """Each table's best key: a primary before a unique constraint, then by name; columns in order of position.

    constraints: table_name, constraint_name, constraint_type (P or U), column_name, position.
    """
    whole = constraints.where(F.col("constraint_type").isin("P", "U")).groupBy("table_name", "constraint_type", "constraint_name").agg(F.array_sort(F.collect_list(F.struct("position", F.lower("column_name").alias("c")))).alias("cs"))
    rank = F.struct(F.when(F.col("constraint_type") == "P", 0).otherwise(1), F.col("constraint_name"))
    return whole.groupBy("table_name").agg(F.min_by(F.struct("constraint_name", F.array_join("cs.c", ",").alias("key_columns")), rank).alias("x")).select("table_name", "x.*")


class NoKeyError(ValueError):
    """A table has no key that rows could be told apart by."""


def resolve_keys(table: str, configured: tuple[str, ...] = (), source: DataFrame | None = None, target: DataFrame | None = None, rows: DataFrame | None = None) -> tuple[list[str], str]:
    """A table's key columns and where they come from: the settings, else the source's best constraint, else the target's, else the first of the least
    sets of columns that are unique in `rows`.

    source, target: constraints as for preferred_key(). Without any of them there is no key, which is an error.
    """
    if configured:
        return list(configured), "settings"
    for side, constraints in (("source", source), ("target", target)):
        if constraints is not None and (found := preferred_key(constraints.where(F.lower("table_name") == table.lower())).first()):
            return found["key_columns"].split(","), f"{side} constraint {found['constraint_name']}"
    if rows is not None and (least := key_search.least_keys(rows)):
        return list(least[0]), "unique in the rows"
    raise NoKeyError(f"{table}: no key in the settings, and no primary or unique constraint on either side")


def dependency_edges(objects: DataFrame, tables: DataFrame) -> DataFrame:
    """Which objects use which tables: EDGE_KEY, status, details, seq.

    objects: source_db, object_schema, object_name, object_type, parent_name, definition, status; tables: table_name. An object belongs to its parent, and
    uses the tables whose names are words of its definition; a sequence belongs to the tables whose names are in its own, or whose objects draw
    from it. Words are exploded and joined by equality, so no object meets every table.
    """
    from concordat.functions.text import sequence_names, words_of

    t = tables.select(F.upper("table_name").alias("_t"), "table_name").dropDuplicates(["_t"])
    base = objects.withColumn("_id", F.monotonically_increasing_id())
    edge = lambda df, kind, details: df.select("source_db", "table_name", "object_schema", "object_name", "object_type", F.lit(kind).alias("dependency_kind"), "status", details.alias("details"), F.col("_id").alias("seq"))
    owned = edge(base.withColumn("_t", F.upper("parent_name")).join(t, "_t"), "parent", F.lit(""))
    used = edge(base.where("definition IS NOT NULL").withColumn("_t", F.explode(F.array_distinct(words_of(F.col("definition"))))).join(t, "_t"), "reference", F.lit("named in the definition"))
    names = base.where(object_type(F.col("object_type")) == "SEQUENCE")
    parts = F.split(F.upper("object_name"), "_")
    ranges = F.flatten(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.transform(F.sequence(F.lit(1), F.size(parts) - n + 1), lambda i: F.array_join(F.slice(parts, i, n), "_"))))
    by_name = edge(names.withColumn("_t", F.explode(F.array_distinct(ranges))).join(t, "_t"), "sequence name", F.lit("named after the table"))
    drawn = base.where("definition IS NOT NULL AND parent_name <> ''").select(F.explode(sequence_names(F.col("definition"))).alias("_s"), F.upper("parent_name").alias("_t"), F.col("object_name").alias("_by")).distinct()
    by_use = edge(names.withColumn("_s", F.upper("object_name")).join(drawn, "_s").join(t, "_t"), "sequence use", F.concat(F.lit("drawn by "), F.col("_by")))
    return distinct_edges(owned.unionByName(used).unionByName(by_name).unionByName(by_use))


def _settled(df: DataFrame) -> DataFrame:
    """df without its lineage, as Parquet in the folder that driver and executors share; it goes when the application ends."""
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        place = spark.conf.get("spark.checkpoint.dir", None)
        if not place and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(place or tempfile.mkdtemp(prefix="concordat-closure-"))
    where = context._jvm.org.apache.hadoop.fs.Path(f"{context.getCheckpointDir()}/closure-{uuid.uuid4().hex[:12]}")
    df.write.parquet(where.toString())
    where.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(where.toString())


def closure(edges: DataFrame, rounds: int = 200, few: int = 20_000) -> DataFrame:
    """What each object uses, directly or through others: object, uses, depth (of the shortest way), and whether the object uses itself (cyclic).

    edges: object, uses. Rows in which either is null are no edges. Objects that no other uses are taken off, layer by layer, while more than `few` edges are left and a
    layer holds at least a quarter of them. What is left holds all cycles and all that it uses itself; it is closed by rounds. Then the layers
    come back, the last first: what an object uses is closed by then, so one join with its uses gives all its pairs, and no pair meets all pairs found before.
    """
    e = edges.select("object", "uses").dropna().distinct()
    rest = _settled(e.join(e.groupBy("object").agg((F.count(F.lit(1)) == 1).alias("_only")), "object"))
    layers, left = [], rest.count()
    while left > few:
        users = rest.select(F.col("uses").alias("object"), F.lit(True).alias("_used")).distinct()
        parted = _settled(rest.join(users, "object", "left"))
        more = parted.where("_used").count()
        if more > 0.75 * left:
            break
        layers.append(parted.where("_used IS NULL").drop("_used"))
        rest, left = parted.where("_used").drop("_used"), more
    found = _closed(rest.select("object", "uses"), rounds)
    found = _settled(found) if layers else found
    for layer in reversed(layers):
        below = found.select(F.col("object").alias("uses"), F.col("uses").alias("_next"), "depth").where("uses <> _next")
        pairs = layer.join(below, "uses").select("object", F.col("_next").alias("uses"), F.col("depth") + 1, "_only")
        pairs = layer.select("object", "uses", F.lit(1).alias("depth"), "_only").union(pairs)
        # an object with one use gets each pair once
        once = pairs.where("_only").drop("_only").union(pairs.where("NOT _only").groupBy("object", "uses").agg(F.min("depth")))
        once = once.withColumn("cyclic", F.lit(False))
        found = found.union(once if layer is layers[0] else _settled(once))
    return found


def _closed(e: DataFrame, rounds: int) -> DataFrame:
    """closure() of distinct edges. A frontier of the pairs found last is joined with the edges, and pairs known before are left out, so each pair is
    found once and cycles come to an end."""
    step = e.select(F.col("object").alias("uses"), F.col("uses").alias("_next"))
    found = frontier = e.withColumn("depth", F.lit(1))
    for depth in range(2, rounds + 1):
        further = frontier.join(step, "uses").select("object", F.col("_next").alias("uses")).distinct()
        frontier = _settled(further.join(found, ["object", "uses"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        found = _settled(found.unionByName(frontier)) if depth % 8 == 0 else found.unionByName(frontier)
    else:
        raise ValueError(f"a chain of more than {rounds} objects")
    loops = found.where("object = uses").select("object", F.lit(True).alias("cyclic"))
    return found.join(loops, "object", "left").select("object", "uses", "depth", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def in_order(objects: DataFrame, closed: DataFrame) -> DataFrame:
    """objects (with a column `object`) with place: what is used comes before what uses it, as it uses fewer objects in all; in a cycle all have the same."""
    uses = closed.groupBy("object").agg(F.count(F.lit(1)).alias("place"))
    return objects.join(uses, "object", "left").withColumn("place", F.coalesce("place", F.lit(0)))


def newly_broken(before: DataFrame, after: DataFrame, edges: DataFrame, loaded: DataFrame) -> DataFrame:
    """Dependents of loaded tables that are broken and were not before: object, table_name, depth, and details of now.

    before, after: object_schema, object_name, object_type, status, details, one row an object. edges: object, uses, by schema.name, as they were before the
    load, since a broken object may have lost its edges. loaded: table_name. Names meet in lower case; an object that is new and broken
    counts, one that is gone does not. A dependent of several loaded tables has a row for each.
    """
    low = edges.select(F.lower("object").alias("object"), F.lower("uses").alias("uses"))
    name = F.lower(F.concat_ws(".", "object_schema", "object_name")).alias("object")
    bad = lambda df: df.where(is_broken(df)).select(name, *(["details"] if df is after else [])).dropDuplicates(["object"])
    fresh = bad(after).join(bad(before), "object", "left_anti")
    tables = loaded.select(F.lower("table_name").alias("uses"), "table_name").dropDuplicates(["uses"])
    return closure(low).join(tables, "uses").join(fresh, "object").select("object", "table_name", "depth", "details")
