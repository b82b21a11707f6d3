"""Repairs of broken objects, round by round, until none is left or a round mends nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators.objects import closure, in_order, is_broken, repair_outcome

KEYS = ["object_schema", "object_name"]
SCHEMA = "object_schema string, object_name string, object_type string, rounds int, message string"


def repaired(spark: SparkSession, scan: Callable[[], DataFrame], act: Callable[[str, str, str], None], rounds: int = 5, edges: DataFrame | None = None) -> DataFrame:
    """What became of the broken objects: object_schema, object_name, object_type, rounds (tried), message (of the last failure), outcome.

    scan gives the objects as they are (object_schema, object_name, object_type, status and others); act mends one, or raises. Objects may depend on
    each other: with edges (object, uses, by schema.name) what is used is mended before what uses it, so one round will do; without, those that
    are still broken are tried again as long as a round mends some. A catalog's broken objects are few.
    """
    closed = closure(edges) if edges is not None else None
    tried: dict[tuple[str, str], list] = {}
    before = None
    for n in range(1, rounds + 1):
        now = scan()
        broken = now.where(is_broken(now)).select(*KEYS, "object_type", F.concat_ws(".", *KEYS).alias("object")).distinct()
        placed = in_order(broken, closed) if closed is not None else broken.withColumn("place", F.lit(0))
        bad = [(r["object_schema"], r["object_name"], r["object_type"]) for r in placed.orderBy("place", *KEYS).collect()]
        if not bad or bad == before:
            break
        before = bad
        for schema, name, kind in bad:
            message = ""
            try:
                act(schema, name, kind)
            except Exception as e:
                message = str(e).splitlines()[0][:300]
            tried[schema, name] = [schema, name, kind, n, message]
    attempted = spark.createDataFrame([tuple(r) for r in tried.values()], SCHEMA)
    last = scan()
    return repair_outcome(attempted, last.where(is_broken(last)), KEYS).withColumn("message", F.when(F.col("outcome") == "failed", F.col("message")).otherwise(""))


def refresh(spark: SparkSession) -> Callable[[str, str, str], None]:
    """Mends what the session's catalog can mend: cached metadata and missing partitions of tables; a view only if what it reads is back."""

    def act(schema: str, name: str, kind: str) -> None:
        spark.sql(f"REFRESH TABLE `{schema}`.`{name}`")
        if kind == "TABLE" and any(c.isPartition for c in spark.catalog.listColumns(f"`{schema}`.`{name}`")):
            spark.sql(f"MSCK REPAIR TABLE `{schema}`.`{name}`")

    return act
