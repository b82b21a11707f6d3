"""Shared storage for intermediate results, gapless ranks and connected components."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session (tests) gets one of our own; on a
    cluster that is an error, as no folder of one machine would do."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        place = "file://" + tempfile.mkdtemp(prefix="concordat-")
        spark.sparkContext.setCheckpointDir(place)
        place = spark.sparkContext.getCheckpointDir()
    return place.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for an application: their machines need not have it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    path = f"{shared_dir(spark)}/concordat-{uuid.uuid4().hex[:12]}.zip"
    _written.append((spark, path))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    stream.write(packed.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends or release() is called."""
    path = f"{shared_dir(spark)}/concordat-{uuid.uuid4().hex[:12]}-{name}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and lost executors cost no recomputation.

    free: let go of the step's shuffle files now. Spark removes them once the driver's garbage is collected, which a small
    driver heap may put off until the whole job is over.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if free:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_cut(df: DataFrame) -> None:
    """Remove a cut() that nothing will read again."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def written() -> list[str]:
    """The intermediate results that are there, in order."""
    return [path for _, path in _written]


def drop_written(paths: list[str]) -> None:
    """Remove intermediate results that nothing will read again."""
    gone = set(paths)
    for spark, path in [x for x in _written if x[1] in gone]:
        _written.remove((spark, path))
        remove(spark, path)


@atexit.register
def release() -> None:
    """Remove every intermediate result written so far."""
    while _written:
        spark, path = _written.pop()
        try:
            remove(spark, path)
        except Exception:  # the session may be gone; the folder's owner cleans up then
            return


@dataclass
class Sieve:
    """A bitmap of hashes, to be broadcast: at most 4096 rows of 4 KB. Without a table, every row may be in it."""

    table: DataFrame | None
    bits: int


def sieve(hashes: DataFrame, count: int) -> Sieve:
    """A bitmap of the hashes in the one column (long) of a table of `count` rows, 16 to 32 bits for each hash.

    Its size is bounded at 16 MB, which serves 30 million hashes well. Beyond four times as many, most rows would pass: then there is
    none, and the join that it would have spared does all the work.
    """
    bits = max(16, (16 * count).bit_length())
    if bits > 29:
        return Sieve(None, 0)
    bits = min(27, bits)
    at = F.pmod(F.col(hashes.columns[0]), F.lit(1 << bits)) + 1
    return Sieve(hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_sieve_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_sieve_map")), bits)


def sifted(df: DataFrame, hash_: Column, sieve_: Sieve, name: str = "_likely") -> DataFrame:
    """Add whether a row's hash may be in the sieve: never false for one that is. Spares a join the rows that cannot match."""
    if sieve_.table is None:
        return df.withColumn(name, F.lit(True))
    at = F.pmod(hash_, F.lit(1 << sieve_.bits)) + 1
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_sieve_map", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    joined = df.join(F.broadcast(sieve_.table), F.bitmap_bucket_number(at) == F.col("_sieve_bucket"), "left")
    return joined.withColumn(name, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("_sieve_bucket", "_sieve_map")


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: Column, ways: int = 16) -> DataFrame:
    """Inner join where one key may hold much of left: left's rows of a key are dealt to `ways` tasks by a hash, right's rows go to
    each of them. right must be narrow, with few rows beside left's."""
    dealt = left.withColumn("_way", F.pmod(F.xxhash64(by), F.lit(ways)).cast("int"))
    return dealt.join(right.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))), [*on, "_way"]).drop("_way")


def gapless_rank(df: DataFrame, group: str, order: list[Column], rows: int, salt: Column, name: str = "rank", groups: int = 1) -> DataFrame:
    """Number the rows of each group from 0 without bringing a whole group into one task.

    Rows are dealt to chunks of a group by a hash; a chunk's offset is the sum of the counts of earlier chunks of its group.
    A window sorts one chunk only. At most 4096 chunks a group, so the table of offsets stays small.
    """
    chunks = max(1, min(4096, -(-rows // (500 * groups))))
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(salt), F.lit(chunks)).cast("int"))
    counts = dealt.groupBy(F.col(group).alias("_g"), F.col("_chunk").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_chunk").orderBy(*order)
    ranked = dealt.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    joined = ranked.join(offsets, (ranked[group].eqNullSafe(offsets["_g"])) & (ranked["_chunk"] == offsets["_c"]))
    return joined.withColumn(name, F.col("_row") + F.col("_before")).drop("_chunk", "_g", "_c", "_row", "_before")


def are_stars(edges: DataFrame) -> bool:
    """Whether the distinct edges (u, v), u > v, are stars already: no node has two smaller ones, and none whose smaller one has a smaller one itself."""
    end = lambda node, up, down: F.struct(F.col(node).alias("node"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    ends = edges.select(F.explode(F.array(end("u", 1, 0), end("v", 0, 1))).alias("x")).select("x.*")
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1")
    return not odd.agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    edges: columns a, b (long). Returns node, component (the smallest node reachable), for nodes that have an edge.
    Each step is two grouped minima and joins by key; every round is cut to the shared folder. No edge reaches the driver. What the driver
    keeps of a round's tasks is let go with it, and there is no round beyond the one that leaves stars only.
    """
    current = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", free=True)
    turned = lambda d, *pairs: d.select(F.explode(F.array(*(F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in pairs))).alias("x")).select("x.*")
    for _ in range(max_rounds):
        if are_stars(current):
            break
        both = turned(current, ("u", "v"), ("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = turned(large.join(least, "u"), ("v", "m"), ("u", "m")).where("u <> v")
        nxt = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", free=True)
        drop_cut(current)
        current = nxt
    else:
        raise RuntimeError("components did not settle")
    stars = current.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
