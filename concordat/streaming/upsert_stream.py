"""Upserts from a folder that files arrive in, as a stream that stops when it has seen them all."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from concordat.operators.upsert import last_wins, merged
from concordat.sources.versions import ConflictError, VersionedTable

TRIES = 6  # of a batch that meets other loads


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, which its checkpoint holds: a new checkpoint is another stream, though its batches have the same numbers."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())["id"]
    finally:
        stream.close()


def upsert_available(spark: SparkSession, folder: str, schema: T.StructType, table: VersionedTable, keys: list[str], order: list[Column], checkpoint: str, files_per_batch: int = 1000) -> int:
    """Apply all files not seen before, a new version of the table for each micro-batch; returns the number of batches.

    A batch reads and writes only the files that hold one of its keys. That it was applied is part of the commit that makes its rows visible,
    so a batch that is repeated after a failure has no further effect, and any number of streams may feed one table.
    """
    done = []

    def apply(batch: DataFrame, epoch: int) -> None:
        stream = _stream_id(spark, checkpoint)
        changes = last_wins(batch, keys, order)
        run = f"stream-{stream[:8]}-{epoch:08d}"
        for attempt in range(TRIES):
            state = table.state()
            if state["applied"].get(stream, -1) >= epoch:
                return
            now = table.read(state=state)
            touched = table.touched(changes, keys, state) if now is not None else []
            table.stage(merged(table.read_files(touched, now), changes, keys) if now is not None else changes, run)
            try:
                table.rewrite(run, state["version"], touched, applied=(stream, epoch))
                break
            except ConflictError:
                if attempt == TRIES - 1:
                    raise
        table.retain()
        done.append(epoch)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)
