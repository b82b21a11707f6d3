"""The corpus pipeline: quality, line dedup, near-duplicate removal, mixing, packing.

Each stage is written as Parquet and read back as the next one's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import lines, mixing, near_dedup, packing, quality
from concordat.llm.common import cut, drop_written, written

MIX_SHARE = 0.9  # of the tokens that reach the mixing stage


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []  # intermediate results of the stage that was asked for last


def stage(f: Stage) -> Stage:
    """A stage that removes the intermediate results of the one before, so that the shared folder holds those of one stage only. A stage's result must
    have been written when the next is asked for, as run() does; stages of two runs in one process must not alternate."""

    @wraps(f)
    def one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_written(_left)
        before = set(written())
        out = f(spark, docs, sf_dir)
        _left[:] = [p for p in written() if p not in before and not p.endswith(".zip")]
        return out

    return one


# Every stage: rows that repeat a doc_id with another text are documents of their own, other columns pass through whatever their
# names, texts are taken whole, and an empty table stays empty.


@stage
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; so do those without words or without doc_id, and null texts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go from all but their first document; a document of which nothing is left goes whole. Null texts
    and rows without doc_id stay as they are."""
    cleaned = lines.dedup_lines(docs)
    return cleaned.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S")).select(*docs.columns)


@stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays. Null and blank texts and rows without doc_id are no copies."""
    return near_dedup.drop_near(docs)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their weights within MIX_SHARE of the tokens; no document is taken twice. A null source or language is the group ''; null
    texts cost no tokens; rows without doc_id go."""
    levels, weights = mixing.document_tree()
    chosen = mixing.mix(docs, levels, weights, share=MIX_SHARE, max_epochs=1, carry={"text_hash": F.xxhash64("text")})
    taken = chosen.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    base = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"))
    return base.join(taken, ["_d", "_t"], "left_semi").select("_row.*")


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: sequence_id, ids, and doc_ids, pieces, offsets of the pieces in it. A null text is
    empty."""
    return packing.sequences(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True))


STAGES = [("quality", good_documents), ("lines", without_repeated_lines), ("near", without_near_copies), ("mix", mixed), ("pack", packed)]

#: Neither the classifier nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, one in STAGES:
        docs = cut(one(spark, docs, sf_dir), f"stage-{name}")
    return docs
