"""Registered queries over the driver's tables, and the same in DuckDB SQL.

Source and target are derived from one table by fixed rules, the same in both engines; small inputs are inline VALUES that both read.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.functions import canon, text
from concordat.functions.types import assessed, source_label, suggested_type, target_label
from concordat.model import Incremental, LoadResult, TableSpec
from concordat.operators import chunks, digest_tree, incremental, key_search, long_columns, mapping, objects, profile, reconcile, schema_diff, sequences, upsert
from concordat.plans import audit, load, queryperf, reports
from concordat.sources import catalog, files, table_source, versions
from concordat.streaming import ledger, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def values(spark: SparkSession, body: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM (VALUES {body}")


def derived(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """Rows that both engines derive from the tables by one and the same text."""
    _views(spark, sf, *(t for t in _TABLES if re.search(rf"\b{t}\b", text)))
    return spark.sql(text)


# ---- source and target pairs

_SRC = "src AS (SELECT * FROM orders WHERE o_orderkey % 97 <> 0)"
_TGT = "tgt AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 83 <> 0)"
_PAIR = f"WITH {_SRC}, {_TGT}"


def pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    changed = F.when(F.col("o_orderkey") % 89 == 0, "X").otherwise(F.col("o_orderstatus"))
    return o.where("o_orderkey % 97 <> 0"), o.where("o_orderkey % 83 <> 0").withColumn("o_orderstatus", changed)


def lines_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    keys = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return keys.where("l_orderkey % 97 <> 0"), keys.where("l_orderkey % 89 <> 0")


_LINES = "s AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 97 <> 0), t AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 89 <> 0)"
_ONLY = "a AS (SELECT count(*) AS n FROM (SELECT {k} FROM {s} EXCEPT ALL SELECT {k} FROM {t})), b AS (SELECT count(*) AS n FROM (SELECT {k} FROM {t} EXCEPT ALL SELECT {k} FROM {s}))"
_SUMMARY = "SELECT a.n AS source_only, b.n AS target_only, least(a.n, {n}) AS source_sample, least(b.n, {n}) AS target_sample, a.n > {n} OR b.n > {n} AS sample_truncated, CASE WHEN a.n = 0 AND b.n = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM a, b"


@query(f"{_PAIR}, {_ONLY.format(k='o_orderkey', s='src', t='tgt')} {_SUMMARY.format(n=1000)}")
def keydiff_orders_summary(spark, sf):
    return reconcile.key_diff_summary(*pair(spark, sf), ["o_orderkey"])


@query(f"{_PAIR} SELECT o_orderkey FROM src EXCEPT ALL SELECT o_orderkey FROM tgt")
def keydiff_orders_source_only(spark, sf):
    return reconcile.keys_only(*pair(spark, sf), ["o_orderkey"], "source")


@query(f"{_PAIR} SELECT o_orderkey FROM tgt EXCEPT ALL SELECT o_orderkey FROM src")
def keydiff_orders_target_only(spark, sf):
    return reconcile.keys_only(*pair(spark, sf), ["o_orderkey"], "target")


@query(f"{_PAIR} SELECT o_orderkey FROM (SELECT o_orderkey FROM src EXCEPT ALL SELECT o_orderkey FROM tgt) ORDER BY 1 LIMIT 25")
def keydiff_sample_topn(spark, sf):
    return reconcile.key_sample(*pair(spark, sf), ["o_orderkey"], "source", 25)


@query(f"WITH {_LINES}, {_ONLY.format(k='l_orderkey, l_linenumber', s='s', t='t')} {_SUMMARY.format(n=100)}")
def keydiff_lineitem_multiset(spark, sf):
    return reconcile.key_diff_summary(*lines_pair(spark, sf), ["l_orderkey", "l_linenumber"], 100)


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_TRIMMED = {"orders": "o_orderkey % 97 <> 0", "events": "event_id % 11 <> 0", "documents": "doc_id % 5 <> 0", "customer": "c_custkey % 2 = 0"}
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS source_count, count(*) FILTER (WHERE {_TRIMMED.get(t, 'TRUE')}) AS target_count FROM {t}" for t in _TABLES)


@query(f"SELECT *, target_count - source_count AS row_count_diff, source_count = target_count AS row_count_match, CASE WHEN source_count = target_count THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM ({_COUNTS})")
def rowcount_all_tables(spark, sf):
    """The target of four tables lacks rows."""
    return reconcile.rowcounts({t: (table(spark, sf, t), table(spark, sf, t).where(_TRIMMED.get(t, "true"))) for t in _TABLES})


@query("WITH c AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS s, count(*) AS t FROM orders) SELECT 'orders' AS table_name, s AS source_count, t AS target_count, t - s AS row_count_diff, s = t AS row_count_match, CASE WHEN s = t THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM c")
def rowcount_filtered_source(spark, sf):
    o = table(spark, sf, "orders")
    return reconcile.rowcounts({"orders": (o, o)}, {"orders": "o_orderstatus = 'F'"})


@query("SELECT count(*) AS rows FROM lineitem")
def rowcount_fast_footer(spark, sf):
    return catalog.footer_count(spark, f"{sf}/lineitem.parquet")


# ---- digests

_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"
_MONEY = "coalesce(CAST({c} AS VARCHAR), '\\N')"
_TXT = "coalesce(replace({c}, '\\', '\\\\'), '\\N')"
_NUM = "coalesce(CAST({c} AS VARCHAR), '\\N')"
_ROW = "sha256(concat_ws(chr(31), " + ", ".join([_NUM.format(c="o_orderkey"), _NUM.format(c="o_custkey"), _TXT.format(c="o_orderstatus"), _MONEY.format(c="o_totalprice"), f"coalesce({_TS.format(c='o_orderdate')}, '\\N')", _TXT.format(c="o_orderpriority")]) + "))"
_SLICE = "sum(CAST(('0x' || substr(h, {at}, 15)) AS HUGEINT))"
_DIGEST = f"count(*) AS n, sha256(concat_ws(':', CAST(count(*) AS VARCHAR), coalesce(CAST({_SLICE.format(at=1)} AS VARCHAR), '0'), coalesce(CAST({_SLICE.format(at=16)} AS VARCHAR), '0'))) AS d"
_BOTH = "SELECT coalesce(s.k, t.k) AS chunk_key, s.d AS source_hash, t.d AS target_hash, coalesce(s.n, 0) AS row_count_source, coalesce(t.n, 0) AS row_count_target, CASE WHEN s.d = t.d THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM s FULL JOIN t ON s.k = t.k"
_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _digests(key: str) -> str:
    return f"{_PAIR}, s AS (SELECT k, {_DIGEST} FROM (SELECT {key} AS k, {_ROW} AS h FROM src) GROUP BY 1), t AS (SELECT k, {_DIGEST} FROM (SELECT {key} AS k, {_ROW} AS h FROM tgt) GROUP BY 1)"


@query(f"{_digests(chr(39) + 'table' + chr(39))} {_BOTH}")
def checksum_table_orders(spark, sf):
    return reconcile.checksum(*pair(spark, sf), _COLS)


@query(f"{_digests('CAST(o_orderkey // 1000 AS VARCHAR)')} {_BOTH}")
def checksum_chunks_orders(spark, sf):
    return reconcile.checksum(*pair(spark, sf), _COLS, chunks.chunk_of("o_orderkey", 1000, 0))


@query(f"{_digests('CAST(o_orderkey // 50 AS VARCHAR)')}, r AS ({_BOTH}) SELECT * FROM r WHERE status = 'MISMATCH'")
def checksum_chunk_mismatch(spark, sf):
    return reconcile.checksum(*pair(spark, sf), _COLS, chunks.chunk_of("o_orderkey", 50, 0)).where("status = 'MISMATCH'")


@query(f"{_digests('CAST(o_orderkey // 1000 AS VARCHAR)')}, r AS ({_BOTH}) SELECT count(*) AS chunks, CAST(sum(row_count_source) AS BIGINT) AS row_count_source, CAST(sum(row_count_target) AS BIGINT) AS row_count_target, CASE WHEN count(*) = 1 THEN max(source_hash) ELSE count(*) || ' chunks' END AS source_hash, CASE WHEN count(*) = 1 THEN max(target_hash) ELSE count(*) || ' chunks' END AS target_hash, CASE WHEN bool_or(status = 'MISMATCH') THEN 'MISMATCH' ELSE 'MATCH' END AS status FROM r")
def checksum_summary(spark, sf):
    return reconcile.checksum_summary(reconcile.checksum(*pair(spark, sf), _COLS, chunks.chunk_of("o_orderkey", 1000, 0)))


_STRICT = "'[' || concat_ws(',', '{\"value\":\"' || o_orderkey || '\"}', '{\"value\":\"' || o_custkey || '\"}', '{\"str\":\"' || o_orderstatus || '\"}', '{\"float\":\"' || o_totalprice || '\"}', '{\"datetime\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '\"}', '{\"str\":\"' || o_orderpriority || '\"}', CASE WHEN o_orderkey % 3 = 0 THEN '{\"null\":true}' ELSE '{\"decimal\":\"' || rtrim(rtrim(CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR), '0'), '.') || '\"}' END, '{\"value\":\"' || CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END || '\"}', '{\"bytes_sha256\":\"' || sha256(o_orderpriority) || '\"}') || ']'"


@query(f"SELECT o_orderkey // 500 AS chunk_id, count(*) AS rows, sha256('[\"o_orderkey\",\"o_custkey\",\"o_orderstatus\",\"o_totalprice\",\"o_orderdate\",\"o_orderpriority\",\"maybe\",\"even\",\"raw\"]' || chr(10) || string_agg(r, chr(10) ORDER BY r COLLATE C)) AS digest FROM (SELECT o_orderkey, {_STRICT} AS r FROM orders) GROUP BY 1".replace(" COLLATE C", ""))
def checksum_strict_stream_chunk(spark, sf):
    o = table(spark, sf, "orders").withColumns({"maybe": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("decimal(18,4)")), "even": F.col("o_orderkey") % 2 == 0, "raw": F.col("o_orderpriority").cast("binary")})
    return canon.strict_digest(o, [*_COLS, "maybe", "even", "raw"], chunks.chunk_of("o_orderkey", 500, 0).alias("chunk_id"))


@query("SELECT count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE CAST(('0x' || substr(md5(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 8)) AS BIGINT) % 10000 < 500")
def checksum_sample_bucket(spark, sf):
    return reconcile.sample_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 5).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("keys"))


_VALUE_DIFF = f"{_PAIR}, d AS (SELECT s.o_orderkey, 'o_orderstatus' AS column_name, s.o_orderstatus AS source_value, t.o_orderstatus AS target_value FROM src AS s JOIN tgt AS t USING (o_orderkey) WHERE s.o_orderstatus <> t.o_orderstatus)"


@query(f"{_VALUE_DIFF} SELECT * FROM d")
def value_diff_orders(spark, sf):
    return reconcile.value_diff(*pair(spark, sf), ["o_orderkey"], _COLS[1:])


@query(f"{_VALUE_DIFF} SELECT column_name, count(*) AS differences FROM d GROUP BY 1")
def value_diff_by_column(spark, sf):
    return reconcile.value_diff_by_column(reconcile.value_diff(*pair(spark, sf), ["o_orderkey"], _COLS[1:]))


_FLOATS = "(1,'nan','nan'),(2,'nan',NULL),(3,'-0.0','0.0'),(4,'1e-7','0.0'),(5,'1.0000001','1.0000002'),(6,'1e40','1e40'),(7,'1e40','1.0000000000000002e40'),(8,'inf','inf'),(9,'inf','-inf'),(10,'5e-324','0.0'),(11,NULL,NULL),(12,'123456789.5','123456789.5'),(13,'0.1','0.10000000000000002'),(14,'1.7976931348623157e308','1.7976931348623157e308'),(15,'nan','inf')) AS t(id,a,b)"


@query(f"SELECT CAST(id AS VARCHAR) AS chunk_key, CASE WHEN CAST(a AS DOUBLE) IS NOT DISTINCT FROM CAST(b AS DOUBLE) THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM (VALUES {_FLOATS}")
def checksum_float_edges(spark, sf):
    """NaN, signed zeros, tiny and huge numbers: a digest tells apart whatever differs, and nothing else."""
    v = values(spark, _FLOATS)
    one, two = (v.select("id", F.col(c).cast("double").alias("v")) for c in "ab")
    return reconcile.checksum(one, two, ["id", "v"], F.col("id")).select("chunk_key", "status")


@query(f"SELECT id, 'v' AS column_name FROM (VALUES {_FLOATS} WHERE CAST(a AS DOUBLE) IS DISTINCT FROM CAST(b AS DOUBLE)")
def value_diff_float_edges(spark, sf):
    v = values(spark, _FLOATS)
    one, two = (v.select("id", F.col(c).cast("double").alias("v")) for c in "ab")
    return reconcile.value_diff(one, two, ["id"], ["v"]).select("id", "column_name")


@query("SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price, CAST(p_retailprice * 1e12 AS VARCHAR) AS large, CAST(p_retailprice / 1e9 AS VARCHAR) AS small, CAST(p_retailprice / 7 AS VARCHAR) AS odd FROM part")
def float_digits(spark, sf):
    """All digits of a number, in whole, large, small and periodic values."""
    c = F.col("p_retailprice")
    return table(spark, sf, "part").select("p_partkey", canon.float_text(c).alias("price"), canon.float_text(c * 1e12).alias("large"), canon.float_text(c / 1e9).alias("small"), canon.float_text(c / 7).alias("odd"))


_ODD_TEXTS = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat(lang, chr(31), source) WHEN 1 THEN concat(lang, chr(92), chr(31)) ELSE lang END AS a, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN '' ELSE source END AS b FROM documents"
_ODD_TARGET = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN concat(lang, chr(92)) ELSE lang END AS a, CASE doc_id % 4 WHEN 0 THEN concat(source, chr(31), source) WHEN 1 THEN chr(31) ELSE source END AS b FROM documents"


@query(f"SELECT CAST(s.doc_id % 4 AS VARCHAR) AS chunk_key, CASE WHEN bool_and(s.a = t.a AND s.b = t.b) THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM ({_ODD_TEXTS}) AS s JOIN ({_ODD_TARGET}) AS t USING (doc_id) GROUP BY 1")
def checksum_texts_with_separators(spark, sf):
    """Texts that hold the characters which part and escape a row's values, moved from one column to the next."""
    one, two = (derived(spark, sf, q) for q in (_ODD_TEXTS, _ODD_TARGET))
    return reconcile.checksum(one, two, ["doc_id", "a", "b"], F.col("doc_id") % 4).select("chunk_key", "status")


_MIXED_S = "SELECT o_orderkey, o_custkey AS whole, CAST(o_totalprice AS DECIMAL(18,2)) AS money, CAST(o_orderdate AS DATE) AS day, concat('', o_custkey) AS name FROM orders"
_MIXED_T = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + CAST(0.5 AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS whole, CASE WHEN o_orderkey % 7 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(20,4)) + CAST(0.0001 AS DECIMAL(20,4)) ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(20,4)) END AS money, CASE WHEN o_orderkey % 11 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 5 HOUR ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1 ELSE o_custkey END AS name FROM orders"


@query("SELECT column_name, CAST(sum(n) AS BIGINT) AS differences FROM (SELECT unnest(['whole', 'money', 'day', 'name']) AS column_name, unnest([CAST(o_orderkey % 5 = 0 AS INT), CAST(o_orderkey % 7 = 0 AS INT), CAST(o_orderkey % 11 = 0 AS INT), CAST(o_orderkey % 13 = 0 AS INT)]) AS n FROM orders) GROUP BY 1")
def value_diff_mixed_types(spark, sf):
    """Whole numbers against doubles, decimals of two scales, dates against times, text against numbers: no side is narrowed."""
    return reconcile.value_diff_by_column(reconcile.value_diff(derived(spark, sf, _MIXED_S), derived(spark, sf, _MIXED_T), ["o_orderkey"], ["whole", "money", "day", "name"]))


@query("SELECT CAST(o_orderkey % 12 AS VARCHAR) AS chunk_key, CASE WHEN bool_or(o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0) THEN 'MISMATCH' ELSE 'MATCH' END AS status FROM orders WHERE o_orderkey % 12 IN (1, 5) AND (o_orderkey % 12 = 1 OR (o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)) GROUP BY 1")
def checksum_mixed_types(spark, sf):
    part = "o_orderkey % 12 IN (1, 5) AND (o_orderkey % 12 = 1 OR (o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0))"
    one, two = (derived(spark, sf, q).where(part) for q in (_MIXED_S, _MIXED_T))
    return reconcile.checksum(one, two, ["whole", "money", "day", "name"], F.col("o_orderkey") % 12).select("chunk_key", "status")


_NULL_KEY = "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 5 AS VARCHAR) END"


@query(f"{_digests(_NULL_KEY)} {_BOTH.replace('s.k = t.k', 's.k IS NOT DISTINCT FROM t.k')}")
def checksum_null_chunk(spark, sf):
    k = F.col("o_orderkey") % 5
    return reconcile.checksum(*pair(spark, sf), _COLS, F.when(k != 0, k))


_REPEAT_S = "s AS (SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id // 2 * (event_id % 3) END AS k, event_type AS v FROM events)"
_REPEAT_T = "t AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'other' ELSE v END AS v FROM s)"


@query(f"WITH {_REPEAT_S}, {_REPEAT_T}, a AS (SELECT k, count(*) AS n, min(v) AS v FROM s GROUP BY 1), b AS (SELECT k, count(*) AS n, min(v) AS v FROM t GROUP BY 1) SELECT a.k, CASE WHEN a.n > 1 OR b.n > 1 THEN '{reconcile.REPEATED}' ELSE 'v' END AS column_name, CASE WHEN a.n > 1 OR b.n > 1 THEN CAST(a.n AS VARCHAR) ELSE a.v END AS source_value, CASE WHEN a.n > 1 OR b.n > 1 THEN CAST(b.n AS VARCHAR) ELSE b.v END AS target_value FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k WHERE a.n > 1 OR b.n > 1 OR a.v <> b.v")
def value_diff_repeated_keys(spark, sf):
    s = table(spark, sf, "events").selectExpr("CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id DIV 2 * (event_id % 3) END AS k", "event_type AS v")
    return reconcile.value_diff(s, s.withColumn("v", F.when(F.col("k") % 7 == 0, "other").otherwise(F.col("v"))), ["k"], ["v"])


@query("SELECT table_name, count(*) AS source_column_count, count(*) AS target_column_count, CAST(0 AS BIGINT) AS error_count, 'MATCH' AS status FROM duckdb_columns() WHERE table_name IN ('nation','orders','lineitem','events','documents','embeddings') GROUP BY 1")
def audit_identical(spark, sf):
    """Tables against themselves agree, of whatever types."""
    frames = audit.audit(spark, {t: (table(spark, sf, t), table(spark, sf, t)) for t in ("nation", "orders", "lineitem", "events", "documents", "embeddings")})
    return frames["inventory"].select("table_name", "source_column_count", "target_column_count", "error_count", "status")


# ---- loads

_OUT = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority"


def _shown(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderpriority")


@query(f"{_PAIR} SELECT {_OUT} FROM src UNION ALL SELECT {_OUT} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)")
def upsert_orders(spark, sf):
    s, t = pair(spark, sf)
    return _shown(upsert.merged(t, s, ["o_orderkey"]))


@query(f"{_PAIR} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, CAST(t.o_totalprice AS DECIMAL(18,2)) AS o_totalprice, t.o_orderpriority FROM tgt AS t FULL JOIN src AS s ON s.o_orderkey = t.o_orderkey")
def upsert_partial_columns(spark, sf):
    s, t = pair(spark, sf)
    return _shown(upsert.merged(t, s, ["o_orderkey"], ["o_orderstatus"]))


@query("SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,6)) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def upsert_last_wins(spark, sf):
    e = table(spark, sf, "events")
    return upsert.upserted(e.limit(0), e, ["user_id"], on_duplicate="last", order=[F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type", F.col("value").cast("decimal(18,6)").alias("value"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def upsert_duplicate_keys(spark, sf):
    return upsert.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _load(mode: str, **more) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        s, t = pair(spark, sf)
        spec = TableSpec("orders", keys=("o_orderkey",), mode=mode, **more)
        load.check(spec)
        return _shown(load.next_version(spec, t, load.incoming(spec, s, t)))

    return run


@query(f"{_PAIR} SELECT {_OUT} FROM tgt UNION ALL SELECT {_OUT} FROM src WHERE o_orderkey % 83 = 0")
def apply_append(spark, sf):
    return _load("append", where="o_orderkey % 83 = 0")(spark, sf)


@query(f"{_PAIR} SELECT {_OUT} FROM src")
def apply_overwrite(spark, sf):
    return _load("truncate")(spark, sf)


@query(f"{_PAIR} SELECT {_OUT} FROM tgt WHERE o_orderkey % 7 <> 0 OR o_orderkey % 97 = 0 UNION ALL SELECT {_OUT} FROM src WHERE o_orderkey % 7 = 0")
def apply_delete_insert(spark, sf):
    return _load("delete_insert", where="o_orderkey % 7 = 0")(spark, sf)


def _place(spark: SparkSession, name: str) -> str:
    """A fresh folder: in the shared one where there is one, as what executors write must lie where the driver sees it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared.rstrip('/')}/concordat-{name}-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix=f"concordat-{name}-")


def _published(spark: SparkSession, spec: TableSpec, source: DataFrame, start: DataFrame, **options) -> tuple[DataFrame, LoadResult]:
    """The table that a load leaves, read back, and what the load said."""
    t = versions.VersionedTable(spark, _place(spark, "table"))
    t.stage(start, "v0")
    t.publish("v0")
    result = load.run(spark, spec, source, t, ledger.Ledger(), **options)
    return t.read(), result


_RAW = "SELECT concat('', o_orderkey) AS o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN 'none' ELSE concat('', o_custkey) END AS o_custkey, o_orderstatus, concat('', CAST(o_totalprice AS DECIMAL(18,2))) AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0"


@query("SELECT count(*) AS rows_read, count(*) FILTER (WHERE o_orderkey % 41 <> 0) AS rows_written, count(*) FILTER (WHERE o_orderkey % 41 = 0) AS rows_failed, 'MATCH' AS checksum_status FROM orders WHERE o_orderkey % 97 <> 0")
def copy_completeness(spark, sf):
    """A load of texts, some of which are no numbers: what it says that it read, wrote and left out."""
    _, r = _published(spark, TableSpec("orders", skip_failed=True), derived(spark, sf, _RAW), _shown(table(spark, sf, "orders")).limit(0))
    return spark.createDataFrame([(r.rows_read, r.rows_written, r.rows_failed, r.checksum_status)], "rows_read long, rows_written long, rows_failed long, checksum_status string")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 41 <> 0")
def load_without_rejected(spark, sf):
    return _published(spark, TableSpec("orders", skip_failed=True), derived(spark, sf, _RAW), _shown(table(spark, sf, "orders")).limit(0))[0]


_TWICE = "SELECT concat('', o_orderkey) AS o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN 'none' ELSE concat('', o_custkey) END AS o_custkey, o_orderstatus, CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE concat('', CAST(o_totalprice AS DECIMAL(18,2))) END AS o_totalprice, o_orderpriority FROM orders"


@query(f"""WITH raw AS ({_TWICE}) SELECT o_orderkey AS key_values, 'o_custkey' AS column_name, o_custkey AS value FROM raw WHERE o_custkey = 'none'
    UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice FROM raw WHERE o_totalprice = 'n/a'""")
def load_rejects_published(spark, sf):
    """Every value that an append could not cast, read back from the rejected rows of the version it made."""
    start = _shown(table(spark, sf, "orders"))
    t = versions.VersionedTable(spark, _place(spark, "table"))
    t.stage(start.limit(0), "v0")
    t.publish("v0")
    r = load.run(spark, TableSpec("orders", keys=("o_orderkey",), mode="append", skip_failed=True), derived(spark, sf, _TWICE), t, ledger.Ledger())
    left = t.rejects()
    if r.status != "SUCCESS" or left.count() != r.rows_failed or t.read().count() + r.rows_failed != start.count():
        raise load.LoadError(f"{r.status}: {r.rows_failed} of {r.rows_read} rows were left out {r.message}")
    return left.select("key_values", F.explode("failures").alias("f")).select("key_values", "f.column_name", "f.value")


@query(f"{_PAIR} SELECT {_OUT} FROM tgt UNION ALL SELECT {_OUT} FROM src WHERE o_orderkey % 83 = 0")
def load_append_published(spark, sf):
    """The version after an append is the folders before and one more."""
    s, t = pair(spark, sf)
    return _shown(_published(spark, TableSpec("orders", mode="append", where="o_orderkey % 83 = 0"), s, t)[0])


@query("WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT user_id, event_id, event_type FROM e WHERE n = 1")
def load_last_published(spark, sf):
    """An upsert of all events by user: the last of each stands, over whichever stood there."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    spec = TableSpec("events", keys=("user_id",), mode="upsert", on_duplicate="last", order_by=("ts", "event_id"))
    return _published(spark, spec, e, e.dropDuplicates(["user_id"]).withColumn("event_type", F.lit("old")))[0].drop("ts")


@query("SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 97 <> 0")
def load_chunks_published(spark, sf):
    """An append by key ranges to a table that has all orders."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    t = versions.VersionedTable(spark, _place(spark, "chunks"))
    t.stage(o, "v0")
    t.publish("v0")
    load.append_chunks(spark, TableSpec("orders", mode="append", chunk_size=500), o.where("o_orderkey % 97 <> 0"), t, ledger.Ledger(), "r1", "o_orderkey")
    return t.read()


@query("SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey / 8 END, o_custkey FROM orders WHERE o_orderkey % 97 <> 0")
def load_chunks_null_and_fraction(spark, sf):
    """An append by ranges of keys that are fractions, some of them null."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("double").alias("o_orderkey"), "o_custkey")
    t = versions.VersionedTable(spark, _place(spark, "chunks"))
    t.stage(o, "v0")
    t.publish("v0")
    part = F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderkey") / 8)
    load.append_chunks(spark, TableSpec("orders", mode="append", chunk_size=700), o.where("o_orderkey % 97 <> 0").withColumn("o_orderkey", part), t, ledger.Ledger(), "r1", "o_orderkey")
    return t.read()


def _filed(spark: SparkSession, df: DataFrame, keys: list[str], files_: int) -> versions.VersionedTable:
    """A table whose files part its keys."""
    t = versions.VersionedTable(spark, _place(spark, "filed"))
    t.stage(df.repartitionByRange(files_, *keys), "v0")
    t.publish("v0")
    return t


@query(f"""{_PAIR}, low AS (SELECT min(o_orderkey) AS k FROM src WHERE o_orderkey % 7 = 0), new AS (SELECT src.* FROM src, low WHERE o_orderkey % 7 = 0 AND o_orderkey < k + 400)
    SELECT {_OUT} FROM new UNION ALL SELECT {_OUT} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def load_upsert_touched_files(spark, sf):
    """An upsert of a few neighbouring keys into a table of twelve files, read back; the files without one of them stay as they are."""
    s, t = pair(spark, sf)
    low = s.where("o_orderkey % 7 = 0").agg(F.min("o_orderkey")).first()[0]
    place = _filed(spark, _shown(t), ["o_orderkey"], 12)
    before = set(place.files())
    r = load.run(spark, TableSpec("orders", keys=("o_orderkey",), mode="upsert", where=f"o_orderkey % 7 = 0 AND o_orderkey < {low + 400}"), _shown(s), place, ledger.Ledger())
    kept = before & set(place.files())
    if r.status != "SUCCESS" or not kept or len(kept) + r.files_rewritten != len(before):
        raise load.LoadError(f"{r.status}: {len(kept)} of {len(before)} files stayed, {r.files_rewritten} were rewritten {r.message}")
    return place.read()


@query("SELECT * FROM orders WHERE o_orderkey BETWEEN (SELECT min(o_orderkey) + 100 FROM orders) AND (SELECT min(o_orderkey) + 600 FROM orders)")
def source_filter_skips_files(spark, sf):
    """A range of keys read through the data source: of twelve files only those that can hold one are opened."""
    table_source.register(spark)
    o = table(spark, sf, "orders")
    place = _filed(spark, o, ["o_orderkey"], 12)
    place.index(["o_orderkey"])
    low = o.agg(F.min("o_orderkey")).first()[0]
    folder = table_source.Folder(place.path)
    largest = max(size for _, _, size in folder.files(folder.version(None, None)))
    read = spark.read.format("concordat").option("bundle_bytes", largest)
    some = read.load(place.path).where(F.col("o_orderkey").between(low + 100, low + 600))
    if some.rdd.getNumPartitions() >= read.load(place.path).rdd.getNumPartitions():
        raise ValueError("no file was left out")
    return some


@query(f"{_PAIR} SELECT 'before' AS state, {_OUT} FROM tgt UNION ALL SELECT 'after' AS state, {_OUT} FROM src WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'after' AS state, {_OUT} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src WHERE o_orderkey % 7 = 0)")
def source_versions(spark, sf):
    """A table before and after an upsert, both read through the data source, the one before by its time."""
    table_source.register(spark)
    s, t = pair(spark, sf)
    place = _filed(spark, _shown(t), ["o_orderkey"], 4)
    then = place.state()["at"]
    r = load.run(spark, TableSpec("orders", keys=("o_orderkey",), mode="upsert", where="o_orderkey % 7 = 0"), _shown(s), place, ledger.Ledger())
    if r.status != "SUCCESS":
        raise load.LoadError(r.message)
    read = spark.read.format("concordat")
    return files.union_all([df.select(F.lit(name).alias("state"), "*") for name, df in (("before", read.option("as_of", repr(then)).load(place.path)), ("after", spark.read.format("concordat").load(place.path)))])


@query("SELECT CAST(max(event_id) AS VARCHAR) AS watermark, count(*) AS rows_read FROM events WHERE event_id > 100")
def load_renamed_watermark(spark, sf):
    """An incremental upsert by a column that the target has under another name."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    spec = TableSpec("events", keys=("id",), mode="upsert", rename={"event_id": "id"}, incremental=Incremental("event_id", "numeric_key", initial="100"))
    _, r = _published(spark, spec, e, e.limit(0).withColumnRenamed("event_id", "id"))
    return spark.createDataFrame([(r.watermark, r.rows_read)], "watermark string, rows_read long")


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE l_orderkey % 13 = 0) AS null_rows, true AS balanced, true AS parted FROM lineitem")
def ranges_equal_depth(spark, sf):
    """Ranges over a key of two columns, one of them text: their rows, those without a key, whether the largest is within half of an even share
    above it, and whether ranges follow each other."""
    li = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 13 != 0, F.col("l_orderkey")).alias("k"), F.concat(F.lit("n"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("n"))
    r = chunks.equal_depth(li, ["k", "n"], 20)
    some = r.where(F.col("chunk_id") >= 0)
    after = Window.partitionBy(F.lit(0)).orderBy("chunk_id")  # of twenty rows
    apart = some.withColumn("_p", F.lag("last_key").over(after)).agg(F.bool_and(F.col("_p").isNull() | (F.col("_p") < F.col("first_key"))).alias("parted"))
    sizes = r.agg(F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(F.col("chunk_id") < 0, F.col("rows"))), F.lit(0)).alias("null_rows"), F.max(F.when(F.col("chunk_id") >= 0, F.col("rows"))).alias("most"), F.sum(F.when(F.col("chunk_id") >= 0, F.col("rows"))).alias("keyed"))
    return sizes.select("rows", "null_rows", (F.col("most") <= 1.5 * F.col("keyed") / 20).alias("balanced")).crossJoin(apart)


_CHANGED = f"""{_PAIR} SELECT o_orderkey, CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(t.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
    CASE WHEN t.o_orderkey IS NULL THEN 'source only' WHEN s.o_orderkey IS NULL THEN 'target only' ELSE 'changed' END AS status
    FROM src AS s FULL JOIN tgt AS t USING (o_orderkey) WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_orderstatus <> t.o_orderstatus"""


@query(_CHANGED)
def digest_tree_changed_keys(spark, sf):
    """Keys that differ, by digests of ranges from the root down."""
    return digest_tree.changed_keys(*pair(spark, sf), ["o_orderkey"], _COLS)


@query(f"{_PAIR}, low AS (SELECT min(o_orderkey) AS k FROM src), t AS (SELECT o_orderkey, CASE WHEN o_orderkey < k + 300 AND o_orderkey % 3 = 0 THEN 'Z' ELSE o_orderstatus END AS v FROM src, low) SELECT o_orderkey, CAST(1 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS target_rows, 'changed' AS status FROM src JOIN t USING (o_orderkey) WHERE o_orderstatus <> v")
def digest_tree_after_upsert(spark, sf):
    """Two tables of twelve files each, alike at first; then some neighbouring keys of one are changed. Digests of the files that stay are not made again,
    and rows are read of the files that reach into the differing ranges."""
    s, _ = pair(spark, sf)
    rows = s.select("o_orderkey", "o_orderstatus")
    low = rows.agg(F.min("o_orderkey")).first()[0]
    one, two = (_filed(spark, rows, ["o_orderkey"], 12) for _ in range(2))
    if digest_tree.KeptTree(one, two, ["o_orderkey"], rows.columns).nodes():
        raise load.LoadError("equal tables differ")
    part = rows.where(f"o_orderkey < {low + 300} AND o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("Z"))
    load.run(spark, TableSpec("orders", keys=("o_orderkey",), mode="upsert"), part, two, ledger.Ledger())
    tree = digest_tree.KeptTree(one, two, ["o_orderkey"], rows.columns)
    if len(tree.files(0, tree.nodes())) >= len(one.files()):
        raise load.LoadError("all files are read")
    return tree.changed_keys()


_SEARCHED = {"lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "customer": ["c_custkey", "c_nationkey", "c_name"], "events": ["event_type", "event_id", "user_id"], "nation": ["n_nationkey", "n_name", "n_regionkey"]}


def _key_sql(name: str, columns: list[str]) -> str:
    """All sets of at most three columns, counted; those that are unique and hold no smaller one."""
    sets = [s for n in (1, 2, 3) for s in combinations(range(len(columns)), n)]
    label = lambda s: "_".join(map(str, s))
    counts = ", ".join(f"count(DISTINCT ({', '.join(columns[i] for i in s)})) = count(*) AS u{label(s)}" if len(s) > 1 else f"count(DISTINCT {columns[s[0]]}) = count(*) AS u{label(s)}" for s in sets)
    rows = " UNION ALL ".join(f"SELECT '{name}' AS table_name, '{','.join(columns[i] for i in s)}' AS key_columns FROM c WHERE u{label(s)}" + "".join(f" AND NOT u{label(t)}" for t in sets if len(t) < len(s) and set(t) < set(s)) for s in sets)
    return f"SELECT * FROM (WITH c AS (SELECT {counts} FROM {name}) {rows})"


@query(" UNION ALL ".join(_key_sql(t, c) for t, c in _SEARCHED.items()))
def composite_keys(spark, sf):
    """The least sets of columns that are unique; lineitem has none in its two usual columns."""
    found = [(t, ",".join(k)) for t, columns in _SEARCHED.items() for k in key_search.least_keys(table(spark, sf, t), columns)]
    return spark.createDataFrame(found, "table_name string, key_columns string")


_SKETCHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, true AS distinct_close, true AS median_close FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders)" for c in _SKETCHED))
def profile_of_versions(spark, sf):
    """A profile of a table that was appended to, from sketches kept for each folder; distinct counts within five standard errors, medians within three of rank."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    t = _filed(spark, o.where("o_orderkey % 5 > 0"), ["o_orderkey"], 6)
    profile.of_versions(t, _SKETCHED)
    t.stage(o.where("o_orderkey % 5 = 0"), "more")
    t.append("more", ["more"])
    got = profile.of_versions(t, _SKETCHED)
    exact = o.agg(*(F.count_distinct(c).alias(f"d_{c}") for c in _SKETCHED), *(F.percentile_approx(c, [0.45, 0.55], 100_000).cast("array<double>").alias(f"m_{c}") for c in _SKETCHED if c != "o_orderstatus"), F.lit(None).cast("array<double>").alias("m_o_orderstatus"))
    told = exact.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"d_{c}").alias("_d"), F.col(f"m_{c}").alias("_m")) for c in _SKETCHED))).alias("x")).select("x.*")
    near = F.abs(F.col("distinct_count") - F.col("_d")) <= F.greatest(5 * profile.ERROR_DISTINCT * F.col("_d"), F.lit(1))
    middle = F.coalesce((F.col("quartiles")[1] >= F.col("_m")[0]) & (F.col("quartiles")[1] <= F.col("_m")[1]), F.lit(True))
    return got.join(told, "column_name").select("column_name", "non_null", "nulls", "min_value", "max_value", near.alias("distinct_close"), middle.alias("median_close"))


_HISTORY = "SELECT concat('r', 1000 + event_id % 90) AS source_run, concat('2026-01-', lpad(concat('', 1 + event_id % 90 % 28), 2, '0'), 'T00:00:00') AS started, concat('t', user_id % 5) AS table_name, CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, event_id AS rows_loaded, CAST(event_id % 100 AS DOUBLE) / 4 AS elapsed_seconds FROM events"
_LATEST = f"SELECT source_run FROM ({_HISTORY}) GROUP BY 1 ORDER BY max(started) DESC, source_run DESC LIMIT 30"


@query(f"SELECT substr(started, 1, 10) AS day, table_name, status, count(DISTINCT source_run) AS runs, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, round(sum(elapsed_seconds), 3) AS elapsed_seconds FROM ({_HISTORY}) WHERE source_run NOT IN ({_LATEST}) GROUP BY 1, 2, 3")
def history_compacted(spark, sf):
    return reports.compacted(derived(spark, sf, _HISTORY), 30)[1]


@query(f"SELECT * FROM ({_HISTORY}) WHERE source_run IN ({_LATEST})")
def history_recent(spark, sf):
    return reports.compacted(derived(spark, sf, _HISTORY), 30)[0]


_LOG = "SELECT concat('r', user_id % 50) AS run_id, concat('', event_id + 1000000) AS stamp, concat('t', event_id % 6) AS table_name, event_type AS phase, CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status, concat('m', event_id) AS message FROM events"


@query(f"SELECT run_id, phase, count(DISTINCT table_name) AS tables, count(*) AS events, count_if(status = 'failed')::BIGINT AS failures, min(stamp) AS first_at, max(stamp) AS last_at, coalesce(arg_min(message, (stamp, table_name)) FILTER (WHERE status = 'failed'), '') AS first_error FROM ({_LOG}) GROUP BY 1, 2")
def log_rollup(spark, sf):
    return reports.log_rollup(derived(spark, sf, _LOG).withColumnRenamed("stamp", "at"))


_PIECES = """SELECT 'source' AS source_db, 'app' AS object_schema, concat('o', p_partkey) AS object_name, CASE p_partkey % 3 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'TRIGGER' ELSE 'INDEX' END AS object_type,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('TAB', p_size % 10) END AS parent_name, CASE WHEN p_partkey % 3 <> 2 THEN concat('select * from app."tab', p_size % 12, '" join TAB', p_partkey % 20, ' on seq_', p_size, '.nextval = 1 -- ', p_name) END AS definition, 'VALID' AS status FROM part"""
_NAMES = "SELECT concat('tab', n_nationkey) AS table_name FROM nation"


@query(f"""
    WITH o AS ({_PIECES}), t AS ({_NAMES}),
    w AS (SELECT DISTINCT object_name, upper(unnest(regexp_extract_all(definition, '[A-Za-z0-9_$#]+'))) AS word FROM o)
    SELECT t.table_name, o.object_name, 'parent' AS dependency_kind FROM o JOIN t ON upper(t.table_name) = o.parent_name
    UNION ALL SELECT t.table_name, w.object_name, 'reference' FROM w JOIN t ON upper(t.table_name) = word""")
def dependency_discovery(spark, sf):
    """Which views, triggers and indexes use which tables, from their definitions and parents."""
    return objects.dependency_edges(derived(spark, sf, _PIECES), derived(spark, sf, _NAMES)).select("table_name", "object_name", "dependency_kind")


_RESULTS = "('a','forward',3,3,0,'',true),('b','forward',3,3,0,'',false),('c','reverse',3,3,0,'',false),('d','forward',3,3,0,'',null),('e','forward',3,2,0,'',true),('f','forward',3,3,0,'MISMATCH',true),('g','forward',3,3,1,'MATCH',true)) AS t(table_name,direction,rows_read,rows_written,rows_failed,checksum_status,row_count_match)"


@query(f"SELECT table_name, CASE WHEN rows_failed > 0 OR rows_read <> rows_written OR checksum_status = 'MISMATCH' THEN 'FAIL' WHEN row_count_match IS NULL THEN 'UNKNOWN' WHEN row_count_match THEN 'PASS' WHEN direction = 'reverse' THEN 'FAIL' ELSE 'WARN' END AS verdict FROM (VALUES {_RESULTS}")
def integrity_verdict(spark, sf):
    return load.verdicts(values(spark, _RESULTS)).select("table_name", "verdict")


_OUTCOMES = "SELECT concat('t', event_id) AS table_name, CASE WHEN event_id % 2 = 0 THEN 'forward' ELSE 'reverse' END AS direction, event_id AS rows_read, CASE WHEN event_id % 11 = 0 THEN event_id - 1 ELSE event_id END AS rows_written, CASE WHEN event_id % 17 = 0 THEN user_id % 3 ELSE 0 END AS rows_failed, CASE WHEN event_id % 19 = 0 THEN 'MISMATCH' WHEN event_id % 5 = 0 THEN '' ELSE 'MATCH' END AS checksum_status, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 7 <> 0 END AS row_count_match FROM events"


@query(f"SELECT table_name, CASE WHEN rows_failed > 0 OR rows_read <> rows_written OR checksum_status = 'MISMATCH' THEN 'FAIL' WHEN row_count_match IS NULL THEN 'UNKNOWN' WHEN row_count_match THEN 'PASS' WHEN direction = 'reverse' THEN 'FAIL' ELSE 'WARN' END AS verdict FROM ({_OUTCOMES})")
def integrity_verdicts_derived(spark, sf):
    return load.verdicts(derived(spark, sf, _OUTCOMES)).select("table_name", "verdict")


# ---- increments and chunks


@query("SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderkey > 500")
def incremental_numeric_key(spark, sf):
    return table(spark, sf, "orders").where(incremental.newer("o_orderkey", "numeric_key", "500")).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTE")
def incremental_updated_at_overlap(spark, sf):
    return table(spark, sf, "events").where(incremental.newer("ts", "updated_at", "2024-01-15 00:00:00", 5)).select("event_id", "user_id", "event_type")


@query("SELECT count(*) AS rows FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS updated, ts - INTERVAL 1 DAY AS created FROM events) WHERE coalesce(updated, created) >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 MINUTE")
def incremental_coalesce(spark, sf):
    e = table(spark, sf, "events").selectExpr("*", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS updated", "ts - INTERVAL 1 DAY AS created")
    return e.where(incremental.newer("coalesce(updated, created)", "updated_at", "2024-01-20 00:00:00", 10)).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT CAST(max(o_orderkey) AS VARCHAR) AS watermark FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey > 500")
def watermark_advance(spark, sf):
    s, t = pair(spark, sf)
    spec = TableSpec("orders", mode="upsert", keys=("o_orderkey",), incremental=Incremental("o_orderkey", "numeric_key", initial="500"))
    return incremental.watermark_of(load.incoming(spec, s, t), "o_orderkey")


_COLUMNS = "('a','id',1,'integer','int4'),('a','created_at',2,'timestamp','timestamp'),('a','last_update',3,'timestamp','timestamp'),('a','modified_at',4,'timestamp','timestamp'),('b','name',1,'text','text'),('b','entry_day',2,'date','date'),('c','last_change_time',1,'timestamp','timestamp'),('c','update_note',2,'text','text'),('d','id',1,'integer','int4'),('e','when_created',1,'date','date'),('e','when_changed',2,'date','date')) AS t(table_name,column_name,ordinal,data_type,udt_name)"
_LISTED = [f"list_position({names!r}, column_name)" for names in (incremental.UPDATE_NAMES, incremental.CREATE_NAMES)]


@query(f"""
    WITH c AS (SELECT *, CASE WHEN {_LISTED[0]} > 0 THEN 1001 - {_LISTED[0]} WHEN regexp_matches(column_name, 'update|modify|modified|change') THEN CASE WHEN contains(column_name, 'last') THEN 850 ELSE 750 END END AS u,
            CASE WHEN {_LISTED[1]} > 0 THEN 1001 - {_LISTED[1]} WHEN contains(column_name, 'creat') THEN 800 WHEN regexp_matches(column_name, 'insert|entry') THEN 650 END AS k
        FROM (VALUES {_COLUMNS} WHERE data_type IN ('timestamp', 'date')),
    g AS (SELECT table_name, arg_max(column_name, (u, -ordinal)) FILTER (WHERE u IS NOT NULL) AS update_column, arg_max(column_name, (k, -ordinal)) FILTER (WHERE k IS NOT NULL) AS create_column FROM c GROUP BY 1)
    SELECT *, CASE WHEN update_column <> create_column THEN 'coalesce(' || update_column || ',' || create_column || ')' ELSE coalesce(update_column, create_column) END AS expression FROM g""")
def incremental_column_detection(spark, sf):
    return incremental.detected_columns(values(spark, _COLUMNS))


@query("WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders), r AS (SELECT unnest(range(lo, hi + 1, 1000)) AS s, hi FROM b) SELECT 'o_orderkey:' || s || ':' || least(s + 999, hi) AS chunk_key, s AS chunk_start, least(s + 999, hi) AS chunk_end FROM r")
def chunk_plan(spark, sf):
    return chunks.plan(table(spark, sf, "orders"), "o_orderkey", 1000)


@query("SELECT o_orderkey // 1000 AS chunk_id, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def chunk_rowcounts(spark, sf):
    return chunks.counts(table(spark, sf, "orders"), "o_orderkey", 1000)


_LEDGER = "('o_orderkey:0:999','success'),('o_orderkey:1000:1999','failed')) AS t(chunk_key,status)"


@query(f"WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders), r AS (SELECT unnest(range(lo, hi + 1, 1000)) AS s, hi FROM b), p AS (SELECT 'o_orderkey:' || s || ':' || least(s + 999, hi) AS chunk_key, s AS chunk_start, least(s + 999, hi) AS chunk_end FROM r) SELECT * FROM p WHERE chunk_key NOT IN (SELECT chunk_key FROM (VALUES {_LEDGER} WHERE status = 'success')")
def chunk_resume_pending(spark, sf):
    return chunks.pending(chunks.plan(table(spark, sf, "orders"), "o_orderkey", 1000), values(spark, _LEDGER))


# ---- profiles and recommendations

_PROFILED = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_count, count(*) > 0 AND count(DISTINCT {c}) = count(*) AS is_unique, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM customer" for c in _PROFILED)


@query(_PROFILE)
def profile_columns(spark, sf):
    return profile.profile(table(spark, sf, "customer"), _PROFILED)


def _profiles(spark: SparkSession, sf: str, names: dict[str, list[str]]) -> DataFrame:
    return files.union_all([profile.profile(table(spark, sf, t), cs).select(F.lit(t).alias("table_name"), "*", F.expr(f"array_position(array({','.join(repr(c) for c in cs)}), column_name)").alias("ordinal")) for t, cs in names.items()])


_KEYED = {"customer": ["c_custkey", "c_nationkey"], "part": ["p_partkey", "p_size"], "nation": ["n_nationkey", "n_regionkey"]}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {100 + i} AS preference FROM {t} HAVING count(DISTINCT {c}) = count(*) AND count(*) = count({c}) AND count(*) > 0" for t, cs in _KEYED.items() for i, c in enumerate(cs, 1)))
def key_candidates(spark, sf):
    return profile.key_candidates(_profiles(spark, sf, _KEYED))


_MODES = {"orders": ["o_orderkey", "o_orderdate"], "customer": ["c_custkey", "c_nationkey"], "events": ["event_id", "user_id"]}
_MODE_SQL = """
    SELECT 'orders' AS table_name, count(*) AS source_count, count(*) AS target_count, 'o_orderkey' AS best_key, 'o_orderdate' AS best_watermark, 'incremental_candidate' AS mode, 'unique key and a watermark column' AS reason FROM orders
    UNION ALL SELECT 'customer', count(*), count(*), 'c_custkey', NULL, 'truncate', 'small table' FROM customer
    UNION ALL SELECT 'events', count(*), count(*) - 1, 'event_id', NULL, 'truncate', 'row counts differ' FROM events"""


@query(_MODE_SQL)
def load_mode_recommendation(spark, sf):
    pairs = {t: (table(spark, sf, t), table(spark, sf, t).where("event_id <> 0") if t == "events" else table(spark, sf, t)) for t in _MODES}
    return profile.recommendation(reconcile.rowcounts(pairs).select("table_name", "source_count", "target_count"), _profiles(spark, sf, _MODES))


# ---- schemas

_SCHEMA = "AS t(table_name,column_name,ordinal,data_type,char_length,data_length,numeric_precision,numeric_scale,nullable,udt_name)"
_I = "CAST(NULL AS INT)"


def _column(t: str, c: str, n: int, kind: str, size=_I, p=_I, s=_I, short="NULL") -> str:
    return f"('{t}','{c}',{n},'{kind}',{size},{_I},{p},{s},true,{short if short == 'NULL' else repr(short)})"


_SOURCE = ",".join([_column("t1", "ID", 1, "NUMBER", p=9, s=0), _column("t1", "FREEZE", 2, "VARCHAR2", size=10), _column("t1", "GONE", 3, "DATE"), _column("t2", "ID", 1, "NUMBER", p=18, s=0), _column("t2", "NAME", 2, "VARCHAR2", size=20), _column("t3", "A", 1, "NUMBER", p=38, s=0), _column("t3", "B", 2, "DATE"), _column("t4", "X", 1, "NUMBER"), _column("t5", "L", 1, "CLOB")]) + ") " + _SCHEMA
_TARGET = ",".join([_column("t1", "id", 1, "integer", short="int4"), _column("t1", "freezee", 2, "character varying", size=10, short="varchar"), _column("t1", "more", 3, "text", short="text"), _column("t2", "name", 1, "character varying", size=10, short="varchar"), _column("t2", "id", 2, "integer", short="int4"), _column("t3", "a", 1, "numeric", p=38, s=0, short="numeric"), _column("t3", "b", 2, "timestamp without time zone", short="timestamp"), _column("t4", "x", 1, "double precision", short="float8"), _column("t5", "l", 1, "text", short="text")]) + ") " + _SCHEMA
_DUCK_SOURCE = f"""SELECT *, data_type || CASE WHEN data_type IN ('VARCHAR2','CHAR') AND char_length > 0 THEN '(' || char_length || ')' WHEN data_type = 'NUMBER' AND numeric_precision IS NOT NULL THEN '(' || numeric_precision || ',' || numeric_scale || ')' ELSE '' END AS source_type,
    CASE data_type WHEN 'VARCHAR2' THEN 'varchar(' || char_length || ')' WHEN 'DATE' THEN 'timestamp' WHEN 'CLOB' THEN 'text' WHEN 'NUMBER' THEN
        CASE WHEN numeric_precision IS NULL THEN 'numeric' WHEN numeric_precision <= 4 THEN 'smallint' WHEN numeric_precision <= 9 THEN 'integer' WHEN numeric_precision <= 18 THEN 'bigint' ELSE 'numeric(' || numeric_precision || ',0)' END END AS suggested_type
    FROM (VALUES {_SOURCE}"""
_DUCK_PAIRS = f"""s AS (SELECT *, coalesce((SELECT target_column FROM (VALUES ('t1','freeze','freezee')) AS r(table_name,source_column,target_column) WHERE r.table_name = x.table_name AND source_column = lower(column_name)), lower(column_name)) AS k FROM ({_DUCK_SOURCE}) AS x),
    t AS (SELECT *, lower(column_name) AS k FROM (VALUES {_TARGET}),
    p AS (SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.k, t.k) AS k, s.k AS sk, t.k AS tk, s.ordinal AS so, t.ordinal AS t_o, s.data_type AS sd, t.udt_name AS td, s.char_length AS sl, t.char_length AS tl, s.numeric_precision AS sp, t.numeric_precision AS tp, s.suggested_type FROM s FULL JOIN t ON s.table_name = t.table_name AND s.k = t.k),
    -- of the kinds of type that stand here: digits that a whole-number type holds, lengths, a date's time of day, binary fractions
    j AS (SELECT *, CASE WHEN tk IS NULL THEN 'missing_in_target' WHEN sk IS NULL THEN 'extra_in_target'
            WHEN sd = 'NUMBER' AND td = 'int4' AND sp > 9 OR sd = 'VARCHAR2' AND td = 'varchar' AND sl > tl THEN 'type_mismatch'
            WHEN sd = 'NUMBER' AND td = 'float8' OR sd = 'DATE' AND td = 'timestamp' THEN 'type_difference' END AS kind FROM p),
    d AS (SELECT table_name, k AS column_name, kind AS diff_type, CASE WHEN kind = 'type_difference' THEN 'compatible_with_warning' ELSE 'incompatible' END AS compatibility_status,
            CASE WHEN kind <> 'type_difference' THEN 'ERROR' WHEN td = 'float8' THEN 'WARNING' ELSE 'INFO' END AS severity, suggested_type FROM j WHERE kind IS NOT NULL
          UNION ALL SELECT table_name, k, 'ordinal_difference', 'compatible_with_warning', 'INFO', suggested_type FROM p WHERE so <> t_o)"""


def _schemas(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return values(spark, _SOURCE), values(spark, _TARGET), values(spark, "('t1','freeze','freezee')) AS r(table_name,source_column,target_column)")


@query(f"WITH {_DUCK_PAIRS} SELECT table_name, column_name, diff_type, compatibility_status, severity FROM d")
def schema_diff_columns(spark, sf):
    return schema_diff.column_diff(*_schemas(spark)).select("table_name", "column_name", "diff_type", "compatibility_status", "severity")


@query(f"""WITH {_DUCK_PAIRS}, n AS (SELECT table_name, count_if(severity = 'ERROR') AS e, count_if(severity = 'WARNING') AS w, count_if(severity = 'INFO') AS i FROM d GROUP BY 1)
    SELECT table_name, count(sk)::INTEGER AS source_column_count, count(tk)::INTEGER AS target_column_count, coalesce(max(e), 0)::INTEGER AS error_count, coalesce(max(w), 0)::INTEGER AS warning_count, coalesce(max(i), 0)::INTEGER AS info_count,
        coalesce(string_agg(k, ';' ORDER BY k) FILTER (WHERE tk IS NULL), '') AS missing_columns, coalesce(string_agg(k, ';' ORDER BY k) FILTER (WHERE sk IS NULL), '') AS extra_columns,
        CASE WHEN max(e) > 0 THEN 'MISMATCH' WHEN max(w) > 0 THEN 'WARNING' ELSE 'MATCH' END AS status FROM p LEFT JOIN n USING (table_name) GROUP BY table_name""")
def table_status(spark, sf):
    s, t, r = _schemas(spark)
    out = schema_diff.inventory(s, t, schema_diff.column_diff(s, t, r))
    n = {c: F.col(c).cast("int") for c in ("source_column_count", "target_column_count", "error_count", "warning_count", "info_count")}
    return out.withColumns(n).select("table_name", *n, "missing_columns", "extra_columns", "status")


@query(f"""WITH {_DUCK_PAIRS} SELECT table_name, column_name, 'ALTER TABLE "public"."' || table_name || '" ' || CASE diff_type WHEN 'missing_in_target' THEN 'ADD COLUMN "' || column_name || '" ' || suggested_type ELSE 'DROP COLUMN "' || column_name || '"' END || ';' AS statement FROM d WHERE diff_type LIKE '%in_target'""")
def ddl_suggestions(spark, sf):
    return schema_diff.ddl_suggestions(schema_diff.column_diff(*_schemas(spark)), drop=True)


_RULES = [
    # source kind, length, precision, scale; target kind, length, precision, scale, short name; status, severity
    ("VARCHAR2", 10, None, None, "character varying", 10, None, None, "varchar", "compatible_exact", "OK"),
    ("VARCHAR2", 10, None, None, "character varying", 5, None, None, "varchar", "incompatible", "ERROR"),
    ("VARCHAR2", 10, None, None, "text", None, None, None, "text", "compatible", "OK"),
    ("VARCHAR2", 10, None, None, "integer", None, None, None, "int4", "incompatible", "ERROR"),
    ("CHAR", 10, None, None, "character", 10, None, None, "bpchar", "compatible_exact", "OK"),
    ("CHAR", 10, None, None, "character varying", 10, None, None, "varchar", "compatible", "OK"),
    ("NUMBER", None, 10, 2, "numeric", None, 10, 2, "numeric", "compatible_exact", "OK"),
    ("NUMBER", None, 10, 2, "numeric", None, 8, 2, "numeric", "incompatible", "ERROR"),
    ("NUMBER", None, 10, 2, "numeric", None, 12, 1, "numeric", "incompatible", "ERROR"),
    ("NUMBER", None, 10, 2, "numeric", None, None, None, "numeric", "compatible", "OK"),
    ("NUMBER", None, None, None, "numeric", None, 38, 0, "numeric", "compatible_with_warning", "WARNING"),
    ("NUMBER", None, 4, 0, "smallint", None, None, None, "int2", "compatible", "OK"),
    ("NUMBER", None, 5, 0, "smallint", None, None, None, "int2", "incompatible", "ERROR"),
    ("NUMBER", None, 18, 0, "integer", None, None, None, "int4", "incompatible", "ERROR"),
    ("NUMBER", None, 18, 0, "bigint", None, None, None, "int8", "compatible", "OK"),
    ("NUMBER", None, 5, 2, "integer", None, None, None, "int4", "incompatible", "ERROR"),
    ("NUMBER", None, None, None, "bigint", None, None, None, "int8", "compatible", "OK"),
    ("NUMBER", None, 10, 2, "double precision", None, None, None, "float8", "compatible_with_warning", "WARNING"),
    ("NUMBER", None, 10, 2, "text", None, None, None, "text", "incompatible", "ERROR"),
    ("FLOAT", None, None, None, "real", None, None, None, "float4", "compatible", "OK"),
    ("BINARY_DOUBLE", None, None, None, "numeric", None, None, None, "numeric", "compatible_with_warning", "INFO"),
    ("TIMESTAMP(6)", None, None, None, "timestamp without time zone", None, None, None, "timestamp", "compatible_exact", "OK"),
    ("DATE", None, None, None, "timestamp without time zone", None, None, None, "timestamp", "compatible_with_warning", "INFO"),
    ("DATE", None, None, None, "date", None, None, None, "date", "incompatible", "ERROR"),
    ("DATE", None, None, None, "time without time zone", None, None, None, "time", "incompatible", "ERROR"),
    ("INTERVAL DAY(2) TO SECOND(6)", None, None, None, "interval", None, None, None, "interval", "compatible", "OK"),
    ("BOOLEAN", None, None, None, "boolean", None, None, None, "bool", "compatible_exact", "OK"),
    ("RAW", None, None, None, "bytea", None, None, None, "bytea", "compatible_exact", "OK"),
    ("BLOB", None, None, None, "text", None, None, None, "text", "incompatible", "ERROR"),
    ("CLOB", None, None, None, "text", None, None, None, "text", "compatible", "OK"),
    ("CLOB", None, None, None, "character varying", None, None, None, "varchar", "compatible_with_warning", "WARNING"),
    ("CLOB", None, None, None, "character varying", 100, None, None, "varchar", "incompatible", "ERROR"),
    ("ROWID", None, None, None, "text", None, None, None, "text", "compatible", "OK"),
    ("JSON", None, None, None, "jsonb", None, None, None, "jsonb", "compatible", "OK"),
    ("XMLTYPE", None, None, None, "text", None, None, None, "text", "compatible_with_warning", "INFO"),
    ("SDO_GEOMETRY", None, None, None, "text", None, None, None, "text", "incompatible", "ERROR"),
]


@query("SELECT * FROM (VALUES " + ",".join(f"({i},'{r[9]}','{r[10]}')" for i, r in enumerate(_RULES)) + ") AS t(case_id,status,severity)")
def type_rules(spark, sf):
    rows = [(i, (("t", "c", 1, r[0], r[1], None, r[2], r[3], True, None)), (("t", "c", 1, r[4], r[5], None, r[6], r[7], True, r[8]))) for i, r in enumerate(_RULES)]
    fields = "struct<table_name:string,column_name:string,ordinal:int,data_type:string,char_length:int,data_length:int,numeric_precision:int,numeric_scale:int,nullable:boolean,udt_name:string>"
    return spark.createDataFrame(rows, f"case_id int, s {fields}, t {fields}").select("case_id", assessed(F.col("s"), F.col("t")).alias("a")).select("case_id", "a.status", "a.severity")


# columns of both sides described from the tables: each part stands for one column, its numbers for digits and lengths
_TYPED = """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'NUMBER' WHEN 1 THEN 'VARCHAR2' ELSE 'CHAR' END AS sk, 1 + p_size % 30 AS a, p_partkey % 4 AS b,
    CASE WHEN p_partkey % 3 = 0 THEN CASE p_partkey % 5 WHEN 0 THEN 'smallint' WHEN 1 THEN 'integer' WHEN 2 THEN 'bigint' WHEN 3 THEN 'numeric' ELSE 'text' END
         ELSE CASE p_partkey % 5 WHEN 0 THEN 'character varying' WHEN 1 THEN 'text' WHEN 2 THEN 'integer' WHEN 3 THEN 'character varying' ELSE 'character' END END AS tk,
    1 + p_partkey % 32 AS c, p_partkey % 3 AS d FROM part"""


@query(f"""SELECT p_partkey, CASE WHEN sk = 'NUMBER' THEN CASE
        WHEN tk = 'text' THEN 'incompatible' WHEN tk = 'numeric' THEN CASE WHEN a = c AND b = d THEN 'compatible_exact' WHEN c - d >= a - b AND d >= b THEN 'compatible' ELSE 'incompatible' END
        WHEN b > 0 THEN 'incompatible' WHEN a <= CASE tk WHEN 'smallint' THEN 4 WHEN 'integer' THEN 9 ELSE 18 END THEN 'compatible' ELSE 'incompatible' END
      WHEN tk = 'integer' THEN 'incompatible' WHEN tk = 'text' THEN 'compatible' WHEN c < a THEN 'incompatible'
      WHEN sk = 'VARCHAR2' AND tk = 'character varying' OR sk = 'CHAR' AND tk = 'character' THEN CASE WHEN c = a THEN 'compatible_exact' ELSE 'compatible' END ELSE 'compatible' END AS status
    FROM ({_TYPED}) WHERE NOT (sk = 'VARCHAR2' AND tk = 'character')""")
def type_rules_derived(spark, sf):
    """The type rules over columns described from a table: digits of numbers, lengths of texts."""
    t = derived(spark, sf, _TYPED).where("NOT (sk = 'VARCHAR2' AND tk = 'character')")
    number, none = F.col("sk") == "NUMBER", F.lit(None).cast("int")
    def column(kind, size, scale, short):  # noqa: E306
        return F.struct(F.lit("t").alias("table_name"), F.lit("c").alias("column_name"), F.lit(1).alias("ordinal"), kind.alias("data_type"), F.when(~number, size).cast("int").alias("char_length"), none.alias("data_length"), F.when(number, size).cast("int").alias("numeric_precision"), F.when(number, scale).cast("int").alias("numeric_scale"), F.lit(True).alias("nullable"), short.alias("udt_name"))
    names = {"smallint": "int2", "integer": "int4", "bigint": "int8", "numeric": "numeric", "text": "text", "character varying": "varchar", "character": "bpchar"}
    short = F.coalesce(*(F.when(F.col("tk") == k, v) for k, v in names.items()))
    sized = F.col("tk").isin("numeric", "character varying", "character")
    s = column(F.col("sk"), F.col("a"), F.col("b"), F.lit(None).cast("string"))
    return t.select("p_partkey", assessed(s, column(F.col("tk"), F.when(sized, F.col("c")), F.when(sized, F.col("d")), short)).alias("x")).select("p_partkey", "x.status")


@query(f"SELECT table_name, column_name, source_type, suggested_type FROM ({_DUCK_SOURCE})")
def suggested_types(spark, sf):
    c = F.struct("*")
    return values(spark, _SOURCE).select("table_name", "column_name", source_label(c).alias("source_type"), suggested_type(c).alias("suggested_type"))


@query(f"SELECT table_name, column_name, CASE WHEN data_type = 'character varying' THEN 'varchar(' || char_length || ')' WHEN data_type = 'numeric' THEN 'numeric(' || numeric_precision || ',' || numeric_scale || ')' ELSE udt_name END AS target_type FROM (VALUES {_TARGET}")
def target_types(spark, sf):
    return values(spark, _TARGET).select("table_name", "column_name", target_label(F.struct("*")).alias("target_type"))


# ---- objects, dependencies, sequences

_CHAINED = "SELECT concat('o', p_partkey) AS object, concat('o', p_partkey DIV 2) AS uses FROM part WHERE p_partkey > 1 UNION ALL SELECT concat('o', p_partkey), concat('o', p_partkey DIV 3) FROM part WHERE p_partkey > 2 AND p_partkey % 5 = 0 UNION ALL SELECT concat('o', 1 + p_partkey % 3), concat('o', p_partkey) FROM part WHERE p_partkey = 700"


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT object, uses FROM ({_CHAINED.replace(' DIV ', ' // ')})), r AS (SELECT object, uses FROM e UNION SELECT r.object, e.uses FROM r JOIN e ON e.object = r.uses)
    SELECT r.object, r.uses, r.object IN (SELECT object FROM r WHERE object = uses) AS cyclic FROM r""")
def dependency_closure(spark, sf):
    """What every object uses in the end, a cycle among them."""
    return objects.closure(derived(spark, sf, _CHAINED)).select("object", "uses", "cyclic")


_OBJECTS_S = "('VIEW','SAMPLE_VIEW','','VALID','a',1),('SEQUENCE','SAMPLE_SEQ','','VALID','b',2),('TRIGGER','TRG','SAMPLE','VALID','c',3),('VIEW','sample_view','','INVALID','d',4)) AS t(object_type,object_name,parent_name,status,details,seq)"
_OBJECTS_T = "('view','sample_view','','VALID','e',1),('FUNCTION','sample_fn','','VALID','f',2),('TRIGGER','trg','sample','DISABLED','g',3)) AS t(object_type,object_name,parent_name,status,details,seq)"


@query(f"""
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY lower(object_type), lower(parent_name), lower(object_name) ORDER BY seq DESC) AS n FROM (VALUES {_OBJECTS_S}),
    t AS (SELECT * FROM (VALUES {_OBJECTS_T})
    SELECT coalesce(s.object_type, t.object_type) AS object_type, coalesce(s.object_name, t.object_name) AS object_name, coalesce(s.parent_name, t.parent_name) AS parent_name,
           s.seq IS NOT NULL AS source_exists, t.seq IS NOT NULL AS target_exists, CASE WHEN t.seq IS NULL THEN 'MISSING_IN_TARGET' WHEN s.seq IS NULL THEN 'MISSING_IN_SOURCE' ELSE 'MATCH' END AS status,
           s.status AS source_status, t.status AS target_status, s.details AS source_details, t.details AS target_details
    FROM (SELECT * FROM s WHERE n = 1) AS s FULL JOIN t ON lower(s.object_type) = lower(t.object_type) AND lower(s.parent_name) = lower(t.parent_name) AND lower(s.object_name) = lower(t.object_name)""")
def object_compare(spark, sf):
    return objects.compare(values(spark, _OBJECTS_S), values(spark, _OBJECTS_T))


_EDGES = "('pre','source','sample','app','V1','VIEW','view','VALID','',1),('pre','source','SAMPLE','APP','v1','view','VIEW','INVALID','',2),('pre','source','sample','app','P1','PROCEDURE','routine','INVALID','',3),('post','target','sample','app','i1','INDEX','index','','status=UNUSABLE',4),('post','target','sample','app','t1','TRIGGER','trigger','ENABLED','',5)) AS t(phase,source_db,table_name,object_schema,object_name,object_type,dependency_kind,status,details,seq)"
_REPAIRS = "('target','sample','app','MATERIALIZED VIEW','m1','refreshed','missing',''),('target','sample','app','PROCEDURE','p1','failed','exists','FAILED')) AS t(source_db,table_name,object_schema,object_type,object_name,maintenance_status,validation_status,compile_status)"


@query(f"SELECT phase, source_db, table_name, object_name, status FROM (SELECT *, row_number() OVER (PARTITION BY lower(source_db), lower(table_name), lower(object_schema), lower(object_name), lower(object_type), lower(dependency_kind) ORDER BY seq) AS n FROM (VALUES {_EDGES}) WHERE n = 1")
def dependency_dedupe(spark, sf):
    return objects.distinct_edges(values(spark, _EDGES)).select("phase", "source_db", "table_name", "object_name", "status")


_BAD = "regexp_matches(upper({c}), 'BROKEN|DISABLED|FAILED|INVALID|MISSING|UNUSABLE')"


@query(f"""
    SELECT phase, source_db, table_name, count(*) AS object_count, count_if({_BAD.format(c='status')} OR regexp_matches(upper(details), 'STATUS=(BROKEN|DISABLED|FAILED|INVALID|MISSING|UNUSABLE)'))::BIGINT AS broken_count,
           count_if({_BAD.format(c='status')})::BIGINT AS invalid_count, CAST(0 AS BIGINT) AS missing_count, CAST(0 AS BIGINT) AS failed_count FROM (VALUES {_EDGES} GROUP BY ALL
    UNION ALL SELECT 'maintenance', source_db, table_name, count(*), count_if({_BAD.format(c='validation_status')} OR {_BAD.format(c='maintenance_status')} OR {_BAD.format(c='compile_status')})::BIGINT, 0,
           count_if(contains(upper(validation_status), 'MISSING'))::BIGINT, count_if(contains(upper(maintenance_status), 'FAILED') OR contains(upper(compile_status), 'FAILED'))::BIGINT FROM (VALUES {_REPAIRS} GROUP BY ALL""")
def dependency_summary(spark, sf):
    return objects.health(values(spark, _EDGES), values(spark, _REPAIRS))


_TRIED = "SELECT concat('s', p_size % 3) AS object_schema, concat('v', p_partkey) AS object_name FROM part WHERE p_partkey % 2 = 0"
_STILL = "SELECT concat('s', p_size % 3) AS object_schema, concat('v', p_partkey) AS object_name FROM part WHERE p_partkey % 3 = 0"


@query(f"SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM ({_STILL}) AS b WHERE b.object_schema = t.object_schema AND b.object_name = t.object_name) THEN 'failed' ELSE 'fixed' END AS outcome FROM ({_TRIED}) AS t")
def repair_outcome(spark, sf):
    return objects.repair_outcome(derived(spark, sf, _TRIED), derived(spark, sf, _STILL), ["object_schema", "object_name"])


_OBJECT_ROWS = "SELECT concat('t', p_size) AS table_name, CASE p_partkey % 11 WHEN 0 THEN 'INDEX' WHEN 1 THEN 'view' WHEN 2 THEN 'MVIEW' WHEN 3 THEN 'PROC' WHEN 4 THEN 'PKG' WHEN 5 THEN 'TRIGGER' WHEN 6 THEN 'SEQUENCE' WHEN 7 THEN 'CONSTRAINT' WHEN 8 THEN 'materialized_view' WHEN 9 THEN 'FUNCTION' ELSE 'SYNONYM' END AS object_type, CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE lower(p_brand) END AS object_name FROM part"


@query(f"SELECT table_name, count_if(k = 'INDEX')::BIGINT AS index_count, count(DISTINCT lower(object_name)) FILTER (WHERE k IN ('VIEW', 'MVIEW', 'MATERIALIZED_VIEW')) AS view_count, count_if(k = 'SEQUENCE')::BIGINT AS sequence_count, count(DISTINCT lower(object_name)) FILTER (WHERE k IN ('PROC', 'PKG', 'FUNCTION')) AS routine_count, count_if(k = 'TRIGGER')::BIGINT AS trigger_count, count_if(k = 'CONSTRAINT')::BIGINT AS constraint_count FROM (SELECT *, upper(object_type) AS k FROM ({_OBJECT_ROWS})) GROUP BY 1")
def object_counts(spark, sf):
    return objects.object_counts(derived(spark, sf, _OBJECT_ROWS)).select("table_name", *(f"{c}_count" for c in ("index", "view", "sequence", "routine", "trigger", "constraint")))


_CONSTRAINTS = "SELECT concat('t', l_orderkey % 400) AS table_name, concat(CASE l_suppkey % 3 WHEN 0 THEN 'pk_' WHEN 1 THEN 'uq_' ELSE 'ck_' END, l_partkey % 4) AS constraint_name, CASE l_suppkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'U' ELSE 'C' END AS constraint_type, concat('C', l_linenumber) AS column_name, l_linenumber * 7 % 5 * 10 + l_linenumber AS position FROM lineitem GROUP BY l_orderkey % 400, l_suppkey % 3, l_partkey % 4, l_linenumber"


@query(f"WITH w AS (SELECT table_name, constraint_type, constraint_name, string_agg(lower(column_name), ',' ORDER BY position) AS key_columns FROM ({_CONSTRAINTS}) WHERE constraint_type IN ('P', 'U') GROUP BY ALL) SELECT table_name, constraint_name, key_columns FROM w QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY constraint_type, constraint_name) = 1")
def preferred_keys(spark, sf):
    return objects.preferred_key(derived(spark, sf, _CONSTRAINTS))


_ROUTINES = """SELECT p_partkey AS id, CASE p_partkey % 8
    WHEN 0 THEN concat('begin insert into t values (app.seq_', p_size, '.nextval); x := SEQ_', p_size, '.NEXTVAL; y := "S$', p_partkey, '".NextVal; end;')
    WHEN 1 THEN 'select * from app.orders o join "orders" x on 1=1'
    WHEN 2 THEN concat('select * from my_orders; update ordersx set a=', p_size)
    WHEN 3 THEN 'select * from APP . Orders' WHEN 4 THEN concat(p_name, ' orders$old') WHEN 5 THEN concat('-- ', p_name, chr(10), 'delete from "Orders"')
    WHEN 6 THEN concat('x := nextval; a.b.s', p_size, ' . nextval') ELSE concat(p_name, ' ', p_brand) END AS definition FROM part"""


@query(f"""SELECT id, list_sort(list_distinct(list_transform(regexp_extract_all(definition, '(?i)([a-z0-9_$#]+)"?\\s*[.]\\s*nextval', 1), lambda x: upper(x)))) AS sequences FROM ({_ROUTINES})""")
def nextval_extract(spark, sf):
    return derived(spark, sf, _ROUTINES).select("id", F.sort_array(text.sequence_names(F.col("definition"))).alias("sequences"))


@query(f"SELECT id, regexp_matches(definition, '(?i)(^|[^a-z0-9_$#])orders([^a-z0-9_$#]|$)') AS mentions_orders FROM ({_ROUTINES})")
def table_reference_match(spark, sf):
    return derived(spark, sf, _ROUTINES).select("id", text.mentions_table(F.col("definition"), "orders").alias("mentions_orders"))


_SEQUENCES = "('s_orders',100L,{m},90L,true,{m},1L,9223372036854775807L,0L,''),('s_far',10L,5L,500L,true,9L,1L,1000000L,0L,''),('s_cap',5000L,4000L,10L,true,10L,1L,999L,0L,''),('s_skip',1L,1L,CAST(NULL AS BIGINT),false,1L,1L,100L,0L,''),('s_buf',100L,80L,100L,false,90L,5L,100000L,50L,'SET'),('s_ok',9L,9L,10L,false,9L,1L,100L,0L,'')) AS t(target_sequence,source_last,source_table_max,target_last,target_is_called,target_table_max,increment,max_value,buffer,status)"


def _sequence_rows(spark: SparkSession, sf: str) -> DataFrame:
    most = table(spark, sf, "orders").agg(F.max("o_orderkey").alias("m"))
    rows = values(spark, _SEQUENCES.format(m="CAST(NULL AS BIGINT)"))
    both = rows.crossJoin(most)
    mine = F.col("target_sequence") == "s_orders"
    return both.withColumns({c: F.when(mine, F.col("m")).otherwise(F.col(c)) for c in ("source_table_max", "target_table_max")}).drop("m")


_SEQ_SQL = "WITH q AS (SELECT target_sequence, source_last, CASE WHEN target_sequence = 's_orders' THEN (SELECT max(o_orderkey) FROM orders) ELSE source_table_max END AS source_table_max, target_last, target_is_called, CASE WHEN target_sequence = 's_orders' THEN (SELECT max(o_orderkey) FROM orders) ELSE target_table_max END AS target_table_max, increment, max_value, buffer, status FROM (VALUES " + _SEQUENCES.format(m="CAST(NULL AS BIGINT)").replace("L,", ",") + "), c AS (SELECT *, CASE WHEN target_is_called THEN target_last + increment ELSE target_last END AS current_next FROM q), n AS (SELECT *, least(greatest(source_last + greatest(buffer, 0), current_next, source_table_max + abs(increment), target_table_max + abs(increment), 1), max_value) AS set_to FROM c)"


@query(f"{_SEQ_SQL} SELECT target_sequence, current_next, set_to, coalesce(set_to = max_value, FALSE) AS capped FROM n")
def sequence_next_values(spark, sf):
    return sequences.planned(_sequence_rows(spark, sf)).select("target_sequence", "current_next", "set_to", "capped")


@query(f"{_SEQ_SQL} SELECT target_sequence, CASE WHEN status = 'SKIPPED' OR current_next IS NULL OR set_to IS NULL THEN 'SKIPPED' WHEN current_next < set_to AND status = 'SET' THEN 'SET_APPLIED' WHEN current_next < set_to THEN 'NEEDS_SET' WHEN CASE WHEN buffer > 0 THEN current_next > set_to ELSE current_next > coalesce(source_table_max, source_last) END THEN 'TARGET_AHEAD' ELSE 'ALIGNED' END AS compare_status, current_next - coalesce(nullif(source_table_max, 0), source_last) AS delta FROM n")
def sequence_compare_status(spark, sf):
    return sequences.planned(_sequence_rows(spark, sf)).select("target_sequence", "compare_status", "delta")


_WANTED = "SELECT concat('tab', s_suppkey) AS table_name, CASE s_suppkey % 3 WHEN 0 THEN concat('tab', s_suppkey, '_seq') WHEN 1 THEN concat('own_', s_suppkey) ELSE concat('id', s_suppkey) END AS target_sequence FROM supplier"
_DRAWN = "SELECT CASE s_suppkey % 4 WHEN 3 THEN concat('X_TAB', s_suppkey, '_ID') ELSE concat('TAB', s_suppkey, '_SEQ') END AS name, s_suppkey * 10 AS source_last FROM supplier"


@query(f"WITH c AS ({_WANTED}), s AS (SELECT upper(name) AS name, source_last FROM ({_DRAWN})), m AS (SELECT c.*, s.name, s.source_last, s.name = upper(target_sequence) AS equal FROM c JOIN s ON s.name = upper(target_sequence) OR contains(s.name, upper(table_name))), e AS (SELECT * FROM m WHERE equal), h AS (SELECT table_name, target_sequence, min(name) AS name, min(source_last) AS source_last FROM m GROUP BY ALL HAVING count(*) = 1) SELECT c.table_name, c.target_sequence, coalesce(e.name, h.name) AS source_sequence, coalesce(e.source_last, h.source_last) AS source_last, CASE WHEN e.name IS NOT NULL THEN 'exact' WHEN h.name IS NOT NULL THEN 'contains' ELSE 'none' END AS match FROM c LEFT JOIN e USING (target_sequence) LEFT JOIN h USING (target_sequence)")
def sequence_match(spark, sf):
    return sequences.matched(derived(spark, sf, _WANTED), derived(spark, sf, _DRAWN))


# ---- long columns and cleaning


_PLACE = "1 + page_id * 37 % length(html)"


@query(f"""WITH p AS (SELECT *, {_PLACE} AS pos FROM pages WHERE page_id % 13 <> 0)
    SELECT page_id, CAST(strlen(substr(html, 1, pos - 1)) // 512 AS INTEGER) AS segment, 'changed' AS status FROM p WHERE page_id % 3 = 0
    UNION ALL SELECT page_id, 0, 'source only' FROM pages WHERE page_id % 13 = 0""")
def long_value_segments(spark, sf):
    """Where long values part: the first segment of 512 bytes that differs, of pages of which a third have one letter replaced."""
    p = table(spark, sf, "pages").select("page_id", "html")
    at = F.expr(_PLACE).cast("int")
    changed = F.concat(F.substr("html", F.lit(1), at - 1), F.lit("\x01"), F.substr("html", at + 1))
    other = p.where("page_id % 13 <> 0").withColumn("html", F.when(F.col("page_id") % 3 == 0, changed).otherwise(F.col("html")))
    return long_columns.first_differences(p, other, ["page_id"], "html", 512).select("page_id", "segment", "status")


def _sizes(t: str, c: str) -> str:
    return f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, CAST(coalesce(sum(strlen({c})), 0) AS BIGINT) AS total_bytes, CAST(coalesce(max(strlen({c})), 0) AS BIGINT) AS max_bytes, round(sum(strlen({c})) / count({c}), 3) AS avg_bytes FROM {t}"


@query(_sizes("documents", "text"))
def lob_profile_documents(spark, sf):
    return long_columns.size_profile(table(spark, sf, "documents"), ["text"])


@query(_sizes("pages", "html") + " UNION ALL " + _sizes("pages", "url"))
def lob_profile_pages(spark, sf):
    return long_columns.size_profile(table(spark, sf, "pages"), ["html", "url"])


@query("SELECT page_id, CAST(strlen(html) AS INTEGER) AS bytes, sha256(html) AS digest FROM pages")
def lob_value_digests(spark, sf):
    return long_columns.value_digests(table(spark, sf, "pages"), ["page_id"], "html")


_LONG = "SELECT concat('t', p_size) AS table_name, concat('c', p_partkey) AS column_name, CASE WHEN p_partkey % 9 < p_size % 10 THEN CASE p_partkey % 5 WHEN 0 THEN 'BLOB' WHEN 1 THEN 'CLOB' WHEN 2 THEN 'NCLOB' WHEN 3 THEN 'bytea' ELSE 'LONG' END ELSE 'NUMBER' END AS data_type, CAST(p_partkey AS INT) AS ordinal, CASE WHEN p_partkey % 40 = 7 THEN 'bytea' ELSE '' END AS udt_name FROM part"
_STRATEGIES = "SELECT concat('T', p_size) AS table_name, concat('C', p_partkey) AS column_name, CASE p_partkey % 3 WHEN 0 THEN 'skip' WHEN 1 THEN 'STREAM' ELSE 'null' END AS strategy FROM part WHERE p_partkey % 4 = 0"


@query(f"""
    WITH c AS (SELECT *, CASE WHEN upper(data_type) IN ('BLOB','CLOB','NCLOB','LONG','LONG RAW','BYTEA') THEN upper(data_type) WHEN upper(udt_name) = 'BYTEA' THEN 'BYTEA' END AS lob_type FROM ({_LONG})),
    t AS (SELECT table_name, count(*) AS total, count(lob_type) AS n, count(*) FILTER (WHERE lob_type IN ('BLOB','LONG RAW','BYTEA')) AS b FROM c GROUP BY 1),
    k AS (SELECT *, CASE WHEN n = 0 THEN 'normal' WHEN 2 * n > total THEN 'LOB-heavy' WHEN b >= greatest(1, n // 2) THEN 'binary-heavy' ELSE 'normal' END AS classification FROM t)
    SELECT k.table_name, classification, c.column_name, lob_type, CASE WHEN lob_type IN ('BLOB','LONG RAW','BYTEA','RAW') THEN 'bytea' WHEN lob_type IS NOT NULL THEN 'text' END AS target_type,
           CASE WHEN lob_type IS NOT NULL THEN coalesce(lower(s.strategy), 'error') END AS strategy,
           CASE WHEN lob_type IS NULL THEN '' WHEN classification = 'LOB-heavy' THEN CAST(round(n * 100.0 / total) AS INTEGER) || '% of the columns are long' WHEN classification = 'binary-heavy' THEN 'long columns hold bytes' WHEN lob_type IN ('LONG','LONG RAW') THEN 'this type depends on the reader' ELSE '' END AS warning,
           CASE WHEN lob_type IS NULL THEN 'none' WHEN classification = 'LOB-heavy' THEN 'exclude' WHEN classification = 'binary-heavy' OR lower(s.strategy) = 'skip' THEN 'partial_columns' ELSE 'stream' END AS recommendation
    FROM k LEFT JOIN c ON c.table_name = k.table_name AND c.lob_type IS NOT NULL LEFT JOIN ({_STRATEGIES}) AS s ON lower(s.table_name) = c.table_name AND lower(s.column_name) = c.column_name""")
def lob_classification(spark, sf):
    return long_columns.analyzed(derived(spark, sf, _LONG), derived(spark, sf, _STRATEGIES))


@query("SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS text, n_chars FROM documents")
def lob_policy_null_skip(spark, sf):
    d = table(spark, sf, "documents")
    pairs = mapping.with_long_policy(mapping.column_map(d, d.select("doc_id", "lang", "text", "source", "n_chars")), "app.documents", {"text", "source"}, {"documents.text": "null", "app.documents.source": "skip"})
    return mapping.projected(d, pairs)


_PADDED = "SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN concat('  ', c_name, chr(9)) WHEN 1 THEN '   ' WHEN 2 THEN c_name WHEN 3 THEN '' ELSE concat('　', c_mktsegment, '　 ') END AS v FROM customer"
_WHITE = r"[\t\n\x0b\f\r\x{85}\p{Z}]"


@query(f"SELECT id, regexp_replace(v, '^{_WHITE}+|{_WHITE}+$', '', 'g') AS v FROM ({_PADDED})")
def sanitize_text(spark, sf):
    return derived(spark, sf, _PADDED).select("id", text.strip(text.without_nul(F.col("v"))).alias("v"))


@query(f"SELECT id, CASE WHEN regexp_full_match(v, '{_WHITE}*') THEN ' ' ELSE v END AS v FROM ({_PADDED})")
def blank_to_space(spark, sf):
    return derived(spark, sf, _PADDED).select("id", text.blank_to_space(F.col("v")).alias("v"))


@query("SELECT c_custkey, '\\x' || lower(hex(c_name)) AS h, strlen(c_name) AS bytes FROM customer")
def hex_binary(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.hex_text(F.col("c_name").cast("binary")).alias("h"), text.byte_size(F.col("c_name")).cast("long").alias("bytes"))


_NUMBERS = "SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN concat('-', p_size, '.', p_partkey, '23456789012345') WHEN 1 THEN concat(p_size, '.500') WHEN 2 THEN concat(' ', p_partkey, ' ') WHEN 3 THEN '-0.0000000000001' WHEN 4 THEN p_name WHEN 5 THEN concat('.', p_size) ELSE concat('+', p_size, '.') END AS v FROM part"


@query(f"WITH n AS (SELECT id, v, CASE WHEN regexp_full_match(trim(v), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') THEN CAST(trim(v) AS DECIMAL(38,12)) END AS d FROM ({_NUMBERS})) SELECT id, CASE WHEN d IS NULL THEN v WHEN d = 0 THEN '0' ELSE rtrim(rtrim(CAST(d AS VARCHAR), '0'), '.') END AS v FROM n")
def decimal_text_clean(spark, sf):
    return derived(spark, sf, _NUMBERS).select("id", text.decimal_text(F.col("v")).alias("v"))


# ---- queries, costs, reports

_ANTI = "SELECT c_custkey FROM customer c WHERE c.c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"


def _views(spark: SparkSession, sf: str, *names: str) -> None:
    for n in names:
        table(spark, sf, n).createOrReplaceTempView(n)


@query(_ANTI)
def anti_join_not_in(spark, sf):
    _views(spark, sf, "customer", "orders")
    return spark.sql(queryperf.variants(_ANTI)["original"])


@query(_ANTI)
def anti_join_not_exists(spark, sf):
    _views(spark, sf, "customer", "orders")
    return spark.sql(queryperf.variants(_ANTI)["not_exists"])


_COMMA = "SELECT o_orderkey, c_mktsegment FROM orders, customer WHERE o_custkey = c_custkey AND c_nationkey = 3"


@query(_COMMA)
def implicit_join(spark, sf):
    _views(spark, sf, "customer", "orders")
    return spark.sql(queryperf.one_query(_COMMA + ";"))


@query("SELECT count(*) AS rows FROM customer WHERE c_acctbal > 0")
def queryperf_count_wrapper(spark, sf):
    _views(spark, sf, "customer")
    return queryperf.count_of(spark, "SELECT * FROM customer WHERE c_acctbal > 0 ORDER BY c_name")


_TIMINGS = "SELECT concat('db', c_nationkey) AS database, CASE WHEN c_custkey % 4 = 0 THEN 'original' ELSE concat('v', c_custkey % 4) END AS variant, CASE WHEN c_custkey % 6 = 5 THEN 'ERROR' ELSE 'OK' END AS status, min(CAST(c_custkey % 97 + 10 AS DOUBLE) / 4) AS runtime_ms FROM customer GROUP BY c_nationkey, c_custkey % 4, c_custkey % 6"


@query(f"WITH b AS (SELECT database, arg_min(variant, (runtime_ms, variant)) AS v, min(runtime_ms) AS r, max(runtime_ms) FILTER (WHERE variant = 'original') AS o FROM ({_TIMINGS}) WHERE status = 'OK' GROUP BY 1), g AS (SELECT *, coalesce((o - r) / o * 100, 0) AS gain FROM b) SELECT database, v AS recommended_variant, round(r, 3) AS runtime_ms, round(o, 3) AS original_runtime_ms, round(gain, 2) AS improvement_percent, CASE WHEN v = 'original' THEN 'keep' WHEN gain > 5 THEN 'use' ELSE 'optional' END AS recommendation FROM g")
def queryperf_best_variant(spark, sf):
    return reports.best_variants(derived(spark, sf, _TIMINGS))


_SIM = "SELECT concat('t', p_partkey) AS table_name, CASE p_partkey % 4 WHEN 0 THEN 'append' WHEN 1 THEN 'swap' WHEN 2 THEN 'truncate' END AS mode, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS BIGINT) * 1237 END AS estimated_rows, CAST(p_size AS BIGINT) * 43000001 AS size_bytes, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 17 ELSE 0 END AS BIGINT) AS dependents FROM part"


@query(f"SELECT table_name, coalesce(mode, 'truncate') AS mode, coalesce(estimated_rows, 0) AS estimated_rows, round(coalesce(estimated_rows, 0) / 10000, 3) AS estimated_seconds, CAST(floor(size_bytes * 2.5) AS BIGINT) AS swap_bytes, dependents AS dependency_impact, CASE WHEN dependents > 10 OR size_bytes > 1073741824 THEN 'high' WHEN size_bytes > 104857600 OR dependents > 0 THEN 'medium' ELSE 'low' END AS risk_level FROM ({_SIM})")
def simulate_risk(spark, sf):
    return profile.simulated(derived(spark, sf, _SIM))


_RUNS = "SELECT concat('r', c_nationkey) AS source_run, concat('t', c_custkey) AS table_name, CASE c_custkey % 3 WHEN 0 THEN 'truncate' WHEN 1 THEN 'append' ELSE 'upsert' END AS mode, CASE c_custkey % 7 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'DRY_RUN' WHEN 3 THEN 'SKIPPED' WHEN 4 THEN 'MATCH' ELSE 'SUCCESS' END AS status, CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey AS BIGINT) * 11 END AS rows_loaded, CAST(c_custkey % 1500 AS DOUBLE) / 4 AS elapsed_seconds, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('w', c_custkey % 5) END AS worker_name, concat('m', c_custkey) AS message FROM customer"


@query(f"SELECT worker_name, CAST(coalesce(sum(rows_loaded), 0) AS BIGINT) AS rows_loaded, sum(elapsed_seconds) AS elapsed_seconds, round(sum(rows_loaded) / sum(elapsed_seconds), 3) AS rows_per_second FROM ({_RUNS}) WHERE worker_name <> '' GROUP BY 1")
def metrics_by_worker(spark, sf):
    return reports.by_worker(derived(spark, sf, _RUNS))


@query(f"SELECT count(DISTINCT nullif(worker_name, '')) AS workers, round(avg(elapsed_seconds), 3) AS avg_table_duration, arg_max(table_name, (elapsed_seconds, table_name)) AS slowest_table, coalesce(string_agg(table_name, ';' ORDER BY table_name) FILTER (WHERE status = 'SUCCESS'), '') AS success_tables, coalesce(string_agg(table_name, ';' ORDER BY table_name) FILTER (WHERE status = 'FAILED'), '') AS failed_tables, coalesce(string_agg(table_name, ';' ORDER BY table_name) FILTER (WHERE status IN ('SKIPPED', 'DRY_RUN')), '') AS skipped_tables FROM ({_RUNS})")
def metrics_summary(spark, sf):
    return reports.metrics(derived(spark, sf, _RUNS))


_CHECKS = "SELECT concat('t', c_custkey) AS table_name, CASE c_custkey % 3 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'mismatch' ELSE '' END AS status FROM customer"
_DIFFS = "SELECT concat('t', p_size) AS table_name, concat('c', p_partkey) AS column_name, CASE p_partkey % 5 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'INFO' END AS severity, p_name AS reason FROM part"
_HEAVY = "SELECT concat('t', p_size) AS table_name, CASE WHEN p_partkey % 4 = 0 THEN 'LOB-heavy' ELSE 'normal' END AS classification FROM part"


@query(f"SELECT * FROM (SELECT count(*) AS total_tables, count_if(status IN ('SUCCESS', 'MATCH'))::BIGINT AS success, count_if(status = 'FAILED')::BIGINT AS failed, count_if(status = 'WARNING')::BIGINT AS warning, count_if(status = 'DRY_RUN')::BIGINT AS dry_run, CAST(sum(rows_loaded) AS BIGINT) AS rows_processed, round(sum(elapsed_seconds), 3) AS duration_seconds, count_if(elapsed_seconds >= 300)::BIGINT AS slow_tables FROM ({_RUNS})), (SELECT count_if(upper(status) = 'MATCH')::BIGINT AS checksum_pass, count_if(upper(status) = 'MISMATCH')::BIGINT AS checksum_fail FROM ({_CHECKS})), (SELECT count_if(severity = 'ERROR')::BIGINT AS schema_diff_error, count_if(severity = 'WARNING')::BIGINT AS schema_diff_warning, count_if(severity = 'INFO')::BIGINT AS schema_diff_info FROM ({_DIFFS})), (SELECT count_if(classification = 'LOB-heavy')::BIGINT AS lob_heavy_tables FROM ({_HEAVY}))")
def dashboard(spark, sf):
    return reports.dashboard(*(derived(spark, sf, q) for q in (_RUNS, _CHECKS, _DIFFS, _HEAVY)))


@query(f"SELECT status, count(*) AS tables FROM ({_RUNS}) GROUP BY 1")
def status_counts(spark, sf):
    return reports.status_counts(derived(spark, sf, _RUNS))


_FIXES = "SELECT concat('t', s_suppkey) AS table_name, s_name AS object_name, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'fixed' END AS maintenance_status, CASE WHEN s_suppkey % 2 = 0 THEN 'missing' ELSE 'exists' END AS validation_status FROM supplier"


@query(f"SELECT 'load' AS kind, table_name, mode AS item, message FROM ({_RUNS}) WHERE status = 'FAILED' UNION ALL SELECT 'schema', table_name, column_name, reason FROM ({_DIFFS}) WHERE severity = 'ERROR' UNION ALL SELECT 'maintenance', table_name, object_name, validation_status FROM ({_FIXES}) WHERE maintenance_status = 'failed'")
def error_report(spark, sf):
    return reports.errors(*(derived(spark, sf, q) for q in (_RUNS, _DIFFS, _FIXES)))


_ARCHIVE = "SELECT concat('r', c_nationkey) AS source_run, concat('t', c_custkey) AS table_name, c_custkey AS rows_loaded FROM customer WHERE c_nationkey < 15"
_FRESH = "SELECT concat('r', c_nationkey) AS source_run, concat('t', c_custkey) AS table_name, c_custkey + 1 AS rows_loaded FROM customer WHERE c_nationkey > 8"


@query(f"SELECT * FROM ({_ARCHIVE}) UNION ALL SELECT * FROM ({_FRESH}) WHERE source_run NOT IN (SELECT source_run FROM ({_ARCHIVE}))")
def consolidate_runs(spark, sf):
    return reports.consolidated(derived(spark, sf, _ARCHIVE), derived(spark, sf, _FRESH))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS table_name, count(*) AS rows FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_tables(spark, sf):
    return reports.top_tables(table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("string").alias("table_name")).agg(F.count(F.lit(1)).alias("rows")), "rows", 10)


_STATES = "SELECT concat('r', user_id % 4) AS run_id, concat('t', user_id % 9) AS table_name, concat('c', user_id) AS chunk_key, event_type AS status, event_id * 7919 % 100003 * 1000000 + event_id AS seq FROM events"


@query(f"SELECT * FROM ({_STATES}) QUALIFY row_number() OVER (PARTITION BY run_id, table_name, chunk_key ORDER BY seq DESC) = 1")
def latest_ledger_state(spark, sf):
    return upsert.last_wins(derived(spark, sf, _STATES), ["run_id", "table_name", "chunk_key"], [F.col("seq")])


@query("SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000 GROUP BY 1")
def filtered_projection(spark, sf):
    return files.conjoined(files.read(spark, f"{sf}/orders.parquet", ["o_custkey", "o_orderstatus", "o_totalprice"]), "o_orderstatus = 'O'", None, "o_totalprice > 1000").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))


_AMOUNTS = "SELECT c_custkey AS id, c_name AS name, CASE c_custkey % 40 WHEN 3 THEN concat('x', c_custkey) WHEN 7 THEN '' WHEN 9 THEN NULL WHEN 11 THEN '123456789012' ELSE concat(c_custkey, '.5') END AS amount FROM customer"


@query(f"SELECT concat_ws(';', CAST(id AS VARCHAR), name) AS key_values, 'amount' AS column_name, amount AS value FROM ({_AMOUNTS}) WHERE amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(10,2)) IS NULL ORDER BY 1 LIMIT 20")
def failed_row_sample(spark, sf):
    return files.rejected(derived(spark, sf, _AMOUNTS), {"amount": "decimal(10,2)"}, ["id", "name"])[1]


@query(f"SELECT id, name, CAST(amount AS DECIMAL(10,2)) AS amount FROM ({_AMOUNTS}) WHERE amount IS NULL OR TRY_CAST(amount AS DECIMAL(10,2)) IS NOT NULL")
def accepted_rows(spark, sf):
    return files.rejected(derived(spark, sf, _AMOUNTS), {"amount": "decimal(10,2)"}, ["id", "name"])[0]


_DUCK_TYPES = {"INTEGER": ("integer", "int4"), "BIGINT": ("bigint", "int8"), "DOUBLE": ("double precision", "float8"), "FLOAT": ("real", "float4"), "VARCHAR": ("text", "text"), "DATE": ("date", "date"), "BOOLEAN": ("boolean", "bool"), "TIMESTAMP": ("timestamp without time zone", "timestamp"), "TIMESTAMP WITH TIME ZONE": ("timestamp with time zone", "timestamptz"), "FLOAT[]": ("array<float>", "array<float>")}
_NAMED = [" ".join(["CASE data_type", *(f"WHEN '{k}' THEN '{v[i]}'" for k, v in _DUCK_TYPES.items()), "ELSE data_type END"]) for i in (0, 1)]


@query(f"SELECT table_name, column_name, CAST(column_index AS INTEGER) AS ordinal, {_NAMED[0]} AS data_type, {_NAMED[1]} AS udt_name FROM duckdb_columns() WHERE table_name IN ({','.join(map(repr, _TABLES))})")
def catalog_columns(spark, sf):
    return catalog.columns_of({t: table(spark, sf, t) for t in _TABLES}, spark).select("table_name", "column_name", "ordinal", "data_type", "udt_name")


@query("SELECT 'pair' AS table_name, coalesce(s.k, t.k) AS column_name, CASE WHEN t.k IS NULL THEN 'missing_in_target' ELSE 'extra_in_target' END AS diff_type FROM (SELECT substr(column_name, 3) AS k FROM duckdb_columns() WHERE table_name = 'customer') AS s FULL JOIN (SELECT substr(column_name, 3) AS k FROM duckdb_columns() WHERE table_name = 'supplier') AS t ON s.k = t.k WHERE s.k IS NULL OR t.k IS NULL")
def schema_diff_missing_extra(spark, sf):
    """Customers and suppliers without their prefixes: which columns one of them lacks."""
    c, o = (table(spark, sf, t).toDF(*(n[2:] for n in table(spark, sf, t).columns)) for t in ("customer", "supplier"))
    diff = schema_diff.column_diff(catalog.columns_of({"pair": c}, spark, "source"), catalog.columns_of({"pair": o}, spark))
    return diff.where("diff_type LIKE '%in_target'").select("table_name", "column_name", "diff_type")


# ---- ledger, retention, edges, streams

_BREAKERS = "SELECT concat('job', c_custkey) AS job, c_custkey % 6 AS failures, CASE WHEN c_custkey % 2 = 0 THEN '2026-01-02T00:00:00' ELSE '2025-12-31T00:00:00' END AS cooldown_until FROM customer"


@query(f"SELECT job, failures, failures >= 3 AND CAST(cooldown_until AS TIMESTAMP) > TIMESTAMP '2026-01-01 12:00:00' AS blocked FROM ({_BREAKERS})")
def breaker_blocked(spark, sf):
    return ledger.blocked_jobs(derived(spark, sf, _BREAKERS), "2026-01-01T12:00:00")


_MARKS = "SELECT concat('t', s_suppkey) AS table_name, concat('', s_suppkey) AS value FROM supplier WHERE s_suppkey % 3 <> 0"
_GOOD = "SELECT concat('t', s_suppkey) AS table_name, 'SUCCESS' AS status, concat('', s_suppkey + 5) AS watermark FROM supplier WHERE s_suppkey % 4 <> 0"
_BAD_RUN = "SELECT concat('t', s_suppkey) AS table_name, CASE WHEN s_suppkey = 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status, concat('', s_suppkey + 5) AS watermark FROM supplier"


@query(" UNION ALL ".join(f"SELECT '{n}' AS run, coalesce(m.table_name, r.table_name) AS table_name, CASE WHEN (SELECT bool_and(status = 'SUCCESS') FROM ({q})) THEN coalesce(watermark, value) ELSE value END AS value FROM ({_MARKS}) AS m FULL JOIN ({q}) AS r ON r.table_name = m.table_name WHERE value IS NOT NULL OR (SELECT bool_and(status = 'SUCCESS') FROM ({q}))" for n, q in (("good", _GOOD), ("bad", _BAD_RUN))))
def watermark_publish(spark, sf):
    moves = lambda q: ledger.watermark_moves(derived(spark, sf, _MARKS), derived(spark, sf, q))
    return moves(_GOOD).select(F.lit("good").alias("run"), "*").unionByName(moves(_BAD_RUN).select(F.lit("bad").alias("run"), "*"))


_BACKUPS = "SELECT concat('t', c_nationkey) AS table_name, concat('b', 100000 + c_custkey) AS backup, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS dependents FROM customer"


@query(f"SELECT table_name, backup FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY backup DESC) AS n FROM ({_BACKUPS})) WHERE n > 3 AND dependents = 0")
def retention_drop_list(spark, sf):
    return versions.expired(derived(spark, sf, _BACKUPS))


_PARTS = ("SELECT 'source' AS source_db, p_name AS object_name FROM part", "SELECT 'target' AS source_db, s_name AS object_name, 'btree' AS details FROM supplier", "SELECT 'target' AS source_db, c_name AS object_name FROM customer")


@query(" UNION ALL BY NAME ".join(f"SELECT *, '{p}' AS phase FROM ({q})" for p, q in zip(("pre", "pre", "post"), _PARTS, strict=True)))
def dependency_union(spark, sf):
    return files.union_all([derived(spark, sf, q).withColumn("phase", F.lit(p)) for p, q in zip(("pre", "pre", "post"), _PARTS, strict=True)])


_USES = "SELECT concat('db.V', s_suppkey) AS object, concat('db.v', CAST(floor(s_suppkey / 3) AS BIGINT)) AS uses FROM supplier WHERE s_suppkey >= 3"
_HEALTH = "SELECT 'db' AS object_schema, concat('v', s_suppkey) AS object_name, 'VIEW' AS object_type, CASE WHEN s_suppkey % 7 = 0 THEN 'INVALID' ELSE 'VALID' END AS status, '' AS details FROM supplier"
_HEALTH_AFTER = _HEALTH.replace("s_suppkey % 7 = 0", "s_suppkey % 7 = 0 OR s_suppkey % 5 = 0")


@query(f"""WITH RECURSIVE e AS (SELECT lower(object) AS object, lower(uses) AS uses FROM ({_USES})), c AS (SELECT object, uses, 1 AS depth FROM e UNION ALL SELECT c.object, e.uses, depth + 1 FROM c JOIN e ON c.uses = e.object),
    b AS (SELECT concat(object_schema, '.', object_name) AS object FROM ({_HEALTH_AFTER}) WHERE status = 'INVALID' EXCEPT SELECT concat(object_schema, '.', object_name) FROM ({_HEALTH}) WHERE status = 'INVALID')
    SELECT object, uses AS table_name, min(depth) AS depth FROM c JOIN b USING (object) WHERE uses IN ('db.v1', 'db.v2') GROUP BY 1, 2""")
def dependents_newly_broken(spark, sf):
    """Views on views, two of which were loaded: those that are broken now and were not before, with their distance."""
    loaded = derived(spark, sf, "SELECT concat('db.v', s_suppkey) AS table_name FROM supplier WHERE s_suppkey IN (1, 2)")
    return objects.newly_broken(derived(spark, sf, _HEALTH), derived(spark, sf, _HEALTH_AFTER), derived(spark, sf, _USES), loaded).select("object", "table_name", "depth")


@query(f"""WITH t AS ({_WANTED}), s AS (SELECT upper(name) AS name, source_last FROM ({_DRAWN})), m AS (SELECT t.*, s.name, s.source_last, s.name = upper(target_sequence) AS equal FROM t JOIN s ON s.name = upper(target_sequence) OR contains(s.name, upper(table_name))),
    h AS (SELECT table_name, target_sequence, max(CASE WHEN equal THEN source_last END) AS e, min(source_last) AS l, count(*) AS n FROM m GROUP BY 1, 2),
    o AS (SELECT concat('tab', l_suppkey) AS table_name, max(l_orderkey) AS top FROM lineitem GROUP BY 1),
    r AS (SELECT t.table_name, target_sequence, coalesce(e, CASE WHEN n = 1 THEN l END) AS source_last, top FROM t LEFT JOIN h USING (table_name, target_sequence) LEFT JOIN o USING (table_name))
    SELECT table_name, target_sequence, CASE WHEN source_last IS NULL THEN NULL ELSE greatest(source_last, 11, top + 1) END AS set_to, CASE WHEN source_last IS NULL THEN 'SKIPPED' WHEN 11 < greatest(source_last, 11, top + 1) THEN 'NEEDS_SET' WHEN 11 > coalesce(top, source_last) THEN 'TARGET_AHEAD' ELSE 'ALIGNED' END AS compare_status FROM r""")
def sequence_scan_planned(spark, sf):
    """Sequences of both sides matched by name, with the largest keys of the tables they belong to, and what each has to be set to."""
    target = derived(spark, sf, _WANTED).withColumns({"target_last": F.lit(10).cast("long"), "target_is_called": F.lit(True), "increment": F.lit(1).cast("long"), "max_value": F.lit(2**62)})
    top = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("tab"), F.col("l_suppkey").cast("string")).alias("table_name")).agg(F.max("l_orderkey").cast("long").alias("source_table_max"))
    planned = sequences.planned(sequences.scanned(target, derived(spark, sf, _DRAWN), top.withColumn("target_table_max", F.lit(None).cast("long"))))
    return planned.select("table_name", "target_sequence", F.when(F.col("compare_status") != "SKIPPED", F.col("set_to")).alias("set_to"), "compare_status")


@query("SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def ordered_text_aggregate(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("nations"))


@query("SELECT r_name, count(n_nationkey) AS nations, EXISTS (SELECT 1 FROM customer WHERE c_nationkey = min(n_nationkey)) AS has_customers FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def catalog_style_joins(spark, sf):
    _views(spark, sf, "nation", "region", "customer")
    first = spark.sql("SELECT r_name, count(n_nationkey) AS nations, min(n_nationkey) AS k FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
    used = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct().withColumn("u", F.lit(True))
    return first.join(used, "k", "left").select("r_name", "nations", F.coalesce("u", F.lit(False)).alias("has_customers"))


@query("SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,6)) AS value FROM events")
def stream_upsert_available_now(spark, sf):
    """Two folders of files arrive one after the other, with a fifth of the events in both; the table ends with all rows, once each."""
    place = _place(spark, "stream")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("value").cast("decimal(18,6)").alias("value"))
    target = versions.VersionedTable(spark, f"{place}/table")
    for part in (F.col("event_id") % 10 < 6, F.col("event_id") % 10 >= 4):
        e.where(part).write.mode("append").parquet(f"{place}/in")
        upsert_stream.upsert_available(spark, f"{place}/in", e.schema, target, ["event_id"], [F.col("user_id")], f"{place}/checkpoint")
    return target.read()


@query("SELECT event_id, user_id, event_type FROM events")
def stream_two_checkpoints(spark, sf):
    """Two streams with checkpoints of their own, whose batches have the same numbers, feed one table."""
    place = _place(spark, "streams")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    target = versions.VersionedTable(spark, f"{place}/table")
    for i, part in enumerate((F.col("event_id") % 10 < 6, F.col("event_id") % 10 >= 4)):
        e.where(part).write.parquet(f"{place}/in{i}")
        upsert_stream.upsert_available(spark, f"{place}/in{i}", e.schema, target, ["event_id"], [F.col("user_id")], f"{place}/checkpoint{i}")
    return target.read()
