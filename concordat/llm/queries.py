"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import conversation, fill_middle, html_text, lines, mixing, near_dedup, near_vectors, nearest, packing, quality, repeats, sharding, warc
from concordat.llm.common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: forty leaves of a k-d tree over the documents' metadata."""
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarters of the corpus's tokens, no document more than twice."""
    levels, weights = mixing.document_tree()
    return mixing.mix(table(spark, sf_dir, "documents"), levels, weights, share=0.75, max_epochs=2)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), place)
    return warc.page_digests(warc.read_archives(spark, place))


def op7_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source as host, language as path."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.report(*conversation.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_onebit": op1_onebit,
    "op2_kdtree": op2_kdtree,
    "op3_html": op3_html,
    "op4_mix": op4_mix,
    "op5_lines": op5_lines,
    "op6_warc": op6_warc,
    "op7_bottomk": op7_bottomk,
    "op8_pack": op8_pack,
    "op9_crosspolytope": op9_crosspolytope,
    "op10_quality": op10_quality,
    "op11_repeats": op11_repeats,
    "op12_fim": op12_fim,
    "op13_repair": op13_repair,
}

SQL: dict[str, str] = {
    "op1_onebit": """
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score
              FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
    "op4_mix": """
        WITH d AS MATERIALIZED (
            SELECT doc_id, regexp_extract(coalesce(source, ''), '^([^0-9]*[0-9]?)', 1) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) AS tokens FROM documents),
        leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
        -- a level: children by cap / weight; the level is that of the first child whose cap is above its fair part
        a AS (SELECT domain, CAST(1 AS BIGINT) AS weight, CAST(sum(tokens) * 2 AS BIGINT) AS cap FROM leaf GROUP BY ALL),
        a1 AS (SELECT *, (SELECT sum(tokens) FROM leaf) * CAST(0.75 AS DOUBLE) AS b, coalesce(sum(cap) OVER (ORDER BY cap / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
                      sum(weight) OVER (ORDER BY cap / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM a),
        a2 AS (SELECT *, CASE WHEN cap <= weight * ((b - c) / w) THEN NULL ELSE (b - c) / w END AS v FROM a1),
        a3 AS (SELECT *, first_value(v IGNORE NULLS) OVER (ORDER BY cap / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM a2),
        a4 AS (SELECT domain, CASE WHEN lv IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), weight * lv) END AS b FROM a3),
        e AS (SELECT domain, lang, CAST(CASE WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'fr', 'es') THEN 2 ELSE 1 END AS BIGINT) AS weight, CAST(sum(tokens) * 2 AS BIGINT) AS cap FROM leaf GROUP BY domain, lang),
        e1 AS (SELECT e.*, b, coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
                      sum(weight) OVER (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM e JOIN a4 USING (domain)),
        e2 AS (SELECT *, CASE WHEN cap <= weight * ((b - c) / w) THEN NULL ELSE (b - c) / w END AS v FROM e1),
        e3 AS (SELECT *, first_value(v IGNORE NULLS) OVER (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM e2),
        e4 AS (SELECT domain, lang, CASE WHEN lv IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), weight * lv) END AS b FROM e3),
        f AS (SELECT domain, lang, source, CAST(1 AS BIGINT) AS weight, CAST(sum(tokens) * 2 AS BIGINT) AS cap FROM leaf GROUP BY ALL),
        f1 AS (SELECT f.*, b, coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
                      sum(weight) OVER (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM f JOIN e4 USING (domain, lang)),
        f2 AS (SELECT *, CASE WHEN cap <= weight * ((b - c) / w) THEN NULL ELSE (b - c) / w END AS v FROM f1),
        f3 AS (SELECT *, first_value(v IGNORE NULLS) OVER (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM f2),
        f4 AS (SELECT domain, lang, source, CASE WHEN lv IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), weight * lv) END AS target, cap / 2 AS held FROM f3),
        g AS (SELECT *, CASE WHEN held > 0 THEN CAST(floor(target / held) AS INTEGER) ELSE 0 END AS whole FROM f4),
        k AS (SELECT d.*, target, whole, target - whole * held AS rest, md5(concat_ws('|', '17', CAST(whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS key FROM d JOIN g USING (domain, lang, source)),
        r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k),
        x AS (SELECT *, unnest(range(0, CASE WHEN upto <= rest THEN whole + 1 ELSE whole END)) AS epoch FROM r)
        SELECT doc_id, domain, lang, source, tokens, CAST(epoch AS INTEGER) AS epoch, target AS leaf_target FROM x WHERE epoch < 2
    """,
    "op5_lines": r"""
        WITH l AS MATERIALIZED (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
        t AS MATERIALIZED (SELECT doc_id, line_no, trim(regexp_replace(translate(raw, chr(9) || chr(11) || chr(12) || chr(13) || chr(160) || chr(12288), '      '), ' +', ' ', 'g')) AS line
                           FROM l WHERE doc_id IS NOT NULL AND line <> ''),
        f AS MATERIALIZED (SELECT line, min((doc_id, line_no)) AS first FROM t GROUP BY 1),
        w AS MATERIALIZED (SELECT line, first, string_split(line, ' ') AS w FROM f WHERE len(string_split(line, ' ')) >= 8),
        v AS MATERIALIZED (SELECT line, first, unnest(list_transform(range(0, len(w)), lambda i: {'i': i, 'v': array_to_string(w[1:i] || w[i + 2:], ' ')})) AS x FROM w),
        p AS (SELECT x.v AS v, x.i AS i, min(first) AS m FROM v GROUP BY 1, 2),
        near AS (
            SELECT line FROM v JOIN p ON p.v = x.v AND p.i = x.i WHERE m < first
            UNION SELECT v.line FROM v JOIN w ON w.line = v.x.v WHERE w.first < v.first
            UNION SELECT w.line FROM w JOIN v ON w.line = v.x.v WHERE v.first < w.first),
        gone AS (SELECT DISTINCT doc_id, line_no FROM t JOIN f USING (line) WHERE (doc_id, line_no) <> first OR line IN (SELECT line FROM near)),
        kept AS (SELECT l.doc_id AS doc_id, string_agg(raw, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL) AS text, count(*) AS n, count(g.line_no) AS dropped
                 FROM l LEFT JOIN gone AS g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY 1)
        SELECT d.doc_id, CASE WHEN coalesce(dropped, 0) = 0 THEN d.text ELSE coalesce(kept.text, '') END AS text, coalesce(n, 0) AS n_lines, coalesce(dropped, 0) AS n_dropped
        FROM documents AS d LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM m
    """,
    "op7_bottomk": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS MATERIALIZED (SELECT x, y FROM p JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * m >= 75 * (a.n + b.n - m)),
        e AS MATERIALIZED (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, d.doc_id = coalesce(c.c, d.doc_id) AS kept
        FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT node, min(seen) AS c FROM r GROUP BY 1) AS c ON c.node = d.doc_id
    """,
    "op9_crosspolytope": """
        WITH RECURSIVE v AS MATERIALIZED (
            SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.98),
        r AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
        SELECT m.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.c, m.vec_id) AS component_id, m.vec_id = coalesce(c.c, m.vec_id) AS kept
        FROM embeddings AS m LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY 1) AS k ON k.a = m.vec_id
        LEFT JOIN (SELECT node, min(seen) AS c FROM r GROUP BY 1) AS c ON c.node = m.vec_id
    """,
    "op12_fim": r"""
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                     CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM h),
        c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (SELECT doc_id, t, n, form, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
        FROM p
    """,
    "op13_repair": r"""
        WITH RECURSIVE k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, b:
                         list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END))) % 20 AS harm FROM k),
        d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE harm > 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
        f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                     NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
        t AS MATERIALIZED (SELECT conv_id, i, turn, role, text, role[1:1] AS x, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND open AS truncated,
                     before || role[1:1] NOT IN ('su', 'ua', 'au') AS illegal FROM f),
        g AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
                     count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM t GROUP BY 1),
        -- the cheapest (cost, audit) that ends with nothing (z), a system (s), user (u) or assistant (a) message; a message may be inserted after each
        p AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'e': ''} AS z, {'c': CAST(1000000000 AS BIGINT), 'e': ''} AS s, {'c': CAST(2 AS BIGINT), 'e': 'I'} AS u, {'c': CAST(4 AS BIGINT), 'e': 'II'} AS a FROM g
              UNION ALL
              SELECT conv_id, i, z, s, least(u, {'c': z.c + 2, 'e': z.e || 'I'}, {'c': s.c + 2, 'e': s.e || 'I'}, {'c': a.c + 2, 'e': a.e || 'I'}),
                     least(a, {'c': u.c + 2, 'e': u.e || 'I'}, {'c': z.c + 4, 'e': z.e || 'II'}, {'c': s.c + 4, 'e': s.e || 'II'})
              FROM (SELECT p.conv_id, t.i, {'c': z.c + 3, 'e': z.e || 'D'} AS z,
                           CASE WHEN go OR x <> 's' THEN {'c': s.c + 3, 'e': s.e || 'D'} ELSE least({'c': s.c + 3, 'e': s.e || 'D'}, {'c': z.c + m, 'e': z.e || 'K'}) END AS s,
                           CASE WHEN go THEN {'c': u.c + 3, 'e': u.e || 'D'} ELSE least({'c': u.c + 3, 'e': u.e || 'D'}, {'c': z.c + m + ru, 'e': z.e || eu}, {'c': s.c + m + ru, 'e': s.e || eu}, {'c': a.c + m + ru, 'e': a.e || eu}) END AS u,
                           CASE WHEN go THEN {'c': a.c + 3, 'e': a.e || 'D'} ELSE least({'c': a.c + 3, 'e': a.e || 'D'}, {'c': u.c + m + ra, 'e': u.e || ea}) END AS a
                    FROM p JOIN (SELECT conv_id, i, x, blank OR duplicate AS go, CAST(truncated AS BIGINT) AS m, CASE x WHEN 'u' THEN 0 ELSE 2 END AS ru, CASE x WHEN 'u' THEN 'K' ELSE 'R' END AS eu,
                                        CASE x WHEN 'a' THEN 0 ELSE 2 END AS ra, CASE x WHEN 'a' THEN 'K' ELSE 'R' END AS ea FROM t) AS t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1)),
        b AS MATERIALIZED (SELECT p.conv_id, least(z, a).c AS cost, least(z, a).e AS audit FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.i = g.n),
        l AS (SELECT conv_id, audit, generate_subscripts(string_split(audit, ''), 1) AS j, unnest(string_split(audit, '')) AS e FROM b WHERE audit <> ''),
        w AS (SELECT *, sum(CAST(e <> 'I' AS INT)) OVER q AS i, sum(CAST(e <> 'D' AS INT)) OVER q AS pos, sum(CAST(e <> 'D' AS INT)) OVER (PARTITION BY conv_id) AS len FROM l WINDOW q AS (PARTITION BY conv_id ORDER BY j)),
        r AS (SELECT w.conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (pos + len) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS sha
              FROM w LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i WHERE e <> 'D' GROUP BY 1)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
}
