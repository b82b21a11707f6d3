"""The subpackage's queries against their SQL, and the pipeline, over whole small tables."""

import duckdb
import pytest

from concordat.llm import packing
from concordat.llm.queries import QUERIES, SQL

RANKS = [pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")]

TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tiny, name):
    df = QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert ours
    if name in SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
        assert sorted(con.sql(SQL[name]).columns) == columns
        theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
        assert ours == sorted(map(repr, theirs))


def test_pipeline_stage_by_stage(spark, tiny):
    import corpus_pipeline as P
    from concordat.llm.common import cut

    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near", "mix", "pack"]
    first = docs = spark.read.parquet(f"{tiny}/documents.parquet")
    before = docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = cut(stage(spark, docs, tiny), name)
        assert docs.dtypes == first.dtypes
        after = docs.count()
        assert 0 < after <= before and docs.select("doc_id").distinct().count() == after
        before = after
    packed = P.STAGES[-1][1](spark, docs, tiny).collect()
    assert {d for r in packed for d in r.doc_ids} == {r[0] for r in docs.select("doc_id").collect()}
    encode = packing._encode(*packing.vocabulary(RANKS[0]))
    want = sorted(i for r in docs.collect() for i in [*encode([r.text or ""])[0], 2])
    assert sorted(i for r in packed for i in r.ids) == want and all(0 < len(r.ids) <= 1024 for r in packed)
    empty = first.limit(0)
    for name, stage in P.STAGES:
        empty = cut(stage(spark, empty, tiny), name)
        assert empty.count() == 0


def test_pipeline_against_plain_stages(spark, tiny, tmp_path):
    """Each stage's rows against a version in SQL over the rows that the stage before it has kept; packing against the ids of all texts in order."""
    import corpus_pipeline as P

    def sql(text, folder):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/*.parquet'")
        return con.sql(text)

    folders, docs = {}, spark.read.parquet(f"{tiny}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, tiny).write.parquet(f"{tmp_path}/{name}")
        folders[name] = f"{tmp_path}/{name}"
        docs = spark.read.parquet(folders[name])
    texts = lambda name: {r.doc_id: r.text for r in spark.read.parquet(folders[name]).collect()}
    lines = sql(f"SELECT doc_id, text FROM ({SQL['op5_lines']}) WHERE n_dropped = 0 OR regexp_matches(text, '\\S')", folders["quality"]).fetchall()
    assert texts("lines") == dict(lines)
    kept = sql(f"SELECT doc_id FROM ({SQL['op7_bottomk']}) WHERE kept", folders["lines"]).fetchall()
    assert set(texts("near")) == {d for (d,) in kept} and texts("near").items() <= texts("lines").items()
    mix = SQL["op4_mix"].replace("CAST(0.75 AS DOUBLE)", "CAST(0.9 AS DOUBLE)").replace("CAST(sum(tokens) * 2 AS BIGINT)", "CAST(sum(tokens) AS BIGINT)").replace("cap / 2 AS held", "cap AS held").replace("epoch < 2", "epoch < 1")
    assert set(texts("mix")) == {d for (d,) in sql(f"SELECT DISTINCT doc_id FROM ({mix})", folders["near"]).fetchall()} and texts("mix").items() <= texts("near").items()
    encode = packing._encode(*packing.vocabulary(RANKS[0]))
    want = {d: [*encode([t or ""])[0], 2] for d, t in texts("mix").items()}
    got: dict[int, dict[int, list[int]]] = {}
    for r in P.STAGES[-1][1](spark, docs, tiny).collect():
        ends = [*r.offsets[1:], len(r.ids)]
        for d, piece, lo, hi in zip(r.doc_ids, r.pieces, r.offsets, ends, strict=True):
            got.setdefault(d, {})[piece] = r.ids[lo:hi]
    assert {d: [i for k in sorted(p) for i in p[k]] for d, p in got.items()} == want
