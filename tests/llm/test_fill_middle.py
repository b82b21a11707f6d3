"""Fill in the middle, against a plain version on odd texts."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordat.llm import fill_middle as fm

DOCS = "doc_id long, text string, n long, _text string, _fim string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", None, " ", "\n \t", "a", " a ", "a b c  d\n", "\x01\x02 \x02d\x01\x01 \x02e x\x02", "<P> in it", "a<S", "<S <M <P", "x" * 5000 + " y", "😀 é　ü z\x0b", "$1 \\1 $", "\x00 a\x00"]


def plain(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    n = len(units)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, lo), (lo, hi), (hi, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, None, text
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


def held(spark, data, **options):
    df = spark.createDataFrame([(i, t, 7, "kept", "gone") for i, t in data], DOCS)
    out = fm.fill_in_middle(df, **options)
    assert out.columns == df.columns
    got = out.select("doc_id", "n", "_text", "_fim.*", fm.restored(F.col("_fim.output"), F.col("_fim.form")).alias("back")).toDF("doc_id", "own", "_text", "n", "form", "prefix", "middle", "suffix", "output", "back").collect()
    want = [plain(i, t, **{"rate": options.get("rate", 50), "spm": options.get("spm_rate", 80)}) for i, t in data]
    assert [(r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in got] == want
    assert all(r.back == (t or "") and (r.own, r._text) == (7, "kept") for r, (_, t) in zip(got, data, strict=True))
    return got


def test_odd_texts(spark):
    data = [(17 * i + j, t) for j in range(17) for i, t in enumerate(ODD)] + [(None, "a b c d"), (5, "one two"), (5, "one two"), (5, "three")]
    assert {r.form for r in held(spark, data)} == {"plain", "spm", "psm"}
    assert {r.form for r in held(spark, [(i, "a b c") for i in range(40)], rate=100, spm_rate=0)} == {"psm"}


def test_long_text_and_empty_table(spark):
    held(spark, [(i, "word, \n" * 300_000 + " " * 100_000) for i in range(3)], rate=100)
    assert fm.digests(fm.fill_in_middle(spark.createDataFrame([], DOCS))).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\x01\x02de<>PSMé\U0001f600", max_size=40), min_size=60, max_size=60))
def test_any_text(spark, texts):
    held(spark, list(enumerate(texts)))


def test_no_shuffle_and_no_python(spark):
    plan = fm.digests(fm.fill_in_middle(spark.createDataFrame([(1, "a b", 0, "", "")], DOCS)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
