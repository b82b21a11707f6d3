"""The ten operators against plain versions on small inputs, odd rows included."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concordat.llm import html_text, lines, mixing, near_dedup, near_vectors, nearest, packing, quality, sharding, shingles, vectors, warc
from concordat.llm.common import components, cut, gapless_rank, sieve, sifted, spread_join
from tests.conftest import DATA, rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, *texts, ids=None, source="src0", lang="en"):
    data = [(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(data, DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


# ---- common


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def test_components_end_at_stars(spark, monkeypatch):
    from concordat.llm import common

    written, whole = [], common.cut
    monkeypatch.setattr(common, "cut", lambda df, name, free=False: written.append((name, free)) or whole(df, name, free))
    stars = [(a, hub) for hub in (1, 2, 3) for a in range(10 * hub, 10 * hub + 9)]
    got = dict(rows(components(spark.createDataFrame(stars, "a long, b long"))))
    assert got == {x: hub for a, hub in stars for x in (a, hub)}
    assert written == [("edges", True)]  # no round where nothing is left to do, and nothing of it held by the driver
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(x, x - 1) for x in range(401, 440)] + [(440, x) for x in range(450, 470)]
    low = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(low)):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert dict(rows(components(spark.createDataFrame(edges, "a long, b long")))) == low


def test_gapless_rank_of_a_hot_group(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") < 2500, 0).otherwise(F.col("id") % 7 + 1))
    got = gapless_rank(cut(df, "t"), "g", [F.col("id")], 3000, F.col("id"))
    for r in got.groupBy("g").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.count_distinct("rank").alias("d")).collect():
        assert (r.lo, r.hi, r.d) == (0, r.n - 1, r.n)


def test_sieve_loses_nothing(spark):
    keys = spark.range(0, 1000, 3).select(F.xxhash64("id").alias("h"))
    got = sifted(spark.range(1000), F.xxhash64("id"), sieve(keys, 334))
    assert got.where("id % 3 = 0 AND NOT _likely").count() == 0 and got.where("_likely").count() < 400
    assert sifted(spark.range(5), F.xxhash64("id"), sieve(keys.limit(0), 0)).where("_likely").count() == 0
    assert sifted(spark.range(5), F.xxhash64("id"), sieve(keys, 10**9)).where("_likely").count() == 5


def test_spread_join(spark):
    left, right = spark.range(200).select((F.col("id") % 3).alias("k"), "id"), spark.range(2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    assert rows(spread_join(left, right, ["k"], F.col("id"), 4), "id", "x") == [(i, i % 3 * 10) for i in range(200) if i % 3 < 2]


# ---- 1


def test_nearest_against_all_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 24))
    x[50:80] = x[50]  # ties
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(600, None), (601, []), (602, [0.0] * 24), (603, [math.nan] * 24), (604, [None] + [1.0] * 23), (605, [1.0] * 5), (None, [1.0] * 24), (606, [math.inf] * 24)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = {}
    for q, rank, v, s in rows(nearest.search(df, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score"):
        got.setdefault(q, []).append((rank, v, s))
    for q in range(0, 600, 20):
        scores = vectors.inner(x, np.broadcast_to(x[q], x.shape))
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert all(s == scores[v] for _, v, s in got[q])
        assert got[q] == sorted(got[q], key=lambda r: (-r[2], r[1]))
        assert [(v, s) for _, v, s in got[q]] == [(i, -s) for s, i in want]
    assert set(got) == set(range(0, 600, 20))
    assert rows(nearest.search(df.limit(0), F.col("vec_id") % 20 == 0)) == []
    assert len(rows(nearest.search(df.where("vec_id < 4"), F.col("vec_id") == 0))) == 3


def test_nearest_of_repeated_ids(spark):
    """A row that repeats a vec_id is a query and a candidate of its own."""
    data = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 0.5])]
    got = rows(nearest.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=2), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 1.0), (0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 2, 2, 0.5)]


def test_one_bit_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(2000, 64)), rng.normal(size=(20, 64))
    bits, norm, fit = nearest.one_bit(x)
    assert bits.nbytes == 2000 * 8 * nearest.SPREAD
    both = [e for e in nearest._each(q, nearest.Codes(bits, norm, fit), 3.0)]
    estimate, half = (np.array([b[i] for b in both]) for i in (0, 1))
    apart = np.abs(estimate - q @ x.T)
    assert (apart <= half).mean() > 0.99 and (apart <= half / 3).mean() < 0.8
    # the estimate by population counts is that of the sign vectors themselves, up to the rounding of the queries
    signs = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").astype(float) * 2 - 1
    plain = nearest._wide(q, nearest.SEED) @ signs.T * (norm / (fit * np.sqrt(signs.shape[1])))
    assert np.abs(estimate - plain).max() < 0.5 * half.max()


# ---- 2


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(900)] + ["same words here"] * 450 + [None, "", "é" * 50]
    df = docs(spark, *texts).withColumn("shard", F.lit("clash"))
    got = sharding.kd_shards(df, shards=10).collect()
    assert len(got) == len(texts)
    sizes, slots = {}, {}
    for r in got:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, set()).add(r.slot)
    assert sorted(sizes) == list(range(10)) and max(sizes.values()) < 1.1 * min(sizes.values())
    assert all(s == set(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(texts)


def test_shards_of_little(spark):
    assert rows(sharding.kd_shards(docs(spark), shards=4)) == []
    assert len(rows(sharding.kd_shards(docs(spark, "a", "b"), shards=4))) == 2
    one = sharding.kd_shards(docs(spark, *["x" * 84] * 40), target_bytes=1000)
    assert {r["shard"] for r in one.collect()} == {0, 1, 2, 3}
    null = spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS)
    assert len(rows(sharding.kd_shards(null, shards=2))) == 3


def test_shards_are_written_with_every_row_once(spark, tmp_path):
    df = docs(spark, *(f"text {i % 7} " * (i % 50) for i in range(300)))
    df = df.unionByName(df.where("doc_id < 30")).unionByName(df.where("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("Shard", F.lit("mine")).withColumn("row", F.col("text"))
    assert sharding.write_shards(df, str(tmp_path / "out"), shards=6) == "_shard"
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    sizes = [r[1] for r in back.groupBy("_shard").agg(F.sum(F.octet_length("text") + 16)).orderBy("_shard").collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * min(sizes)
    assert sharding.write_shards(df.limit(0).drop("Shard"), str(tmp_path / "none"), shards=6) == "shard"


# ---- 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>One<p>Two <b>bold</b>\n text<br>next", "One\n\nTwo bold\ntext\nnext".replace("bold\ntext", "bold text")),
        ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d</ol></ul>", "- a\n- b\n  3. c\n  9. d"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple<td>1<tr><td colspan=2>wide</table>", "Name  | Qty\napple | 1\nwide"),
        ("<table><tr><td rowspan=2>two<td>x<tr><td>z</table>", "two | x\n    | z"),
        ("<head><title>t</title></head><body>b<script>s</p></script><style>p{}</style><!-- c --><noscript>n</noscript>", "b"),
        ("<div style='color:red; DISPLAY : none'>x</div><p hidden>y<p>z", "z"),
        ("<pre>\n a  b\n\n  c</pre>", " a  b\n\n  c"),
        ("a &amp; b&nbsp;&copy;", "a & b\xa0©"),
        ("<dl><dt>T<dd>D</dl>", "T\n    D"),
        ("<details><summary>S</summary>no</details><details open><summary>S</summary>yes</details>", "S\nS\nyes"),
        ("<p title=it's ok>text 'quoted'</p><img alt='a>b'>c", "text 'quoted'\n\nc"),
        ("<select><option>a<option selected>b</select><textarea>t</textarea><input type=hidden value=h><input type=submit value=Go>", "b t Go"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<b>x</i></b></p>y", "x\n\ny"),
        ("日本<table><tr><td>日本<td>1<tr><td>a<td>2</table>", "日本\n\n日本 | 1\na    | 2"),
        ("<style>.x, p#y {display : none} @media print{.z{display:none}}</style><p class='w x'>hid<p id=y>hid<p class=z>shown", "shown"),
        ("<style>p{display:none}.k{display:block}div p{display:none}</style><p>hid<p class=k>shown", "shown"),
        ("<style>.a{visibility:hidden!important}</style><div class=a style='visibility:visible'>a<b style='visibility:visible'>b</b><i>c</i></div>", "b"),
        ("<div style='visibility:hidden'><p>x</p></div>y<div hidden style='display:block'>z</div>", "y\nz"),
        ("<svg><title>t</title><desc>d</desc><text>label</text></svg> <math><mi>x</mi><annotation>n</annotation></math><map name=m>m<area></map>", "label xm"),
        ("<table><tr>" + "<td colspan=1000>a" * 3 + "<tr><td>b</table>", "a | a | a\nb |   |"),
        ("<table><tr><td rowspan=3>a<td>b<tr><td rowspan=2 colspan=2>c<tr><td>d</table>", "a | b |\n  | c |\n  |   | d"),
        ("<table><tr><td colspan=4>only</table>", "only"),
    ],
)
def test_rendering(page, text):
    assert html_text.page_text(page) == text


def plain_words(page):
    """Visible words in order by the standard library's parser: names of elements that are never shown, the hidden attribute and inline
    display:none, over a stack that ends with the outermost element closed."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.found = [], []

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            if tag not in html_text.VOID:
                gone = tag in html_text.HIDDEN or "hidden" in a or "display:none" in (a.get("style") or "").replace(" ", "").lower()
                self.open.append((tag, gone))

        def handle_endtag(self, tag):
            names = [t for t, _ in self.open]
            if tag in names:
                del self.open[len(names) - 1 - names[::-1].index(tag) :]

        def handle_data(self, data):
            if not any(g for _, g in self.open):
                self.found += data.split()

    reader = Reader()
    reader.feed(page)
    reader.close()
    return reader.found


def test_rendering_against_a_plain_reader(tiny):
    """Built pages of every block: all visible words come out, in order, and no hidden one. Pages of the table: the same words."""
    rng = random.Random(12)
    at = iter(range(10**6))

    def part(depth):
        kind = rng.choice(["text", "p", "div", "ul", "table", "hidden", "style", "span", "pre", "dl"]) if depth else "text"
        word = lambda: f"w{next(at)}"
        inner = lambda n=3: "".join(part(depth - 1) for _ in range(rng.randint(1, n)))
        return {
            "text": lambda: f" {word()} {word()} ",
            "ul": lambda: "<ul>" + "".join(f"<li>{inner(2)}</li>" for _ in range(3)) + "</ul>",
            "table": lambda: "<table>" + "".join("<tr>" + "".join(f"<td>{word()}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>",
            "hidden": lambda: f"<div {rng.choice(['hidden', 'style=display:none'])}>{inner()}</div>",
            "style": lambda: f"<style>.q{next(at)}{{color:red}}</style>",
            "dl": lambda: f"<dl><dt>{word()}</dt><dd>{inner(2)}</dd></dl>",
        }.get(kind, lambda: f"<{kind}>{inner() if kind != 'p' else word()}</{kind}>")()

    for _ in range(150):
        page = "".join(part(3) for _ in range(6))
        got = [w for w in html_text.page_text(page).split() if w.startswith("w")]
        assert got == plain_words(page)
    import pyarrow.parquet as pq

    for page in pq.read_table(f"{tiny}/pages.parquet").column("html").to_pylist():
        got = re.findall(r"\w{4,}", html_text.page_text(page))
        want = re.findall(r"\w{4,}", " ".join(plain_words(page)))
        assert sorted(got) == sorted(want)


def test_rendering_keeps_every_visible_word(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    import html

    for r in pages.collect():
        bare = re.sub(r"(?is)<head.*?</head>|<(script|style|noscript)\b.*?</\1>|<!--.*?-->", " ", r.html)
        want = html.unescape(re.sub(r"<[^>]*>", " ", bare)).split()
        have = got[r.page_id].split()
        assert len(have) >= len([w for w in want if w.isalnum()]) * 0.95 and set(w for w in want if w.isalpha() and len(w) > 3) <= set(re.split(r"[\s|]+", got[r.page_id])) | set("".join(have))


@pytest.mark.parametrize("evil", ["<" * 50_000, "<a href='" * 20_000, "<table><tr><td>" * 2000, "<!--" * 20_000, "<td colspan=1000>" * 2000, "<b " * 30_000, '<a ="' * 9_001])
def test_rendering_ends(evil):
    assert isinstance(html_text.page_text(evil), str)


@pytest.mark.parametrize("tag", ["div", "span", "font", "section", "b", "p", "blink", "q", "button", "svg", "x-y"])
def test_any_depth(tag):
    hidden = '<script>var secret=1;</script><style>p{}</style><p style="display:none">gone</p><div hidden><b>gone</b></div>'
    for depth in (1, 399, 450, 5000):
        got = html_text.page_text(f"<{tag}>" * depth + hidden + "seen<br>more" + f"</{tag}>" * depth + "<p>after")
        assert "gone" not in got and "secret" not in got and got.split("\n")[-1] == "after", (tag, depth)
        assert got.replace('"', "").split("\n")[:2] == ["seen", "more"], (tag, depth)


def test_depth_of_lists_tables_and_quotes():
    for tag, inner in (("ul", "li"), ("blockquote", "div"), ("table", "td"), ("ol", "li")):
        got = html_text.page_text(f"<{tag}><{inner}>" * 700 + "<script>no</script>seen" + f"</{inner}></{tag}>" * 700)
        assert got.strip().endswith("seen") and "no" not in got and got.count("seen") == 1
    many = html_text.page_text("<div>" * 100_000 + "deep" + "</div>" * 60_000 + "<p>end")
    assert many == "deep\n\nend"
    assert html_text.page_text("<p>" + "<i>" * 50_000 + "a" + "<p>b" * 50_000).count("b") == 50_000


def test_cdata_is_a_comment_outside_of_drawings():
    assert html_text.page_text("a <![CDATA[ b ]]> c") == "a c"
    assert html_text.page_text("a <![CDATA[ b > c ]]> d") == "a c ]]> d"
    assert html_text.page_text("<svg><text><![CDATA[a < b > c]]></text></svg> d <![CDATA[e]]>f") == "a < b > c d f"
    assert html_text.page_text("<svg><foreignObject>a<![CDATA[b]]>c</foreignObject><text><![CDATA[d]]></text></svg>") == "acd"
    assert html_text.page_text("a <![CDATA[ b") == "a"


# ---- 4


def leaf_budgets(tree, weights, budget):
    """Plain water-filling: tree is {child: subtree or cap}; weights by path."""

    def cap(t):
        return sum(map(cap, t.values())) if isinstance(t, dict) else t

    def share(t, path, b):
        if not isinstance(t, dict):
            return {path: b}
        left, open_, got = b, dict(t), {}
        while open_:
            w = sum(weights[(*path, c)] for c in open_)
            full = [c for c in open_ if cap(open_[c]) <= left * weights[(*path, c)] / w + 1e-9]
            if not full:
                got |= {c: left * weights[(*path, c)] / w for c in open_}
                break
            for c in full:
                got[c] = cap(open_.pop(c))
            left = b - sum(got.values())
        out = {}
        for c, x in got.items():
            out |= share(t[c], (*path, c), x)
        return out

    return share(tree, (), budget)


def test_mixing_meets_water_filling(spark):
    rng, data, tree = random.Random(2), [], {}
    for d in "AB":
        for lang in ("en", "xx"):
            for s in range(3):
                n = rng.randint(1, 30)
                texts = ["w" * rng.randint(1, 80) for _ in range(n)]
                data += [(len(data) + i, t, lang, f"{d}{s}", None) for i, t in enumerate(texts)]
                tree.setdefault(d, {}).setdefault(lang, {})[f"{d}{s}"] = 2 * sum(-(-len(t) // 4) for t in texts)
    data += [(5000, None, "en", "A0", None), (5001, "", None, None, None)]
    df = spark.createDataFrame(data, DOCS).withColumn("epoch", F.lit("clash"))
    levels = {"domain": F.substring("source", 1, 1), "lang": F.col("lang"), "source": F.col("source")}
    weights = {"domain": F.lit(1), "lang": F.when(F.col("lang") == "en", 3).otherwise(1), "source": F.lit(1)}
    got = mixing.mix(df, levels, weights, 0.8, 2).collect()
    total = sum(-(-len(t or "") // 4) for _, t, *_ in data)
    plain = {(): 1} | {(d,): 1 for d in tree} | {(d, lang): 3 if lang == "en" else 1 for d in tree for lang in tree[d]} | {(d, lang, s): 1 for d in tree for lang in tree[d] for s in tree[d][lang]}
    want = leaf_budgets(tree, plain, total * 0.8)
    taken, most = {}, {}
    for r in got:
        if r.domain:
            key = (r.domain, r.lang, r.source)
            assert r.leaf_target == pytest.approx(want[key])
            taken[key] = taken.get(key, 0) + r.tokens
            most[key] = max(most.get(key, 0), r.tokens)
    for key, n in taken.items():
        assert n <= want[key] + 1e-6 and n > want[key] - 25
    pairs = [(r.doc_id, r.epoch) for r in got]
    assert len(pairs) == len(set(pairs)) and {e for _, e in pairs} <= {0, 1}
    assert all((d, 0) in set(pairs) for d, e in pairs if e == 1)
    assert rows(mixing.mix(df.limit(0), levels, weights, 0.8, 2)) == []


# ---- 5


def drop_plainly(texts):
    """Lines that go, by comparing every line with every earlier one."""
    seen, gone = [], set()
    for d, t in sorted(texts.items()):
        for i, raw in enumerate((t or "").split("\n") if t is not None else []):
            w = raw.split()
            line = " ".join(w)
            if not w:
                continue
            for other in seen:
                if other == line or (len(w) >= 8 and len(other.split(" ")) >= 8 and near(w, other.split(" "))):
                    gone.add((d, i))
                    break
            seen.append(line)
    return gone


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_lines_against_all_pairs(spark, monkeypatch):
    rng = random.Random(7)
    base = [prose(rng, rng.randint(3, 14)) for _ in range(30)]
    texts = {}
    for d in range(60):
        out = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(base).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.3 and len(w) > 1:
                    del w[k]
                elif kind < 0.6:
                    w.insert(k, prose(rng, 1))
                else:
                    w[k] = prose(rng, 1)
            out.append(" " * rng.randint(0, 2) + " ".join(w))
        texts[d] = "\n".join(out)
    texts |= {100: None, 101: "", 102: "\n\n", 103: "short", 104: "x " * 300, 105: "x " * 299, 106: "same long line of words that stands here\n" * 3}
    texts |= {107: "short\nnot so short", 108: "\tshort\r\n  not  so\xa0short ", 109: "日本語\n日本語", 110: "\n".join(f"row {i % 700}" for i in range(3000))}
    monkeypatch.setattr(lines, "HOT", 2)
    df = docs(spark, *texts.values(), ids=list(texts)).withColumn("n_lines", F.lit("clash"))
    gone = drop_plainly(texts)
    assert set(rows(lines.dropped_lines(df), "doc_id", "line_no")) == gone and len(gone) > 40
    for r in lines.dedup_lines(df).collect():
        t = texts[r.doc_id]
        if t is None:
            assert (r.text, r.n_lines, r.n_dropped) == (None, 0, 0)
            continue
        kept = [x for i, x in enumerate(t.split("\n")) if (r.doc_id, i) not in gone]
        assert r.text == "\n".join(kept) and r.n_lines == len(t.split("\n")) and r.n_dropped == r.n_lines - len(kept)
        assert r.n_chars == len(r.text)
    assert rows(lines.dedup_lines(df.limit(0))) == []


def test_lines_are_split_once(spark):
    """No filter that Spark infers below the explosion splits every text a second time."""
    df = docs(spark, "a b\n\n  c\td", None, "")
    table = lines.line_table(df)
    assert table._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert rows(table, "doc_id", "line_no", "line") == [(0, 0, "a b"), (0, 2, "c d")]
    among = sieve(df.where("doc_id = 1").select(F.xxhash64("doc_id", F.xxhash64("text")).alias("at")), 1)
    assert lines.line_table(df, among).count() == 0


def test_lines_of_odd_rows(spark):
    line = "a line that is long enough to be compared with another one"
    df = spark.createDataFrame([(None, line, None, None, None), (1, line, None, None, None), (1, line, None, None, None), (2, line, None, None, None)], DOCS)
    got = lines.dedup_lines(df).collect()
    assert len(got) == 4 and {r.doc_id: r.n_dropped for r in got} == {None: 0, 1: 0, 2: 1}


CLASHES = ["_text", "_likely", "_doc", "_gone", "_bucket", "_bitmap", "_d", "_t", "_row", "row", "p", "node", "line", "component", "_way", "n", "first", "key"]


def test_lines_of_repeated_ids_and_clashing_columns(spark):
    x, y = "one line of words that is as long as need be", "and quite another line with nothing of the first in it"
    for data in ([(1, x), (2, x), (2, y)], [(2, y), (2, x), (1, x)]):
        df = docs(spark, *(t for _, t in data), ids=[i for i, _ in data]).repartition(2)
        assert sorted((r.doc_id, r.text) for r in lines.dedup_lines(df).collect()) == [(1, x), (2, ""), (2, y)]
    df = docs(spark, x, x, None).select("*", *(F.lit(c).alias(c) for c in CLASHES))
    got = lines.dedup_lines(df).orderBy("doc_id").collect()
    assert [r.text for r in got] == [x, "", None] and all(r[c] == c for r in got for c in CLASHES)
    near = near_dedup.drop_near(df)
    assert near.columns == df.columns and all(r[c] == c for r in near.collect() for c in CLASHES) and near.count() == 2


# ---- 6


def test_archives_round_trip(spark, tmp_path):
    big, other = "é" * 700, "z" * 1000
    data = [(1, "http://a/1", big), (2, "http://a/ 2", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", other), (None, "u", other), (9, "WARC/1.1\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("refers_to", F.lit("clash"))
    path = f"file://{tmp_path}/w"
    warc.write_archives(pages.repartition(3), path)
    got = {r.page_id: r for r in warc.page_digests(warc.read_archives(spark, path)).collect()}
    for page, _, h in data:
        raw = (h or "").encode()
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        if page is not None:
            assert (r.record_type, r.refers_to) == (("revisit", 3) if page in (1, 2) else ("response", None))
    assert got[None].record_type == "revisit" and got[None].refers_to == 8
    warc.write_archives(pages.limit(0), path + "-none")
    assert rows(warc.read_archives(spark, path + "-none").where("record_type <> 'warcinfo'"), "record_id") == []


def test_archive_predicates_and_ranges(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 50).alias("html"))
    warc.write_archives(pages.coalesce(1), path)
    warc.register(spark)
    small = spark.read.format("warc").option("rangebytes", "8000").load(path)
    assert small.rdd.getNumPartitions() > 5 and small.where("record_type = 'response'").count() == 200
    one = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'response' AND target_uri = 'http://h/7'")
    assert [(r.payload, r.payload_bytes) for r in one.collect()] == [(None, 3200)]
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, Not, StringStartsWith

    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), StringStartsWith(("target_uri",), "http://h/19"), Not(EqualTo(("date",), "x")), EqualTo(("payload_bytes",), 1)]))
    assert len(rest) == 2 and sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 11


def test_foreign_archives(tmp_path, spark):
    import gzip

    body = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhello"
    digest = "sha1:" + base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    raw = [warc.record("response", f"urn:x:{i}", body, {"WARC-Payload-Digest": digest, "Content-Type": "application/http; msgtype=response", "X-Long": "a\r\n b"}) for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, raw)))
    (tmp_path / "b.warc").write_bytes(b"".join(raw))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert len(got) == 6 and {(r.payload_digest, bytes(r.payload), r.headers["x-long"], r.headers["http-server"]) for r in got} == {(hashlib.sha1(b"hello").hexdigest(), b"hello", "a b", "x")}


def test_plain_archives_in_ranges(tmp_path, spark):
    """Every record is read once, whatever the ranges; a record's text inside a block is no record."""
    blocks = [random.Random(i).randbytes(i * 700) + b"\r\n\r\n" * (i % 2) for i in range(12)]
    nested = b"".join(warc.record("resource", f"urn:in:{i}", b"inner", {}) for i in range(40))
    blocks[3], blocks[8] = b"\r\n\r\n" + nested, nested[:-1500]
    (tmp_path / "a.warc").write_bytes(b"".join(warc.record("resource", f"urn:x:{i}", b, {}) for i, b in enumerate(blocks)))
    for step in (100, 777, 5000, 1 << 20):
        got = spark.read.format("warc").option("rangebytes", str(step)).load(str(tmp_path)).select("record_id", "payload") if step == 5000 else None
        reader = warc.WarcReader({"path": str(tmp_path), "rangebytes": step})
        rows_ = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["record_id"], r["payload"]) for r in rows_] == [(f"urn:x:{i}", b) for i, b in enumerate(blocks)]
        assert got is None or got.count() == 12


def test_bad_headers(tmp_path):
    import gzip

    good = [warc.record("resource", f"urn:x:{i}", b"block %d" % i, {}) for i in range(3)]
    bad = [good[0], good[1].replace(b"Content-Length: 7", b"Content-Length: seven"), good[2]]
    lost = [good[0], good[1].replace(b"Content-Length: 7\r\n", b""), good[2]]
    wrong = [good[0].replace(b"Content-Length: 7", b"Content-Length: 3"), good[1]]
    for name, parts in (("bad", bad), ("lost", lost)):
        (tmp_path / f"{name}.warc").write_bytes(b"".join(parts))
        (tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(b"".join(parts[:2])) + gzip.compress(parts[2]))
    reader = warc.WarcReader({"path": str(tmp_path)})
    got = [(r["record_id"], r["block_bytes"], r["payload"].rstrip(b"\r\n")) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert got == 4 * [("urn:x:0", 7, b"block 0"), ("urn:x:1", None, b"block 1"), ("urn:x:2", 7, b"block 2")]
    (tmp_path / "wrong.warc").write_bytes(b"".join(wrong))
    reader = warc.WarcReader({"path": str(tmp_path / "wrong.warc")})
    with pytest.raises(ValueError, match="no record at byte"):
        [b for p in reader.partitions() for b in reader.read(p)]


def test_many_records_in_a_member(tmp_path, spark):
    import gzip

    blocks = [random.Random(i).randbytes(i * 40_000) for i in range(6)]
    raw = [warc.record("resource", f"urn:x:{i}", b, {"Content-Type": "text/plain"}) for i, b in enumerate(blocks)]
    for name, press in (("a", gzip.compress), ("b", warc.member)):
        (tmp_path / f"{name}.warc.gz").write_bytes(press(b"".join(raw[:4])) + press(b"".join(raw[4:])))
    got = warc.read_archives(spark, str(tmp_path))
    assert sorted(bytes(r.payload) for r in got.collect()) == sorted(2 * blocks)
    assert got.where("block_bytes = 120000").count() == 2
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(raw[0]) + b"what is not a member" + gzip.compress(raw[1]))
    with pytest.raises(Exception, match="no gzip member"):
        got.collect()


# ---- 7


def plain_sets(texts):
    lower = {c: c + 32 for c in range(65, 91)}
    out = {}
    for d, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower))
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def plain_groups(sets, percent=75):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def test_near_groups_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG", 8)
    monkeypatch.setattr(near_dedup, "DENSE_BLOCK", 16)
    rng, texts = random.Random(11), {}
    for _ in range(25):
        words = prose(rng, rng.choice([3, 20, 60, 200])).split(" ")
        for _ in range(rng.choice([1, 2, 6, 25])):
            w = list(words)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts[len(texts)] = rng.choice([" ", "\n"]).join(w)
    texts |= {900: None, 901: "", 902: " \t\n", 903: "one", 904: "ONE", 905: "a b c d", 906: "A B c d", 907: "a\xa0b", 908: "É é", 909: "x " * 3000, 910: "x " * 4000, 911: texts[3].upper()}
    df = docs(spark, *texts.values(), ids=list(texts)).withColumn("component_id", F.lit("clash"))
    sets = plain_sets(texts)
    want = plain_groups(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(df).collect()}
    assert got == {d: (len(sets[d]), want[d], want[d] == d) for d in texts}
    assert {r.doc_id for r in near_dedup.drop_near(df).collect()} == {d for d in texts if want[d] == d}


def test_near_groups_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "", "", 1), (1, "a b c d e f", "", "", 1), (1, "a b c d e f", "", "", 1), (2, "a b c d e f", "", "", 1)], DOCS)
    assert rows(near_dedup.near_groups(df)) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, False)]
    assert rows(near_dedup.near_groups(df.limit(0))) == []
    assert sorted(str(r.doc_id) for r in near_dedup.drop_near(df.unionByName(docs(spark, None, "", ids=[None, None]))).collect()) == ["1", "None", "None", "None"]


def test_near_groups_of_repeated_ids(spark):
    """Rows are linked by their texts: none is lost because another text has its doc_id."""
    rng = random.Random(3)
    one, two = prose(rng, 60), prose(rng, 60)
    texts = [(5, one), (5, two), (1, one + " more"), (2, two + " more"), (7, one + " again"), (9, "alone here")]
    want = [(1, 1, True), (2, 2, True), (5, 1, False), (5, 2, False), (7, 1, False), (9, 9, True)]
    for data in (texts, texts[::-1], texts[2:] + texts[:2]):
        df = docs(spark, *(t for _, t in data), ids=[i for i, _ in data]).repartition(3)
        assert rows(near_dedup.near_groups(df), "doc_id", "component_id", "kept") == want
        assert sorted((r.doc_id, r.text) for r in near_dedup.drop_near(df).collect()) == [(1, one + " more"), (2, two + " more"), (9, "alone here")]


def test_hashes_do_not_depend_on_what_lies_around(monkeypatch):
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(0, 40)) for _ in range(50)] + ["", " ", "é ü 日本", "a" * 5000]
    whole = [s.tolist() for s in shingles.text_sets(pa.array(texts))]
    alone = [next(iter(shingles.text_sets(pa.array([t])))).tolist() for t in texts]
    monkeypatch.setattr(shingles, "WINDOW", 300)
    cut_up = [s.tolist() for s in shingles.text_sets(pa.chunked_array([texts[:20], texts[20:]]))]
    assert whole == alone == cut_up
    assert [len(s) for s in whole] == [len(s) for s in plain_sets(dict(enumerate(texts))).values()]


# ---- 8

tokenizers = pytest.importorskip("public_tokenizers")
JSON, RANKS = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("byte_bpe_50k.tiktoken")


def untouched(texts, found=[]):  # noqa: B006
    from tokenizers import Tokenizer

    if not found:
        found.append(Tokenizer.from_file(JSON))
    return [e.ids for e in found[0].encode_batch(texts, add_special_tokens=False)]


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(6)
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endof", "it's  3.14\n\n\tx", "日本 été ñ", "a" * 3000]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2FF), rng.randrange(0x370, 0xD7FF), rng.randrange(0x1F300, 0x1FAFF), 10, 32])) for _ in range(rng.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(map(chr, range(lo, lo + 256))) for lo in range(0, 0x30000, 256) if not 0xD800 <= lo < 0xE000]
    want = untouched(texts)
    assert packing._encode(*packing.vocabulary(JSON, RANKS))(texts) == want == packing._encode(*packing.vocabulary(JSON))(texts)
    assert want[2] == [50256]


def test_packing(spark, tiny):
    odd = docs(spark, None, "<|endoftext|>", "word " * 3000, "a", ids=[10_000, 10_001, 10_002, 10_003]).unionByName(docs(spark, "a", ids=[10_003]))
    df = spark.read.parquet(f"{tiny}/documents.parquet").unionByName(odd).withColumn("length", F.lit("clash"))
    pieces = cut(packing.token_pieces(df, JSON, RANKS, with_ids=True), "p")
    got = packing.pack(pieces).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        ids = np.array(r.ids, dtype="<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r.length, r.ids_crc32)
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in df.collect():
        mine = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        want = [*untouched([r.text or ""])[0], 2]
        if r.doc_id != 10_003:
            assert [x for p in mine for x in p.ids] == want and [p.start for p in mine] == list(np.cumsum([0, *[p.length for p in mine[:-1]]]))
            assert all(p.length == 1024 for p in mine[1:])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert len(by_sequence) <= math.ceil(sum(r.length for r in got) / 1024) * 1.02 + 1
    joined = packing.sequences(packing.pack_documents(df, JSON, RANKS, with_ids=True)).collect()
    assert sum(len(r.ids) for r in joined) == sum(r.length for r in got) and max(len(r.ids) for r in joined) <= 1024
    whole = {(p.doc_id, p.piece, p.length): p.ids for p in got if p.doc_id != 10_003}
    for r in joined:
        for d, k, at, end in zip(r.doc_ids, r.pieces, r.offsets, [*r.offsets[1:], len(r.ids)], strict=True):
            assert d == 10_003 or r.ids[at:end] == whole[d, k, end - at]
    assert rows(packing.pack_documents(df.limit(0), JSON, RANKS)) == []


def test_configurations_cover_exactly():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300, 20_000):
        sizes = np.clip((rng.lognormal(5, 1.2, n)).astype(int), 1, 1024)
        histogram = {int(x): int(c) for x, c in zip(*np.unique(sizes, return_counts=True), strict=True)}
        plan = packing.configurations(histogram, 1024)
        used = {}
        for copies, filling in plan:
            assert sum(x * k for x, k in filling.items()) <= 1024
            for x, k in filling.items():
                used[x] = used.get(x, 0) + copies * k
        assert used == histogram
        assert sum(c for c, _ in plan) <= math.ceil(sizes.sum() / 1024) * 1.01 + 1
    assert packing.knapsack(np.array([3, 5]), np.array([3.0, 5.1]), 10) == {1: 2}


def test_many_pieces_of_one_short_length():
    assert packing.configurations({1: 1000}, 1024) == [(1, {1: 1000})]  # empty texts only
    rng = np.random.default_rng(1)
    sizes = np.clip(rng.lognormal(5, 1, 10_000).astype(int), 1, 1024)
    for short in (1, 3):
        histogram = {int(x): int(c) for x, c in zip(*np.unique(sizes, return_counts=True), strict=True)}
        histogram[short] = histogram.get(short, 0) + 5000
        plan = packing.configurations(histogram, 1024)
        used = {}
        for copies, filling in plan:
            assert copies > 0 and sum(x * k for x, k in filling.items()) <= 1024
            for x, k in filling.items():
                used[x] = used.get(x, 0) + copies * k
        assert used == histogram
        assert sum(c for c, _ in plan) <= math.ceil(sum(x * n for x, n in histogram.items()) / 1024) * 1.002 + 1


# ---- 9


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 48))
    x = np.concatenate([b + 0.12 * rng.normal(size=(rng.integers(1, 30), 48)) for b in base])
    x = np.concatenate([x, np.repeat(x[:1], 60, axis=0), 3 * x[5:8]])
    label = rng.integers(0, 2, len(x))
    data = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    n = len(data)
    data += [(n, None, 0), (n + 1, [0.0] * 48, 0), (n + 2, [math.nan] * 48, 0), (n + 3, x[0].tolist(), None), (n + 4, [], 0), (n + 5, [1.0, 2.0], 0), (n + 6, [1.0, 2.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash"))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = list(range(n))
    changed = True
    while changed:
        new = [min([root[i], *(root[j] for j in np.flatnonzero(near[i]))]) for i in range(n)]
        changed, root = new != root, new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df).collect()}
    assert {i: got[i] for i in range(n)} == {i: (int(near[i].sum()), root[i], root[i] == i) for i in range(n)}
    assert all(got[n + k] == (0, n + k, True) for k in range(5))
    assert got[n + 5] == (1, n + 5, True) and got[n + 6] == (1, n + 5, False)
    assert rows(near_vectors.near_vectors(df.limit(0))) == []


def test_groups_come_whole():
    keys = sorted(random.Random(2).choices(range(9), k=200))
    batches, at = [], 0
    for n in (0, 1, 3, 60, 2, 0, 50, 84):
        batches.append(pa.RecordBatch.from_pydict({"k": pa.array(keys[at : at + n], pa.int64()), "i": pa.array(range(at, at + n), pa.int64())}))
        at += n
    tables = list(vectors.whole_groups(iter(batches), 1))
    assert [i for t in tables for i in t.column(1).to_pylist()] == list(range(200))
    ends = [(t.column(0)[0].as_py(), t.column(0)[-1].as_py()) for t in tables]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_rotations_keep_lengths():
    x = np.random.default_rng(0).normal(size=(10, 48))
    y = vectors.rotate(x, 1)
    assert y.shape == (10, 64) and np.allclose(y @ y.T, x @ x.T) and not np.allclose(y, vectors.rotate(x, 2))


# ---- 10


def test_quality_on_documents_not_trained_on(spark):
    d, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0
    known = {r.doc_id: (r.quality, r.toxic) for r in labels.where(fold).collect()}
    got = quality.score(d, labels.where(~fold), F.col("source"), F.col("lang")).where(F.col("doc_id").isin(list(known))).collect()
    clean = [r.kept for r in got if known[r.doc_id] == (1, 0)]
    poor = [r.kept for r in got if known[r.doc_id][0] == 0]
    toxic = [r.toxic for r in got if known[r.doc_id][1] == 1]
    assert np.mean(clean) > 0.97 and np.mean(poor) < 0.1 and np.mean([t > 0.3 for t in toxic]) > 0.6


def test_quality_of_odd_rows(spark):
    d = docs(spark, "some plain words here", None, "", "***", "more plain words").withColumn("quality", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.score(d, none, F.col("source"), F.col("lang")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: True}
    odd = spark.createDataFrame([(0, 1, None), (None, 1, 0), (4, None, 0), (77, 1, 0), (0, 1, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(rows(quality.score(d.withColumn("source", F.lit(None).cast("string")), odd, F.col("source"), F.col("lang")))) == 5
    assert rows(quality.score(d.limit(0), none, F.col("source"), F.col("lang"))) == []
    assert [r.doc_id for r in quality.keep_good(d, none).orderBy("doc_id").collect()] == [0, 4]
    twice = docs(spark, "some plain words", "***", ids=[3, 3]).select("*", *(F.lit(c).alias(c) for c in CLASHES))
    assert [(r.text, r["_d"], r["_row"]) for r in quality.keep_good(twice, none).collect()] == [("some plain words", "_d", "_row")]


def plain_posteriors(evidence):
    """Hierarchical empirical Bayes row by row, from (host, path, chance) of rows with words: {row: (host rate, path rate, posterior)}."""
    n = len(evidence)
    mean = sum(x for _, _, x in evidence) / n
    groups = {}
    for h, p, x in evidence:
        groups.setdefault(h, {}).setdefault(p, []).append(x)
    by_host = {h: [x for xs in ps.values() for x in xs] for h, ps in groups.items()}

    def worth(total, parts, between, within, squares):
        if parts < 2 or total <= parts:
            return 1e6
        variance = (between / (parts - 1) - within / (total - parts)) / ((total - squares) / (parts - 1))
        return min(1e6, max(1.0, mean * (1 - mean) / variance - 1)) if variance > 0 else 1e6

    host_mean = {h: sum(xs) / len(xs) for h, xs in by_host.items()}
    between = sum(len(xs) * (host_mean[h] - mean) ** 2 for h, xs in by_host.items())
    within = sum((x - host_mean[h]) ** 2 for h, xs in by_host.items() for x in xs)
    a = worth(n, len(by_host), between, within, sum(len(xs) ** 2 for xs in by_host.values()) / n)
    paths = [(h, xs) for h, ps in groups.items() for xs in ps.values()]
    between = sum(len(xs) * (sum(xs) / len(xs) - host_mean[h]) ** 2 for h, xs in paths)
    within = sum((x - sum(xs) / len(xs)) ** 2 for _, xs in paths for x in xs)
    lost = len(by_host) - 1
    b = worth(n - lost, len(paths) - lost, between, within, sum(len(xs) ** 2 / len(by_host[h]) for h, xs in paths) - lost)
    odds = lambda p: math.log(p / (1 - p))
    inside = lambda p: min(1 - quality.EDGE, max(quality.EDGE, p))
    out = []
    for h, p, x in evidence:
        mine, here = by_host[h], groups[h][p]
        host = inside((sum(mine) - x + a * mean) / (len(mine) - 1 + a))
        path = inside((sum(here) - x + b * host) / (len(here) - 1 + b))
        out.append((host, path, 1 / (1 + math.exp(-(odds(x) + odds(path) - odds(mean))))))
    return out


def test_quality_against_plain_shrinkage(spark, tiny, monkeypatch):
    d = spark.read.parquet(f"{tiny}/documents.parquet")
    rng = random.Random(9)
    chances = {r.doc_id: (rng.choice("abcd"), rng.choice("xyz"), rng.betavariate(3, 1), rng.betavariate(1, 9)) for r in d.collect()}
    table = [(i, 0, h, p, min(1 - 1e-4, max(1e-4, q + 0.1 * (h == "a") - 0.1)), max(1e-4, t), 1) for i, (h, p, q, t) in chances.items()]
    fake = spark.createDataFrame(table, "doc_id long, text_hash long, host string, path string, quality double, toxic double, n_words long")
    monkeypatch.setattr(quality, "evidence", lambda *_: fake)
    monkeypatch.setattr(quality, "train", lambda *_: None)
    got = {r.doc_id: r for r in quality.score(d, None, F.col("source"), F.col("lang")).collect()}
    good, bad = plain_posteriors([(r[2], r[3], r[4]) for r in table]), plain_posteriors([(r[2], r[3], r[5]) for r in table])
    for row, (host, path, post), (_, _, toxic) in zip(table, good, bad, strict=True):
        r = got[row[0]]
        assert (r.host_quality, r.path_quality, r.quality, r.toxic) == pytest.approx((host, path, post, toxic), rel=1e-6)
        assert r.kept == (post >= 0.5 and toxic < 0.5)
    assert len({round(g[0], 3) for g in good}) > 3


def test_shrinkage():
    """A small site stays near the global rate, a large one shows its own."""
    assert quality.strength(1000, 10, 100, 0.0, 100.0, 0.5) == 1e6
    weak = quality.strength(1000, 10, 100, 0.1, 200.0, 0.5)
    strong = quality.strength(1000, 10, 100, 100.0, 50.0, 0.5)
    assert strong < 20 < weak
