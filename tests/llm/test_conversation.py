"""Repair of conversations against an enumeration of all edits, and odd rows."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from concordat.llm import conversation as C
from tests.conftest import rows

RIGHT = re.compile(r"(s?(ua)+)?\Z")


def cheapest(tokens):
    """Of every way to edit (initial, must_go, more) with at most two insertions in a place, the least (cost, audit)."""
    best = None
    inserts = ["", "u", "a", "ua", "au", "uu", "aa"]
    options = [[(3, "D", "")] + ([] if go else [(more, "K", x)] + [(2 + more, "R", y) for y in "ua"]) for x, go, more in tokens]
    for put in itertools.product(inserts, repeat=len(tokens) + 1):
        if sum(map(len, put)) > 3:
            continue
        for chosen in itertools.product(*options):
            text, audit, cost = put[0], "I" * len(put[0]), 2 * len(put[0])
            for (c, e, x), more in zip(chosen, put[1:], strict=True):
                text, audit, cost = text + x + more, audit + e + "I" * len(more), cost + c + 2 * len(more)
            if RIGHT.match(text) and (best is None or (cost, audit, text) < best):
                best = (cost, audit, text)
    return best


def test_parse_finds_the_cheapest():
    rng = random.Random(4)
    for _ in range(120):
        tokens = [(rng.choice("ssuuaax"), rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randint(0, 4))]
        parse, audit, roles = C.Parse(C.Grammar()), "", ""
        for t in tokens:
            parse.feed(*t)
            a, r = parse.settled()
            audit, roles = audit + a, roles + r
        cost, a, r = parse.finish()
        assert (cost, audit + a, (roles + r).replace("-", "")) == cheapest(tokens), tokens
        assert len(parse.waiting) <= 2


def test_what_is_let_go_could_not_win():
    rng = random.Random(9)
    for _ in range(400):
        parses = [C.Parse(C.Grammar()), C.Parse(C.Grammar(slack=None))]
        audits = ["", ""]
        for _ in range(rng.randint(0, 40)):
            t = rng.choice("ssuuaax"), rng.random() < 0.3, int(rng.random() < 0.3)
            for i, parse in enumerate(parses):
                parse.feed(*t)
                audits[i] += parse.settled()[0]
        ends = [parse.finish() for parse in parses]
        assert ends[0][0] == ends[1][0] and audits[0] + ends[0][1] == audits[1] + ends[1][1]


def test_any_grammar():
    """Right recursion, empty rules and a cycle of them; nothing is settled early, and the least cost is found."""
    g = C.Grammar({"S": (("u", "R"), ("E",)), "R": (("a", "S"), ("E",)), "E": ((), ("E",))}, insert=5, rerole=1, slack=None)
    for said, want in (("uaua", (0, "KKKK")), ("aaa", (2, "RKR")), ("", (0, "")), ("ux", (1, "KR"))):
        parse = C.Parse(g)
        for x in said:
            parse.feed(x, False, 0)
            assert parse.settled() in (("", ""), ("K", "u"))
        cost, audit, _ = parse.finish()
        assert (cost, audit[-len(said) :] if said else audit) == want


def test_a_long_conversation_is_let_go():
    rng = random.Random(1)
    conv = C._Conversation(C.Grammar(), listed=True)
    held = 0
    for i in range(4000):
        conv.take(i, rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["yes.", "no", " "]) + str(i) * (i % 3), i % 7 > 0)
        held = max(held, len(conv.held), max(len(v[1]) for v in conv.parse.items.values()))
    assert held < 200
    _, report = conv.end()
    assert len(report[6].replace("I", "")) == 4000


MESSAGES = "conv_id long, turn long, role string, text string, audit string"


def test_odd_rows(spark):
    said = [
        (1, 0, "user", "Hi.", "x"), (1, 1, "assistant", "Yes!", "x"), (1, 1, "assistant", "Yes!", "x"), (1, 5, "user", "no", None),
        (2, None, "system", None, "x"), (2, None, "user", "a?", "x"), (3, 2, "", "b.", "x"), (None, 7, "user", "\n\t", "x"),
        (4, 3, None, "c. \x0b", "x"), (5, 1, "user", "é" * 100_000 + ".", "x"), (5, 2, "assistant", "d.", "x"), (6, 1, "system", "e.", "x"),
    ]
    df = spark.createDataFrame(said, MESSAGES)
    got = {r.conv_id: tuple(r)[1:8] for r in C.report(df).collect()}
    # gaps, blank, duplicate, truncated, illegal, cost, audit
    assert got == {
        1: (3, 0, 1, 1, 1, 6, "KKDD"), 2: (0, 1, 0, 0, 0, 5, "DKI"), 3: (0, 0, 0, 0, 0, 3, "D"), None: (0, 1, 0, 0, 0, 3, "D"),
        4: (0, 0, 0, 0, 0, 3, "D"), 5: (0, 0, 0, 0, 0, 0, "KK"), 6: (0, 0, 0, 0, 0, 3, "D"),
    }
    kept = rows(C.repaired(df).where("conv_id = 2"), "position", "edit", "turn", "role", "text")
    assert kept == [(0, "K", None, "user", "a?"), (1, "I", None, "assistant", "")]
    sha = {r.conv_id: r.repaired_sha256 for r in C.report(df).collect()}
    assert sha[2] == hashlib.sha256(b"user:a?\nassistant:").hexdigest() and sha[6] == hashlib.sha256(b"").hexdigest()
    assert C.report(df.limit(0)).collect() == [] and C.repaired(df.limit(0)).collect() == []
    (gone,) = C.report(df.where("conv_id = 5"), F.lit(False)).collect()
    assert tuple(gone) == (5, 0, 0, 0, 0, 0, 0, "", sha[6])


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_sql_on_odd_tables(spark, tmp_path, seed):
    import duckdb

    from concordat.llm.queries import SQL, op13_repair

    rng = random.Random(seed)
    said = [(rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "No", "Why? ", "", None, "\t", "é!", "a.b.", "\x01."]), "k") for _ in range(400)]
    spark.createDataFrame(said, MESSAGES).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    ours = op13_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    theirs = con.sql(SQL["op13_repair"])
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = ours.columns
    assert sorted(repr(tuple(r)) for r in ours.collect()) == sorted(map(repr, con.sql(f"SELECT {', '.join(columns)} FROM ({SQL['op13_repair']})").fetchall()))
