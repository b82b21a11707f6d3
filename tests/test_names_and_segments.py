"""Names found by pieces, digests of segments, and plans without nested loops."""

import random


from concordat.operators import long_columns, sequences
from tests.conftest import rows


def test_names_that_hold_a_word(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("ABC_") for _ in range(rng.randint(0, 7))) for _ in range(150)] + ["É_TAB"]
    words = ["".join(rng.choice("abC_") for _ in range(rng.randint(0, 5))) for _ in range(80)] + ["é", "tab", ""]
    n, w = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, name string"), spark.createDataFrame([(i, x) for i, x in enumerate(words)], "k int, word string")
    got = sequences.holding(w, "word", n, "name")
    assert sorted((r.k, r.i) for r in got.collect()) == sorted((k, i) for k, x in enumerate(words) for i, y in enumerate(names) if x and x.upper() in y)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_matched_sequences(spark):
    c = spark.createDataFrame([("orders", "orders_id_seq"), ("lines", "lines_seq"), ("two", "x"), ("", "y"), ("none", "z"), (None, "w")], "table_name string, target_sequence string")
    s = spark.createDataFrame([("ORDERS_ID_SEQ", 5), ("SEQ_LINES_ID", 7), ("TWO_A", 1), ("TWO_B", 2)], "name string, source_last long")
    assert rows(sequences.matched(c, s), "target_sequence", "source_sequence", "source_last", "match") == sorted([("lines_seq", "SEQ_LINES_ID", 7, "contains"), ("orders_id_seq", "ORDERS_ID_SEQ", 5, "exact"), ("w", None, None, "none"), ("x", None, None, "none"), ("y", None, None, "none"), ("z", None, None, "none")], key=lambda r: r[0])


def test_first_segment_that_differs(spark):
    rng = random.Random(5)
    one, two, want = [], [], {}
    for i in range(40):
        a = bytes(rng.randint(0, 255) for _ in range(rng.choice([0, 1, 9, 10, 11, 100, 1005])))
        b = bytearray(a)
        if i % 4 == 1 and a:
            b[rng.randrange(len(a))] ^= 1
        elif i % 4 == 2:
            b += b"more" * rng.randint(1, 9)
        elif i % 4 == 3:
            b = b[: len(b) // 2]
        one.append((i, a))
        two.append((i, bytes(b)))
        parts = lambda x: [bytes(x[k : k + 10]) for k in range(0, max(len(x), 1), 10)]
        p, q = parts(a), parts(b)
        apart = [k for k in range(max(len(p), len(q))) if p[k : k + 1] != q[k : k + 1]]
        if apart:
            want[i] = (apart[0], len(apart), "changed")
    one += [(None, b"x"), (50, None), (51, b""), (60, b"here" * 9)]
    two += [(None, b"x"), (50, b""), (51, b""), (61, None)]
    want |= {50: (0, 1, "changed"), 60: (0, 4, "source only"), 61: (0, 1, "target only")}
    a, b = (spark.createDataFrame(t, "k int, v binary") for t in (one, two))
    got = {r.k: (r.segment, r.differing, r.status) for r in long_columns.first_differences(a, b, ["k"], "v", 10).collect()}
    assert got == want
    assert long_columns.first_differences(a, a, ["k"], "v", 10).count() == 0
    text = spark.createDataFrame([(1, "é" * 30)], "k int, v string")
    assert [r.bytes for r in long_columns.segments(text, ["k"], "v", 25).orderBy("segment").collect()] == [25, 25, 10]
