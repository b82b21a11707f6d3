"""Repeated byte strings against a dictionary of all strings of 200 bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import repeats as R
from tests.conftest import DATA

L = R.LENGTH
DOCS = "doc_id long, text string, key string, _repeats string, at long"


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept digest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + L] for b in raw for i in range(len(b) - L + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - L + 1):
            if seen[b[i : i + L]] > 1:
                gone[i : i + L] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), int((gone[:-1] & ~np.r_[False, gone[:-1]][:-1]).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 6))) for _ in range(n))


def planted(seed):
    """Texts with passages of about the length, copies, edits, runs, periods, and passages inside others."""
    rng = random.Random(seed)
    pool = [words(rng, rng.randint(30, 120)) for _ in range(8)]
    exact = [words(rng, 200).encode()[:n].decode(errors="ignore") for n in (199, 200, 201, 202, 260)]
    out = ["", None, "short", "x" * 150, "x" * 199, "y" * 200, "z" * 201, "ab" * 400, "q" * 900]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice([lambda: words(rng, rng.randint(1, 60)), lambda: rng.choice(pool), lambda: rng.choice(exact), lambda: rng.choice(pool)[rng.randint(0, 40) :], lambda: rng.choice(pool)[: rng.randint(150, 300)]])())
        out.append(rng.choice(["", " ", "\n"]).join(parts))
    out += rng.sample(out, 8) + [out[-1][:-5] + "!" + out[-1][-4:]]
    return out


def got(spark, texts, ids=None, **options):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame([(i, t, "k", "gone", 3) for i, t in zip(ids, texts, strict=True)], DOCS).repartition(5)
    out = R.without_repeats(df, **options)
    assert sorted(out.columns) == sorted(df.columns)
    assert out.where("key <> 'k' OR at <> 3").count() == 0
    return sorted(tuple(r) for r in R.digests(out.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))).collect())


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 3), (3, 2), (4, 16)])
def test_against_all_strings(spark, seed, block):
    texts = planted(seed)
    assert got(spark, texts, block=block) == sorted((i, *r) for i, r in enumerate(brute(texts)))


def test_a_common_passage_in_small_blocks(spark):
    """One passage in most texts, with other words around it, and the same words on one side in some."""
    rng = random.Random(8)
    passage, sides = words(rng, 60), [words(rng, 50) for _ in range(3)]
    texts = [rng.choice([words(rng, 40), *sides]) + passage + rng.choice([words(rng, 40), *sides]) for _ in range(120)]
    assert got(spark, texts, block=7) == sorted((i, *r) for i, r in enumerate(brute(texts)))


def test_repeated_ids_rows_and_empty_table(spark):
    a, b = words(random.Random(1), 90), words(random.Random(2), 90)
    texts, ids = [a, a, b, b, b, a[10:]], [1, 1, None, 2, None, 1]
    want = sorted((-1 if i is None else i, *r) for i, r in zip(ids, brute(texts), strict=True))
    assert got(spark, texts, ids) == want and all(r[2] == r[1] for r in want)
    assert R.digests(R.without_repeats(spark.createDataFrame([], DOCS))).collect() == []
    assert got(spark, ["one", None]) == sorted((i, *r) for i, r in enumerate(brute(["one", None])))


def test_a_long_text_over_stretches(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghij") for _ in range(R.STRETCH + 5000))
    texts = [long, long[R.STRETCH - 700 : R.STRETCH + 600], long[:300], "+" + long[77:276], "-" + long[77:277] + "-"]
    rows = got(spark, texts)
    assert rows[0][2] == 300 + 1300 and [r[2] for r in rows[1:]] == [1300, 300, 0, 200] and rows[0][3] == 2


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(6)
    passage = words(rng, 70)
    passage = passage.encode()[:230].decode(errors="ignore")
    texts = [words(rng, 30) + "<" + str(i) + passage + str(i) + ">" + words(rng, 30) for i in range(9)]
    df = spark.createDataFrame([(i, t, "k", "", 3) for i, t in enumerate(texts)], DOCS)
    found = defaultdict(set)
    for r in R.repeat_groups(df).collect():
        found[r.repeat, r.length].add((r.doc_id, r.start))
    n = len(passage.encode())
    whole = [occurrences for (_, length), occurrences in found.items() if length == n]
    want = {(i, len(t.encode()[: t.encode().index(passage.encode())])) for i, t in enumerate(texts)}
    assert whole and all(w == want for w in whole)
    for (_, length), occurrences in found.items():
        assert len({texts[d].encode()[s : s + length] for d, s in occurrences}) == 1 and len(occurrences) > 1


def test_query_on_a_whole_table(spark):
    from concordat.llm.queries import op11_repeats

    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))
    assert sorted(tuple(r) for r in op11_repeats(spark, f"{DATA}/sf0.001").collect()) == want


def test_intervals_are_those_of_the_strings():
    rng = random.Random(3)
    for _ in range(50):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 12)))
        common = [0] + [R.shared(a, b) for a, b in zip(strings, strings[1:], strict=False)]
        got_ = {(d, a, b) for d, _, a, b in R.intervals(common)}
        want = set()
        for a in range(len(strings)):
            for b in range(a + 1, len(strings)):
                d = min(common[a + 1 : b + 1])
                if (a == 0 or common[a] < d) and (b == len(strings) - 1 or common[b + 1] < d):
                    want.add((d, a, b))
        assert got_ == want
