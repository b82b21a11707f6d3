"""Removal of repeated byte strings by a sparse enhanced suffix array that is dealt to tasks.

A string of LENGTH bytes is repeated if it starts at two places of the corpus. Suffixes are sampled by content: of the GRAM-byte strings inside
any LENGTH bytes the one with the least hash is an anchor, so two equal strings have their anchors at the same place in them. What lies
REACH bytes around an anchor (its context) holds every string of LENGTH bytes with that anchor's gram in it.

1. Anchors are a table: document, position, hash of the gram, hash of the context. Grams that occur once go. A gram whose contexts are all
   equal is not left-diverse: each context is repeated whole, which a count shows.
2. Of the others, one context of each kind goes on, with its bytes: the suffix from the gram on, and what is before it, read backwards. Spark
   sorts them by ranges; in a task, longest common prefixes of neighbours make the array enhanced, and a stack scan finds its common-prefix
   intervals. Inside an interval the left sides are sorted and scanned likewise: where they part (left-extension diversity) a maximal
   repeat ends, and the interval holds all its occurrences.
3. A gram with more than BLOCK contexts is dealt to several tasks, by ranges too, and scanned in blocks. Only for intervals that touch a
   block's edge, each different string of LENGTH bytes in it is sent on by its hash, once a block, and meets its like from other blocks
   in a count.

So no group of occurrences is held in one place: equal contexts are counted, blocks have at most BLOCK contexts, spans are collected by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import cut, drop_cut, ship, sieve, sifted

LENGTH = 200  # bytes of a string that must not repeat
GRAM = 64  # bytes of an anchor's own string
BLOCK = 4096  # contexts of a gram that are scanned together
STRETCH = 1 << 18  # bytes hashed at once
_rng = np.random.default_rng(7_411)
_BYTES = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_powers: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}


def _power(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both bases and of their inverses modulo 2^64."""
    if n not in _powers:
        _powers.clear()
        _powers[n] = []
        for base in _BASES:
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p))
            _powers[n].append(tuple(both))
    return _powers[n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _slid(x: np.ndarray, width: int, of) -> np.ndarray:
    """of (minimum or maximum) each `width` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = of(x[: len(x) - step], x[step:])
        done += step
    return x


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors in texts that lie end to end in data (bounds: their ends after a leading 0), hashes of their grams and of
    their contexts. A context ends with its text."""
    reach = length - gram
    found = []
    for lo in range(0, len(data), STRETCH):
        hi = min(len(data), lo + STRETCH)
        a, b = max(0, lo - reach), min(len(data), hi + length)
        part = data[a:b]
        if len(part) < length:
            continue
        (up, down), (up2, down2) = _power(STRETCH + reach + length + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[0][part] * up[: len(part)], out=total[1:])
        h = np.maximum(_mix((total[gram:] - total[:-gram]) * down[: len(part) - gram + 1]), np.uint64(1))
        least = _slid(h, reach + 1, np.minimum)  # of each string of `length` bytes
        ends = bounds[np.searchsorted(bounds, a, side="right") : np.searchsorted(bounds, b, side="left")] - a
        for e in ends:  # strings do not cross from one text to the next
            least[max(0, e - length + 1) : e] = 0
        padded = np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)])
        at = np.flatnonzero(_slid(padded, reach + 1, np.maximum) == h)
        at = at[(at + a >= lo) & (at + a < hi)]
        if not len(at):
            continue
        np.cumsum(_BYTES[1][part] * up2[: len(part)], out=total[1:])
        text = np.searchsorted(bounds, at + a, side="right")
        first, last = np.maximum(at - reach, bounds[text - 1] - a), np.minimum(at + length, bounds[text] - a)
        around = _mix((total[last] - total[first]) * down2[first]) + (at - first).astype(np.uint64)
        found.append((at + a, h[at], around))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and the ends of its values after a leading 0."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shared(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    if a == b:
        return len(a)
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def intervals(common: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(depth, parent's depth, first, last) of the common-prefix intervals of two or more sorted strings; common[i] is what strings i - 1 and i
    share, common[0] is not read. A negative number parts intervals for good."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        depth, first = common[i] if i < len(common) else -1, i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, max(depth, stack[-1][0] if stack else -1), first, i - 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class _Block:
    """Contexts of one gram in order: (kind, copies, suffix from the gram on, text before it backwards)."""

    def __init__(self, members: list[tuple], reach: int):
        self.m, self.reach = members, reach
        self.out: list[tuple] = []

    def _row(self, i: int, what: int, lo: int, hi: int, whole: bytes | None = None) -> None:
        self.out.append((self.m[i][0], what, lo, hi, whole))

    def _string(self, i: int, p: int) -> bytes:
        _, _, right, left = self.m[i]
        return hashlib.blake2b(left[:p][::-1] + b"|" + right[: LENGTH - p], digest_size=16).digest()

    def scan(self, open_: bool, groups: bool) -> list[tuple]:
        """Rows (kind, what, lo, hi, string): what 0: the context's bytes from lo to hi, counted from the gram's first, are repeated; 1: the
        string of LENGTH bytes from lo to hi is alone here, 2: it is here. With groups, 3: it is in the maximal repeat that `string` names."""
        m, reach, gram = self.m, self.reach, LENGTH - self.reach
        common = [0] + [shared(x[2], y[2]) - gram for x, y in zip(m, m[1:], strict=False)]
        last = len(m) - 1
        for depth, above, a, b in intervals([c if c >= 0 else -1 for c in common]):
            self._sides(depth, above, a, b, open_ and (a == 0 or b == last), groups, gram)
        if open_:
            for i in {0, last}:
                deepest = max(common[i] if i else -1, common[i + 1] if i < last else -1, -1)
                for p in range(0, reach - deepest):
                    self._tell([i], p)
        return self.out

    def _tell(self, run: list[int], p: int) -> None:
        i = run[0]
        _, copies, right, left = self.m[i]
        if p <= len(left) and LENGTH - p <= len(right):
            self._row(i, 1 if len(run) == 1 and copies == 1 else 2, -p, LENGTH - p, self._string(i, p))

    def _sides(self, depth: int, above: int, a: int, b: int, edge: bool, groups: bool, gram: int) -> None:
        """What the members a to b, which share `depth` bytes behind the gram, have repeated; a shallower interval sees what shares no more than
        `above`."""
        m, low, high = self.m, self.reach - depth, self.reach - above - 1  # bytes before the gram
        order = sorted(range(a, b + 1), key=lambda i: m[i][3])
        common = [0] + [min(self.reach, shared(m[i][3], m[j][3])) for i, j in zip(order, order[1:], strict=False)]
        best = [max(common[i] if i else 0, common[i + 1] if i + 1 < len(order) else 0) for i in range(len(order))]
        for i, u in zip(order, best, strict=True):
            if u >= low and m[i][1] == 1:
                self._row(i, 0, -min(u, high), gram + depth)
        if groups:
            for u, _, x, y in intervals(common):
                members = order[x : y + 1]
                # right-diverse: not all inside one deeper interval; else that one gives the longer repeat
                ends = gram + depth
                if u >= low and (len({m[i][2][: ends + 1] for i in members}) > 1 or any(len(m[i][2]) == ends for i in members)):
                    string = m[order[x]][3][:u][::-1] + m[order[x]][2][:ends]
                    # an anchor of the string itself is one wherever the string occurs; by another some occurrences would be missing
                    if u in anchors(np.frombuffer(string, np.uint8), np.array([0, len(string)]))[0]:
                        name = hashlib.blake2b(string, digest_size=16).digest()
                        for i in members:
                            self._row(i, 3, -u, ends, name)
        if edge:
            for p in range(low, high + 1):
                run: list[int] = []
                for i, u in zip(order, common, strict=True):
                    if run and u < p:
                        self._tell(run, p)
                        run = []
                    run.append(i)
                self._tell(run, p)


_FOUND = "g long, c long, what int, lo int, hi int, string binary"


def _scan(sorted_: DataFrame, reach: int, groups: bool, most: int) -> DataFrame:
    """The stack scan over contexts (g, c, copies, right, left, hot) in order of g, right, left. hot: the gram has more than `most`, and its
    blocks may lie in several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, members, parted, out = None, [], False, []

        def block() -> list[tuple]:
            return [(g, *r) for r in _Block(members, reach).scan(parted, groups)] if len(members) > 1 or parted else []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["g", "c", "what", "lo", "hi", "string"])

        for batch in batches:
            for key, c, copies, right, left, hot in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if members and (key != g or len(members) == most):
                    out += block()
                    members = []
                g, parted = key, hot
                members.append((c, copies, right, left))
                if len(out) > 8192:
                    yield rows(out)
                    out = []
        if members:
            out += block()
        if out:
            yield rows(out)

    return sorted_.select("g", "c", "copies", "right", "left", "hot").mapInArrow(run, _FOUND)


def _anchored(texts: DataFrame) -> DataFrame:
    fields = {f.name: f.dataType.simpleString() for f in texts.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _flat(batch.column(2))
            at, g, c = anchors(data, bounds)
            text = np.searchsorted(bounds, at, side="right") - 1
            for lo in range(0, len(at), 1 << 16):
                own = slice(lo, lo + (1 << 16))
                took = pa.array(text[own])
                columns = [batch.column(0).take(took), batch.column(1).take(took), pa.array((at - bounds[text])[own].astype(np.int32)), pa.array(g[own].view(np.int64)), pa.array(c[own].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "at", "g", "c"])

    return texts.mapInArrow(run, f"doc_id {fields['doc_id']}, key long, at int, g long, c long")


def _contexts(wanted: DataFrame) -> DataFrame:
    """Bytes around anchors, from texts with the list of theirs: (text, list of (at, g, c, copies))."""
    reach = LENGTH - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text, out = memoryview(batch.column(0)[row].as_buffer()), []
                for x in batch.column(1)[row].as_py():
                    at = x["at"]
                    out.append((x["g"], x["c"], x["copies"], bytes(text[at : at + LENGTH]), bytes(text[max(0, at - reach) : at])[::-1], x["hot"]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["g", "c", "copies", "right", "left", "hot"])

    return wanted.mapInArrow(run, "g long, c long, copies long, right binary, left binary, hot boolean")


def _same(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join by document; b's columns doc_id and key are named _d and _k."""
    return a.join(b, a["doc_id"].eqNullSafe(b["_d"]) & (a["key"] == b["_k"]), how).drop("_d", "_k")


def _found(docs: DataFrame, block: int, groups: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """texts (doc_id, key, bytes); anchors with a repeated gram (doc_id, key, at, g, c, mixed); what the scan has found, with copies."""
    spark = docs.sparkSession
    ship(spark)
    reach = LENGTH - GRAM
    texts = docs.select(F.col("doc_id"), F.xxhash64("text").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("bytes"))
    every = cut(_anchored(texts.where(F.octet_length("bytes") >= LENGTH)), "anchors", free=True)
    counted = every.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1").select("g", (F.col("c0") != F.col("c1")).alias("mixed"))
    repeated = cut(counted, "grams", free=True)
    likely = sifted(every, F.col("g"), sieve(repeated.select("g"), repeated.count())).where("_likely").drop("_likely")
    known = cut(likely.join(repeated, "g").select("doc_id", "key", "at", "g", "c", "mixed"), "repeated-grams", free=True)
    drop_cut(every)
    kinds = cut(known.where("mixed").groupBy("g", "c").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "key", "at")).alias("one")), "contexts", free=True)
    many = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("g", F.lit(True).alias("hot"))
    lists = kinds.join(many, "g", "left").groupBy(F.col("one.doc_id").alias("_d"), F.col("one.key").alias("_k")).agg(F.collect_list(F.struct(F.col("one.at").alias("at"), "g", "c", "copies", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted"))
    have = sifted(texts, F.xxhash64("doc_id", "key"), sieve(kinds.select(F.xxhash64("one.doc_id", "one.key").alias("h")).distinct(), kinds.count())).where("_likely").drop("_likely")
    around = cut(_contexts(_same(have, lists).select("bytes", "wanted")), "context-bytes", free=True)
    in_order = around.repartitionByRange("g", F.when(F.col("hot"), F.col("right")), F.when(F.col("hot"), F.col("left"))).sortWithinPartitions("g", "right", "left")
    seen = cut(_scan(in_order, reach, groups, block), "scanned", free=True)
    drop_cut(around)
    # strings that other blocks have too
    told = seen.where("what IN (1, 2)").groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = seen.where("what = 1").join(told, "string").select("g", "c", "lo", "hi")
    alone = seen.where("what = 0").select("g", "c", "lo", "hi").unionByName(met)
    whole = kinds.where("copies > 1").select("g", "c", F.lit(-reach).alias("lo"), F.lit(LENGTH).alias("hi"))
    spans = alone.unionByName(whole).groupBy("g", "c").agg(F.collect_set(F.struct("lo", "hi")).alias("around"))
    return texts, known, spans if not groups else seen.where("what = 3").select("g", "c", "lo", "hi", "string")


def without_repeats(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs with _repeats: (n_bytes, spans, kept) beside their columns. spans: the bytes [start, end) of the text in UTF-8 that lie in a string of LENGTH
    bytes which starts at another place too, in the same text or another; overlaps count, and all is judged on the texts as they come in.
    kept: the other bytes, end to end.

    A null text is empty, a shorter text than LENGTH bytes has no such string; rows that repeat another, or its id, are texts of their own; a
    null doc_id is one like others; other columns stay, whatever their names, but one called _repeats is replaced. An empty table gives
    an empty one. Hashes decide which strings are equal: 128 bits between blocks, 64 bits of gram and 64 of context between equal contexts.
    """
    _, known, spans = _found(docs, block)
    reach = LENGTH - GRAM
    pure = known.where("NOT mixed").select("doc_id", "key", F.struct((F.col("at") - reach).alias("start"), (F.col("at") + LENGTH).alias("end")).alias("span"))
    shifted = F.transform("around", lambda s: F.struct((F.col("at") + s["lo"]).alias("start"), (F.col("at") + s["hi"]).alias("end")))
    mixed = known.where("mixed").join(spans, ["g", "c"]).select("doc_id", "key", F.explode(shifted).alias("span"))
    # a document has at most as many as it has bytes
    marked = cut(pure.unionByName(mixed).groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(F.collect_set("span").alias("_some")), "repeated-spans", free=True)
    base = docs.select(F.struct("*").alias("_row"), F.col("doc_id"), F.xxhash64("text").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("_bytes"))
    told = sifted(base, F.xxhash64("doc_id", "key"), sieve(marked.select(F.xxhash64("_d", "_k").alias("h")), marked.count()))
    kind = "struct<n_bytes: bigint, spans: array<struct<start: bigint, end: bigint>>, kept: binary>"
    names = [c for c in docs.columns if c != "_repeats"]
    columns = [F.col("_row").getField(c).alias(c) for c in names]
    rest = F.struct(F.octet_length("_bytes").cast("long").alias("n_bytes"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"), F.col("_bytes").alias("kept"))
    clean = told.where("NOT _likely").select(*columns, rest.cast(kind).alias("_repeats"))
    joined = _same(told.where("_likely").drop("_likely"), marked, "left").select("_row", F.coalesce("_some", F.array()).alias("_some"))
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, some = batch.column(0).field(at_text).cast(pa.large_binary()), batch.column(1)
            n_bytes, spans, kept = [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_buffer() or b""
                pairs = some[i].values
                found = _merged(pairs.field(0).to_numpy(), pairs.field(1).to_numpy(), len(text))
                n_bytes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in found])
                view, at, parts = memoryview(text), 0, []
                for a, b in found:
                    parts.append(view[at:a])
                    at = b
                kept.append(b"".join([*parts, view[at:]]))
            fields = [pa.array(n_bytes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(fields, names=["n_bytes", "spans", "kept"])], names=["_row", "_repeats"])

    schema = f"_row {base.schema['_row'].dataType.simpleString()}, _repeats {kind}"
    cleaned = joined.mapInArrow(run, schema).select(*columns, "_repeats")
    return clean.unionByName(cleaned)


def _merged(starts: np.ndarray, ends: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Union of spans, cut to a text of n bytes; a context that the text's ends leave shorter than LENGTH holds no string."""
    starts, ends = np.maximum(starts, 0), np.minimum(ends, n)
    good = ends - starts >= LENGTH
    starts, ends = starts[good], ends[good]
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return list(zip(starts[new].tolist(), ends[np.r_[new[1:] - 1, len(ends) - 1]].tolist(), strict=True))


def repeat_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Maximal repeats of LENGTH bytes or more with all their occurrences: repeat (a name), length, doc_id, start. Repeats are seen through the
    contexts of their anchors, so one that reaches beyond a context comes as several groups that overlap; a gram's equal contexts
    are a group of their own. A gram with more than `block` different contexts has the groups of its blocks, those of one string put together:
    an occurrence that no other of its block shares is missing there. Rows are read as by without_repeats()."""
    texts, known, groups = _found(docs, block, groups=True)
    reach = LENGTH - GRAM
    sizes = texts.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.octet_length("bytes").alias("size")).distinct()
    parted = known.where("mixed").join(groups, ["g", "c"]).select("doc_id", "key", F.hex("string").alias("repeat"), (F.col("at") + F.col("lo")).alias("start"), (F.col("at") + F.col("hi")).alias("end"))
    copies = known.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g", "c")
    alike = known.join(copies, ["g", "c"]).select("doc_id", "key", F.concat(F.hex("g"), F.hex("c")).alias("repeat"), (F.col("at") - reach).alias("start"), (F.col("at") + LENGTH).alias("end"))
    cut_to = _same(parted.unionByName(alike), sizes).select("doc_id", "repeat", F.greatest("start", F.lit(0)).cast("long").alias("start"), F.least("end", "size").cast("long").alias("end"))
    return cut_to.where(F.col("end") - F.col("start") >= LENGTH).select("repeat", (F.col("end") - F.col("start")).alias("length"), "doc_id", "start").distinct()


def digests(done: DataFrame) -> DataFrame:
    """Counts of what without_repeats() has removed, and the digest of what it has kept."""
    spans = F.col("_repeats.spans")
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", F.col("_repeats.n_bytes").alias("n_bytes"), removed.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), F.sha2("_repeats.kept", 256).alias("kept_sha256"))
