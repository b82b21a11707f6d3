"""Best-fit packing of tokenised documents into fixed-length sequences.

A configuration linear program over the histogram of piece lengths says how often each filling of a sequence is used. It is
solved by multiplicative weights whose pricing step is a knapsack dynamic program, rounded down, and completed by best fit on
what is left. The program sees at most `capacity` numbers, whatever the corpus holds; the pieces themselves are dealt to
sequences in parallel, from their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from concordat.llm.common import cut, gapless_rank, ship

_encoders: dict = {}


def _encode(tokenizer: str, ranks: bytes | None = None, pattern: str = ""):
    """Function from texts to lists of ids, those of the JSON tokenizer as it is, with add_special_tokens=False.

    The arguments are the files' contents, as executors need not have the files. The same vocabulary as merge ranks, where given, is several times as
    fast. It knows no special tokens, so texts that hold the string of one go through the JSON tokenizer, which gives it its own id.
    """
    key = hash(tokenizer), hash(ranks)
    if key not in _encoders:
        from tokenizers import Tokenizer

        full = Tokenizer.from_str(tokenizer)
        whole = lambda texts: [e.ids for e in full.encode_batch(texts, add_special_tokens=False)]
        if ranks:
            import base64

            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
            plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            special = [t.content for t in full.get_added_tokens_decoder().values()]
            _encoders[key] = lambda texts: [whole([t])[0] if any(s in t for s in special) else plain.encode_ordinary(t) for t in texts]
        else:
            _encoders[key] = whole
    return _encoders[key]


def vocabulary(tokenizer: str, ranks: str | None = None) -> tuple[str, bytes | None, str]:
    """What _encode() needs, from the driver's files: a few MB, sent with the tasks."""
    if not ranks:
        return Path(tokenizer).read_text(encoding="utf-8"), None, ""
    import public_tokenizers

    return Path(tokenizer).read_text(encoding="utf-8"), Path(ranks).read_bytes(), public_tokenizers.PATTERN


def token_pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenise documents and cut the ones longer than capacity.

    A document is its ids and then end_id; a null text is empty. The cut-off pieces have exactly `capacity` ids except the
    first, which takes the remainder. Returns doc_id, piece, start, length, ids_crc32 (little-endian 32-bit ids) and, if asked
    for, ids. Every row is a document, so rows that repeat a doc_id each give pieces; an empty table gives none.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    # cloudpickle would copy the vocabulary into every task's command; Spark sends a broadcast once to each executor
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encode(*sent.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                docs_, pieces, starts, lengths, sums, flat = [], [], [], [], [], []
                for doc, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    whole = np.array([*ids, end_id], dtype="<u4")
                    n, start = len(whole), 0
                    for k, end in enumerate(range(n % capacity or capacity, n + 1, capacity)):
                        docs_.append(doc)
                        pieces.append(k)
                        starts.append(start)
                        lengths.append(end - start)
                        sums.append(zlib.crc32(whole[start:end].tobytes()))
                        start = end
                    if with_ids:
                        flat.append(whole.astype(np.int32))
                columns = [pa.array(docs_, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *flat]))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """The filling of one sequence of the largest total value (unbounded knapsack): {index of length: times}."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], take[c] = best[c - 1], -1
        if k := fit[c]:
            gain = best[c - lengths[:k]] + values[:k]
            i = int(gain.argmax())
            if gain[i] > best[c] + 1e-12:
                best[c], take[c] = gain[i], i
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            out[int(take[c])] = out.get(int(take[c]), 0) + 1
            c -= int(lengths[take[c]])
    return out


def configurations(histogram: dict[int, int], capacity: int, rounds: int = 1500, step: float = 0.25) -> list[tuple[int, dict[int, int]]]:
    """How often to use which filling: [(copies, {length: times})], covering each length's count exactly.

    Covering program: least number of fillings so that every length is covered as often as it occurs. Multiplicative weights:
    a length's price falls exponentially with the share of it already covered; the knapsack finds the filling of the best
    price; it is used as far as a fixed share of the scarcest length in it. The averaged solution is scaled, rounded down and
    limited to what is left; the rest is packed by best fit. Of a short length the rest may be most of what there was.
    """
    left = {length: n for length, n in histogram.items() if 0 < length < capacity and n > 0}
    plan: list[tuple[int, dict[int, int]]] = [(histogram[capacity], {capacity: 1})] if histogram.get(capacity) else []
    if not left:
        return plan
    lengths = np.array(sorted(left))
    need = np.array([left[x] for x in lengths], dtype=float)
    cover, uses = np.zeros(len(lengths)), {}
    for _ in range(rounds):
        share = cover / need
        # a length's own size is its fair price; weights tilt it towards what is less covered, and what is left keeps gaps filled
        price = np.exp(-20.0 * (share - share.min())) + 0.01
        found = knapsack(lengths, lengths / capacity * price, capacity)
        amount = step * min(need[i] / k for i, k in found.items())
        for i, k in found.items():
            cover[i] += amount * k
        key = tuple(sorted(found.items()))
        uses[key] = uses.get(key, 0.0) + amount
    scale = 1 / max(1e-9, float(np.average(cover / need, weights=need * lengths)))
    rest = need.astype(np.int64)
    for key, amount in sorted(uses.items(), key=lambda x: (-x[1], x[0])):
        copies = min(int(amount * scale), *(int(rest[i]) // k for i, k in key))
        if copies > 0:
            plan.append((copies, {int(lengths[i]): k for i, k in key}))
            for i, k in key:
                rest[i] -= copies * k
    return plan + best_fit({int(x): int(n) for x, n in zip(lengths, rest, strict=True) if n}, capacity)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Fill from the longest length left, each time with the reachable sum that leaves least, as often as counts allow."""
    plan = []
    lengths = sorted(left, reverse=True)
    while lengths:
        first = lengths[0]
        filling, gap = {first: 1}, capacity - first
        reach, before = 1, []  # bit s of reach: the sum s can be had; (length, reach without it) in order
        for x in lengths:
            if reach >> gap & 1:
                break
            before.append((x, reach))
            free, step = min(left[x] - (x == first), gap // x), 1
            while free:  # any number up to free is a sum of such steps
                step = min(step, free)
                reach |= reach << step * x & (2 << gap) - 1
                free, step = free - step, 2 * step
        at = reach.bit_length() - 1
        for x, known in reversed(before):
            k = next(k for k in range(at // x + 1) if known >> at - k * x & 1)
            if k:
                filling[x] = filling.get(x, 0) + k
                at -= k * x
        copies = min(left[x] // k for x, k in filling.items())
        plan.append((copies, filling))
        for x, k in filling.items():
            left[x] -= copies * k
        lengths = [x for x in lengths if left[x]]
    return plan


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add sequence_id and offset to token_pieces(). pieces should be a cut() table: it is read three times.

    Empty input gives an empty result. Pieces of equal length are interchangeable, so ties need no rule beyond their rank.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    rows = sum(histogram.values())
    deals: dict[int, list[tuple[int, int, int, int]]] = {}
    dealt: dict[int, int] = {}
    sequence = 0
    for copies, filling in configurations(histogram, capacity):
        offset = 0
        for length, times in sorted(filling.items(), reverse=True):
            start = dealt.get(length, 0)
            deals.setdefault(length, []).append((start, times, sequence, offset))
            dealt[length] = start + copies * times
            offset += length * times
        sequence += copies
    tables = {length: np.array(rows_, dtype=np.int64) for length, rows_ in deals.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                table = tables[int(x)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - row[:, 0]
                seq[at] = row[:, 2] + inside // row[:, 1]
                off[at] = row[:, 3] + inside % row[:, 1] * x
            keep = [i for i, n in enumerate(batch.schema.names) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(seq), pa.array(off)], names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    ranked = gapless_rank(pieces, "length", [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], rows, F.struct("doc_id", "piece"))
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.select(*pieces.columns, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ids: sequence_id, ids, and for each piece in it doc_ids, pieces, offsets.

    A sequence holds at most `capacity` ids, so its group is bounded. No pieces, no sequences.
    """
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.piece").alias("pieces"), F.col("parts.offset").alias("offsets"))


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    Pieces are ranked and placed without their ids, which join them by the piece's number once their place is known.
    """
    pieces = token_pieces(docs, tokenizer, ranks, capacity, end_id, with_ids)
    if not with_ids:
        return pack(cut(pieces, "pieces"), capacity)
    numbered = cut(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    return pack(numbered.drop("ids"), capacity).join(numbered.select("number", "ids"), "number").drop("number")
