"""Repair of conversations by error-correcting Earley parsing.

A weighted grammar says which sequences of role initials are right. Beside scanning a message as it is, an item may delete it, scan it
under another role, or pass over a terminal by inserting an empty message; chart items keep the least (cost, audit), the audit being the edits'
initials in order, and the completed chart's item yields the repair.

Where every nonterminal stands at the left end of its rules, as in ROLES, all items begin at position 0: the last set of the chart is
all that is needed and its size is that of the grammar. Items too dear to win are dropped, and what the other audits have in common is
settled, so messages are let go while a conversation streams by. Memory is bounded by the unsettled stretch (a few messages), not by the conversation.

Spark deals conversations to tasks and sorts their messages; which message repeats an earlier one is found by a grouped minimum before
that, with partial aggregation. A conversation's own messages pass through one task, in order and never held together: its digest and its
audit are of all of them in sequence.
"""

from __future__ import annotations

import hashlib
import os.path
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm.common import ship

#: An optional system message, then user and assistant in turn; or nothing. Nonterminals are keys, all else is a role's initial.
ROLES = {"S": ((), ("P",)), "P": (("X", "a"),), "X": (("u",), ("T", "u"), ("P", "u")), "T": (("s",),)}
END = "end"
SPACE = " \t\n\x0b\x0c\r"
_SOLID = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Grammar:
    """Rules, the start symbol, costs of the edits, and the roles by their initials that a message may be given or inserted with."""

    rules: dict[str, tuple[tuple[str, ...], ...]] = field(default_factory=lambda: ROLES)
    start: str = "S"
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    unfinished: int = 1  # more for a truncated message that stays
    roles: dict[str, str] = field(default_factory=lambda: {"u": "user", "a": "assistant"})
    #: An item that costs more than this beyond another of its set is let go: wherever a parse by ROLES stands, two insertions and a
    #: deletion at most bring it to what any other accepts. It is for costs as above; None, for other rules, lets nothing go.
    slack: int | None = 7


Value = tuple[int, str, str]  # cost, edits' initials, and for each of them the role's initial, - for a deletion


def _then(a: Value, b: Value) -> Value:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


class Parse:
    """An Earley chart that is fed a message at a time. Items are (rule, dot, origin); of sets before the last, only what waits there
    for an item that is still open is kept."""

    def __init__(self, grammar: Grammar):
        self.g = grammar
        self.rules = [("", (grammar.start, END)), *((n, right) for n, rights in grammar.rules.items() for right in rights)]
        self.of = {n: [k for k, (left, _) in enumerate(self.rules) if left == n] for n in grammar.rules}
        self.at, self.waiting = 0, {}
        self.items: dict[tuple[int, int, int], Value] = {}
        self._close({(0, 0, 0): (0, "", "")})

    def _next(self, rule: int, dot: int) -> str | None:
        right = self.rules[rule][1]
        return right[dot] if dot < len(right) else None

    def _close(self, begun: dict[tuple[int, int, int], Value]) -> None:
        """Predict, complete and insert until nothing becomes cheaper."""
        items, waits, whole = begun, {}, {}
        self.waiting[self.at] = waits
        work = list(items)

        def put(key: tuple[int, int, int], value: Value) -> None:
            if key not in items or value < items[key]:
                items[key] = value
                work.append(key)

        while work:
            key = work.pop()
            rule, dot, origin = key
            value, x = items[key], self._next(rule, dot)
            if x is None:
                left = self.rules[rule][0]
                if origin == self.at and (left not in whole or value < whole[left]):
                    whole[left] = value
                for (r, d, o), before in list(self.waiting[origin].get(left, {}).items()):
                    put((r, d + 1, o), _then(before, value))
            elif x in self.of:
                waits.setdefault(x, {})[key] = value
                for k in self.of[x]:
                    put((k, 0, self.at), (0, "", ""))
                if x in whole:
                    put((rule, dot + 1, origin), _then(value, whole[x]))
            elif x in self.g.roles:
                put((rule, dot + 1, origin), _then(value, (self.g.insert, "I", x)))
        if self.g.slack is not None:
            least = min(v[0] for v in items.values())
            items = {k: v for k, v in items.items() if v[0] <= least + self.g.slack}
        self.items = items
        needed = {o for _, _, o in items} | {self.at}
        stack = list(needed)
        while stack:  # what waits in a needed set has origins of its own
            for held in self.waiting.get(stack.pop(), {}).values():
                for _, _, o in held:
                    if o not in needed:
                        needed.add(o)
                        stack.append(o)
        self.waiting = {o: w for o, w in self.waiting.items() if o in needed}

    def feed(self, initial: str, must_go: bool, more: int) -> None:
        """The next message: its role's initial, whether it must be deleted, and what it costs more to keep."""
        begun: dict[tuple[int, int, int], Value] = {}
        for (rule, dot, origin), value in self.items.items():
            x = self._next(rule, dot)
            if x is None or x in self.of:
                continue
            ways = [((rule, dot, origin), (self.g.delete, "D", "-"))]
            if not must_go and x == initial:
                ways.append(((rule, dot + 1, origin), (more, "K", x)))
            elif not must_go and x in self.g.roles:
                ways.append(((rule, dot + 1, origin), (self.g.rerole + more, "R", x)))
            for key, edit in ways:
                new = _then(value, edit)
                if key not in begun or new < begun[key]:
                    begun[key] = new
        self.at += 1
        self._close(begun)

    def settled(self) -> tuple[str, str]:
        """Edits and roles that all items have in common, taken off them. None, if an item began elsewhere than at position 0."""
        if any(o for _, _, o in self.items) or any(v[1] for w in self.waiting.get(0, {}).values() for v in w.values() if self.at):
            return "", ""
        open_ = [v for k, v in self.items.items() if self._next(k[0], k[1]) not in self.of and not (self._next(k[0], k[1]) is None)]
        n = min(len(os.path.commonprefix([v[i] for v in open_])) for i in (1, 2))
        if not n:
            return "", ""
        shared = open_[0][1][:n], open_[0][2][:n]
        # items that are complete have been used up; only those that wait for a terminal go on
        self.items = {k: (v[0], v[1][n:], v[2][n:]) for k, v in self.items.items() if self._next(k[0], k[1]) not in (None, *self.of)}
        return shared

    def finish(self) -> Value:
        """The least cost, and the edits that were not settled yet."""
        return self.items[(0, 1, 0)]


class _Conversation:
    """One conversation as it streams by."""

    def __init__(self, grammar: Grammar, listed: bool):
        self.g, self.parse, self.listed = grammar, Parse(grammar), listed
        self.held: list[tuple[int | None, str, str]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = self.rows = self.written = 0
        self.low = self.high = None
        self.last = ""
        self.audit: list[str] = []
        self.sha = hashlib.sha256()

    def take(self, turn: int | None, role: str, text: str, first: bool) -> list[tuple]:
        solid = text.rstrip(SPACE)
        blank = not _SOLID.search(text)
        cut = not blank and first and solid[-1] not in ".!?"
        self.blank += blank
        self.duplicate += not blank and not first
        self.truncated += cut
        if self.rows:
            self.illegal += self.last + role[:1] not in ("su", "ua", "au")
        self.last, self.rows = role[:1], self.rows + 1
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.parse.feed(role[:1], blank or not first, self.g.unfinished * cut)
        self.held.append((turn, role, text))
        return self._write(*self.parse.settled()) if len(self.held) >= 8 else []

    def _write(self, edits: str, roles: str) -> list[tuple]:
        out, used = [], 0
        for edit, initial in zip(edits, roles, strict=True):
            turn, role, text = self.held[used] if edit != "I" else (None, "", "")
            used += edit != "I"
            if edit != "D":
                role = role if edit == "K" else self.g.roles[initial]
                self.sha.update(f"\n{role}:{text}".encode() if self.written else f"{role}:{text}".encode())
                if self.listed:
                    out.append((self.written, edit, turn, role, text))
                self.written += 1
        self.audit.append(edits)
        del self.held[:used]
        return out

    def end(self) -> tuple[list[tuple], tuple]:
        """Messages not written yet, and the report."""
        cost, edits, roles = self.parse.finish()
        rest = self._write(edits, roles)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return rest, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.sha.hexdigest())


_REPORT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_MESSAGE = [("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
_SPARK = {pa.int64(): "long", pa.string(): "string"}


def _streamed(messages: DataFrame, present: Column | None, grammar: Grammar, listed: bool) -> DataFrame:
    spark = messages.sparkSession
    ship(spark)
    id_type = messages.schema["conv_id"].dataType
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = messages.select("conv_id", F.when(there, F.col("turn").cast("long")).alias("turn"), F.when(there, text("role")).alias("role"), F.when(there, text("text")).alias("text"))
    digest = F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")
    seen = named.where(F.col("role").isNotNull()).select("conv_id", "role", digest, F.struct("turn").alias("at")).groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    firsts = seen.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"))
    both = named.select("conv_id", "turn", "role", digest, F.lit(1).alias("kind"), "text").unionByName(firsts)
    # the row before a message says that no earlier one of the conversation has its role and text
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind").select("conv_id", "turn", "role", "kind", "text")
    fields = _MESSAGE if listed else _REPORT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, first, out = object(), None, False, []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), [id_arrow, *(k for _, k in fields)], strict=True)], names=["conv_id", *(n for n, _ in fields)])

        def ended() -> list[tuple]:
            rest, report = conv.end()
            return [(now, *r) for r in (rest if listed else [report])]

        for batch in batches:
            id_arrow = batch.column(0).type
            for key, turn, role, kind, said in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv is None or key != now:
                    if conv is not None:
                        out += ended()
                    now, conv, first = key, _Conversation(grammar, listed), False
                if kind == 0:
                    first = True
                elif role is not None:
                    out += [(now, *r) for r in conv.take(turn, role, said, first)]
                    first = False
                if len(out) >= 2048:
                    yield rows(out)
                    out = []
        if conv is not None:
            out += ended()
        if out:
            yield rows(out)

    schema = T.StructType([T.StructField("conv_id", id_type)]).simpleString()[len("struct<") : -1]
    return ordered.mapInArrow(run, f"{schema},{','.join(f'{n}:{_SPARK[k]}' for n, k in fields)}")


def report(messages: DataFrame, present: Column | None = None, grammar: Grammar = Grammar()) -> DataFrame:
    """For each conversation of messages (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Messages are taken by turn, nulls first; those of one turn by role, then by the MD5 of their text. A null role or text is one space;
    a null conv_id is a conversation like others; other columns are left alone. A message's first fault counts: blank (white space
    only), duplicate (its role and text were seen earlier), truncated (not ended by . ! or ?). illegal: neighbours whose roles' initials
    are not su, ua or au. gaps: missing numbers between the least and the largest turn. cost and audit are those of the cheapest
    repair, of equal ones the ASCII-least; repaired_sha256 is over its `role:text` lines. Where `present` does not hold, a row only says
    that its conversation exists; without messages all is zero or empty. Any length of text or conversation; an empty table gives no rows.
    """
    return _streamed(messages, present, grammar, listed=False)


def repaired(messages: DataFrame, present: Column | None = None, grammar: Grammar = Grammar()) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit (K kept, R given another role, I inserted), turn (null if
    inserted), role, text. Rows are read as by report()."""
    return _streamed(messages, present, grammar, listed=True)


def damaged(messages: DataFrame) -> tuple[DataFrame, Column]:
    """messages (conv_id, turn, role, text), some of them harmed by a hash of conversation and turn, and which of them are left: one in
    twenty each is dropped, emptied, loses its . ! and ?, stands twice, or becomes the user's. Nulls are one space, but a null turn and
    conv_id stay null in their columns."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    base = messages.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), harm.alias("_harm"))
    text = F.when(F.col("_harm") == 1, "").when(F.col("_harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = base.select("conv_id", "turn", F.when(F.col("_harm") == 4, "user").otherwise(F.col("role")).alias("role"), F.when(F.col("_harm") > 0, text).alias("text"), "_harm", F.explode(F.when(F.col("_harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return out, F.col("_harm") > 0
