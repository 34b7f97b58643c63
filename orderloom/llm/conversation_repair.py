"""Conversation structure repair by Four-Russians block tables.

The rows of a conversation, in order, are edited at least cost until the roles'
initials fit ``(s?(ua)+)?``: keep 0, change a role to user or assistant 3, delete
4, insert an empty user or assistant row 3; a truncated row that stays adds 3; a
blank or repeated row must go. Of equal costs the edits whose initials (D, I, K,
R) are least as a string are taken.

What is left to pay behind a row depends on the state alone (nothing yet, after
s, after u, after a): a vector of four costs, normalised by its least. Only a
few normalised vectors exist. For each of them and each block of ``BLOCK`` row
symbols a table holds the vector before the block and the cost that was taken
out, so a conversation is worked on backward one lookup per block. To trace, a
block is expanded backward from the vector at its end, and from the first row on
the least letter that keeps the cost is taken; expansions are remembered.

No conversation has to fit in a task. Rows are sorted over range partitions and
numbered; the rows of a conversation in one partition are a segment. A segment's
table lookups are done for all vectors at once, which gives its effect on any
future; the effects are chained per conversation (a few numbers per segment),
segments are traced from each state they may start in, and a last pass over
rows in order puts rows and edits together as a stream.

Defined results: null roles and texts are one blank; rows go by turn (nulls
first), equal turns by role, then by a hash of the text; a role that starts
neither with s, u nor a (or is empty) never fits; rows without a conversation id
are one conversation; an empty table gives an empty table; extra columns are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderloom.llm.common import BLANKS, ship_package
from orderloom.plans.stage_store import write_stage

BLOCK = 3
REROLE = INSERT = CUT = 3
DELETE = 4

#: States: nothing yet, after s, after u, after a; the state that a user or assistant row leads to.
_NEXT = (2, 2, 3, 2)
#: By role class (s, u, a, other): the state it leads to from each state, if it fits.
_FITS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
#: 0: must go; 1 + 2 * role class + truncated; PAD: no row.
SYMBOLS, PAD = 10, 9
#: What is left to pay when no row is left: a started conversation ends with a.
_END = (0, 2 * INSERT, INSERT, 0)


def _options(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits that use up a row: letter, cost, state afterwards."""
    yield "D", DELETE, state
    if symbol:
        role, cut = divmod(symbol - 1, 2)
        if state in _FITS[role]:
            yield "K", CUT * cut, _FITS[role][state]
        yield "R", REROLE + CUT * cut, _NEXT[state]


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """What is left to pay before a row, by state, from what is left after it."""
    if symbol == PAD:
        return after
    left = [min(cost + after[to] for _, cost, to in _options(symbol, state)) for state in range(4)]
    for _ in range(2):  # insertions: at most two in a row lead on
        left = [min(own, INSERT + left[_NEXT[state]]) for state, own in enumerate(left)]
    return tuple(left)


class Tables(NamedTuple):
    """Normalised vectors (0: at the end), and by vector and symbol or block the
    vector before it and the cost taken out."""

    vectors: np.ndarray
    one: np.ndarray
    one_cost: np.ndarray
    block: np.ndarray
    block_cost: np.ndarray


@cache
def tables() -> Tables:
    number, todo = {_END: 0}, [_END]
    one, cost = [], []
    for vector in todo:
        one.append([])
        cost.append([])
        for symbol in range(SYMBOLS):
            left = _before(symbol, vector)
            least = min(left)
            norm = tuple(x - least for x in left)
            if norm not in number:
                number[norm] = len(todo)
                todo.append(norm)
            one[-1].append(number[norm])
            cost[-1].append(least)
    step, price = np.array(one), np.array(cost)
    block = np.repeat(np.arange(len(todo))[:, None], SYMBOLS**BLOCK, 1)
    paid = np.zeros_like(block)
    codes = np.arange(SYMBOLS**BLOCK)
    for place in range(BLOCK):  # the last symbol is the code's lowest digit
        symbol = codes // SYMBOLS**place % SYMBOLS
        paid += price[block, symbol]
        block = step[block, symbol]
    return Tables(np.array(todo), step, price, block, paid)


def block_codes(symbols: bytes) -> np.ndarray:
    """The blocks of a segment, the last one padded."""
    s = np.frombuffer(symbols, np.uint8).astype(np.int64)
    s = np.concatenate([s, np.full(-len(s) % BLOCK, PAD)]).reshape(-1, BLOCK)
    return s @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def effect(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each vector behind a segment the vector before it and the cost taken out."""
    t = tables()
    now = np.arange(len(t.vectors))
    paid = np.zeros(len(now), np.int64)
    for code in block_codes(symbols)[::-1].tolist():
        paid += t.block_cost[now, code]
        now = t.block[now, code]
    return now, paid


@cache
def _expanded(code: int, behind: int, state: int) -> tuple[str, int]:
    """The edits of a block from a state, least of the cheapest, and the state behind it."""
    t = tables()
    symbols = [code // SYMBOLS**place % SYMBOLS for place in range(BLOCK - 1, -1, -1)]
    vectors, paid = [behind], [0]
    for symbol in reversed(symbols):
        paid.append(paid[-1] + int(t.one_cost[vectors[-1], symbol]))
        vectors.append(int(t.one[vectors[-1], symbol]))
    left = [(t.vectors[v] + p).tolist() for v, p in zip(reversed(vectors), reversed(paid), strict=True)]
    letters = []
    for at, symbol in enumerate(symbols):
        while symbol != PAD:
            now, after = left[at], left[at + 1]
            ways = [(letter, to) for letter, cost, to in _options(symbol, state) if cost + after[to] == now[state]]
            if INSERT + now[_NEXT[state]] == now[state]:
                ways.append(("I", _NEXT[state]))
            letter, state = min(ways)
            letters.append(letter)
            if letter != "I":
                break
    return "".join(letters), state


def trace(symbols: bytes, behind: int, last: bool) -> tuple[list[str], list[int]]:
    """For each state that a segment may start in: its edits, and the state behind it."""
    t = tables()
    codes = block_codes(symbols).tolist()
    vectors = [behind]
    for code in reversed(codes):
        vectors.append(int(t.block[vectors[-1], code]))
    vectors = vectors[-2::-1]  # the vector behind each block
    edits, states = [], []
    for state in range(4):
        parts = []
        for code, vector in zip(codes, vectors, strict=True):
            letters, state = _expanded(code, vector, state)
            parts.append(letters)
        while last and _END[state]:
            parts.append("I")
            state = _NEXT[state]
        edits.append("".join(parts))
        states.append(state)
    return edits, states


# one pass over sorted rows each


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: StructType, size: int = 4096) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _pass(df: DataFrame, by: list[str], order: list[str], work, schema: StructType) -> DataFrame:
    """``work(rows in order)`` on partitions that hold all rows of a key ``by``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(work(_rows(batches)), schema)

    return df.repartition(*by).sortWithinPartitions(*order).mapInArrow(run, schema)


def _segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    """conv, part, pos, symbol, fault, role class -> one row per segment."""
    for (conv, _), group in groupby(rows, key=lambda r: (r[0], r[1])):
        symbols, faults, illegal, first, before = bytearray(), [0] * 4, 0, None, None
        for _, _, pos, symbol, fault, role in group:
            if before is None:
                first, head = pos, role
            elif (before, role) not in _LEGAL:
                illegal += 1
            before = role
            symbols.append(symbol)
            faults[fault] += 1
        to, paid = effect(bytes(symbols))
        yield conv, first, bytes(symbols), to.tolist(), paid.tolist(), *faults[1:], illegal, head, before


#: Classes of neighbouring roles: su, ua, au.
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _chained(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The segments of a conversation, the last one first -> the vector behind each, and
    with the first one the conversation's figures."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        behind, total, sums, later, row = 0, 0, [0] * 4, None, None
        for _, seg, to, paid, *counts, first, last in group:
            if row is not None:
                yield row
            sums = [a + b for a, b in zip(sums, counts, strict=True)]
            if later is not None and (last, later) not in _LEGAL:
                sums[3] += 1
            row = (seg, behind, later is None, conv, None, None, None, None, None)
            total += paid[behind]
            behind, later = to[behind], first
        yield (*row[:4], *sums, total + int(tables().vectors[behind][0]))


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of a conversation, each segment's edits before its rows -> edited rows."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        at = state = n = 0
        for _, _, role, text, edits, states in group:
            if edits is not None:
                # the edits up to each row; what is left closes the conversation
                *parts, closing = edits[state].replace("D", "D ").replace("K", "K ").replace("R", "R ").split(" ")
                ahead, left, state = iter(parts), len(parts), states[state]
                continue
            for letter in next(ahead):
                made, said = role, text
                if letter in "IR":
                    made = "assistant" if at == 2 else "user"
                if letter == "I":
                    said = ""
                if letter == "K":
                    at = _FITS["sua".find(role[:1])][at]
                elif letter != "D":
                    at = _NEXT[at]
                yield conv, n, letter, made, said
                n += 1
            left -= 1
            for _ in closing if not left else ():
                yield conv, n, "I", "assistant" if at == 2 else "user", ""
                at = _NEXT[at]
                n += 1


def _digested(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edited rows in order -> audit and digest of each conversation."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        audit, digest, gap = [], hashlib.sha256(), b""
        for _, _, letter, role, text in group:
            audit.append(letter)
            if letter != "D":
                digest.update(gap + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                gap = b"\n"
        yield conv, "".join(audit), digest.hexdigest()


class Repaired(NamedTuple):
    """rows: conv_id, n (number of the edit), edit, role, text - deleted rows too;
    figures: per conversation blank, duplicate, truncated, illegal, cost and gaps;
    digests: per conversation audit and repaired_sha256."""

    rows: DataFrame
    figures: DataFrame
    digests: DataFrame


def _class(role: Column) -> Column:
    head = F.substring(role, 1, 1)
    return F.when(head == "s", 0).when(head == "u", 1).when(head == "a", 2).otherwise(3)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest repair of each conversation."""
    ship_package(turns.sparkSession)
    read = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    # equal rows are told apart too, so that no range is one row's copies
    read = read.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "hash"]
    # the number tells the partition and the place in it, in order
    stored = write_stage(
        read.repartitionByRange(*order, "row").sortWithinPartitions(*order, "text").withColumn("pos", F.monotonically_increasing_id()).drop("hash", "row"),
        "ordered-turns",
    )
    conv_type = stored.schema["conv_id"].dataType.simpleString()

    bare = F.btrim("text", F.lit(BLANKS))
    said = F.sha2(F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), F.lit("\n")), F.length("role"), "role", "text"), 256)
    slim = stored.select(
        "conv_id", "pos", _class(F.col("role")).alias("class"), (F.length(bare) == 0).alias("blank"),
        F.substring(bare, -1, 1).isin(*".!?").alias("closed"), said.alias("said"),
    )
    first = slim.groupBy("said").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = F.when(F.col("blank"), 1).when(F.col("pos") > F.col("first"), 2).when(~F.col("closed"), 3).otherwise(0)
    marked = slim.join(first, "said", "left").withColumn("fault", fault)
    symbol = F.when(F.col("fault").isin(1, 2), 0).otherwise(1 + 2 * F.col("class") + (F.col("fault") == 3).cast("int"))
    rows = marked.select("conv_id", F.shiftright("pos", 33).alias("part"), "pos", symbol.alias("symbol"), "fault", "class")

    schema = lambda ddl: StructType.fromDDL(f"conv_id {conv_type}, {ddl}")
    counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    segments = write_stage(
        _pass(rows, ["part"], ["pos"], _segments, schema(f"seg bigint, symbols binary, to array<int>, paid array<bigint>, {counts}, head int, tail int")),
        "turn-segments",
    )
    futures = write_stage(
        _pass(
            segments.select("conv_id", "seg", "to", "paid", *counts.replace(" bigint", "").split(", "), "head", "tail"),
            ["conv_id"], ["conv_id", F.desc("seg")], _chained,
            StructType.fromDDL(f"seg bigint, behind int, last boolean, conv_id {conv_type}, {counts}, cost bigint"),
        ),
        "turn-futures",
    )

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((conv_, seg, *trace(symbols, behind, last)) for conv_, seg, symbols, behind, last in _rows(batches))
        return _batches(made, edits_schema)

    edits_schema = schema("pos bigint, edits array<string>, states array<int>")
    edits = (
        segments.select("conv_id", "seg", "symbols")
        .join(futures.select("seg", "behind", "last"), "seg")
        .select("conv_id", "seg", "symbols", "behind", "last")
        .mapInArrow(traced, edits_schema)
    )
    both = stored.select("conv_id", "pos", "role", "text").unionByName(edits, allowMissingColumns=True)
    edited = _pass(
        both.select("conv_id", "pos", "role", "text", "edits", "states"), ["conv_id"],
        ["conv_id", "pos", F.col("edits").isNull()], _edited, schema("n bigint, edit string, role string, text string"),
    )
    digests_schema = schema("audit string, repaired_sha256 string")
    digests = edited.mapInArrow(lambda batches: _batches(_digested(_rows(batches)), digests_schema), digests_schema)

    gaps = stored.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    own = futures.where("cost IS NOT NULL").drop("seg", "behind", "last")
    return Repaired(edited, own.join(gaps, own["conv_id"].eqNullSafe(gaps["conv_id"])).drop(gaps["conv_id"]), digests)


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_digests(conversations: DataFrame, repaired: Repaired) -> DataFrame:
    """Per conversation of ``conversations`` (column conv_id, no repeats), those without
    rows too: conv_id, the figures, audit and repaired_sha256."""
    figures, digests = (df.withColumnRenamed("conv_id", name) for df, name in ((repaired.figures, "c1"), (repaired.digests, "c2")))
    found = conversations.join(figures, F.col("conv_id").eqNullSafe(F.col("c1")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("c2")), "left"
    )
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FIGURES),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with faults by the CRC-32 of the row's
    number: dropped, emptied, without ends of sentences, repeated or by the user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        turns.withColumn("kind", kind)
        .where("kind != 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
