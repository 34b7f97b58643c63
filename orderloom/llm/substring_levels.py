"""Substring dedup by doubling window lengths.

A window is a run of words of one document. Starting from short windows, only
those that are repeated somewhere in the corpus are extended to twice the length
(at most the wanted one), until the wanted length is reached or none is left.

A window of the wanted length is judged at a shorter length by one of the
shorter windows inside it: the one with the smallest hash, the first of equal
ones. Equal windows choose alike, and neighbours mostly choose the same one, so
few windows have to be compared; at the wanted length each window stands for
itself. A word has two independent 64-bit hashes, and a window one of each kind.

Documents are packed into blocks of about ``BLOCK_BYTES``, written once. Per
level each block sends its hashes, each once, to the tasks that hold parts of
the hash range, and gets back one bit for each. So a hash that a third of all
windows share costs a task one entry per block, and nothing but the packed
blocks and these entries is shuffled.

Defined results: words are separated by blanks, tabs and line ends; a null text
has no words; a window that occurs twice in one document is repeated; a document
shorter than a window keeps all its words; repeated rows and ids are documents
of their own; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh3_128_digest

from orderloom.llm.common import fresh, ship_package
from orderloom.plans.stage_store import write_stage

WINDOW = 35
#: The shortest length that is compared is the wanted one halved until it is at most this.
SHORTEST = 18
BLOCK_BYTES = 1 << 19
#: Hashes that one task compares at a time, about.
PART_KEYS = 1 << 18

_RNG = np.random.default_rng(35)
#: One odd multiplier for each half of a window's hash.
_MULTIPLIERS = tuple(int(x) * 8 + 5 for x in _RNG.integers(1, 1 << 60, 2))


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, each at most twice the one before."""
    out = [window]
    while out[0] > shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes for each word of all texts in order (a column each),
    and each text's number of words."""
    split = [t.split() for t in texts]  # of bytes: at the six blanks only
    digests = b"".join(map(xxh3_128_digest, chain.from_iterable(split)))
    halves = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
    return np.ascontiguousarray(halves), np.array([len(w) for w in split], np.int64)


def window_hashes(words: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """A hash for each run of ``length`` words, built by doubling."""
    by_bits, size, h = None, 1, words
    done = 0
    while True:
        if length & size:
            # the run so far, then this one behind it
            if by_bits is None:
                by_bits = h
            else:
                tail = h[done:]
                n = min(len(by_bits), len(tail))
                by_bits = by_bits[:n] * np.uint64(pow(multiplier, size, 2**64)) + tail[:n]
            done += size
        if size * 2 > length:
            break
        n = max(0, len(h) - size)
        h = h[:n] * np.uint64(pow(multiplier, size, 2**64)) + h[size : size + n]
        size *= 2
    return by_bits[: max(0, len(words) - length + 1)]


def chosen(hashes: np.ndarray, among: int) -> np.ndarray:
    """For each run of ``among`` hashes the place of its smallest, the first of equals."""
    value, place, size = hashes, np.arange(len(hashes)), 1

    def smaller(value, place, gap, n):
        left = value[:n] <= value[gap : gap + n]
        return np.where(left, value[:n], value[gap : gap + n]), np.where(left, place[:n], place[gap : gap + n])

    while size * 2 <= among:
        value, place = smaller(value, place, size, max(0, len(value) - size))
        size *= 2
    if size < among:
        value, place = smaller(value, place, among - size, max(0, len(value) - (among - size)))
    return place


class Block:
    """The documents of a block and which of their windows are still candidates."""

    def __init__(self, texts: list[str | None], window: int):
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.words, self.counts = word_hashes(self.texts)
        self.window = window
        inner = [np.arange(max(0, c - window + 1)) + at for c, at in zip(self.counts, np.cumsum(self.counts) - self.counts)]
        self.open = np.concatenate(inner) if inner else np.zeros(0, int)

    def keys(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash pairs of the level (each once, sorted), which of them the block holds
        twice, and for each candidate the number of its pair."""
        if not len(self.open):
            return np.zeros((0, 2), np.uint64), np.zeros(0, bool), np.zeros(0, int)
        high = _mixed(window_hashes(self.words[0], length, _MULTIPLIERS[0]))
        low = window_hashes(self.words[1], length, _MULTIPLIERS[1])
        place = chosen(high, self.window - length + 1)[self.open]
        places, at = np.unique(place, return_inverse=True)
        pairs = np.stack([high[places], low[places]], 1)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        new = np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])
        number = np.empty(len(places), int)
        number[order] = np.cumsum(new) - 1
        times = np.bincount(number)
        return pairs[new], times > 1, number[at]

    def keep(self, number: np.ndarray, repeated: np.ndarray) -> None:
        self.open = self.open[repeated[number]]

    def covered(self) -> np.ndarray:
        """For each word: does a candidate window cover it?"""
        n = self.words.shape[1] + 1
        edge = np.bincount(self.open, minlength=n) - np.bincount(self.open + self.window, minlength=n)
        return np.cumsum(edge)[:-1] > 0


def part_of(high: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash range, rising with the hash."""
    return ((high >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(docs: DataFrame, text: str) -> DataFrame:
    """Blocks of documents (whole rows, compressed) with the words they hold."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, words = [], 0, 0

        def packed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([words], pa.int64())], names=["rows", "words"])

        for batch in batches:
            first = 0
            for i, value in enumerate(batch.column(at)):
                t = value.as_py() or ""
                size += len(t) + 16
                words += len(t) // 6
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(first, i + 1 - first))
                    yield packed()
                    held, size, words, first = [], 0, 0, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield packed()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "rows binary, words bigint")


def _rows(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _state(raw: bytes, text: str, window: int, answers: dict[int, dict[int, bytes]], lengths: list[int], parts: list[int]) -> tuple[pa.Table, Block]:
    """A block after the levels that were answered."""
    rows = _rows(raw)
    block = Block(rows[text].to_pylist(), window)
    for level, (length, n) in enumerate(zip(lengths, parts, strict=True)):
        pairs, twice, number = block.keys(length)
        repeated = twice.copy()
        part = part_of(pairs[:, 0], n)
        bounds = np.searchsorted(part, np.arange(n + 1))
        for p, bits in answers.get(level, {}).items():
            a, b = bounds[p], bounds[p + 1]
            repeated[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a, bitorder="little").astype(bool)
        block.keep(number, repeated)
    return rows, block


_SENT = "part int, block bigint, pairs binary"
_ANSWERS = "block bigint, level int, part int, bits binary"


def _sent(block: Block, name: int, length: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    pairs, _, _ = block.keys(length)
    part = part_of(pairs[:, 0], parts)
    bounds = np.searchsorted(part, np.arange(parts + 1))
    for p in np.unique(part).tolist():
        yield p, name, pairs[bounds[p] : bounds[p + 1]].tobytes()


def _answer(sent: DataFrame, level: int) -> DataFrame:
    """For each part of the range: which of a block's hashes another block holds."""

    def run(group: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(x.as_py(), np.uint64).reshape(-1, 2) for x in group["pairs"]]
        pairs = np.concatenate(blocks)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        same = (pairs[order][1:] == pairs[order][:-1]).all(1)
        shared = np.zeros(len(pairs), bool)
        shared[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        bits = [np.packbits(s, bitorder="little").tobytes() if s.any() else None for s in np.split(shared, np.cumsum([len(b) for b in blocks])[:-1])]
        out = pa.table(
            {
                "block": group["block"],
                "level": pa.array([level] * len(bits), pa.int32()),
                "part": group["part"],
                "bits": pa.array(bits, pa.binary()),
            }
        )
        return out.filter(out["bits"].is_valid())

    return sent.groupBy("part").applyInArrow(run, _ANSWERS)


def _with_answers(blocks: DataFrame, answers: list[DataFrame], run: Callable, schema: str | StructType) -> DataFrame:
    """``run(raw rows, block name, answers by level and part)`` for each block."""
    if not answers:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for raw, name in zip(batch.column(0), batch.column(1), strict=True):
                    yield from run(raw.as_py(), name.as_py(), {}).to_batches()
            pa.default_memory_pool().release_unused()

        return blocks.select("rows", "block").mapInArrow(alone, schema)
    told = answers[0]
    for more in answers[1:]:
        told = told.union(more)

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[int, dict[int, bytes]] = {}
        for row in right.to_pylist():
            found.setdefault(row["level"], {})[row["part"]] = row["bits"]
        made = [run(raw.as_py(), name.as_py(), found) for raw, name in zip(left["rows"], left["block"], strict=True)]
        return pa.concat_tables(made) if made else None

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema).empty_table() if isinstance(schema, StructType) else None

    def safe(left: pa.Table, right: pa.Table) -> pa.Table:
        made = joined(left, right)
        return empty if made is None else made

    return blocks.select("block", "rows").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(safe, schema)


def remove_repeated(docs: DataFrame, text: str = "text", window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the words that stay, joined by
    one blank). Columns with these names are replaced."""
    taken = {"n_words", "n_removed", "kept_text"}
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() not in taken))
    return _run(docs, text, window, shortest, None)


def removal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_sha256."""
    return _run(docs.select(f"`{key}`", f"`{text}`"), text, window, SHORTEST, key)


def _run(docs: DataFrame, text: str, window: int, shortest: int, digest_key: str | None) -> DataFrame:
    ship_package(docs.sparkSession)
    name = fresh(docs, "block")
    blocks = write_stage(
        _pack(docs, text).withColumn(name, F.monotonically_increasing_id()), "text-blocks"
    ).withColumnRenamed(name, "block")
    words = blocks.agg(F.sum("words")).first()[0] or 0
    lengths = levels(window, shortest)
    answers: list[DataFrame] = []
    parts: list[int] = []
    for level, length in enumerate(lengths):
        # the share of windows that are chosen at this length, two per run of places
        density = min(1.0, 2 / (window - length + 2))
        parts.append(max(1, int(words * density) // PART_KEYS + 1))
        before, dealt = lengths[:level], list(parts)

        def send(raw, block, found, length=length, before=before, dealt=dealt):
            _, state = _state(raw, text, window, found, before, dealt[:-1])
            sent = list(_sent(state, block, length, dealt[-1]))
            return pa.table(
                {
                    "part": pa.array([s[0] for s in sent], pa.int32()),
                    "block": pa.array([s[1] for s in sent], pa.int64()),
                    "pairs": pa.array([s[2] for s in sent], pa.binary()),
                }
            )

        from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField

        sent_type = StructType(
            [StructField("part", IntegerType()), StructField("block", LongType()), StructField("pairs", BinaryType())]
        )
        sent = _with_answers(blocks, answers, send, sent_type)
        answers.append(write_stage(_answer(sent, level), "repeated-windows"))

    def finish(raw, block, found):
        rows, state = _state(raw, text, window, found, lengths, parts)
        gone, at = state.covered(), 0
        n_words, n_removed, kept = [], [], []
        for value, count in zip(state.texts, state.counts.tolist(), strict=True):
            mine = gone[at : at + count]
            found_words = value.split()
            if mine.any():
                found_words = list(compress(found_words, (~mine).tolist()))
            n_words.append(count)
            n_removed.append(count - len(found_words))
            kept.append(b" ".join(found_words))
            at += count
        if digest_key is not None:
            rows = rows.select([digest_key])
            last = ("kept_sha256", pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
        else:
            last = ("kept_text", pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()))
        rows = rows.append_column("n_words", pa.array(n_words, pa.int64()))
        return rows.append_column("n_removed", pa.array(n_removed, pa.int64())).append_column(*last)

    from pyspark.sql.types import LongType, StringType, StructField

    fields = docs.schema.fields if digest_key is None else [docs.schema[digest_key]]
    schema = StructType(
        [
            *fields,
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_text" if digest_key is None else "kept_sha256", StringType()),
        ]
    )
    return _with_answers(blocks, answers, finish, schema)
