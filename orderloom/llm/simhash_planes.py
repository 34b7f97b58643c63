"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64-bit majorities over the hashes of a text's word shingles.
Equal fingerprints are one row from then on. Two fingerprints that differ in at
most two bits agree in at least two of four 16-bit quarters, so each goes into
six tables, one for each pair of quarters, keyed by their bits. Rows with equal
keys are compared in blocks: a block is stored as 64 bit planes, a fingerprint
is held against 64 others by one exclusive-or per plane, and the differences
are added by carry-save counters of one bit per lane. After every few planes the
words whose lanes have all passed the radius are abandoned.

Where very many fingerprints share a key, they are keyed again within it: what is
left of them are 32 bits, of whose four pieces at least two agree for two near
ones, so each goes into six smaller tables. Of these a key leaves 16 bits open, so
none is shared by more than 65,536 fingerprints, and the work grows with the
number of fingerprints, not with its square. Such a group is compared by pairs of
blocks. A block gives one link per fingerprint to the head of its group in the
block, never all pairs; components are found over the links.

Defined results: words are separated by blanks, tabs and line ends; a text with
fewer words than a shingle counts as one shingle, a text without words (or null)
has fingerprint zero, linked like any other; every row comes back, repeated rows
and ids too; rows with a null id bind others, and a group of such rows alone has
a null component; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import fresh, ship_package
from orderloom.llm.components import components
from orderloom.plans.stage_store import write_stage

SHINGLE = 3
SEED = 42
RADIUS = 2
QUARTERS = 4
#: Rows of a block; a key that more rows share is divided.
BLOCK = 4096
#: Planes between two looks at which words can be abandoned.
PLANES_A_LOOK = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text, as an unsigned number."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    if not found:
        return 0
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return digest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at : at + 65_536], "<u8")
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    majority = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(majority, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep_text: bool = True) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number in ``name``."""
    ship_package(docs.sparkSession)
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c != text), f"`{text}`")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(v.as_py()) for v in batch.columns[-1]], np.uint64).view(np.int64)
            columns = batch.columns if keep_text else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found)], names=[*batch.schema.names[: len(columns)], name]
            )

    from pyspark.sql.types import LongType, StructField, StructType

    fields = schema.fields if keep_text else schema.fields[:-1]
    return docs.mapInArrow(run, StructType([*fields, StructField(name, LongType())]))


def near_in_block(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All near pairs of a block as words: (row, word number, 64 lanes of others).

    Planes are vertical: bit ``l`` of word ``w`` of plane ``p`` is bit ``p`` of
    fingerprint ``64 w + l``. Rows are compared with the words from their own on.
    """
    n = len(prints)
    words = -(-n // 64)
    lanes = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    padded = np.zeros((64, words * 64), np.uint8)
    padded[:, :n] = lanes.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    real = np.zeros(words * 64, np.uint8)
    real[:n] = 1
    live = np.packbits(real, bitorder="little").view("<u8")
    counters = radius.bit_length()
    rows_out, words_out, lanes_out = [], [], []
    full = ~np.uint64(0)
    for first in range(0, n, 1024):
        rows = np.arange(first, min(first + 1024, n))
        row, word = (x.ravel() for x in np.meshgrid(rows, np.arange(first // 64, words), indexing="ij"))
        count = [np.zeros(len(row), np.uint64) for _ in range(counters)]
        gone = ~live[word]  # lanes that have passed the radius, or are no row
        for p in range(64):
            mine = np.where((prints[row] >> np.uint64(p)) & np.uint64(1) == 1, full, np.uint64(0))
            carry = planes[p][word] ^ mine
            for c in count:  # carry-save: a full adder of one bit in each lane
                c ^= carry
                carry &= ~c
            gone |= carry  # more than the counters hold
            if p % PLANES_A_LOOK == PLANES_A_LOOK - 1:
                over = _above(count, radius)
                gone |= over
                open_words = gone != full
                row, word, gone = row[open_words], word[open_words], gone[open_words]
                count = [c[open_words] for c in count]
        rows_out.append(row)
        words_out.append(word)
        lanes_out.append(~gone)
    return np.concatenate(rows_out), np.concatenate(words_out), np.concatenate(lanes_out)


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counters hold more than the radius, compared from the highest bit."""
    more = np.zeros_like(count[0])
    equal = ~more
    for i in reversed(range(len(count))):
        if radius >> i & 1:
            equal = equal & count[i]
        else:
            more |= equal & count[i]
            equal = equal & ~count[i]
    return more


def block_links(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(head, member) rows for the groups of a block: one link per member."""
    row, word, lanes = near_in_block(prints, radius)
    others = np.bitwise_count(lanes)
    own = (row // 64 == word).astype(others.dtype)
    if (others == own).all():
        return []
    # rows that have company, as sets of rows in one long integer each
    near: dict[int, int] = {}
    for r, w, x in zip(row.tolist(), word.tolist(), lanes.tolist()):
        near[r] = near.get(r, 0) | x << (64 * w)
    links, left = [], (1 << len(prints)) - 1
    back: dict[int, int] = {}
    for r, mask in near.items():  # the words before a row's own were not compared: mirror them
        later = mask >> (r + 1) << (r + 1)
        while later:
            low = later & -later
            s = low.bit_length() - 1
            back[s] = back.get(s, 0) | 1 << r
            later ^= low
    for head in range(len(prints)):
        if not left >> head & 1:
            continue
        left &= ~(1 << head)
        todo = [head]
        while todo:
            r = todo.pop()
            new = (near.get(r, 0) | back.get(r, 0)) & left
            left &= ~new
            while new:
                low = new & -new
                s = low.bit_length() - 1
                links.append((head, s))
                todo.append(s)
                new ^= low
    return links


def links_by_blocks(prints: np.ndarray, radius: int = RADIUS, block: int = BLOCK) -> Iterator[list[tuple[int, int]]]:
    """The links of any number of rows, a pair of blocks at a time."""
    n = len(prints)
    if n <= 2 * block:
        yield block_links(prints, radius)
        return
    pieces = np.array_split(np.arange(n), -(-n // block))
    for i, piece in enumerate(pieces):
        for other in pieces[i + 1 :]:
            rows = np.concatenate([piece, other])
            yield [(int(rows[a]), int(rows[b])) for a, b in block_links(prints[rows], radius)]


def _keys(value: Column, bits: int) -> Column:
    """The pairs of quarters of a number of so many bits: (table, key, the bits left)."""
    width = bits // QUARTERS
    part = [F.shiftrightunsigned(value, i * width).bitwiseAND((1 << width) - 1) for i in range(QUARTERS)]
    pairs = list(combinations(range(QUARTERS), 2))
    # the other two quarters are the pair at the same place from the end
    joined = [F.shiftleft(part[i], width).bitwiseOR(part[j]) for i, j in pairs]
    return F.array(
        *(F.struct(F.lit(t).alias("t"), joined[t].alias("key"), joined[-1 - t].alias("rest")) for t in range(len(pairs)))
    )


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp, no repeats) whose
    components are those of all pairs within the radius (2 at most)."""
    if not 0 <= radius <= QUARTERS - 2:
        raise ValueError("pairs of four quarters find differences of at most two bits")
    ship_package(prints.sparkSession)
    spread = prints.select("fp", F.explode(_keys(F.col("fp"), 64)).alias("at")).select("fp", "at.*")
    counts = spread.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = spread.join(counts, ["t", "key"])
    whole = F.struct(F.lit(-1).alias("t"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("rest"))
    inner = F.when(F.col("n") > BLOCK, _keys(F.col("rest"), 32)).otherwise(F.array(whole))
    dealt = shared.select("t", "key", F.explode(inner).alias("in"), "fp").select(
        "t", "key", F.col("in.t").alias("s"), F.col("in.key").alias("inner"), "fp"
    )
    group = ["t", "key", "s", "inner"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # whole groups of fewer than BLOCK rows, and the one that is open

        def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            rows = np.unique(rows).view(np.uint64)
            signed = rows.view(np.int64)
            for links in links_by_blocks(rows, radius):
                found = np.array(links, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(signed[found[:, 0]]), pa.array(signed[found[:, 1]])], names=["a", "b"])

        for batch in batches:
            names = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)], 1)
            prints = batch.column(4).to_numpy()
            cuts = np.nonzero((names[1:] != names[:-1]).any(1))[0] + 1
            if held and (names[0] != last).any():
                cuts = np.concatenate([[0], cuts])
            last, at = names[-1], 0
            for cut in cuts.tolist():
                held.append(prints[at:cut])
                at = cut
                if sum(map(len, held)) >= BLOCK:
                    yield from linked(np.concatenate(held))
                    held = []
            held.append(prints[at:])
        if held:
            yield from linked(np.concatenate(held))

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_groups(printed: DataFrame, fp: str = "fingerprint", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """fp, root, component_id: the smallest fingerprint of the component, and the
    smallest key among all rows that can be reached (repeated keys may name several
    components alike, the root never does)."""
    own = write_stage(
        printed.groupBy(F.col(f"`{fp}`").alias("fp")).agg(F.min(F.col(f"`{key}`")).alias("least")), "prints"
    )
    roots = components(fingerprint_links(own.select("fp"), radius))
    placed = own.join(roots, own["fp"] == roots["vertex"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = write_stage(placed, "print-roots")
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(heads, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, fingerprint (16 hexadecimal digits), component_id."""
    printed = write_stage(
        with_fingerprints(docs.select(f"`{key}`", f"`{text}`"), text, "fp_", keep_text=False), "fingerprints"
    )
    groups = near_groups(printed, "fp_", key)
    return printed.join(groups, printed["fp_"] == groups["fp"]).select(
        printed[key],
        F.lower(F.lpad(F.hex("fp_"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one row with the
    smallest key (of several with that key, the first stored).

    Texts are stored once with their fingerprints; only keys and fingerprints
    are shuffled to find the rows that go.
    """
    columns = docs.columns
    fp = fresh(docs, "fp_")
    row = fresh(docs, "row_")
    made = with_fingerprints(docs, text, fp)
    stored = write_stage(made.withColumn(row, F.monotonically_increasing_id()), "printed-documents")
    groups = near_groups(stored.select(key, fp), fp, key)
    slim = stored.select(F.col(row).alias("r"), F.col(fp).alias("f"), F.col(f"`{key}`").alias("k"))
    first = (
        slim.join(groups, slim["f"] == groups["fp"])
        .where(F.col("k").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("r").alias("r"))
    )
    stays = write_stage(first.select(F.col("r").alias("stay")), "stays")
    # the rows that stay grow with the documents, so this join is never a broadcast
    kept = stored.join(stays.hint("merge"), stored[row] == stays["stay"], "left_semi")
    return kept.select(*(f"`{c}`" for c in columns))
