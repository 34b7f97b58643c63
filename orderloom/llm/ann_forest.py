"""Approximate nearest neighbours by a forest of hash prefixes.

Vectors are dealt into blocks of about ``BLOCK`` rows. A block holds a forest:
each tree gives every vector a long hash string (32 signs of random
projections) and keeps the strings in a sorted array. A query goes down each
tree: its place in the sorted array has the entries with the longest common
prefix on both sides, and their prefix, of a length of its own in each tree, is
where the tree is entered. Then all trees go up together, one digit at a time
from the longest of these prefixes, and the entries that now share the shorter
prefix become candidates, until the chance that a vector as near as one of the
query's kept neighbours is still unseen in all trees is below ``MISS`` on average.
Nothing is capped: at the empty prefix every row of the block is a candidate.

Candidates are compared by their exact inner product in double precision. For
the hashes, inner products become angles: vectors are given one more component
that makes all norms of a block equal; queries get 0 there.

Every block is searched by every query, in blocks of queries; a query's best of
each block meet at the end. So the work grows with queries times rows, of which
the share in ``compared`` is compared.

Defined results: vectors that are null, zero, of another length than most or
that hold nulls or non-finite numbers take no part; ties go to the smaller id;
the query's own id is no candidate; with repeated ids every row is a candidate
under its id; rows with a null id take no part (ids are cast to long, and a text
that is no number stops the job); fewer candidates than asked for
give fewer rows; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import ship_package
from orderloom.plans.stage_store import write_stage

BLOCK = 16_384
QUERY_BLOCK = 1_024
TREES = 160
DIGITS = 32
#: Mean chance to miss a vector that is as near as a kept neighbour.
MISS = 0.1


@functools.lru_cache(maxsize=2)
def projections(width: int, trees: int) -> np.ndarray:
    return np.random.default_rng(width * 1000 + trees).standard_normal((width + 1, trees * DIGITS)).astype(np.float32)


def hash_strings(x: np.ndarray, extra: np.ndarray, trees: int) -> np.ndarray:
    """(trees, rows) hash strings of binary digits as numbers, first digit highest."""
    p = projections(x.shape[1], trees)
    signs = (x.astype(np.float32) @ p[:-1] + extra[:, None].astype(np.float32) * p[-1]) > 0
    packed = np.packbits(signs, axis=1).reshape(len(x), trees, DIGITS // 8)
    return np.ascontiguousarray(packed).view(">u4")[:, :, 0].astype(np.uint64).T.copy()


def _bit_length(x: np.ndarray) -> np.ndarray:
    """The number of binary digits of each number, 0 for 0."""
    return np.frexp(x.astype(float))[1]  # hash strings are exact as doubles


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int = TREES):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.trees = ids[order], x[order], trees
        self.norm = float(np.linalg.norm(self.x, axis=1).max())
        #: vectors in single precision, the longest of length 1: good enough to choose by
        self.units = (self.x / self.norm).astype(np.float32)
        extra = np.sqrt(np.maximum(self.norm**2 - (self.x**2).sum(1), 0))
        strings = hash_strings(self.x, extra, trees)
        self.rows = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.rows, 1)

    def _longest(self, strings: np.ndarray) -> np.ndarray:
        """Per tree and query: the length of the longest prefix that an entry shares,
        which is that of one of the two neighbours in the sorted array."""
        out = np.zeros(strings.shape, np.int64)
        for tree, (s, q) in enumerate(zip(self.strings, strings, strict=True)):
            place = np.searchsorted(s, q)
            for near in (np.maximum(place - 1, 0), np.minimum(place, len(s) - 1)):
                out[tree] = np.maximum(out[tree], DIGITS - _bit_length(s[near] ^ q))
        return out

    def _ranges(self, strings: np.ndarray, order: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query: the entries that share the first digits. ``order`` sorts
        the queries of each tree, neighbours are found faster after each other."""
        lo, hi = np.zeros(strings.shape, np.int64), np.full(strings.shape, len(self.ids), np.int64)
        if digits:
            shift = np.uint64(DIGITS - digits)
            low = (strings >> shift) << shift
            high = low | ((np.uint64(1) << shift) - np.uint64(1))
            for tree, (s, at) in enumerate(zip(self.strings, order, strict=True)):
                lo[tree, at] = np.searchsorted(s, low[tree, at], "left")
                hi[tree, at] = np.searchsorted(s, high[tree, at], "right")
        return lo, hi

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, miss: float = MISS) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """Per query: its id, the ids and scores of its best, and how many rows were compared."""
        strings = hash_strings(queries, np.zeros(len(queries)), self.trees)
        order = np.argsort(strings, axis=1)
        longest = self._longest(strings)
        ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by number of digits, made when needed
        entries, n = self.rows.ravel(), len(self.ids)
        units = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
        # products of units in single precision are off by less than this
        margin = 2 * (self.x.shape[1] + 8) * 2.0**-23
        for i, (name, q) in enumerate(zip(query_ids, queries, strict=True)):
            seen = self.ids == name
            best, cosines, compared = np.zeros(0, np.int64), np.zeros(0, np.float32), 0
            for digits in range(int(longest[:, i].max()), -1, -1):
                if digits not in ranges:
                    ranges[digits] = self._ranges(strings, order, digits)
                lo, hi = ranges[digits]
                # at the empty prefix one tree has every row
                entered = np.nonzero(longest[:, i] >= digits)[0] if digits else np.zeros(1, np.int64)
                size = hi[entered, i] - lo[entered, i]
                first = entered * n + lo[entered, i] - (np.cumsum(size) - size)
                found = entries[np.arange(size.sum()) + np.repeat(first, size)]
                fresh = np.zeros(n, bool)
                fresh[found] = True
                fresh[seen] = False
                new = np.flatnonzero(fresh)
                if not len(new):
                    continue
                seen[new] = True
                compared += len(new)
                best = np.concatenate([best, new])
                cosines = np.concatenate([cosines, self.units[new] @ units[i]])
                if len(best) >= k:
                    # all that may be as good as the last one kept
                    last = np.partition(cosines, -k)[-k]
                    keep = cosines >= last - margin
                    best, cosines = best[keep], cosines[keep]
                    if self._unseen(cosines, digits) <= miss:
                        break
            # one exact product per row, summed in one order: the same in every block
            scores = (self.x[best] * q).sum(1)
            first = np.lexsort((self.ids[best], -scores))[:k]
            yield int(name), self.ids[best[first]], scores[first], compared

    def _unseen(self, cosines: np.ndarray, digits: int) -> float:
        """The mean chance, over vectors as near as those kept, to be unseen in all trees."""
        same = 1 - np.arccos(np.clip(cosines, -1, 1)) / np.pi
        return float(((1 - same**digits) ** self.trees).mean())


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (doubles) of the rows that take part."""
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), v.cast("array<double>").alias("v")).where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    widths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == F.lit(widths["n"] if widths else 0))


def _packed(rows: DataFrame, parts: int, name: str) -> DataFrame:
    """Rows dealt by id into ``parts`` blocks, one packed row each (a few MB)."""

    def pack(block: pa.Table) -> pa.Table:
        ids = block["id"].combine_chunks()
        flat = block["v"].combine_chunks().flatten()
        order = np.argsort(ids.to_numpy(), kind="stable")
        x = flat.to_numpy().reshape(len(ids), -1)[order]
        return pa.table(
            {name: pa.array([block[name][0].as_py()], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "ids": [ids.to_numpy()[order].tobytes()], "x": [x.tobytes()]}
        )

    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    return rows.withColumn(name, block).groupBy(name).applyInArrow(
        pack, f"{name} int, n int, ids binary, x binary"
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK,
    trees: int = TREES,
    miss: float = MISS,
) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each row of ``queries``:
    query_id, rank (from 1), vec_id, score and compared (rows compared in all blocks)."""
    ship_package(vectors.sparkSession)
    rows = write_stage(usable(vectors, key, vector), "ann-vectors")
    asked = write_stage(usable(queries, key, vector), "ann-queries")
    n, m = rows.count(), asked.count()
    parts, asked_parts = max(1, -(-n // block_rows)), max(1, -(-m // QUERY_BLOCK))
    index = write_stage(_packed(rows, parts, "part"), "ann-index")
    packs = write_stage(
        _packed(asked, asked_parts, "pack").select("pack", "ids", "x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")),
        "ann-packs",
    )
    # a task per block, however small its bytes are
    pairs = index.repartition(parts, "part").join(
        packs.select("part", F.col("ids").alias("q_ids"), F.col("x").alias("q_x")).repartition(parts, "part").hint("merge"), "part"
    )
    made: dict[bytes, Forest] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, x, q_ids, q_x = (batch.column(c)[row].as_py() for c in range(4))
                if ids not in made:  # pairs of one block follow each other
                    made.clear()
                    names = np.frombuffer(ids, np.int64)
                    made[ids] = Forest(names, np.frombuffer(x, float).reshape(len(names), -1), trees)
                names = np.frombuffer(q_ids, np.int64)
                asked = np.frombuffer(q_x, float).reshape(len(names), -1)
                found = list(made[ids].search(names, asked, k, miss))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                            pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                            pa.array(np.concatenate([f[2] for f in found]), pa.float64()),
                            pa.array(np.repeat([f[3] for f in found], [len(f[1]) for f in found]), pa.int64()),
                        ],
                        names=["query_id", "vec_id", "score", "compared"],
                    )

    found = pairs.select("ids", "x", "q_ids", "q_x").mapInArrow(
        run, "query_id bigint, vec_id bigint, score double, compared bigint"
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "compared")
    )
