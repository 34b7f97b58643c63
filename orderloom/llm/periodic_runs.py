"""Periodic runs of words, by the longest common extensions of suffix trees.

A run is a stretch of words with smallest period q, of at least ``MIN_WORDS``
words and ``MIN_TURNS`` periods, that no neighbouring word extends.

Every run holds a Lyndon word as its root in one of two opposite orders of the
words, and it is the longest Lyndon word that starts at its place (Bannai et al.,
"The runs theorem"). So the longest Lyndon words of all places, in both orders,
are the candidates; each is extended to the right by the longest common extension
of its two ends, and to the left likewise in the reversal. Both trees are built
by Ukkonen's algorithm. A common extension is the depth of the lowest common
ancestor of two leaves; of the Euler tour, the depths passed between neighbouring
leaves are kept in a table of minima, which answers in constant time.

Trees are grown only where a run can lie. In a run of period q, each window of
``GRAM`` words from its second period on has occurred at most q words before;
stretches of places where that holds, for q up to 2, 4, 8 and so on, are found
for many documents at once and widened by q, and no run is outside of them.

Documents are worked on one by one inside their task, in memory that grows with
the longest one. Defined results: words are separated by blanks, tabs and line
ends; a null or blank text has no words and no runs; repeated rows are documents
of their own; an empty table gives an empty table. Columns named like the results
are replaced, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from orderloom.llm.common import ship_package, words

MIN_WORDS = 24
MIN_TURNS = 3
#: Words of the windows that show where runs can be.
GRAM = 8
#: Words that are looked through at a time.
CHUNK_WORDS = 1 << 17

RESULTS = ("n_words", "runs", "kept_text")
_RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
_TYPES = (LongType(), ArrayType(_RUN), StringType())
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def suffix_tree(s: list[int], k: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once and all are below ``k``:
    child by node * k + symbol, and the label of the edge to each node as a range."""
    n = len(s)
    child: dict[int, int] = {}
    start, stop, link = [0], [0], [0]
    node = edge = length = rest = 0
    for i, symbol in enumerate(s):
        rest += 1
        waiting = 0  # an inner node without its suffix link
        while rest:
            if not length:
                edge = i
            key = node * k + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                first = start[below]
                size = stop[below] - first
                if length >= size:
                    node, edge, length = below, edge + size, length - size
                    continue
                if s[first + length] == symbol:
                    if waiting:
                        link[waiting] = node
                    length += 1
                    break
                middle = len(start)
                start += (first, i)
                stop += (first + length, n)
                link += (0, 0)
                start[below] = first + length
                child[key] = middle
                child[middle * k + symbol] = middle + 1
                child[middle * k + s[first + length]] = below
                if waiting:
                    link[waiting] = middle
                waiting = middle
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return child, start, stop


class Extensions:
    """Longest common extensions of the suffixes of a text."""

    def __init__(self, text: np.ndarray, k: int, both_orders: bool = False):
        """``text`` holds numbers from 1 to k - 1."""
        self.n = len(text)
        child, start, stop = suffix_tree([*text.tolist(), 0], k)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        del child
        size = np.array(stop) - np.array(start)
        above, symbol = keys // k, keys % k
        self.leaves, depths = self._tour(above, symbol, nodes, size)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[self.leaves] = np.arange(self.n + 1)
        self.back = None
        if both_orders:
            # the end of the text stays the smallest symbol in the opposite order
            leaves, _ = self._tour(above, np.where(symbol > 0, k - symbol, 0), nodes, size)
            self.back = np.empty(self.n + 1, np.int64)
            self.back[leaves] = np.arange(self.n + 1)
        self.minima = [depths]
        while (width := 1 << len(self.minima)) <= len(depths):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[: len(last) - width // 2], last[width // 2 :]))

    def _tour(self, above: np.ndarray, symbol: np.ndarray, nodes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the tour, and the depth of the deepest node above
        each two neighbours."""
        order = np.lexsort((-symbol, above))
        kids = nodes[order].tolist()
        bounds = np.searchsorted(above[order], np.arange(len(size) + 1)).tolist()
        sizes = size.tolist()
        end = self.n + 1
        leaves, depths = [], []
        stack = list(zip(kids[: bounds[1]], [0] * bounds[1], strict=True))
        branch = 0
        while stack:
            node, depth = stack.pop()
            if branch < 0:
                branch = depth
            own = depth + sizes[node]
            a, b = bounds[node], bounds[node + 1]
            if a == b:
                leaves.append(end - own)
                depths.append(branch)
                branch = -1
            else:
                stack += [(kid, own) for kid in kids[a:b]]
        return np.array(leaves), np.array(depths[1:], np.int32)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many symbols from there agree."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for i in np.unique(level).tolist():
            at = level == i
            table = self.minima[i]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << i)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller suffix; the last rank is the end's."""
    out = [0] * (len(rank) - 1)
    stack: list[int] = []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(text: np.ndarray, k: int) -> np.ndarray:
    """The runs (start, length, period) of a sequence of numbers from 1 to k - 1."""
    n = len(text)
    ahead = Extensions(text, k, both_orders=True)
    places = np.arange(n)
    ends = [np.array(_next_smaller(rank.tolist())) for rank in (ahead.rank, ahead.back)]
    pairs = np.unique(np.concatenate([places * (n + 1) + end for end in ends]))
    i, j = pairs // (n + 1), pairs % (n + 1)
    right = ahead.of(i, j)
    del ahead
    behind = Extensions(text[::-1], k)
    left = behind.of(n - i, n - j)  # of the words before i and before j
    period = j - i
    start, length = i - left, period + right + left
    found = length >= np.maximum(MIN_WORDS, MIN_TURNS * period)
    return np.unique(np.stack([start, length, period], 1)[found], axis=0)


def _stretches(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of places outside of which there is no run, from the words' hashes of
    several documents one after the other; ranges of one document do not touch."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < MIN_WORDS:
        return none, none
    gram, factor, width = hashes, _FACTOR, 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            gram = gram[: len(gram) - width] * factor + gram[width:]
            factor, width = factor * factor, width * 2
        doc = np.repeat(np.arange(len(sizes)), sizes)
        gram = (gram ^ (gram >> np.uint64(29))) * _FACTOR + doc[: len(gram)].astype(np.uint64)
    whole = np.nonzero(doc[: len(gram)] == doc[GRAM - 1 :])[0]
    order = whole[np.argsort(gram[whole], kind="stable")]
    again = gram[order[1:]] == gram[order[:-1]]
    places, gaps = order[1:][again], (order[1:] - order[:-1])[again]
    by_place = np.argsort(places)
    places, gaps = places[by_place], gaps[by_place]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    first, last = [], []
    q, least = 1, 1
    longest = int(sizes.max())
    while least * MIN_TURNS <= longest and len(places):
        near = places[gaps <= q]
        if len(near):
            # windows of a run's later periods, fewest over the periods from least to q
            need = min(max(MIN_WORDS - p, (MIN_TURNS - 1) * p) - GRAM + 1 for p in {least, q, min(max(MIN_WORDS // MIN_TURNS, least), q)})
            cuts = np.nonzero((np.diff(near) != 1) | (np.diff(doc[near]) != 0))[0] + 1
            a, b = near[np.concatenate([[0], cuts])], near[np.concatenate([cuts, [len(near)]]) - 1]
            keep = b - a + 1 >= max(1, need)
            a, b = a[keep], b[keep]
            first.append(np.maximum(a - q - 1, begins[doc[a]]))
            last.append(np.minimum(b + GRAM + 1, ends[doc[a]]))
        least, q = q + 1, q * 2
    if not first:
        return none, none
    a, b = np.concatenate(first), np.concatenate(last)
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.concatenate([[True], (a[1:] > reach[:-1]) | (doc[a[1:]] != doc[a[:-1]])]) if len(a) else np.zeros(0, bool)
    heads = np.nonzero(new)[0]
    return a[heads], reach[np.concatenate([heads[1:], [len(a)]]) - 1] if len(a) else none


def _judged(texts: list[list[bytes]]) -> list[tuple[int, list[dict[str, int]], str]]:
    """Number of words, runs and kept text of each document."""
    sizes = np.array([len(t) for t in texts])
    flat = [w for t in texts for w in t]
    hashes = np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64)
    first, last = _stretches(hashes, sizes)
    doc = np.searchsorted(np.cumsum(sizes), first, side="right").tolist()
    begins = (np.cumsum(sizes) - sizes).tolist()
    found: dict[int, list[np.ndarray]] = {}
    for d, a, b in zip(doc, first.tolist(), last.tolist(), strict=True):
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number) + 1) for w in flat[a:b]])
        runs = runs_of(ids, len(number) + 1)
        if len(runs):
            runs[:, 0] += a - begins[d]
            found.setdefault(d, []).append(runs)
    out = []
    for d, own in enumerate(texts):
        runs = np.concatenate(found[d]) if d in found else np.zeros((0, 3), np.int64)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        if len(runs):
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
            own = list(compress(own, (np.cumsum(edge)[:-1] == 0).tolist()))
        told = [{"start": s, "length": size, "period": p} for s, size, p in runs.tolist()]
        out.append((int(sizes[d]), told, b" ".join(own).decode("utf-8", "surrogatepass")))
    return out


def find_runs(docs: DataFrame, text: str = "text", text_needed: bool = True) -> DataFrame:
    """``docs`` (without the text if it is not needed) with n_words, runs - start (number
    of a word), length and period, by start and period - and kept_text: the words,
    joined by one blank, that no run holds after its first period."""
    ship_package(docs.sparkSession)
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() not in RESULTS))
    at = docs.columns.index(text)
    passed = [i for i in range(len(docs.columns)) if text_needed or i != at]
    schema = StructType([*(docs.schema.fields[i] for i in passed), *(StructField(n, t) for n, t in zip(RESULTS, _TYPES, strict=True))])
    arrow = [to_arrow_type(t) for t in _TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size = 0, [], 0
            for i, value in enumerate(batch.column(at)):
                # of bytes, split() cuts at the six blanks alone
                held.append((value.as_py() or "").encode("utf-8", "surrogatepass").split())
                size += len(held[-1])
                if size >= CHUNK_WORDS or i + 1 == batch.num_rows:
                    told, part = _judged(held), batch.slice(first, i + 1 - first)
                    columns = [*(part.column(c) for c in passed), *(pa.array([t[c] for t in told], kind) for c, kind in enumerate(arrow))]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    first, held, size = i + 1, [], 0

    return docs.mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a periodic end in about a tenth of the texts, by the CRC-32 of the
    key; a null key plants nothing."""
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    own = words(F.col(f"`{text}`"))
    g, n = F.floor(h / 10), F.size(own)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turns = F.array_repeat(F.slice(own, a + 1, p), F.ceil((n - a) / p).cast("int"))
    made = F.concat(F.slice(own, F.lit(1), a), F.slice(F.flatten(turns), F.lit(1), n - a))
    return docs.withColumn(text, F.when((h % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(F.col(f"`{text}`")))


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, n_runs, the run of the greatest length by periods (start, length,
    period, exponent_milli), runs_sha256 and collapsed_sha256."""
    # runs are sorted by start and period, so the first of equals stays
    better = lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        f"`{key}`", F.size("runs").cast("long").alias("n_runs"), F.aggregate("runs", none, better).alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    ).select(
        f"`{key}`", "n_runs", "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
