"""URL filters: fixed rules first, gradient-boosted trees for the rest.

The trees are trained on URLs that a rule has labelled, on lexical features:
lengths, depth, digit ratio, entropy, parameter counts and suffix statistics
(how often labelled URLs with the same last host labels, or the same first
directory, were blocked, smoothed).

The sample is bounded by ``SAMPLE_ROWS``; every URL is judged.

Defined results: a URL that is null or has no ``://`` has an empty host and path
and is judged by the trees; repeated rows are judged alike; an empty table gives
an empty table; without labelled rows, or with one label only, the trees give
that label (allow if there is none). Extra columns pass through; columns with
the names of results are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from xxhash import xxh3_128_hexdigest

from orderloom.llm.common import ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Labelled rows that the trees see, about this many at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "other_ratio", "entropy", "parameters", "query_length", "last_label", "last_two_labels", "last_three_labels", "directory",
)
RESULTS = ("host", "path", "rule", "verdict")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.expr("''")
    rest = F.when(known, F.substr(url, F.instr(url, "://") + 3)).otherwise(rest)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _suffixes(host: str, path: str) -> tuple[str, ...]:
    """What statistics are kept of: ends of the host, and the path's first directory."""
    labels = host.rsplit(".", 3)
    ends = (".".join(labels[-n:]) for n in (1, 2, 3))
    return tuple(map(_key, (*ends, "/" + path[1:].split("/", 1)[0])))


def _key(part: str) -> str:
    """A whole part of a URL, long ones by a 128-bit hash, which begins with a blank."""
    return part if len(part) <= 64 else " " + xxh3_128_hexdigest(part.encode("utf-8", "surrogatepass"))


def features(host: str, path: str, url: str | None, rates: dict[str, float], prior: float) -> list[float]:
    url = url or ""
    query = re.search(r"\?([^#]*)", url)
    query = query[1] if query else ""
    n = len(url) or 1
    digits = sum(map(str.isdigit, url))
    letters = sum(map(str.isalpha, url))
    return [
        len(url), len(host), len(path), host.count("."), path.count("/"),
        digits / n, (n - digits - letters) / n,
        -sum(c / n * math.log2(c / n) for c in Counter(url).values()),
        sum(1 for x in re.split("[&;]", query) if x), len(query),
        *(rates.get(s, prior) for s in _suffixes(host, path)),
    ]


class Trees:
    """Boosted complete trees of one depth for the logistic loss."""

    def __init__(self, base: float, splits: np.ndarray, cuts: np.ndarray, leaves: np.ndarray):
        self.base, self.splits, self.cuts, self.leaves = base, splits, cuts, leaves

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], 1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        base = math.log(share / (1 - share))
        score = np.full(n, base)
        splits = np.zeros((trees, 2**depth - 1), int)
        cuts = np.full((trees, 2**depth - 1), np.inf)
        leaves = np.zeros((trees, 2**depth))
        for t in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-12)
            node = np.zeros(n, int)
            for level in range(depth):
                count, first = 2**level, 2**level - 1
                best = np.full(count, 1e-9)
                for f in range(width):
                    if not len(edges[f]):
                        continue
                    place = node * (bins + 1) + binned[:, f]
                    sums = [np.bincount(place, w, count * (bins + 1)).reshape(count, -1) for w in (g, h)]
                    gl, hl = (s.cumsum(1)[:, : len(edges[f])] for s in sums)
                    gs, hs = (s.sum(1, keepdims=True) for s in sums)
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    at = gain.argmax(1)
                    for i in np.nonzero(gain[np.arange(count), at] > best)[0]:
                        best[i] = gain[i, at[i]]
                        splits[t, first + i], cuts[t, first + i] = f, edges[f][at[i]]
                own = first + node
                node = 2 * node + (x[np.arange(n), splits[t, own]] > cuts[t, own])
            sums = [np.bincount(node, w, 2**depth) for w in (g, h)]
            leaves[t] = rate * sums[0] / (sums[1] + 1)
            score += leaves[t, node]
        return cls(base, splits, cuts, leaves)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of a block."""
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(math.log2(self.leaves.shape[1]))
        for split, cut, leaf in zip(self.splits, self.cuts, self.leaves):
            node = np.zeros(len(x), int)
            for level in range(depth):
                own = 2**level - 1 + node
                node = 2 * node + (x[rows, split[own]] > cut[own])
            score += leaf[node]
        return 1 / (1 + np.exp(-score))


class UrlModel:
    """Suffix statistics and trees, from labelled URLs."""

    def __init__(self, rows: Sequence[tuple[str, str, str | None, bool]]):
        blocked = np.array([r[3] for r in rows], float)
        self.prior = float(blocked.mean()) if len(rows) else 0.0
        seen: dict[str, list[float]] = {}
        for (host, path, *_), b in zip(rows, blocked, strict=True):
            for s in set(_suffixes(host, path)):
                counts = seen.setdefault(s, [0.0, 0.0])
                counts[0] += b
                counts[1] += 1
        self.rates = {s: (b + 4 * self.prior) / (n + 4) for s, (b, n) in seen.items()}
        self.trees = None
        if 0 < self.prior < 1:
            self.trees = Trees.fit(self.matrix([r[:3] for r in rows]), blocked)

    def matrix(self, rows: Sequence[tuple[str, str, str | None]]) -> np.ndarray:
        made = [features(h, p, u, self.rates, self.prior) for h, p, u in rows]
        return np.array(made, float).reshape(len(rows), len(FEATURES))

    def predict(self, rows: Sequence[tuple[str, str, str | None]]) -> np.ndarray:
        if self.trees is None or not len(rows):
            return np.full(len(rows), self.prior)
        return self.trees.predict(self.matrix(rows))


def fit(ruled: DataFrame, url: str = "url", sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """A model from the rows that a rule has judged (columns host, path, verdict).

    Rows are taken by a hash of the URL, so the share is the same everywhere and
    nothing is sorted or gathered before it is small.
    """
    known = ruled.where(F.col("verdict").isNotNull())
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    place = F.pmod(F.xxhash64(F.col(f"`{url}`")), F.lit(1 << 30))
    rows = (
        known.where(place <= int(share * (1 << 30)))
        .select("host", "path", F.col(f"`{url}`").alias("url"), (F.col("verdict") == "block").alias("b"))
        .take(2 * sample_rows)
    )
    return UrlModel(sorted((r["host"], r["path"], r["url"], r["b"]) for r in rows))


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (the trees', for every row)."""
    ship_package(pages.sparkSession)
    taken = {*RESULTS, "block_score"}
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in taken]
    host, path = split_url(F.col(f"`{url}`"))
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("*", rule.alias("rule"), verdict.alias("verdict"))
    model = fit(ruled.select("host", "path", "verdict", F.col(f"`{url}`")), url, sample_rows)

    at = [ruled.columns.index(c) for c in ("host", "path", url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in at), strict=True))
            scores = pa.array(model.predict(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "block_score"])

    scored = ruled.mapInArrow(run, StructType([*ruled.schema.fields, StructField("block_score", DoubleType())]))
    by_trees = F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("verdict", by_trees))
