"""Language identification by nearest centroids.

A text becomes a vector of hashed letter pairs and triples, weighted by TF-IDF
and normalised. Each language has several centroids, found by spherical k-means
on its training vectors; a text gets the language of the centroid with the
largest cosine. A text farther from its centroid than nearly all training texts
of the language is marked as rejected: its language is the nearest, not a sure
one.

Whole texts are read. The fit sees a bounded sample of labelled rows
(``SAMPLE_ROWS``), evenly over the languages; the model's size depends on the
number of languages alone.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if nothing was labelled; ties go to the first language by name;
rows are judged one by one, repeated rows alike; an empty table gives an empty
table. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ship_package

#: Labelled rows that the fit sees, about this many at most, evenly over the languages.
SAMPLE_ROWS = 4_000
DIMENSIONS = 4096
CENTROIDS = 4
ROUNDS = 12
#: Share of training texts of a language that lie within its radius.
WITHIN = 0.995
#: Letters that are turned into vectors in one step.
STEP_LETTERS = 2_000_000

UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, with one blank before and after each word."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.concatenate([[32], code[keep], [32]]).astype(np.uint32)


def vectors(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashed n-gram counts, several texts at a time: (first row, float32 matrix)."""
    at = 0
    while at < len(texts):
        first, parts, letters = at, [], 0
        while at < len(texts) and (not parts or letters < STEP_LETTERS) and at - first < 256:
            parts.append(_codes(texts[at] or ""))
            letters += len(parts[-1])
            at += 1
        code = np.concatenate(parts).astype(np.uint64)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        counts = np.zeros(len(parts) * DIMENSIONS, np.float32)
        pair = code[:-1] * np.uint64(0x9E3779B1) + code[1:] * np.uint64(0x85EBCA77)
        triple = pair[:-1] * np.uint64(0xC2B2AE3D) + code[2:] * np.uint64(0x27D4EB2F)
        for gram, n in ((pair, 2), (triple, 3)):
            gram = (gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 12)
            whole = (row[: len(gram)] == row[n - 1 :]) & ((code[: len(gram)] != 32) | (code[n - 1 :] != 32))
            place = row[: len(gram)][whole] * DIMENSIONS + gram[whole].astype(np.int64)
            counts += np.bincount(place, minlength=len(counts)).astype(np.float32)
        yield first, counts.reshape(len(parts), DIMENSIONS)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


class CentroidModel:
    """IDF weights, centroids with their languages, and radii."""

    def __init__(self, langs: list[str], counts: np.ndarray, seed: int = 0):
        self.names = sorted(set(langs))
        n = len(langs)
        seen = (counts > 0).sum(0) if n else np.zeros(DIMENSIONS)
        self.idf = np.log((1 + n) / (1 + seen)).astype(np.float32) + np.float32(1)
        unit = self.weigh(counts) if n else np.zeros((0, DIMENSIONS), np.float32)
        centroids, owner, self.radius = [], [], []
        for k, name in enumerate(self.names):
            own = unit[np.array([x == name for x in langs])]
            found = _clusters(own, CENTROIDS, seed)
            centroids.append(found)
            owner += [k] * len(found)
            nearest = (own @ found.T).max(1)
            self.radius.append(float(np.quantile(1 - nearest, WITHIN)))
        self.centroids = np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32)
        self.owner = np.array(owner, int)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, far = [], [], []
        if not len(self.owner):
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for first, counts in vectors(texts):
            cosine = self.weigh(counts) @ self.centroids.T
            for text, row in zip(texts[first : first + len(counts)], cosine, strict=True):
                best = int(row.argmax())
                if has_letter(text):
                    score = min(1.0, max(0.0, float(row[best])))
                    langs.append(self.names[self.owner[best]])
                    scores.append(score)
                    far.append(1 - score > self.radius[self.owner[best]])
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    far.append(True)
        return langs, scores, far


def _clusters(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Up to ``k`` centroids by spherical k-means, started from far points."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    nearest = x @ centres[0]
    while len(centres) < min(k, len(x)) and nearest.min() < 0.999:
        centres.append(x[int(nearest.argmin())])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(ROUNDS):
        mine = (x @ c.T).argmax(1)
        c = np.stack([x[mine == i].sum(0) if (mine == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def held_out(key: Column) -> Column:
    """True for a quarter of the documents, which no fit sees."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, lang: str = "lang", text: str = "text", key: str = "doc_id") -> CentroidModel:
    """A model from rows with a language, read only from ``text`` and ``lang``.

    Languages are counted first; a hash of the key then picks the same number of
    rows of each. Executors turn them into vectors of a fixed size.
    """
    ship_package(labelled.sparkSession)
    known = labelled.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    counted = known.groupBy(F.col(f"`{lang}`").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    # one entry per language
    counts = counted.agg(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).first()[0]
    if not counts:
        return CentroidModel([], np.zeros((0, DIMENSIONS), np.float32))
    each = max(1, sample_rows // len(counts))
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(f"`{lang}`") == name, F.lit(min(1.0, each / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("fit")), F.lit(1 << 30)) / (1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, found in vectors(texts):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(found)),
                        pa.array([zlib.compress(row.tobytes(), 1) for row in found], pa.binary()),
                    ],
                    names=["lang", "vector"],
                )

    rows = (
        known.where(place < share)
        .select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
        .mapInArrow(run, "lang string, vector binary")
        .take(2 * sample_rows)
    )
    rows = sorted((r["lang"], zlib.decompress(r["vector"])) for r in rows)
    found = np.array([np.frombuffer(v, np.float32) for _, v in rows], np.float32).reshape(-1, DIMENSIONS)
    return CentroidModel([name for name, _ in rows], found)


def identify(docs: DataFrame, model: CentroidModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, lang_pred, score and rejected, from the text alone."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few centroids per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, scores, far = held.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                    names=[key, "lang_pred", "score", "rejected"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, rejected boolean"
    )
