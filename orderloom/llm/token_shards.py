"""Token ids in binary shards with a minimal perfect hash index.

A shard is one file: the raw ids of its documents one after the other, then the
index, then a footer that says where the parts are.

    ids | starts | keys | level bits | ranks | rows | copies | fingerprints | footer | length | mark

The index is minimal and perfect: each level hashes the keys that are still left
into a bit array and keeps those that are alone at their place; a key's number
is the count of set bits before its own. At that number stand the row of the
key's first document, how many documents bear the key, and a fingerprint that
turns away keys the shard does not hold. A lookup reads the footer and then single
entries, whose number does not grow with the shard.

Shards are ranges of the key, written in key order by the tasks of a range
partitioning; every attempt writes a file of its own name, and only the files
named in the manifest (a Parquet table) count, so lost or repeated tasks do no
harm. Ids take two bytes where the vocabulary allows it, else four.

Defined results: a null text is empty and holds the end id alone; documents with
equal keys lie side by side, ordered by a digest of their text, and are all found
under their key; null keys come first and are read in order; an empty table
makes no shard. Keys are whole numbers: others are cast to long, and a text that
is none stops the job. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import os
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.bpe_stream import WordBpe, byte_symbols
from orderloom.llm.common import ship_package
from orderloom.plans.stage_store import new_stage_path

MARK = b"IDSHARD1"
#: Bits of a level's array per key that it gets.
ROOM = 2
#: Entries of the tables of encoded runs and of their parts, each emptied when it is full.
REMEMBERED = 1_000_000
REMEMBERED_PARTS = 300_000
#: Texts that are encoded and written in one step.
STEP = 256

_SEPARATORS = regex.compile("[\x1c-\x1f]")


class LibraryEncoder:
    """Ids as bytes by the tokenizers library.

    Where the file drops white space, the runs between it are encoded apart by the
    library's model and remembered; with other files the library gets whole texts.
    """

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(description)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._kind = f"<u{self.width}"
        d = json.loads(description)
        self._apart = _white_space_dropped(d)
        if self._apart:
            self._runs = _Runs(self, description)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self._kind).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self._apart:
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [self.pack(e.ids) for e in found]
        known = self._runs.__getitem__
        # split() would cut at separators, the file does not: such texts are encoded whole
        return [
            self.pack(self.library.encode(t, add_special_tokens=False).ids)
            if _SEPARATORS.search(t)
            else b"".join(map(known, t.split()))
            for t in texts
        ]


class _Runs(dict):
    """Ids of runs of characters without white space, as bytes; emptied when full.

    A run's parts in normal form go to the library's BPE model."""

    def __init__(self, encoder: LibraryEncoder, description: str):
        self._encoder = encoder
        self._steps = WordBpe(description)
        self._added = tuple(self._steps.added)
        self._parts = _Parts(encoder.library.model, encoder.width)

    def __missing__(self, run: str) -> bytes:
        if any(t in run for t in self._added):
            found = self._encoder.pack(self._encoder.library.encode(run, add_special_tokens=False).ids)
        else:
            parts = self._steps.pieces(run)
            found = self._parts[parts[0]] if len(parts) == 1 else b"".join(map(self._parts.__getitem__, parts))
        if len(self) >= REMEMBERED:
            self.clear()
        self[run] = found
        return found


class _Parts(dict):
    """Ids of parts of runs, as bytes; emptied when full."""

    def __init__(self, model, width: int):
        self._model, self._kind, self._bytes = model, "H" if width == 2 else "I", byte_symbols()

    def __missing__(self, part: str) -> bytes:
        seen = part
        if not (part.isascii() and part.isprintable()):
            seen = "".join(map(self._bytes.__getitem__, part.encode()))
        ids = array(self._kind, [t.id for t in self._model.tokenize(seen)])
        if sys.byteorder == "big":
            ids.byteswap()
        if len(self) >= REMEMBERED_PARTS:
            self.clear()
        found = self[part] = ids.tobytes()
        return found


def _white_space_dropped(d: dict) -> bool:
    """True if the file's own steps throw white space away and cut at it."""
    try:
        cut = d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        WordBpe.steps(d)
        return cut.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    except (KeyError, TypeError, IndexError, ValueError):
        return False


_ENCODERS: dict[str, LibraryEncoder] = {}


def encoder(description: str) -> LibraryEncoder:
    name = hashlib.sha256(description.encode()).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = LibraryEncoder(description)
    return _ENCODERS[name]


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit keys."""
    z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Numbers 0 … n-1 for n different 64-bit keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray, ranks: np.ndarray | None = None):
        self.sizes, self.bits = sizes, bits
        counts = np.bitwise_count(bits).astype(np.uint64)
        self.ranks = np.cumsum(counts) - counts if ranks is None else ranks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            size = -(-len(keys) * ROOM // 64) * 64
            place = (_mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 or any number for keys that were not built in."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = (_mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = base + (place >> 6), (place & 63).astype(np.uint64)
            mine = self.bits[word]
            there = (mine >> bit) & np.uint64(1) == 1
            below = mine[there] & ((np.uint64(1) << bit[there]) - np.uint64(1))
            out[left[there]] = (self.ranks[word[there]] + np.bitwise_count(below)).astype(np.int64)
            left = left[~there]
            base += size // 64
        return out


def _print(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard: documents in key order, then the index."""

    def __init__(self, path: str, width: int):
        fs, inner = _filesystem(path)
        self.path, self.width = path, width
        self.out = fs.open_output_stream(inner)
        self.keys: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.nulls = 0

    def add(self, keys: list[int | None], payloads: list[bytes]) -> None:
        self.nulls += sum(k is None for k in keys)
        self.keys.append(np.array([0 if k is None else k for k in keys], "<i8"))
        self.sizes.append(np.array([len(p) // self.width for p in payloads], "<u8"))
        self.out.write(b"".join(payloads))

    def close(self) -> dict:
        keys, sizes = np.concatenate(self.keys), np.concatenate(self.sizes)
        starts = np.concatenate([np.zeros(1, "<u8"), np.cumsum(sizes)]).astype("<u8")
        own = keys[self.nulls :]
        distinct, first, copies = np.unique(own, return_index=True, return_counts=True)
        table = PerfectHash.build(distinct.view("<u8"))
        order = np.argsort(table.find(distinct.view("<u8")))
        parts = {
            "starts": starts,
            "keys": keys,
            "bits": table.bits.astype("<u8"),
            "ranks": table.ranks.astype("<u8"),
            "rows": (first[order] + self.nulls).astype("<u8"),
            "copies": copies[order].astype("<u8"),
            "prints": _print(distinct[order].view("<u8")),
        }
        at, places = int(starts[-1]) * self.width, {}
        for name, part in parts.items():
            self.out.write(part.tobytes())
            places[name] = [at, len(part), part.dtype.str]
            at += part.nbytes
        footer = json.dumps({"width": self.width, "nulls": self.nulls, "sizes": table.sizes, "parts": places}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MARK)
        self.out.close()
        return {
            "path": self.path,
            "first_key": None if self.nulls else int(keys[0]),
            "last_key": int(own[-1]) if len(own) else None,
            "n_docs": len(keys),
            "n_tokens": int(starts[-1]),
        }


class Shard:
    """One shard, opened for reading: the footer is read at once, single entries of the
    index and the ids when they are asked for, whole parts of the index once."""

    def __init__(self, path: str):
        fs, inner = _filesystem(path)
        self.file = fs.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MARK:
            raise ValueError(f"{path} is no shard")
        length = int.from_bytes(tail[:8], "little")
        footer = json.loads(self.file.read_at(length, size - 16 - length))
        self.width, self.nulls, self.sizes = footer["width"], footer["nulls"], footer["sizes"]
        self._places = footer["parts"]
        self._whole: dict[str, np.ndarray] = {}

    def whole(self, name: str) -> np.ndarray:
        """A part of the index, read once."""
        if name not in self._whole:
            at, n, kind = self._places[name]
            self._whole[name] = np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), kind)
        return self._whole[name]

    def entry(self, name: str, i: int, n: int = 1) -> list[int]:
        """A few neighbouring entries of a part of the index."""
        if name in self._whole:
            return self._whole[name][i : i + n].tolist()
        at, _, kind = self._places[name]
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(n * size, at + i * size), kind).tolist()

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of documents of each key; 0 documents if it is not here."""
        keys = keys.astype("<i8").view("<u8")
        number = PerfectHash(self.sizes, self.whole("bits"), self.whole("ranks")).find(keys)
        known = number >= 0
        known[known] = self.whole("prints")[number[known]] == _print(keys[known])
        rows, copies = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        rows[known], copies[known] = self.whole("rows")[number[known]], self.whole("copies")[number[known]]
        return rows, copies

    def _number(self, key: np.ndarray) -> int:
        """The place of one key in the index, by one entry per level that it goes down;
        -1 if it is surely not here."""
        base = 0
        for level, size in enumerate(self.sizes):
            place = int((_mixed(key, level) % np.uint64(size))[0])
            (bits,) = self.entry("bits", base + place // 64)
            if bits >> place % 64 & 1:
                (rank,) = self.entry("ranks", base + place // 64)
                return rank + (bits & ((1 << place % 64) - 1)).bit_count()
            base += size // 64
        return -1

    def ids(self, row: int) -> np.ndarray:
        """The ids of the document in a row, as unsigned 32-bit integers."""
        start, end = self.entry("starts", row, 2)
        raw = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document with this key. On average a key goes down less than
        two levels, so the reads do not grow with the shard."""
        own = np.array([key], "<i8").view("<u8")
        number = self._number(own)
        if number < 0 or self.entry("prints", number) != _print(own).tolist():
            return []
        (row,), (n,) = self.entry("rows", number), self.entry("copies", number)
        return [self.ids(r) for r in range(row, row + n)]


MANIFEST = "path string, first_key bigint, last_key bigint, n_docs bigint, n_tokens bigint, shard int"


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards and their manifest into ``folder``; returns the manifest.

    Texts are range-partitioned once, with a digest of the text to part a key
    that very many rows share; each task encodes and writes its range as it
    comes, holding one step of texts and a few numbers per document.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        held = spark.sparkContext.broadcast(file.read())  # a vocabulary, not data
    if "://" not in folder and not folder.startswith("/"):
        folder = os.path.abspath(folder)
    _filesystem(folder)[0].create_dir(_filesystem(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = encoder(held.value)
        end, writer, shard = made.pack([end_id]), None, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                payloads = [p + end for p in made.encode(piece.column(1).to_pylist())]
                if writer is None:
                    writer = ShardWriter(f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex[:12]}.bin", made.width)
                writer.add(piece.column(0).to_pylist(), payloads)
        if writer is not None:
            row = writer.close() | {"shard": shard}
            yield pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

    k = F.col(f"`{key}`").cast("long")
    rows = docs.select(k.alias("key"), F.col(f"`{text}`").alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc()]
    shards = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, MANIFEST)
    shards.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


_MANIFEST_ARROW = pa.schema(
    [("path", pa.string()), *((n, pa.int64()) for n in ("first_key", "last_key", "n_docs", "n_tokens")), ("shard", pa.int32())]
)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard with ``base``, the ids in all shards before it."""
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32.

    One task reads one or a few shards; keyed documents are found through the
    index, those without a key in their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                keys, starts = shard.whole("keys"), shard.whole("starts")
                wanted = np.unique(keys[shard.nulls :])
                rows, copies = shard.find(wanted)
                if int(copies.sum()) + shard.nulls != len(keys):
                    raise ValueError(f"the index of {path} does not fit its keys")
                found = [(None, r) for r in range(shard.nulls)]
                found += [(int(k), int(r) + i) for k, r, n in zip(wanted, rows, copies) for i in range(n)]
                for at in range(0, len(found), 4096):
                    part = found[at : at + 4096]
                    ids = [shard.ids(r) for _, r in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in part], pa.int64()),
                            pa.array([base + int(starts[r]) for _, r in part], pa.int64()),
                            pa.array([len(i) for i in ids], pa.int64()),
                            pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                        ],
                        names=[key, "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, manifest.count())
    return manifest.select("path", "base").repartition(n).mapInArrow(
        run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


class TokenStore:
    """Keyed access to a folder of shards from one process."""

    def __init__(self, spark: SparkSession, folder: str):
        shards = F.sort_array(F.collect_list(F.struct("shard", "path", "last_key")))
        rows = read_manifest(spark, folder).agg(shards).first()[0]  # one entry per shard
        self._paths = [r["path"] for r in rows if r["last_key"] is not None]
        self._last = [r["last_key"] for r in rows if r["last_key"] is not None]
        self._open: dict[str, Shard] = {}

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document with this key, in order."""
        out = []
        for i in range(bisect.bisect_left(self._last, key), len(self._paths)):
            path = self._paths[i]
            shard = self._open.setdefault(path, None) or Shard(path)
            self._open[path] = shard
            out += shard.get(key)
            if self._last[i] > key:
                break
        return out


def shard_digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write all documents to shards in the session's shared folder and read them back."""
    folder = new_stage_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, folder, path, end_id))
