"""BPE encoding and decoding as a streaming transducer.

Encoding keeps a window of symbols. From the merge list alone it is computed how
far a change at the right end of a window can reach to the left (the sufficient
lookahead): a merge moves the place from which two continuations differ left by
the length of its left part, and only a later merge whose right part begins at
that place can move it further, so the longest such chain bounds the reach.
Tokens that end before the last ``lookahead`` symbols of the window are stable
and are emitted; the window goes on from there. Every part of a text goes through the
transducer; the tokens of short parts are remembered in a bounded table. A text
is read in pieces of about ``PIECE`` characters that end at white space, and its
tokens come out piece by piece, so besides the text itself memory is bounded by
a piece, a window and the longest run of characters without white space.

Decoding feeds token bytes to an incremental byte-to-text machine that holds
back at most an unfinished character; it takes the encoder's pieces as they come.

Defined results: a null text is empty and has no tokens; the marks of added
tokens that occur in a text are that token, as in the tokenizers library; rows
are independent, so repeated rows, ids and extra columns do not matter.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderloom.llm.common import ship_package

#: Symbols that a window holds besides the lookahead.
WINDOW = 4096
#: Words longer than this are streamed, shorter ones are remembered.
WORD_CHARS = 64
#: Entries of the table of words, which is emptied when it is full.
REMEMBERED = 300_000
#: Ids that are decoded in one step.
DECODE_BLOCK = 8192
#: Characters of a text that are encoded in one step.
PIECE = 1 << 16

#: Token numbers and ranks share one integer.
BITS = 24
MASK = (1 << BITS) - 1
NO_RULE = 1 << 62

#: The characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r\x20\x85\xa0  -     　"
_GAP = regex.compile(f"[{WHITE_SPACE}]+")
#: Characters at which str.split() cuts although they are no White_Space.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The visible character of each byte: printable Latin-1 stands for itself,
    the others are numbered from code point 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class MergeList:
    """Merges over token numbers, and how far ahead they look."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]):
        self.vocab = vocab
        #: pair of tokens (first << BITS | second) -> rank << BITS | merged token
        self.rules: dict[int, int] = {}
        parts = []
        for rank, (left, right) in enumerate(merges):
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            rule = rank << BITS | ab
            if self.rules.setdefault(a << BITS | b, rule) == rule:
                parts.append((a, b, ab))
        self.lookahead = self._sufficient(parts)

    def _sufficient(self, parts: list[tuple[int, int, int]]) -> int:
        length, left_part = {}, {}
        for a, b, ab in parts:
            length[ab] = length.get(a, 1) + length.get(b, 1)
            left_part.setdefault(ab, set()).add(a)
        reach: dict[int, int] = {}  # of the later merges whose right part begins with a token
        most = 0
        for a, b, ab in reversed(parts):
            far = length.get(a, 1) + max(reach.get(a, 0), reach.get(ab, 0))
            most = max(most, far)
            todo, seen = [b], set()
            while todo:
                if (t := todo.pop()) not in seen:
                    seen.add(t)
                    reach[t] = max(reach.get(t, 0), far)
                    todo += left_part.get(t, ())
        return most

    def merge(self, tokens: list[int]) -> list[int]:
        """All merges of one window: the earliest rule first, leftmost first."""
        return self._merge_few(tokens) if len(tokens) <= 32 else self._merge_many(tokens)

    def _merge_few(self, tokens: list[int]) -> list[int]:
        tokens = list(tokens)
        rule = self.rules.get
        found = [rule(a << BITS | b, NO_RULE) for a, b in zip(tokens, tokens[1:])]
        while found and (best := min(found)) < NO_RULE:
            i = found.index(best)
            tokens[i : i + 2] = [best & MASK]
            del found[i]
            if i:
                found[i - 1] = rule(tokens[i - 1] << BITS | tokens[i], NO_RULE)
            if i < len(found):
                found[i] = rule(tokens[i] << BITS | tokens[i + 1], NO_RULE)
        return tokens

    def _merge_many(self, tokens: list[int]) -> list[int]:
        """The same with a heap, for long windows."""
        n, tokens, rule = len(tokens), list(tokens), self.rules.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = (rule(a << BITS | b) for a, b in zip(tokens, tokens[1:]))
        heap = [(r, i) for i, r in enumerate(found) if r is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or rule(tokens[i] << BITS | tokens[j]) != r:
                continue
            tokens[i], tokens[j] = r & MASK, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := rule(tokens[i] << BITS | tokens[k])) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := rule(tokens[h] << BITS | tokens[i])) is not None:
                heapq.heappush(heap, (new, h))
        return [t for t in tokens if t >= 0]

    def stream(self, symbols: Iterable[int], sizes: dict[int, int], window: int = WINDOW) -> Iterator[int]:
        """Tokens of an endless run of symbols, each as soon as it is stable."""
        buffer: list[int] = []
        full = window + self.lookahead
        for s in symbols:
            buffer.append(s)
            if len(buffer) >= full:
                end, stable = 0, len(buffer) - self.lookahead
                for t in self.merge(buffer):
                    if end + sizes.get(t, 1) > stable:
                        break
                    end += sizes.get(t, 1)
                    yield t
                del buffer[:end]
                full = len(buffer) + window
        yield from self.merge(buffer)


class ByteToText:
    """Text of bytes that come in pieces; only an unfinished character waits."""

    def __init__(self) -> None:
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, piece: bytes) -> str:
        return self._machine.decode(piece)

    def close(self) -> str:
        return self._machine.decode(b"", True)


class _Words(dict):
    """Token numbers of runs without white space, as bytes, for a bounded number of runs."""

    def __init__(self, codec: WordBpe):
        self.codec = codec
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > WORD_CHARS:
            return array("I", self.codec.encode_word(word)).tobytes()
        found = b"".join(map(self._part, self.codec.pieces(word)))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def _part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= REMEMBERED // 2:
                self.parts.clear()
            found = self.parts[text] = array("I", self.codec.encode_part(text)).tobytes()
        return found

    def forget(self) -> None:
        self.clear()
        self.parts.clear()


class WordBpe:
    """Encoder and decoder for a tokenizer file of the word-end kind.

    The file's steps must be: NFC, white space to blanks, lower case; cut by its
    pattern; bytes to visible characters; BPE with a mark at the end of words.
    """

    def __init__(self, description: str):
        d = json.loads(description)
        cut, model = self.steps(d)
        vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = MergeList(vocab, pairs)
        end = model["end_of_word_suffix"] or ""
        chars = byte_symbols()
        self._inner = [vocab[c] for c in chars]
        self._last = [vocab[c + end] for c in chars]
        cut_end = lambda t: t[: -len(end)] if end and t.endswith(end) else t
        self._sizes = {i: len(cut_end(t)) for t, i in vocab.items()}
        self._pattern = regex.compile(cut["pattern"]["Regex"].replace(r"\s", WHITE_SPACE))
        self.added = {t["content"]: t["id"] for t in d["added_tokens"]}
        marks = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self._added = regex.compile(f"({marks})") if marks else None
        surface = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self._surface = [surface.get(i, "").encode() for i in range(max(surface) + 1)]
        of_char = {c: bytes([b]) for b, c in enumerate(chars)}
        self._raw = [
            b"".join(of_char.get(c, c.encode()) for c in cut_end(surface.get(i, "")))
            + (b" " if end and surface.get(i, "").endswith(end) else b"")
            for i in range(len(self._surface))
        ]
        self._words = _Words(self)

    @staticmethod
    def steps(d: dict) -> tuple[dict, dict]:
        """The cutting step and the model, if the file's steps are the known ones."""
        kinds = [n["type"] for n in d["normalizer"]["normalizers"]]
        cut, level = d["pre_tokenizer"]["pretokenizers"]
        model = d["model"]
        if (
            kinds != ["NFC", "Replace", "Lowercase"]
            or (cut["type"], cut["behavior"], cut["invert"]) != ("Split", "Removed", True)
            or (level["type"], level["add_prefix_space"], level["use_regex"]) != ("ByteLevel", False, False)
            or (model["type"], model["unk_token"], d["decoder"]) != ("BPE", None, None)
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in d["added_tokens"])
        ):
            raise ValueError("the tokenizer file has steps that this encoder does not know")
        return cut, model

    def pieces(self, word: str) -> list[str]:
        """The parts of a run of characters without white space, in normal form."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
            # letter by letter: str.lower() alone has a rule for sigma at word ends
            word = word.replace("Σ", "σ")
        word = word.lower()
        return [word] if word.isalpha() else self._pattern.findall(word)

    def encode_part(self, text: str) -> Iterator[int]:
        """Tokens of a part of a run, in normal form."""
        piece = text.encode()
        symbols = map(self._inner.__getitem__, memoryview(piece)[:-1])
        return self.merges.stream(chain(symbols, (self._last[piece[-1]],)), self._sizes)

    def encode_word(self, word: str) -> Iterator[int]:
        """Tokens of a run of characters without white space."""
        return chain.from_iterable(map(self.encode_part, self.pieces(word)))

    def encode(self, text: str | None) -> array:
        """Token numbers of a whole text."""
        out = array("I")
        for piece in self.encode_pieces(text):
            out.frombytes(piece)
        return out

    def encode_pieces(self, text: str | None) -> Iterator[bytes]:
        """Token numbers of a text, piece by piece, as the bytes of an array of ``I``."""
        for part, token in self._marked(text or ""):
            if token is not None:
                yield array("I", [token]).tobytes()
            at = 0
            while at < len(part):
                gap = _GAP.search(part, at + PIECE)
                end = gap.start() if gap else len(part)
                piece = part if not at and end == len(part) else part[at:end]
                at = end
                runs = _GAP.split(piece) if _SEPARATORS.search(piece) else piece.split()
                if len(piece) <= 2 * PIECE:
                    yield b"".join(map(self._words.__getitem__, runs))
                else:  # the last run is a long one
                    for run in runs:
                        ids = self.encode_word(run)
                        while block := array("I", islice(ids, DECODE_BLOCK)):
                            yield block.tobytes()

    def _marked(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between marks of added tokens, and their numbers, in order."""
        at = 0
        for mark in self._added.finditer(text) if self._added else ():
            yield text[at : mark.start()], None
            yield "", self.added[mark[0]]
            at = mark.end()
        yield text[at:], None

    def forget(self) -> None:
        """Give back the memory of the remembered words."""
        self._words.forget()

    def decode(self, ids: Iterable[int], surface: bool = True) -> Iterator[str]:
        """Pieces of text: the tokens' own strings with blanks between them, as the
        library gives for a file without a decoder, or (``surface=False``) the
        text that the bytes stand for, with blanks at word ends."""
        made, ids = self.decoder(surface), iter(ids)
        while block := list(islice(ids, DECODE_BLOCK)):
            yield made.feed(block)
        yield made.close()

    def decoder(self, surface: bool = True) -> IdsToText:
        return IdsToText(self._surface, b" ") if surface else IdsToText(self._raw, b"")


class IdsToText:
    """Text of ids that come in pieces."""

    def __init__(self, table: list[bytes], gap: bytes):
        self._table, self._gap, self._machine, self._first = table, gap, ByteToText(), True

    def feed(self, ids: Iterable[int]) -> str:
        found = self._gap.join(map(self._table.__getitem__, ids))
        before, self._first = b"" if self._first else self._gap, False
        return self._machine.feed(before + found)

    def close(self) -> str:
        return self._machine.close()


_CODECS: dict[str, WordBpe] = {}


def codec(description: str) -> WordBpe:
    """One encoder per worker and file."""
    name = hashlib.sha256(description.encode()).hexdigest()
    if name not in _CODECS:
        _CODECS[name] = WordBpe(description)
    return _CODECS[name]


def little_endian(ids: array | bytes) -> bytes:
    """The ids as unsigned 32-bit integers, lowest byte first."""
    return np.frombuffer(ids, dtype=np.uintc).astype("<u4").tobytes() if len(ids) else b""


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens and digests of the ids and of the text decoded from them."""
    ship_package(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary, not data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(held.value)
        bpe.forget()  # what the task before has left
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for value in batch.column(1):
                n, id_digest, text_digest, made = 0, hashlib.sha256(), hashlib.sha256(), bpe.decoder()
                for piece in bpe.encode_pieces(value.as_py()):
                    if not piece:
                        continue
                    ids = memoryview(piece).cast("I")
                    n += len(ids)
                    id_digest.update(little_endian(piece))
                    text_digest.update(made.feed(ids).encode())
                text_digest.update(made.close().encode())
                counts.append(n)
                of_ids.append(id_digest.hexdigest())
                of_text.append(text_digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.forget()
        pa.default_memory_pool().release_unused()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def encode_ids(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the column ``ids``: the token numbers, 32 bits each, lowest byte first.
    A column of that name is replaced."""
    ship_package(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() != ids.lower()))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(held.value)
        for batch in batches:
            made = [little_endian(bpe.encode(v.as_py())) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, ids])

    from pyspark.sql.types import BinaryType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids, BinaryType())]))


def decode_ids(docs: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded", surface: bool = True) -> DataFrame:
    """``docs`` with the column ``text`` decoded from ``ids``. A column of that name is replaced."""
    ship_package(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() != text.lower()))
    at = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(held.value)
        for batch in batches:
            made = ["".join(bpe.decode(np.frombuffer(v.as_py() or b"", "<u4").tolist(), surface)) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, text])

    from pyspark.sql.types import StringType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(text, StringType())]))
