"""Benchmark decontamination by one Aho-Corasick automaton.

The questions and answers of a benchmark are normalised (A-Z lower-cased, words
are runs of digits, letters a-z and characters beyond ASCII) and cut into windows
of ``window`` consecutive words; an item of fewer words is one window. The
distinct windows are the patterns of an automaton over word numbers, which reads
each document once and tells every occurrence. Occurrences are merged into spans
of words, with the character offsets of the original text.

Each window of an item is a pair (window, item). Up to ``BLOCK_PAIRS`` pairs make
one automaton, sent to the workers as a broadcast of that bounded size. A larger
benchmark is dealt over several automata by a hash of the pair - neither a window
that all items share nor a very long item ends in one of them - and the spans and
items that each finds in a document are joined by the document's row.

Defined results: a null text has no words, in a document and in an item; an item
without an id makes words hit but is not listed; items of one id are one item;
repeated rows are documents of their own; an empty benchmark hits nothing; an
empty table of documents gives an empty table. Columns named like the results
are replaced, other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from orderloom.llm.common import fresh, ship_package
from orderloom.plans.stage_store import write_stage

WINDOW = 10
#: Pairs of a window and an item that one automaton holds, about.
BLOCK_PAIRS = 100_000
#: Between the words of a window, in the table of patterns.
GAP = " "

RESULTS = ("n_words", "hits", "item_ids")
_SPAN = StructType([StructField(c, LongType()) for c in ("word", "words", "start", "end")])
_TYPES = (LongType(), ArrayType(_SPAN), ArrayType(StringType()))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """The normalised words of a text as an array."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.regexp_extract_all(low, F.lit(f"({_NO_WORD})"), F.lit(1))


def window_items(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """The distinct pairs (pattern, item) of a benchmark."""
    words = items.select(F.col(f"`{item}`").cast("string").alias("item"), item_words(F.col(f"`{text}`")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = F.transform(starts, lambda at: F.array_join(F.slice("w", at, window), GAP))
    return words.where(F.size("w") > 0).select("item", F.explode(cut).alias("pattern")).distinct()


class Patterns:
    """The automaton of some pairs, and the items of each pattern."""

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        self.number: dict[bytes, int] = {}
        found: dict[bytes, list[str]] = {}
        for pattern, item in pairs:
            own = found.setdefault(pattern, [])
            if item is not None:
                own.append(item)
        self.items = list(found.values())
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for at, pattern in enumerate(found):
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in pattern.split(GAP.encode()))
            self.machine.add_word(ids, (at, len(ids)))
        if found:
            self.machine.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[dict[str, int]], list[str]]:
        """A text's number of words, merged spans of hit words, and items found."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        low = raw.lower()  # of bytes: A-Z only
        words = _WORD.findall(low)
        number = self.number.get
        spans: list[list[int]] = []
        seen: set[int] = set()
        if self.items and words:
            for last, (at, size) in self.machine.iter(tuple([number(w, 0) for w in words])):
                seen.add(at)
                first = last + 1 - size
                while spans and first <= spans[-1][0]:
                    spans.pop()
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = last + 1
                else:
                    spans.append([first, last + 1])
        return len(words), _placed(raw, low, spans), sorted({i for at in seen for i in self.items[at]})


def _placed(raw: bytes, low: bytes, spans: list[list[int]]) -> list[dict[str, int]]:
    """Spans of words with the offsets of their characters in the original text."""
    if not spans:
        return []
    edges = {first for first, _ in spans} | {last - 1 for _, last in spans}
    at = {n: m.span() for n, m in enumerate(_WORD.finditer(low)) if n in edges}
    out, byte, char = [], 0, 0
    for first, last in spans:
        start, end = at[first][0], at[last - 1][1]
        char += len(raw[byte:start].decode("utf-8", "surrogatepass"))
        size = len(raw[start:end].decode("utf-8", "surrogatepass"))
        out.append({"word": first, "words": last - first, "start": char, "end": char + size})
        byte, char = end, char + size
    return out


def _scan(docs: DataFrame, text: str, sent: Broadcast, text_needed: bool, all_rows: bool) -> DataFrame:
    at = docs.columns.index(text)
    passed = [i for i, c in enumerate(docs.columns) if text_needed or i != at]
    fields = [docs.schema.fields[i] for i in passed]
    schema = StructType([*fields, *(StructField(n, t) for n, t in zip(RESULTS, _TYPES, strict=True))])
    arrow = [to_arrow_type(t) for t in _TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(sent.value)
        for batch in batches:
            found = [patterns.scan(t.as_py()) for t in batch.column(at)]
            columns = [*(batch.column(i) for i in passed), *(pa.array([f[k] for f in found], t) for k, t in enumerate(arrow))]
            out = pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
            yield out if all_rows else out.filter(pa.array([bool(f[1]) for f in found]))

    return docs.mapInArrow(run, schema)


def _joined(found: DataFrame, row: str) -> DataFrame:
    """Spans and items of a row from several automata: one row of spans that do not
    touch each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for spans in batch.column(1).to_pylist():
                out: list[dict[str, int]] = []
                for s in sorted(spans, key=lambda s: (s["word"], -s["words"])):
                    if out and s["word"] <= out[-1]["word"] + out[-1]["words"]:
                        if (reach := s["word"] + s["words"]) > out[-1]["word"] + out[-1]["words"]:
                            out[-1] |= {"words": reach - out[-1]["word"], "end": s["end"]}
                    else:
                        out.append(dict(s))
                merged.append(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(merged, to_arrow_type(_TYPES[1])), batch.column(2)], names=[row, "hits", "item_ids"]
            )

    grouped = found.groupBy(row).agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    schema = StructType([StructField(row, LongType()), *(StructField(n, t) for n, t in zip(RESULTS[1:], _TYPES[1:], strict=True))])
    return grouped.mapInArrow(run, schema)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    text_needed: bool = True,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """``docs`` (without the text if it is not needed) with n_words, hits - spans of
    words that lie in windows of the benchmark: number of the first word, number of
    words, first character and the one after the last - and item_ids, the items with
    such windows as sorted strings."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() not in RESULTS))
    pairs = write_stage(window_items(items, item, item_text, window), "benchmark-windows")
    count = pairs.count()
    blocks = max(1, -(-count // block_pairs))

    def sent(block: int) -> Broadcast:
        own = F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == block
        rows = pairs.where(own).toArrow()
        return spark.sparkContext.broadcast([(p.encode(), i) for p, i in zip(rows["pattern"].to_pylist(), rows["item"].to_pylist(), strict=True)])

    if blocks == 1:
        return _scan(docs, text, sent(0), text_needed, True)
    row = fresh(docs, "row_")
    stored = write_stage(docs.withColumn(row, F.monotonically_increasing_id()), "scanned-documents")
    lean = stored.select(row, f"`{text}`")
    base = _scan(stored, text, spark.sparkContext.broadcast([]), text_needed, True).drop("hits", "item_ids")
    found = None
    for block in range(blocks):
        held = sent(block)
        part = write_stage(_scan(lean, text, held, False, False).select(row, "hits", "item_ids"), "benchmark-hits")
        held.destroy()
        found = part if found is None else found.union(part)
    none = [F.coalesce(n, F.array().cast(t)).alias(n) for n, t in zip(RESULTS[1:], _TYPES[1:], strict=True)]
    return base.join(_joined(found, row), row, "left").select(*(f"`{c}`" for c in base.columns if c != row), *none)


def hit_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, span: total + span["words"])
    return found.select(
        f"`{key}`",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
