"""Decontamination, conversation repair and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderloom.llm import conversation_repair, decontaminate, periodic_runs
from orderloom.llm.queries import REGISTRY

LONG = "wörd " * 4000 + "x" * 9000
EXTRA = ["n_words", "hits", "item_ids", "runs", "kept_text", "row_", "pos", "seg"]
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), *(StructField(n, StringType()) for n in EXTRA)])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, data):
    return spark.createDataFrame([(i, t, *["z"] * len(EXTRA)) for i, t in data], DOCS).repartition(3)


def folder(spark, sf, name):
    return [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet").collect()]


# decontamination


def normal_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(docs, items, window=10):
    cut = {}
    for item, text in items:
        w = normal_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            cut.setdefault(tuple(w[k : k + window]), set()).add(item)
    sizes = {len(c) for c in cut}
    out = []
    for i, text in docs:
        w, hit, found = normal_words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (own := cut.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= own
        names = sorted(str(f) for f in found if f is not None)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_contamination_like_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(map(tuple, REGISTRY["op11_decontamination"](spark, f"/root/testdata/{sf}").collect()))
    assert got == plain_hits([tuple(r) for r in docs], folder(spark, sf, "benchmark"))
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def awkward_texts():
    rnd = random.Random(4)
    item = " ".join(rnd.choices("a b c d".split(), k=30))
    texts = [None, "", " \t", "a", "A", "é É", LONG, item, item.upper(), item.replace(" ", "--"), f"x {item} y {item}", "a b " * 40, "ß1 ß2", "𝒳 a 𝒳 b"]
    items = [(1, item), (2, item[10:]), (2, "q"), (3, None), (4, "..."), (None, "c c d"), (5, "ß1"), (6, "a b " * 9), (7, "A-b"), (7, "A-b"), (8, "wörd " * 12), (9, "𝒳 b")]
    return [*enumerate(texts), (7, item), (7, item), (None, item), *((50 + k, " ".join(rnd.choices("a b c d".split(), k=k))) for k in range(40))], items


@pytest.mark.parametrize("block_pairs", [10**6, 7])
@pytest.mark.parametrize("window", [1, 3, 10])
def test_contamination_of_awkward_rows(spark, window, block_pairs):
    data, items = awkward_texts()
    docs, bench = frame(spark, data), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, bench, window=window, block_pairs=block_pairs)
    assert set(found.columns) == set(docs.columns)
    assert Counter(map(tuple, decontaminate.hit_digests(found).collect())) == plain_hits(data, items, window)
    for r in found.collect():
        for span in r["hits"]:
            cut = (r["text"] or "")[span["start"] : span["end"]]
            words = normal_words(r["text"])[span["word"] : span["word"] + span["words"]]
            assert normal_words(cut) == words and cut.lower().startswith(words[0].lower())


def test_contamination_of_empty_tables(spark):
    data, items = awkward_texts()
    docs, bench = frame(spark, data), spark.createDataFrame(items, "item_id long, text string")
    none = decontaminate.contaminated(docs, bench.limit(0)).collect()
    assert len(none) == len(data) and not any(r["hits"] or r["item_ids"] for r in none)
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


# conversation repair


FOLLOW = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit), with every way written out; rows: (initial, must go, truncated)."""
    after = None
    for at in range(len(rows), -1, -1):
        now = {}
        for state, follow in FOLLOW.items():
            ways = []
            if at == len(rows):
                ways += [(0, "")] if state in ("", "a") else []
            else:
                role, gone, cut = rows[at]
                steps = [(4, "D", state)]
                if not gone:
                    steps += [(3 * cut, "K", role)] if role == follow or (role, state) == ("s", "") else []
                    steps.append((3 + 3 * cut, "R", follow))
                ways += [(cost + after[to][0], letter + after[to][1]) for cost, letter, to in steps]
            now[state] = min(ways, default=(10**9, ""))
        for _ in range(3):
            now = {s: min(own, (3 + now[FOLLOW[s]][0], "I" + now[FOLLOW[s]][1])) for s, own in now.items()}
        after = now
    return after[""]


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def plain_repair(convs, rows):
    """``rows``: damaged, of equal turns in the order in which they count."""
    out = []
    for conv in convs:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, faults, coded = set(), Counter(), []
        for _, _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            coded.append((role[:1], fault in ("b", "d") and fault != "", fault == "t"))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit = cheapest(coded)
        at, state, made = 0, "", []
        for letter in audit:
            follow = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            if letter == "I":
                made.append((follow, ""))
            else:
                role, text = own[at][2:]
                at += 1
                if letter == "D":
                    continue
                made.append((role if letter == "K" else follow, text))
            state = made[-1][0][:1]
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names.get(r, r)}:{t}" for r, t in made]
        out.append((conv, gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, sha("\n".join(lines))))
    return Counter(out)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_repair_like_brute_force(spark, sf):
    rows = folder(spark, sf, "conversations")
    got = Counter(map(tuple, REGISTRY["op12_conversation_repair"](spark, f"/root/testdata/{sf}").collect()))
    assert got == plain_repair(list(dict.fromkeys(r[0] for r in rows)), list(plain_damage(rows)))


SCHEMA = "conv_id long, turn long, role string, text string, pos int"


def repaired(spark, rows, parts=7):
    turns = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    ids = turns.select("conv_id").distinct()
    return conversation_repair.repair_digests(ids, conversation_repair.repair(turns.repartition(parts)))


def test_repair_of_awkward_rows(spark):
    rnd = random.Random(6)
    roles, texts = ["system", "user", "assistant", "tool", "s", "User"], ["One.", "two", "\t ", "é?", "three! ", LONG, "four.", "five."]
    rows = [(c, t, rnd.choice(roles), rnd.choice(texts) + str(rnd.randrange(3)) * rnd.randrange(2)) for c in range(80) for t in range(rnd.randrange(1, 9))]
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (200, None, "system", "x."), (200, 0, "assistant", "y."), (201, None, "user", "z")]
    rows += [(300, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(700)]  # lies in several partitions
    rows += [(301, t, "user", "the same.") for t in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = Counter(map(tuple, repaired(spark, rows).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain_repair(list(dict.fromkeys(r[0] for r in rows)), rows)
    assert repaired(spark, [(1, 0, None, None)]).first()["audit"] == "D"
    turns = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.repair(turns).digests.count() == 0
    # equal turns go by role
    same = repaired(spark, [(1, 0, "user", "a."), (1, 0, "assistant", "b."), (1, None, "system", "c.")]).first()
    assert (same["illegal"], same["audit"]) == (1, "KIKKI")


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "a."), (1, 2, "user", "b."), (1, 3, "user", "c")]
    turns = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = conversation_repair.repair(turns).rows.orderBy("n").collect()
    want = plain_repair([1], rows)
    assert "".join(r["edit"] for r in got) == next(iter(want))[7]
    assert [r["n"] for r in got] == list(range(len(got)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in got if r["edit"] != "D"))


@settings(max_examples=300, deadline=None)
@given(symbols=st.lists(st.integers(0, 8), max_size=11), cut=st.integers(0, 11))
def test_blocks_like_the_rows(symbols, cut):
    rows = tuple(("sua?"[(s - 1) // 2], False, (s - 1) % 2) if s else ("u", True, 0) for s in symbols)
    cost, audit = cheapest(rows)
    # in two segments, as if they lay in two partitions
    parts = [bytes(symbols[:cut]), bytes(symbols[cut:])]
    behind, total, vectors = 0, 0, []
    for part in reversed(parts):
        vectors.append(behind)
        to, paid = conversation_repair.effect(part)
        total += int(paid[behind])
        behind = int(to[behind])
    state, made = 0, ""
    for part, vector, last in zip(parts, reversed(vectors), (False, True)):
        edits, states = conversation_repair.trace(part, vector, last)
        made, state = made + edits[state], states[state]
    assert (total + int(conversation_repair.tables().vectors[behind][0]), made) == (cost, audit)


# periodic runs


def plain_runs(w):
    n, found = len(w), set()
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p) and not any((i2, j + p) == (i, e) and p % q == 0 for i2, e, q in found if i2 == i):
                found.add((i, j + p, p))
            i = j
    return sorted((s, e - s, p) for s, e, p in found)


def plain_row(i, w):
    runs = plain_runs(w)
    gone = {k for s, size, p in runs for k in range(s + p, s + size)}
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *told, sha("".join(f"{s},{size},{p}\n" for s, size, p in runs)), sha(kept))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(i, w):
    h, n = zlib.crc32(str(i).encode()) if i is not None else 1, len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_runs_like_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    docs = {i: words(t) for i, t in docs}
    got = {r[0]: tuple(r) for r in REGISTRY["op13_periodic_runs"](spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(docs)
    for i, w in docs.items():
        if len(w) <= 3000:
            assert got[i] == plain_row(i, planted(i, w))
    assert sum(r[1] > 0 for r in got.values()) > len(docs) // 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=7), st.integers(1, 12)), max_size=6))
def test_runs_of_repeated_words(pieces):
    w = [f"w{x}" for root, times in pieces for x in root * times]
    got = periodic_runs._judged([[x.encode() for x in w], [b"w1"] * 30, [x.encode() for x in w]])
    want = [{"start": s, "length": size, "period": p} for s, size, p in plain_runs(w)]
    assert got[0][1] == want == got[2][1]
    assert got[1] == (30, [{"start": 0, "length": 30, "period": 1}], "w1")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60))
def test_trees_tell_common_extensions(text):
    n, tree = len(text), periodic_runs.Extensions(np.array(text), 4, both_orders=True)
    assert tree.leaves.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
    assert tree.back.tolist() == np.argsort(sorted(range(n + 1), key=lambda i: [-x for x in text[i:]])).tolist()
    pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
    want = [next((k for k in range(n - max(i, j)) if text[i + k] != text[j + k]), n - max(i, j)) for i, j in pairs]
    assert tree.of(*np.array(pairs).T).tolist() == want


def test_runs_of_awkward_rows(spark):
    rnd = random.Random(3)
    root = [str(rnd.randrange(10**6)) for _ in range(700)]
    texts = [None, "", " \n", "a " * 23, "a " * 24, LONG, "a\x1cb c d " * 30, " ".join(root * 3), " ".join(["q", *root, *root, *root[:699]]), "x y " * 20 + "y x " * 20]
    data = [*enumerate(texts), (4, "a " * 24), (4, "a " * 24), (None, "b " * 50)]
    docs = frame(spark, data)
    found = periodic_runs.find_runs(docs)
    assert set(found.columns) == set(docs.columns)
    assert Counter(map(tuple, periodic_runs.run_digests(found).collect())) == Counter(plain_row(i, words(t)) for i, t in data)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    moved = {r["doc_id"]: r["text"] for r in periodic_runs.with_planted_runs(docs).collect()}
    for i, t in data[:10]:
        assert words(moved[i]) == planted(i, words(t))
