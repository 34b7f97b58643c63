"""The corpus operators against brute-force versions and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from checks.compare import connect, difference
from orderloom.llm import (
    ann_forest,
    bpe_stream,
    chat_format,
    components,
    lang_id,
    quality_rules,
    simhash_planes,
    source_mix,
    substring_levels,
    token_shards,
    url_filter,
)
from orderloom.llm.oracle import ORACLE
from orderloom.llm.queries import REGISTRY, mix_levels

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "wörd " * 4000 + "x" * 9000
#: names that operators use or return, as extra columns
EXTRA = [
    "n_words", "kept", "block", "fp_", "row_", "tokens", "k_0", "host", "rows", "score", "__words", "__stay", "stay_",
    "host_", "ok_", "n_lines",
]
DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        *(StructField(n, StringType()) for n in EXTRA),
    ]
)


def rows():
    rnd = random.Random(5)
    common = " ".join(rnd.choices("the of and to in that it is was he for on are".split(), k=60))
    texts = [None, "", " \t\n", "one", "Two words", LONG, common, common, f"begin {common} end of it", "a b\x1cc <|endoftext|> d", "a a a a a " * 20]
    texts += [" ".join(rnd.choices(["alpha", "beta", "gamma", "Δelta", "x1", "#y"], k=rnd.randrange(5, 90))) for _ in range(40)]
    out = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}", *["z"] * len(EXTRA)) for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, common, None, None, *["z"] * len(EXTRA)), (None, None, None, None, *[None] * len(EXTRA))]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_as_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    assert isinstance(difference(REGISTRY[name](spark, folder), connect(folder), ORACLE[name]), int)


# language identification


def test_languages(spark):
    found = REGISTRY["op1_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    out = found.merge(lang, on="doc_id")
    assert len(found) == 1000 and found.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert (out.lang_pred == out.lang)[out.held_out].mean() > 0.95


def test_language_of_awkward_rows(docs, empty):
    model = lang_id.fit(docs)
    got = lang_id.identify(docs, model).collect()
    assert len(got) == len(rows())
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (0, 1, 2))
    assert by_id[5]["lang_pred"] in ("en", "de")
    assert lang_id.identify(empty, model).count() == 0
    nothing = lang_id.identify(docs, lang_id.fit(empty))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def plain_vector(text):
    """Counts of hashed letter pairs and triples, one by one."""
    code, before = [32], False
    for c in text.lower():
        if c.isalpha() or before:  # the first other character after a word is its end
            code.append(ord(c) if c.isalpha() else 32)
        before = c.isalpha()
    code.append(32)
    mask, out = 2**64 - 1, Counter()
    for i in range(len(code) - 1):
        a, b, *c = code[i : i + 3]
        pair = (a * 0x9E3779B1 + b * 0x85EBCA77) & mask
        grams = [(pair, (a, b))]
        if c:
            grams.append(((pair * 0xC2B2AE3D + c[0] * 0x27D4EB2F) & mask, (a, b, c[0])))
        for value, letters in grams:
            if letters[0] != 32 or letters[-1] != 32:
                out[(value * 0xD6E8FEB86659FD93 & mask) >> 52] += 1
    return out


def test_languages_like_brute_force(docs, spark):
    model = lang_id.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    odd = spark.createDataFrame([(900, "zzq xxj qqz vvk", None), (901, "the of and", None), (901, "the of and", None)], "doc_id long, text string, lang string")
    some = docs.select("doc_id", "text", "lang").union(odd)
    want = Counter()
    for i, text, _ in some.collect():
        if not any(map(str.isalpha, text or "")):
            want[(i, "und", 0.0, True)] += 1
            continue
        x = np.zeros(lang_id.DIMENSIONS)
        for place, n in plain_vector(text).items():
            x[place] = np.log1p(n)
        x *= model.idf
        cosine = model.centroids @ (x / np.linalg.norm(x))
        best = int(cosine.argmax())
        far = 1 - cosine[best] > model.radius[model.owner[best]]
        want[(i, model.names[model.owner[best]], round(float(np.clip(cosine[best], 0, 1)), 4), bool(far))] += 1
    got = Counter((r[0], r[1], round(r[2], 4), r[3]) for r in lang_id.identify(some, model).collect())
    assert got == want
    assert len({k[3] for k in got}) == 2  # some are rejected, some are not


def test_counts_of_the_fit_are_not_cut(spark):
    long = "ab " * 90_000
    rows_ = [(i, t, lang) for i, (t, lang) in enumerate([(long, "x"), (long + "ab " * 50_000, "x"), ("cd ef", "y")])]
    model = lang_id.fit(spark.createDataFrame(rows_, "doc_id long, text string, lang string"))
    (_, counts), = lang_id.vectors([t for _, t, _ in rows_])
    plain = lang_id.CentroidModel(["x", "x", "y"], np.stack([*sorted(counts[:2], key=lambda c: c.tobytes()), counts[2]]))
    assert np.array_equal(model.centroids, plain.centroids) and counts.max() > 65_000


# BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_bpe_like_the_library(docs, empty, library):
    got = Counter(tuple(r) for r in bpe_stream.encode_digests(docs, PATH).collect())
    want = Counter()
    for i, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert got == want
    assert bpe_stream.encode_digests(empty, PATH).count() == 0
    coded = bpe_stream.decode_ids(bpe_stream.encode_ids(docs, PATH), PATH, surface=False)
    assert {r["decoded"] for r in coded.where("doc_id = 4").collect()} == {"two words "}


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_bpe_of_any_text(text):
    from tokenizers import Tokenizer

    with open(PATH) as file:
        bpe = bpe_stream.codec(file.read())
    lib = test_bpe_of_any_text.__dict__.setdefault("lib", Tokenizer.from_file(PATH))
    # the two Unicode tables may differ on unassigned characters
    text = "".join(c for c in text if c.isascii() or "À" <= c <= "ɏ" or "Ͱ" <= c <= "Ͽ")
    assert list(bpe.encode(text)) == lib.encode(text, add_special_tokens=False).ids


def test_stream_emits_the_same_tokens():
    with open(PATH) as file:
        bpe = bpe_stream.codec(file.read())
    assert 0 < bpe.merges.lookahead < 10_000
    rnd = random.Random(1)
    for _ in range(5):
        text = "".join(rnd.choice(["in", "th", "an", "re", "ing", "aaa"]) for _ in range(3000))
        symbols = [bpe._inner[b] for b in text.encode()]
        assert list(bpe.merges.stream(iter(symbols), bpe._sizes, window=32)) == bpe.merges.merge(symbols)


def test_texts_come_in_pieces(monkeypatch, library):
    with open(PATH) as file:
        bpe = bpe_stream.codec(file.read())
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choices("abcdefgé1.", k=rnd.randrange(1, 30))) for _ in range(400))
    text = text[:3000] + "<|endoftext|>" + text[3000:] + "\x1d x\u3000y" + "q" * 2000 + " end"
    want = library.encode(text, add_special_tokens=False).ids
    for piece in (1, 50, 1000, 1 << 16):
        monkeypatch.setattr(bpe_stream, "PIECE", piece)
        parts = list(bpe.encode_pieces(text))
        assert b"".join(parts) == np.array(want, np.uintc).tobytes()
        assert len(parts) > 10 or piece > 50
        machine = bpe.decoder()
        told = [machine.feed(memoryview(p).cast("I")) for p in parts if p]
        assert "".join(told) + machine.close() == library.decode(want, skip_special_tokens=False)


def test_text_of_split_characters():
    machine = bpe_stream.ByteToText()
    assert "".join(machine.feed(bytes([b])) for b in "aé漢👩".encode()) + machine.close() == "aé漢👩"


# chat formatting


def test_chat(spark):
    schema = "turn int, role string, conv_id long, text string, n long"
    turns = [
        (1, "assistant", 1, "<|text|> &lt; [INST]", 0), (0, "user", 1, None, 0), (2, "assistant", 1, "", 0), (3, None, 1, "x|>", 0),
        (0, "user", 2, "<|end|>\n&amp;", 0), (0, "user", 2, "<|end|>\n&amp;", 0), (None, "assistant", 2, "ä\n", 0),
        (0, "assistant", None, LONG, 0), (1, "we<|next|>ird\n", None, "y", 0),
    ]
    made = chat_format.format_conversations(spark.createDataFrame(turns, schema))
    for r in made.collect():
        assert sum(x["chars"] for x in r["loss_runs"]) == len(r["formatted"])
    got = {r["conv_id"]: r for r in chat_format.read_back(made).collect()}
    for conv in (1, 2, None):
        own = sorted(((t if t is not None else -1, role or "", text or "") for t, role, c, text, _ in turns if c == conv))
        assert [tuple(t) for t in got[conv]["turns"]] == [(r, t) for _, r, t in own]
        assert got[conv]["loss_text"] == "".join(t for _, r, t in own if r == "assistant")
    assert chat_format.digests(chat_format.format_conversations(spark.createDataFrame([], schema))).count() == 0


def test_mask_must_fit(spark):
    made = chat_format.format_conversations(spark.createDataFrame([(1, 0, "assistant", "ab")], "conv_id long, turn int, role string, text string"))
    broken = made.withColumn("formatted", F.replace("formatted", F.lit("ab"), F.lit("abc")))
    with pytest.raises(Exception, match="mask"):
        chat_format.read_back(broken).collect()


# mixing


def test_budgets_go_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 1000), ("b", "x", 1000), ("b", "z", 5)], "k_0 string, k_1 string, tokens long"
    )
    got = source_mix.leaf_budgets(leaves, ["d", "l"], {"d": {"a": 1, "b": 1}}, 400, 1)
    assert {(r["k_0"], r["k_1"]): r["budget"] for r in got.collect()} == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 195, ("b", "z"): 5}
    short = source_mix.leaf_budgets(leaves, ["d", "l"], {}, 10**6, 2)
    assert sum(r["budget"] for r in short.collect()) == 2 * 2015


def test_mix_of_awkward_rows(docs, empty):
    drawn = source_mix.mix(docs, mix_levels(), {"lang": {"en": 3}}, total=500, seed=3)
    got = drawn.collect()
    assert drawn.columns == [*docs.columns, "mix_epoch", "mix_tokens"]
    assert 500 <= sum(r["mix_tokens"] for r in got) + 10
    assert all(r["mix_tokens"] == len(words(r["text"])) for r in got)
    again = source_mix.mix(docs.repartition(7), mix_levels(), {"lang": {"en": 3}}, total=500, seed=3)
    assert Counter(map(tuple, got)) == Counter(map(tuple, again.collect()))
    assert source_mix.mix(empty, mix_levels(), {}).count() == 0


def test_weight_of_zero_has_no_capacity(spark):
    leaves = spark.createDataFrame([("a", "x", 1000), ("a", "y", 10), ("b", "x", 1000), ("b", "y", 1000)], "k_0 string, k_1 string, tokens long")
    got = source_mix.leaf_budgets(leaves, ["d", "l"], {"l": {"x": 0}}, 400, 1)
    assert {tuple(r) for r in got.collect()} == {("a", "x", 0), ("a", "y", 10), ("b", "x", 0), ("b", "y", 390)}
    got = source_mix.leaf_budgets(leaves, ["d", "l"], {"d": {"b": 0}}, 400, 1)
    assert sum(r["budget"] for r in got.where("k_0 = 'a'").collect()) == 400


# URL filter


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_urls(spark):
    urls = [None, "", "x", "://", "http://WWW.Example.COM/en/a?b#c", "https://example.com", "http://a.example.com/en/1", "http://x.net/es/", "ftp://net/fr/x://y",
            "http://É.net/en/", "http://notcom/", "http://a.org/de/" + "x" * 5000, "a://b://c/d", "http://h.com?x=/en/", "http://q.net/es/\n/z", "http://q.net/es/\n/z"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain_rule(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages.where("page_id < 4")).collect()} == {"allow"}


def test_trees_learn_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").toPandas().url
    known = [(h, p, u, v == "block") for u in pages for h, p, _, v in [plain_rule(u)] if v]
    model = url_filter.UrlModel(known[::2])
    said = model.predict([r[:3] for r in known[1::2]]) > 0.5
    assert (said == [r[3] for r in known[1::2]]).mean() > 0.85


def plain_trees(x, y, trees, depth, bins):
    """The boosting written out: every cut of every feature in every node."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = np.log(share / (1 - share))
    score, out = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-12)
        value = lambda at: g[at].sum() ** 2 / (h[at].sum() + 1)

        def grow(at, level):
            if level == depth:
                return url_filter.RATE * g[at].sum() / (h[at].sum() + 1)
            best = (1e-9, 0, np.inf)
            for f in range(x.shape[1]):
                for cut in edges[f]:
                    right = x[:, f] > cut
                    gain = value(at & ~right) + value(at & right) - value(at)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, cut)
            right = x[:, best[1]] > best[2]
            return (*best[1:], grow(at & ~right, level + 1), grow(at & right, level + 1))

        def walk(node, row):
            while isinstance(node, tuple):
                node = node[3 if row[node[0]] > node[1] else 2]
            return node

        tree = grow(np.ones(len(y), bool), 0)
        score += np.array([walk(tree, row) for row in x])
        out.append(tree)
    return lambda rows_: [1 / (1 + np.exp(-base - sum(walk(t, r) for t in out))) for r in rows_]


def test_trees_like_brute_force():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(120, 4)), 2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] + 0.3 * rng.normal(size=120) > 0)).astype(float)
    plain = plain_trees(x, y, 6, 2, 8)
    made = url_filter.Trees.fit(x, y, trees=6, depth=2, bins=8)
    fresh = np.round(rng.normal(size=(200, 4)), 2)
    assert np.allclose(made.predict(fresh), plain(fresh), atol=1e-9)


def test_verdicts_are_those_of_the_trees(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    got = url_filter.judge(pages).collect()
    known = sorted((r["host"], r["path"], r["url"], r["verdict"] == "block") for r in got if r["rule"])
    model = url_filter.UrlModel(known)
    plain = url_filter.Trees.predict
    assert len(known) < url_filter.SAMPLE_ROWS  # the fit has seen them all
    for r in got:
        host, path, rule, verdict = plain_rule(r["url"])
        score = float(plain(model.trees, model.matrix([(host, path, r["url"])]))[0])
        assert abs(score - r["block_score"]) < 1e-9
        assert r["verdict"] == (verdict or ("block" if score > 0.5 else "allow"))


def test_long_parts_of_a_url_differ_late():
    far = "d" * 300
    rows_ = [(f"{'a' * 600}.x{i % 2}.{far}", f"/{far}{i % 2}/p", "u", bool(i % 2)) for i in range(40)]
    model = url_filter.UrlModel(rows_)
    low, high = (url_filter.features(*rows_[i][:3], model.rates, model.prior) for i in (0, 1))
    at = url_filter.FEATURES.index
    assert low[at("directory")] < 0.2 < 0.8 < high[at("directory")]
    assert low[at("last_two_labels")] < 0.2 < 0.8 < high[at("last_two_labels")]
    assert low[at("last_label")] == high[at("last_label")] == 0.5
    assert max(map(len, model.rates)) < 70


# SimHash


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    head = {}
    for fp in prints:
        if fp in head:
            continue
        head[fp], todo = fp, [fp]
        while todo:
            a = todo.pop()
            for b in prints:
                if b not in head and (a ^ b).bit_count() <= 2:
                    head[b] = fp
                    todo.append(b)
    return head


def test_simhash(docs, empty, spark):
    rnd = random.Random(2)
    near = [(1000 + i, " ".join(rnd.choices(["u", "v"], k=rnd.randrange(1, 9))), None, None, *["z"] * len(EXTRA)) for i in range(150)]
    more = docs.union(spark.createDataFrame(near, DOCS))
    prints = [(r[0], plain_fingerprint(r[1])) for r in [*rows(), *near]]
    head = plain_components(sorted({p for _, p in prints}))
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[head[p]].append(i)
    want = Counter((i, f"{p:016x}", min(least[head[p]])) for i, p in prints)
    assert len(set(head.values())) < len(head)  # some are linked
    assert Counter(map(tuple, simhash_planes.near_duplicates(more).collect())) == want
    assert simhash_planes.near_duplicates(empty).count() == 0
    stays = simhash_planes.one_per_group(more)
    assert stays.columns == more.columns
    assert sorted(r["doc_id"] for r in stays.collect()) == sorted({min(v) for v in least.values()})


def test_one_id_on_two_texts_keeps_both_components(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    data = [(1, one), (1, two), (2, one), (3, two), (None, "x y z w"), (None, "p q r s")]
    got = simhash_planes.one_per_group(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(1, one), (1, two), (0, "x y z w"), (0, "p q r s")])


@pytest.mark.parametrize("n", [1, 63, 64, 65, 700])
def test_planes_find_all_near_rows(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 2**63, n, dtype=np.uint64)
    for _ in range(n // 2):
        i, j = rng.integers(0, n, 2)
        x[i] = x[j] ^ (np.uint64(1) << np.uint64(rng.integers(64))) ^ (np.uint64(1) << np.uint64(rng.integers(64)))
    x = np.unique(x)
    head = plain_components([int(v) for v in x])
    want = sorted((int(np.nonzero(x == h)[0][0]), i) for i, v in enumerate(x) if (h := head[int(v)]) != int(v))
    assert sorted(simhash_planes.block_links(x)) == want


@pytest.mark.parametrize("n, block", [(700, 64), (129, 64), (128, 64), (50, 7)])
def test_blocks_of_a_large_group(n, block):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, 2**12, n, dtype=np.uint64) << np.uint64(20))
    head = plain_components([int(v) for v in x])
    found = {i: i for i in range(len(x))}
    for a, b in (link for links in simhash_planes.links_by_blocks(x, 2, block) for link in links):
        a, b = found[a], found[b]
        found = {k: min(a, b) if v in (a, b) else v for k, v in found.items()}
    assert [int(x[found[i]]) for i in range(len(x))] == [head[int(v)] for v in x]


@pytest.mark.parametrize("at", [0, 8, 16, 24, 40, 48])
def test_hot_keys_are_divided(spark, monkeypatch, at):
    monkeypatch.setattr(simhash_planes, "BLOCK", 16)
    rnd = random.Random(at)
    near = {((1 << a) ^ (1 << b)) << at for a in range(16) for b in range(16)}
    far = {rnd.getrandbits(16) << at for _ in range(200)}
    values = sorted(v - (v >> 63 << 64) for v in near | far | {5 << 40})
    links = simhash_planes.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    roots = {r["vertex"]: r["root"] for r in components.components(links).collect()}
    head = plain_components([v % 2**64 for v in values])
    named = {}
    for v in values:
        named.setdefault(roots.get(v, v), set()).add(head[v % 2**64])
    assert all(len(h) == 1 for h in named.values()) and len(named) == len(set(head.values()))


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([((i * 7) % n, ((i + 1) * 7) % n) for i in range(n - 1)], "a long, b long")
    got = {r["vertex"]: r["root"] for r in components.components(links).collect()}
    assert got == {v: 0 for v in range(1, n)}


# nearest neighbours


def test_neighbours(spark):
    found = REGISTRY["op7_ann"](spark, "/root/testdata/sf0.1").toPandas()
    rows_ = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = rows_.vec_id.to_numpy(), np.stack(rows_.embedding).astype(float)
    hits = 0
    for q, own in found.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -9
        hits += len(set(ids[np.argsort(-score)[:20]]) & set(own.vec_id))
        assert sorted(own["rank"]) == list(range(1, 21))
        near = dict(zip(ids, score))
        assert all(abs(near[v] - s) < 1e-12 for v, s in zip(own.vec_id, own.score))
    assert hits / len(found) >= 0.9
    assert found.groupby("query_id").compared.first().mean() < 0.5 * len(rows_)


def test_trees_are_entered_at_the_longest_prefix():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    forest = ann_forest.Forest(np.arange(300), x, trees=5)
    queries = rng.normal(size=(40, 8))
    strings = ann_forest.hash_strings(queries, np.zeros(40), 5)
    got, order = forest._longest(strings), np.argsort(strings, axis=1)
    for t in range(5):
        for i in range(40):
            shared = [ann_forest.DIGITS - (int(s) ^ int(strings[t, i])).bit_length() for s in forest.strings[t]]
            assert got[t, i] == max(shared)
            a, b = (side[t, i] for side in forest._ranges(strings, order, int(got[t, i])))
            assert b - a == shared.count(max(shared))


def test_neighbours_of_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (20, [-1.0, 0.5]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(*v, 0) for v in vectors], "vec_id long, embedding array<float>, score int")
    got = ann_forest.search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (0, 1, 2, 3.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (0, 4, 20, -1.0),
        (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 1, -1.0), (20, 4, 2, -2.5),
    ]
    assert ann_forest.search(df.limit(0), df.limit(0)).count() == 0


# substring dedup


def plain_removal(texts, n):
    cut = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in cut for i in range(len(w) - n + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        out.append([x for x, g in zip(w, gone) if not g])
    return cut, out


@pytest.mark.parametrize("window", [1, 5, 35, 40])
def test_substrings(docs, empty, window, monkeypatch):
    monkeypatch.setattr(substring_levels, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(substring_levels, "PART_KEYS", 64)
    cut, kept = plain_removal([r[1] for r in rows()], window)
    want = Counter((r[0], len(w), len(w) - len(k), " ".join(k)) for r, w, k in zip(rows(), cut, kept))
    got = substring_levels.remove_repeated(docs, window=window, shortest=3)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()) == want
    assert substring_levels.remove_repeated(empty, window=window).count() == 0


def test_words_of_one_pattern_are_different(spark):
    # the two words agree in every polynomial hash modulo 2^64
    bits = [bin(i).count("1") % 2 for i in range(512)]
    same = [f"w{i}" for i in range(34)]
    texts = [" ".join([*same, "".join("ab"[b ^ flip] for b in bits)]) for flip in (0, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_levels.remove_repeated(docs)
    assert [r["n_removed"] for r in got.collect()] == [0, 0]
    assert [r["n_removed"] for r in substring_levels.remove_repeated(docs.union(docs)).collect()] == [35] * 4


def test_levels_double():
    assert substring_levels.levels(35) == [18, 35]
    assert substring_levels.levels(35, 5) == [5, 9, 18, 35]


# quality rules


def test_quality_of_awkward_rows(docs, empty):
    got = quality_rules.judge(quality_rules.with_metrics(docs))
    want = Counter()
    for i, text, *_ in rows():
        w, t = words(text), text or ""
        spans = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {k + j for k in range(len(w) - 4) if spans[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if words(x)]
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w))] += 1
    assert Counter(tuple(r) for r in got.select("doc_id", *quality_rules.RESULTS).collect()) == want
    assert quality_rules.judge(quality_rules.with_metrics(empty)).count() == 0
    once = quality_rules.kept_rows(quality_rules.judge(quality_rules.with_metrics(docs), store=False))
    assert once.count() == got.where("kept").count()


def test_bad_hosts_lose_their_documents(spark):
    good = " ".join(f"w{i}" for i in range(20))
    hosts = [("bad", "short")] * 99 + [("bad", good)] + [("fine", good)] * 100 + [(None, good)]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(hosts)], "doc_id long, text string, source string")
    got = quality_rules.judge(quality_rules.with_metrics(df)).where("kept").groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {"fine": 100, None: 1}


def test_junk_hosts_of_any_kind_go(spark):
    rnd = random.Random(7)
    plain = lambda: " ".join(f"word{rnd.randrange(10**6)}" for _ in range(30))
    kinds = {
        "symbols": lambda: plain() + " " + "#|$" * 30,
        "lines": lambda: "\n".join([plain()] + ["the same small line of text"] * 2 + [f"line {rnd.randrange(10**6)} end"] * 1),
        "long": lambda: " ".join("x" * 20 + str(rnd.randrange(10**6)) for _ in range(30)),
    }
    data = [(h, make()) for h, make in kinds.items() for _ in range(60)]
    data[60:120] = [("lines", "\n".join([f"a {rnd.randrange(10**9)} b c d e f g h"] + ["same line here"] * 3)) for _ in range(60)]
    for host in range(12):  # of clean hosts one text in ten is junk
        data += [(f"clean{host}", plain() if i % 10 else kinds["symbols"]()) for i in range(60)]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(data)], "doc_id long, text string, source string")
    got = quality_rules.judge(quality_rules.with_metrics(df))
    stays = {r["source"] for r in got.where("kept").collect()}
    assert stays == {f"clean{i}" for i in range(12)}
    assert got.where("kept").count() == got.where("source like 'clean%' and not base_failed").count()


# token shards


def test_shards(docs, empty, library, spark, tmp_path):
    manifest = token_shards.write_shards(docs, f"file://{tmp_path}/ids", PATH)
    got = token_shards.read_shards(manifest).collect()
    data = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    coded = [(r[0], [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in data]
    want = Counter((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in coded)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    in_order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in in_order] == [r[0] for r in data]
    assert [r["start"] for r in in_order] == np.cumsum([0, *(r["n_tokens"] for r in in_order)])[:-1].tolist()
    store = token_shards.TokenStore(spark, f"file://{tmp_path}/ids")
    assert [x.tolist() for x in store.get(4)] == [i for k, i in coded if k == 4]
    assert len(store.get(6)) == 3 and store.get(10**9) == [] and store.get(-1) == []
    # single entries were read, no part of an index as a whole
    assert store._open and not any(shard._whole for shard in store._open.values())
    for shard in store._open.values():
        keys = np.unique(shard.whole("keys")[shard.nulls :])
        assert [len(shard.get(int(k))) for k in keys] == shard.find(keys)[1].tolist()
    assert token_shards.read_shards(token_shards.write_shards(empty, f"file://{tmp_path}/none", PATH)).count() == 0


@settings(max_examples=30, deadline=None)
@given(keys=st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    table = token_shards.PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))


# pipeline


def test_pipeline_like_a_plain_version(spark, library):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    data = [r.asDict() for r in docs.collect()]
    measured = quality_rules.judge(quality_rules.with_metrics(docs)).where("kept").select("doc_id").collect()
    kept = {r["doc_id"] for r in measured}
    data = [r for r in data if r["doc_id"] in kept]
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in data}
    head = plain_components(sorted(set(prints.values())))
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(head[p], i)
    data = [r for r in data if r["doc_id"] in set(first.values())]
    cut, left = plain_removal([r["text"] for r in data], 35)
    for r, w, k in zip(data, cut, left):
        r["text"] = r["text"] if len(w) == len(k) else " ".join(k)
        r["n_chars"] = r["n_chars"] if len(w) == len(k) else len(r["text"])
    drawn = corpus_pipeline.mix(spark, spark.createDataFrame(data, docs.schema), folder).collect()
    want = Counter()
    for r in drawn:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[(r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] += 1
    got = corpus_pipeline.run(spark, folder)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got.collect()) == want


def test_pipeline_of_awkward_rows(docs, empty, spark):
    import corpus_pipeline

    for start in (docs, empty):
        now = start.withColumn("n_chars", F.length("text").cast("long"))
        columns = now.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.write_stage(stage(spark, now, ""), "test-stage")
            assert now.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
