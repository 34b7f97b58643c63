"""Tables that grow by extracts, profiles that add up, declared relations."""

import random
import threading
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from orderloom.operators import dedup, distribution, profile, relations, star, tallies
from orderloom.plans import extracts
from orderloom.plans.stage_store import new_stage_path, write_stage
from orderloom.sources import ledger, sinks

SCHEMA = "k string, a string, b long, note string"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


# a key over all extracts


def test_repeated_keys_are_set_aside(spark):
    path = new_stage_path(spark, "extracts")
    one = [("x", "1", 1, None), ("y", "2", 2, ""), (None, "3", 3, "n"), ("z", "4", 4, "n"), ("z", "5", 5, "n")]
    two = [("x", "6", 6, None), ("z", "7", 7, "n"), (None, "8", 8, "n"), ("w", "9", 9, "n"), ("y", "2", 2, "")]
    first = extracts.append_extract(frame(spark, one), path, "k", "one")
    assert rows(first.appended) == Counter(one[:3])
    assert rows(first.rejected) == Counter([(*r, "repeated") for r in one[3:]])
    second = extracts.append_extract(frame(spark, two), path, "k", "two")
    assert rows(second.rejected) == Counter([(*two[0], "known"), (*two[4], "known")])
    assert rows(extracts.read_extracts(spark, path)) == Counter(one[:3] + two[1:4])
    assert rows(extracts.rejected_rows(spark, path)) == rows(first.rejected) + rows(second.rejected)
    # an extract that comes again replaces itself
    extracts.append_extract(frame(spark, one[1:2]), path, "k", "one")
    assert rows(extracts.read_extracts(spark, path)) == Counter(one[1:2] + two[1:4])
    with pytest.raises(ValueError, match="'w' is known"):
        extracts.append_extract(frame(spark, two[3:4]), path, "k", "three", on_repeat="stop")
    with pytest.raises(ValueError, match="repeated"):
        extracts.append_extract(frame(spark, [("v", "1", 1, "")] * 2), path, "k", "three", on_repeat="stop")
    with pytest.raises(ValueError, match="the extract"):
        extracts.append_extract(spark.createDataFrame([("v",)], "k string"), path, "k", "three")
    extracts.append_extract(frame(spark, one).limit(0), path, "k", "empty")
    assert rows(extracts.read_extracts(spark, path)) == Counter(one[1:2] + two[1:4])


def test_an_append_opens_the_touched_partitions_of_the_keys(spark):
    path = new_stage_path(spark, "extracts")
    extracts.append_extract(frame(spark, [(f"k{i}", "a", i, "") for i in range(2000)]), path, "k", "many")
    new = frame(spark, [("k7", "a", 1, ""), ("new", "a", 2, "")])
    bucket = F.pmod(F.xxhash64("k"), F.lit(extracts.BUCKETS)).cast("int")
    touched = [r[0] for r in new.select(bucket).distinct().collect()]
    known, last = extracts._current(spark, path)
    held = extracts.known_keys(spark, path, new.schema["k"], touched, list(last.values()))
    assert "PartitionFilters: [isnotnull(bucket" in plan(held) or "PartitionFilters: [bucket" in plan(held)
    assert 0 < held.count() < 100
    assert extracts.append_extract(new, path, "k", "few").rejected.collect()[0]["k"] == "k7"


def test_appends_at_once_keep_the_key(spark, monkeypatch):
    path = new_stage_path(spark, "extracts")
    both, commit, first = threading.Barrier(2), ledger.commit, set()

    def together(session, where, *entry):
        if threading.get_ident() not in first:
            first.add(threading.get_ident())
            both.wait(60)
        return commit(session, where, *entry)

    monkeypatch.setattr(extracts.ledger, "commit", together)
    with ThreadPoolExecutor(2) as pool:
        parts = [frame(spark, [(k, name, 0, "") for k in keys]) for name, keys in (("one", "abc"), ("two", "bcd"))]
        for done in [pool.submit(extracts.append_extract, p, path, "k", n) for p, n in zip(parts, ("one", "two"))]:
            done.result()
    assert sorted(r["k"] for r in extracts.read_extracts(spark, path).collect()) == list("abcd")
    assert len(extracts.rejected_rows(spark, path).collect()) == 2


# duplicates across extracts


@pytest.mark.parametrize("seed", range(3))
def test_extracts_in_turn_like_all_at_once(spark, seed, monkeypatch):
    monkeypatch.setattr(extracts, "BUCKETS", 5)
    rnd = random.Random(seed)
    data = [(rnd.choice([None, f"k{rnd.randrange(40)}", f"u{i}"]), rnd.choice([None, "a", "b"]), rnd.choice([None, *range(12)]), str(i)) for i in range(120)]
    path = new_stage_path(spark, "extracts")
    cuts = [0, 50, 55, 110, 120]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        extracts.add_extract(frame(spark, data[a:b]), path, ["a", "b"], "k", str(n))
        whole = frame(spark, data[:b])
        firsts = dedup.first_of_each_group(whole, ["a", "b"], "k")
        assert rows(extracts.duplicate_firsts(spark, path)) == rows(firsts)
        assert rows(extracts.read_deduplicated(spark, path)) == rows(dedup.drop_one_per_duplicate_group(whole, ["a", "b"], "k"))
    with pytest.raises(ValueError, match="already"):
        extracts.add_extract(whole, path, ["a", "b"], "k", "0")


def test_equal_hashes_are_no_duplicates(spark, monkeypatch):
    monkeypatch.setattr(extracts.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    path = new_stage_path(spark, "extracts")
    data = [("1", "a", 1, ""), ("2", "b", 1, ""), ("3", "a", 1, "")]
    extracts.add_extract(frame(spark, data[:2]), path, ["a", "b"], "k", "one")
    extracts.add_extract(frame(spark, data[2:]), path, ["a", "b"], "k", "two")
    assert rows(extracts.read_deduplicated(spark, path)) == Counter(data[1:])


def test_earlier_rows_are_read_by_bucket(spark):
    path = new_stage_path(spark, "extracts")
    extracts.add_extract(frame(spark, [(f"k{i}", str(i), i, "") for i in range(2000)]), path, ["a", "b"], "k", "one")
    entry = ledger.entries(spark, path)[-1]
    assert entry["firsts"] == {}
    extracts.add_extract(frame(spark, [("k9999", "7", 7, ""), ("new", "x", 1, "")]), path, ["a", "b"], "k", "two")
    # one bucket of firsts for one group; its key is that of the earlier row
    assert len(ledger.entries(spark, path)[-1]["firsts"]) == 1
    assert rows(extracts.duplicate_firsts(spark, path)) == Counter([("k7", 2)])
    schema = spark.read.parquet(f"{path}/rows").select("k", "a", "b", "note", "__hash", "bucket").schema
    members = extracts._members(spark, path, [entry["rows"]], schema, [3])
    assert "PartitionFilters: [isnotnull(bucket" in plan(members) and 0 < members.count() < 100


# profiles that add up


def test_halves_add_up(spark):
    rnd = random.Random(1)
    data = [(rnd.choice([None, "", "a", "B "]), "x", rnd.choice([None, *range(-5, 30)]), "") for _ in range(333)]
    path = new_stage_path(spark, "tallies")
    assert tallies.read_tally(spark, path).count() == 0
    measures = {"k": F.col("k"), "b": F.col("b")}
    for name, part in (("one", data[:100]), ("two", data[100:120]), ("two", data[100:])):
        tallies.add_tally(tallies.tally(frame(spark, part), measures), path, name)
    whole = frame(spark, data)
    merged = tallies.read_tally(spark, path)
    assert rows(tallies.frequencies(merged).where("attribute = 'k'")) == rows(profile.value_frequencies(whole, ["k"]))
    assert rows(tallies.tiles(merged, "b", "b", 7)) == rows(distribution.ntile_profile(whole, F.col("b"), "b", 7))
    one = tallies.read_tally(spark, path, ["b"])
    assert "PartitionFilters: [attribute" in plan(one) or "PartitionFilters: [isnotnull(attribute" in plan(one)


# relations


def test_relations_like_brute_force(spark):
    rnd = random.Random(2)
    values = [None, "", "a", "b", "c", "d", "e"]
    child = [(rnd.choice(values), rnd.choice(values)) for _ in range(50)]
    parent = [(rnd.choice(values[:5] + ["z"]),) for _ in range(9)]
    tables = {
        "child": spark.createDataFrame(child, "x string, y string"),
        "parent": spark.createDataFrame(parent, "p string"),
        "none": spark.createDataFrame([], "q string"),
    }
    wanted = [relations.Reference("child", "x", "parent", "p"), relations.Reference("child", "y", "parent", "p"), relations.Reference("none", "q", "none", "q"), relations.Reference("parent", "p", "child", "x")]
    got = [tuple(r) for r in relations.check_relations(tables, wanted).collect()]
    data = {("child", "x"): [c[0] for c in child], ("child", "y"): [c[1] for c in child], ("parent", "p"): [p[0] for p in parent], ("none", "q"): []}
    want = []
    for r in wanted:
        own, members = data[r.table, r.column], Counter(v for v in data[r.parent, r.parent_column] if v)
        orphans = [v for v in own if v and v not in members]
        want.append((r.name, len(own), sum(not v for v in own), len(orphans), len(set(orphans)), len(members), sum(m not in own for m in members), sum(n > 1 for n in members.values())))
    assert got == want
    text = plan(relations.check_relations(tables, wanted))
    assert "Join" not in text.replace("BroadcastHashJoin", "", 1).replace("SortMergeJoin", "", 1)


# the sliced star


def test_a_slice_reads_its_months_only(spark):
    months = [f"{y}-{m:02d}" for y in (1996, 1997) for m in range(1, 13)]
    data = [(f"o{i}", months[i % 24], "m" if i % 3 else "q", i) for i in range(480)] + [("null", None, "m", 1)]
    path = new_stage_path(spark, "fact")
    fact = sinks.publish(spark.createDataFrame(data, "order_id string, month_order_date string, pay_method string, payment long"), path, partition_by=[star.SLICE])
    categories = spark.createDataFrame([(f"o{i}", c) for i in range(480) for c in ("x", "y")[: 1 + i % 2]], "order_id string, product_category string")
    payments = spark.createDataFrame([("m", "M")], "pay_method string, payment_category string")
    calendar = write_stage(star.calendar(fact), "calendar")
    assert calendar.count() == 24
    got = star.sliced_rollup(fact, categories, payments, calendar, F.expr("year = '1997' AND quarter = 2"))
    want = Counter()
    for o, month, method, payment in data:
        if month in ("1997-04", "1997-05", "1997-06") and method == "m":
            for c in ("x", "y")[: 1 + int(o[1:]) % 2]:
                want[month, c] += payment
    assert {(r["month_order_date"], r["product_category"]): r["payment_total"] for r in got.collect()} == dict(want)
    assert "dynamicpruning" in plan(got)
    scanned = [n for n in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in n and "payment" in n and "month_order_date" in n]
    assert scanned and "dynamicpruning" in scanned[0]
