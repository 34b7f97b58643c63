"""Mixing sources to target weights in a tree of domains, languages and sources.

Budgets run from the root to the leaves. A node's children share its budget by
weight; a child whose documents cannot fill its share is filled up, and what it
lacks goes to its siblings by weight. Only what the siblings cannot take either
is missing from the node, whose own siblings then take it: a node's capacity is
the sum of its leaves', those at or below a weight of 0 left out, so its parent
has already allowed for that.

Each leaf then draws its budget as a token prefix of seeded epochs: an epoch is
the leaf's documents in the order of a seeded digest; full epochs are taken
first, then the shortest prefix of the next one that reaches the budget.

All of it is SQL functions over DataFrames. Documents are never sorted by leaf:
they are added up by leaf and digest bucket, the bucket where the prefix ends is
found on these sums, and only that bucket's documents are ordered. Buckets are
digest prefixes, so a hot leaf is dealt over all of them.

Defined results: null level values form a node of their own; a null or blank
text has no tokens and goes with the prefix that covers its place; documents
with equal digests (repeated ids) are ordered together and taken or left
together; nodes without a weight get ``default_weight``, weight 0 takes nothing
unless given capacity elsewhere is missing - it never takes; an empty table
gives an empty table. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import words
from orderloom.plans.stage_store import write_stage

#: Hexadecimal digits of the digest that name a bucket: 65,536 buckets per leaf and epoch.
BUCKET_DIGITS = 4


def token_count(text: Column) -> Column:
    """Words as the unit of budgets."""
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def digest(seed: int, epoch: Column, key: Column) -> Column:
    """The place of a document in an epoch, as 32 hexadecimal digits."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))
        )
    )


def _weight(weights: Mapping[str, int], level: str, value: Column, default: int) -> Column:
    """The whole-number weight of a level's value; the mapping is given, so small."""
    out = F.lit(default).cast("long")
    for name, weight in weights.items():
        out = F.when(value == name, F.lit(int(weight)).cast("long")).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Give each node (cap, weight, b = its parent's budget) its ``budget``.

    Children are ordered by cap per weight. Going up that order, a child whose
    cap is below its share of what is left is filled; from the first that is
    not, all share by weight. Whole numbers throughout.
    """
    order = F.col("cap").cast("double") / F.col("weight")
    by = Window.partitionBy(*parent).orderBy("order", *[c for c in nodes.columns if c.startswith("k_")])
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = nodes.withColumn("order", order)
    df = df.withColumns(
        {
            "left": F.col("b") - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("weight").over(onwards),
        }
    )
    full = F.col("cap") * F.col("weights") <= F.col("left") * F.col("weight")
    df = df.withColumn("full", full)
    # once a child is not filled, none after it is
    df = df.withColumn("full", F.min(F.col("full").cast("int")).over(by) == 1)
    whole = Window.partitionBy(*parent)
    df = df.withColumns(
        {
            "rest": F.col("b")
            - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)),
            "open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole),
        }
    )
    budget = F.when(F.col("full"), F.col("cap")).otherwise(
        F.expr("least(cap, (rest * weight) div open)")
    )
    return df.withColumn("budget", budget).drop("order", "left", "weights", "full", "rest", "open", "b")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    total: int,
    max_epochs: int,
    default_weight: int = 1,
) -> DataFrame:
    """Budgets of the leaves (k_0 … k_n, tokens) from a total, level by level.

    Weights are whole numbers; with 10**5 for the sum of siblings' weights,
    totals up to 10**13 tokens stay within 64 bits.
    """
    keys = [f"k_{i}" for i in range(len(levels))]
    weight_at = [_weight(weights.get(n, {}), n, F.col(k), default_weight) for n, k in zip(levels, keys, strict=True)]
    takes = F.least(*weight_at, F.lit(1)) > 0  # no weight of 0 from the root to the leaf
    caps = leaves.withColumn("cap", F.when(takes, F.col("tokens") * max_epochs).otherwise(F.lit(0)))
    above: DataFrame | None = None
    for i in range(len(levels)):
        nodes = caps.groupBy(*keys[: i + 1]).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", weight_at[i])
        if above is None:
            nodes = nodes.withColumn("b", F.lit(int(total)).cast("long"))
        else:
            given = above.select(*(F.col(k).alias(f"p_{k}") for k in keys[:i]), F.col("budget").alias("b"))
            same = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in keys[:i]]
            nodes = nodes.join(given, same).drop(*(f"p_{k}" for k in keys[:i]))
        nothing = nodes.where(F.col("weight") <= 0).drop("b").withColumn("budget", F.lit(0).cast("long"))
        above = _share(nodes.where(F.col("weight") > 0), keys[:i] or [F.lit(0)]).unionByName(nothing)
    return above.select(*keys, "budget")


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    total: int | None = None,
    max_epochs: int = 2,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
    text_needed: bool = True,
) -> DataFrame:
    """The drawn rows of ``docs``: all its columns, then mix_epoch (from 0) and mix_tokens.

    ``levels`` maps level names to expressions, root first. ``total`` is the
    budget in tokens, all tokens of ``docs`` if not given. A document drawn in
    two epochs comes twice. The documents are written once with their tokens.
    """
    names = list(levels)
    keys = [f"k_{i}" for i in range(len(names))]
    carried = [c for c in docs.columns if text_needed or c != text]
    stored = write_stage(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"),
            F.col(f"`{key}`").alias("id"),
            *(levels[n].alias(k) for n, k in zip(names, keys, strict=True)),
            token_count(F.col(f"`{text}`")).alias("tokens"),
        ),
        "mix-documents",
    )
    leaves = write_stage(
        stored.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-leaves"
    )
    if total is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
    marks = [F.col(k).eqNullSafe(F.col(f"q_{k}")) for k in keys]
    budgets = leaf_budgets(leaves, names, weights, total, max_epochs)
    budgets = budgets.select(*(F.col(k).alias(f"q_{k}") for k in keys), "budget")
    plan = leaves.join(budgets, marks).select(
        *keys,
        "tokens",
        F.expr("case when tokens > 0 then budget div tokens else 0 end").alias("whole"),
        F.expr("case when tokens > 0 then budget % tokens else 0 end").alias("part"),
    )
    plan = write_stage(plan, "mix-plan")

    # sums by leaf and bucket of the epoch that is taken in part
    put = lambda df: df.select(*(F.col(k).alias(f"q_{k}") for k in keys), "whole", "part")
    placed = stored.join(put(plan), marks).drop(*(f"q_{k}" for k in keys))
    placed = placed.withColumn("place", digest(seed, F.col("whole"), F.col("id")))
    placed = placed.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    slim = placed.where("part > 0").select(*keys, "part", "bucket", "place", "tokens")
    sums = slim.groupBy(*keys, "part", "bucket").agg(F.sum("tokens").alias("tokens"))
    so_far = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sums.withColumn("before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
        .where((F.col("before") < F.col("part")) & (F.col("before") + F.col("tokens") >= F.col("part")))
        .select(*(F.col(k).alias(f"q_{k}") for k in keys), F.col("bucket").alias("q_bucket"), "before")
    )
    last = write_stage(last, "mix-last-buckets")
    # the place within that bucket where the prefix ends
    in_bucket = slim.join(last, [*marks, F.col("bucket") == F.col("q_bucket")])
    by_place = in_bucket.groupBy(*keys, "part", "before", "place").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        by_place.withColumn(
            "start", F.col("before") + F.coalesce(F.sum("tokens").over(upto), F.lit(0))
        )
        .where(F.col("start") < F.col("part"))
        .groupBy(*keys)
        .agg(F.max("place").alias("end"))
    )
    ends = write_stage(
        ends.select(*(F.col(k).alias(f"q_{k}") for k in keys), "end"), "mix-ends"
    )
    drawn = placed.join(ends, marks, "left").withColumn(
        "epochs",
        F.col("whole") + F.when(F.col("place") <= F.col("end"), F.lit(1)).otherwise(F.lit(0)),
    )
    drawn = drawn.where("epochs > 0").withColumn(
        "mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1))
    )
    results = {"mix_epoch", "mix_tokens"}
    return drawn.select(
        *(F.col("row").getField(c).alias(c) for c in carried if c.lower() not in results),
        "mix_epoch",
        F.col("tokens").alias("mix_tokens"),
    )
