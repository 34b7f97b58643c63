"""Connected components of a link table, in rounds of joins.

Each round does two steps on the links (a, b): *large* - every vertex tells its
larger neighbours the smallest vertex it knows of; *small* - it tells its smaller
neighbours. Each step is one grouping and one join, and the links shrink towards
stars around the smallest vertex of each component in a number of rounds that
grows with the logarithm of the longest chain. Rounds are cut by stage tables.

Defined results: a link with a null end is no link; repeated links and links of a
vertex to itself change nothing; no links give no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.plans.stage_store import write_stage


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 32)))
    ).first()
    return row[0], row[1] or 0


def _told(links: DataFrame, heads: DataFrame) -> DataFrame:
    """Each link's far end with the head of its near end. Hot vertices are split
    by the adaptive skew join: there is one head per vertex."""
    return links.join(heads, "u").select(F.col("v").alias("a"), F.col("head").alias("b"))


def _large(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    heads = both.groupBy("u").agg(F.min("v").alias("head")).select("u", F.least("u", "head").alias("head"))
    return _told(both.where("v > u"), heads).where("a != b").distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    heads = down.groupBy("u").agg(F.min("v").alias("head"))
    told = _told(down, heads).where("a != b")
    return told.union(heads.select(F.col("u").alias("a"), F.col("head").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """vertex, root (the smallest vertex of its component) for every vertex of
    ``links`` (two columns of numbers) that is not its own root."""
    a, b = links.columns
    now = write_stage(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "links"
    )
    state = _state(now)
    while state[0]:
        now = write_stage(_small(_large(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.greatest("a", "b").alias("vertex"), F.least("a", "b").alias("root"))
