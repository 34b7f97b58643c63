"""Duplicate groups: finding them, listing them, deleting from them.

A first pass shuffles 8-byte content hashes only and keeps those that occur
more than once. The real columns are compared afterwards, on the few rows that
are left, so a hash collision changes nothing. Groups are always reduced by
partial aggregation (count, smallest key), never collected.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..plans.group_joins import join_groups, without_keys
from ..plans.stage_store import write_counted, write_stage

_HASH = "__hash"
_ROWS = "__rows"
_FIRST = "__first"


def _possible_duplicates(
    df: DataFrame, cols: list[str], key: str | None = None, totals: Observation | None = None
) -> DataFrame:
    """Rows whose content hash is not unique: all duplicates and few others.

    The repeated hashes are counted and stored when this is called, so that the
    table itself has to move only if their list is too long to be broadcast.
    ``totals`` observes the table's rows and those with a ``key``, as sums of
    the counts by hash.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*cols))
    keys = [F.count(key).alias("__keys")] if totals else []
    counted = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_ROWS), *keys)
    if totals:
        sums = [F.sum(c).alias(n) for c, n in ((_ROWS, "rows"), ("__keys", "keys"))]
        counted = counted.observe(totals, *sums)
    repeated = write_stage(counted.where(F.col(_ROWS) > 1).select(_HASH), "repeated-hashes")
    return join_groups(hashed, repeated, [_HASH])


def _groups(rows: DataFrame, cols: list[str], carried: list[str]) -> DataFrame:
    """Real groups of two or more, each with its first row's other columns."""
    return (
        rows.groupBy(_HASH, *cols)
        .agg(
            F.count(F.lit(1)).alias(_ROWS),
            F.min(F.struct(*carried)).alias(_FIRST),
        )
        .where(F.col(_ROWS) > 1)
    )


def duplicate_groups(
    df: DataFrame, cols: list[str], key: str, rows: str = "group_rows",
    totals: Observation | None = None,
) -> DataFrame:
    """One row per duplicate group: its size and the row with the smallest key."""
    carried = [key] + [c for c in df.columns if c not in cols and c != key]
    groups = _groups(_possible_duplicates(df, cols, key, totals), cols, carried)
    source = {c: F.col(c) for c in cols}
    source.update({c: F.col(f"{_FIRST}.{c}").alias(c) for c in carried})
    return groups.select(F.col(_ROWS).alias(rows), *[source[c] for c in df.columns])


def duplicate_rows(
    df: DataFrame,
    cols: list[str],
    key: str,
    rows: str = "group_rows",
    where: Column | None = None,
) -> DataFrame:
    """Every member of every duplicate group, with the size of its group.

    ``where`` may refer to ``__first_key``, the smallest key of the group. The
    possible duplicates are stored once and read for the groups and for their
    members.
    """
    possible = write_stage(_possible_duplicates(df, cols), "possible-duplicates")
    groups = _groups(possible, cols, [key]).select(
        _HASH, *cols, _ROWS, F.col(f"{_FIRST}.{key}").alias("__first_key")
    )
    members = join_groups(possible, groups, [_HASH, *cols], how="inner")
    if where is not None:
        members = members.where(where)
    return members.select(*df.columns, F.col(_ROWS).alias(rows))


class Firsts(NamedTuple):
    """The rows that :func:`drop_one_per_duplicate_group` deletes, their number, and
    the rows of the whole table: all, and those with a key."""

    firsts: DataFrame
    groups: int
    table_rows: int
    table_keys: int


def counted_firsts(df: DataFrame, cols: list[str], key: str, rows: str = "group_rows") -> Firsts:
    """A stage table of the smallest key of each duplicate group and the size of the
    group, with the counts that fall off on the way."""
    totals = Observation()
    found = duplicate_groups(df, cols, key, rows, totals).select(key, rows)
    firsts, counts = write_counted(found, "group-firsts", {"groups": F.lit(True)})
    return Firsts(firsts, counts["groups"], totals.get["rows"] or 0, totals.get["keys"] or 0)


def first_of_each_group(
    df: DataFrame, cols: list[str], key: str, rows: str = "group_rows"
) -> DataFrame:
    """The stage table of :func:`counted_firsts`."""
    return counted_firsts(df, cols, key, rows).firsts


def drop_one_per_duplicate_group(
    df: DataFrame, cols: list[str], key: str, firsts: DataFrame | None = None
) -> DataFrame:
    """Delete one row, the one with the smallest key, of each duplicate group.

    ``firsts`` is the result of :func:`first_of_each_group`, if it is known.
    """
    if firsts is None:
        firsts = first_of_each_group(df, cols, key)
    return without_keys(df, firsts.select(key), key)


def drop_duplicates_keep_first(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Delete all rows of each duplicate group but the one with the smallest key."""
    surplus = duplicate_rows(df, cols, key, where=F.col(key) > F.col("__first_key"))
    return without_keys(df, write_stage(surplus.select(key), "duplicate-surplus"), key)
