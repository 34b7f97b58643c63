"""Joins from rows to counted groups.

A counted group is a key with the number of rows that carry it. The groups are
a stage table, so Spark knows their real size in bytes: it broadcasts them
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond
it. Any group may hold a third of all rows, even rows that are alike in every
column; the adaptive skew join cuts such a partition by its map outputs, which
needs no column that tells the rows apart. Only row-preserving joins are
offered, because those are the ones whose row side can be cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

_RIGHT = "__g_"


def join_groups(
    df: DataFrame, groups: DataFrame, on: list[str], how: str = "left_semi"
) -> DataFrame:
    """Join ``df`` to ``groups`` (unique on ``on``, NULL equals NULL).

    ``how`` is ``left_semi``, ``inner`` or ``left``; the last two add the
    groups' other columns.
    """
    if how not in ("left_semi", "inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    right = groups.withColumnsRenamed({n: _RIGHT + n for n in on})
    same = [F.col(n).eqNullSafe(F.col(_RIGHT + n)) for n in on]
    joined = df.join(right, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[_RIGHT + n for n in on])


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in the stage table ``keys``.

    A NULL key matches nothing and stays.
    """
    return df.join(keys, key, "left_anti")
