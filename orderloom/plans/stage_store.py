"""Stage tables: where a plan is cut and its result written down.

A stage is a Parquet table in the shared folder that the cluster names in
``spark.checkpoint.dir``. Reading it back gives the planner the true size and
keeps the work safe when executors are lost; nothing lives in executor memory
or on one machine's disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_LOCAL_ROOTS: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}
_COLLECTED: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables of this session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="orderloom-")
        shared = _LOCAL_ROOTS[app]
    return f"{shared.rstrip('/')}/orderloom/{spark.sparkContext.applicationId}"


def new_stage_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (collected := _COLLECTED.get()) is not None:
        collected.append(path)
    return path


@contextmanager
def collected_stages() -> Iterator[list[str]]:
    """The paths of the stage tables that are made inside, by this thread."""
    outer, made = _COLLECTED.get(), []
    token = _COLLECTED.set(made)
    try:
        yield made
    finally:
        _COLLECTED.reset(token)
        if outer is not None:
            outer.extend(made)


def stage_paths(spark: SparkSession) -> list[str]:
    """The stage tables that this session has made and not removed, oldest first."""
    return list(_MADE.get(spark.sparkContext.applicationId, []))


def remove_stages(spark: SparkSession, paths: list[str]) -> None:
    """Delete stage tables that this session has made; other paths are left alone."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path in made:
            made.remove(path)
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a stage table and return a frame that reads it."""
    spark = df.sparkSession
    path = new_stage_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, label: str, counts: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Write a stage table and count, while it is written, the rows of each condition.

    The counts are taken by the tasks that write, whose results count once even
    if a task is repeated.
    """
    metrics = Observation()
    observed = df.observe(metrics, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()])
    stored = write_stage(observed, label)
    return stored, dict(metrics.get)
