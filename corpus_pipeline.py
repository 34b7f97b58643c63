"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes it as Parquet in the session's shared folder and hands the stored table
to the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe_stream, quality_rules, simhash_planes, source_mix, substring_levels
from orderloom.llm.common import table
from orderloom.llm.queries import MIX_WEIGHTS, WORD_BPE, mix_levels
from orderloom.plans.stage_store import remove_stages, stage_paths, write_stage

_LEFT: dict[str, list[str]] = {}


def _tables_read(df: DataFrame) -> set[str]:
    """The folders that a frame's plan reads, one entry per scan; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            roots = leaf.relation().location().rootPaths()
            found |= {roots.apply(k).toUri().getPath() for k in range(roots.length())}
    return found


def _tidy(stage: Callable) -> Callable:
    """Before a stage starts, remove the intermediate tables of the stage before,
    whose result is stored by then - unless ``docs`` still reads one of them."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        left = _LEFT.pop(app, [])
        if left:
            read = _tables_read(docs)
            inner = spark._jvm.org.apache.hadoop.fs.Path
            free = [p for p in left if inner(p).toUri().getPath() not in read]
            remove_stages(spark, free)
            left = [p for p in left if p not in free]
        before = stage_paths(spark)
        out = stage(spark, docs, sf_dir)
        _LEFT[app] = left + [p for p in stage_paths(spark) if p not in before]
        return out

    return run_stage


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules or their host's verdict reject go."""
    judged = quality_rules.judge(quality_rules.with_metrics(docs), store=False)
    return quality_rules.kept_rows(judged).select(*docs.columns)


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints (three-word shingles,
    links at two differing bits at most) stays, the one with the smallest id."""
    return simhash_planes.one_per_group(docs)


@_tidy
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; untouched texts stay as they are."""
    out = substring_levels.remove_repeated(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    sizes = {"n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return out.withColumns({"text": text, **sizes}).select(*docs.columns)


@_tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt over sources by weight; a document drawn
    in two epochs comes twice."""
    return source_mix.mix(docs, mix_levels(), MIX_WEIGHTS).select(*docs.columns)


@_tidy
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of what they decode to."""
    return bpe_stream.encode_digests(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix),
    ("BPE encoding and decoding", encode),
]

#: SQL has no tokenizer of this kind; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each from what the one before has stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
