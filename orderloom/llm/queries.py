"""The queries of this subpackage, one per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    ann_forest,
    bpe_stream,
    chat_format,
    conversation_repair,
    decontaminate,
    lang_id,
    periodic_runs,
    quality_rules,
    simhash_planes,
    source_mix,
    substring_levels,
    token_shards,
    url_filter,
)
from orderloom.llm.common import table

WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lang_id.held_out(F.col("doc_id"))
    known = docs.where(F.col("doc_id").isNotNull() & ~out).select("doc_id", "lang", "text")
    model = lang_id.fit(known)
    found = lang_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.encode_digests(
        table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(WORD_BPE)
    )


#: A conversation whose texts are made of another template's marks.
PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = lambda turn, role: F.struct(F.lit(turn).alias("turn"), F.lit(role).alias("role"))
    added = spark.range(1).select(F.explode(F.array(one(0, "user"), one(1, "assistant"))).alias("one"))
    values = {"conv_id": F.lit(-1), "turn": F.col("one.turn"), "role": F.col("one.role"), "text": F.lit(PROBE)}
    probe = added.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in turns.schema))
    return chat_format.digests(chat_format.format_conversations(turns.union(probe)))


#: Whole-number weights by level of the tree.
MIX_WEIGHTS = {
    "domain": {"web": 3, "books": 2},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 2},
}


def mix_levels() -> dict[str, Column]:
    """The tree's levels, root first; a source's number tells its domain."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    return {
        "domain": F.when(F.length(number) != 1, F.lit("books")).otherwise(F.lit("web")),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    drawn = source_mix.mix(docs, mix_levels(), MIX_WEIGHTS, text_needed=False)
    return drawn.select("doc_id", "lang", "source", "mix_epoch", "mix_tokens")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_planes.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann_forest.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_levels.removal_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged = quality_rules.judge(quality_rules.with_metrics(docs).drop("text"))
    return judged.select("doc_id", *quality_rules.RESULTS, "kept")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.shard_digests(
        table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(WORD_BPE), END_ID
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs.select("doc_id", "text"), items, text_needed=False)
    return decontaminate.hit_digests(found)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(conversation_repair.damaged(turns))
    return conversation_repair.repair_digests(turns.select("conv_id").distinct(), repaired)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs.run_digests(periodic_runs.find_runs(docs, text_needed=False))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_bpe,
        op3_chat_format,
        op4_source_mix,
        op5_url_filter,
        op6_simhash,
        op7_ann,
        op8_substring_dedup,
        op9_quality_rules,
        op10_token_shards,
        op11_decontamination,
        op12_conversation_repair,
        op13_periodic_runs,
    )
}
