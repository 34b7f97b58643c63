"""Quality rules with verdicts on hosts.

Every document is measured by Spark expressions alone. Failures are added up by
host and kind: few words, repeated words, symbols, repeated lines, odd lengths
of words. For each kind the hosts' rates are shrunk towards a beta prior fitted
to all hosts, and a host whose shrunk rate of any kind lies beyond that kind's
limit loses all its documents. The limit is the prior's mean and ``SPREADS``
standard deviations, but within ``HOST_LIMITS``: hosts like all others stay,
however strict a rule is, and so do hosts of which few documents fail.

Defined results: a null text counts as empty (no words, so it fails); a null
host has no verdict of its own, its documents stand by their own rules; every
row is judged by itself, repeated rows and repeated ids too; an empty table
gives an empty table. Extra columns pass through; columns that bear the name of
a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import BLANKS, fresh, words
from orderloom.plans.stage_store import write_stage

SYMBOLS = "#*$%&|<>"
SPAN = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host's rule fails a document beyond these, in percent of its letters or lines.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: Least and greatest mean length of words.
WORD_LENGTHS = (2, 15)
SPREADS = 3.0
#: Bounds of the limits on hosts' rates.
HOST_LIMITS = (0.3, 0.5)
#: Bounds of the prior's weight, in documents: hosts without spread get the upper one.
PRIOR_WEIGHT = (1.0, 1e6)

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: Also measured, for the hosts' rules.
LINES = "n_lines"
KINDS = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def with_metrics(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """``docs`` with the six results of the document rules and n_lines, from whole texts.

    Words in repeated spans are counted in linear time: the spans are sorted by
    hash with their positions, equal neighbours are marked, and each marked
    position adds the words up to the next one, ``SPAN`` at most. Only texts
    whose spans are not all distinct come that far.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*RESULTS, LINES)]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    names = ("words", "hashes", "spans", "order", "keys", "at", "lines")
    w, hashes, spans, order, keys, at, ls = inner = [fresh(docs, f"__{n}") for n in names]

    df = docs.select(
        *kept,
        words(t).alias(w),
        lines.alias(ls),
        _without(t, BLANKS).alias("word_chars"),
        (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
    )
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            hashes: F.transform(w, lambda x: F.xxhash64(x)),
            LINES: F.size(ls).cast("long"),
            "n_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        }
    )
    span = lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, SPAN)))
    df = df.withColumn(
        spans,
        F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.lit(0), F.size(hashes) - (SPAN - 1))),
            span,
        ),
    )
    df = df.withColumn(
        order,
        F.when(
            F.size(F.array_distinct(spans)) < F.size(spans),
            F.sort_array(F.transform(spans, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    df = df.withColumn(keys, F.transform(order, lambda x: x["h"]))
    twin = lambda x, i: F.when(
        F.coalesce(F.get(keys, i + 1) == x["h"], F.lit(False))
        | F.coalesce((i > 0) & (F.get(keys, F.greatest(i - 1, F.lit(0))) == x["h"]), F.lit(False)),
        x["i"],
    )
    df = df.withColumn(
        at, F.sort_array(F.filter(F.transform(order, twin), lambda x: x.isNotNull()))
    )
    gaps = F.zip_with(
        at,
        F.slice(at, F.lit(2), F.size(at)),
        lambda a, b: F.least(F.lit(SPAN), F.coalesce(b - a, F.lit(SPAN))),
    )
    df = df.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(gaps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long"),
    )
    few, repeats = _document_rules(min_words, max_repeat_percent)
    return df.withColumn("base_failed", few | repeats).drop(*inner)


def _document_rules(min_words: int, max_repeat_percent: int) -> tuple[Column, Column]:
    n = F.col("n_words")
    return n < min_words, 100 * F.col("n_repeat_words") > max_repeat_percent * n


def failures(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> dict[str, Column]:
    """What counts against a document's host, by kind."""
    few, repeats = _document_rules(min_words, max_repeat_percent)
    n, chars = F.col("n_words"), F.col("word_chars")
    least, most = WORD_LENGTHS
    rules = (
        few,
        repeats,
        100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * chars,
        100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col(LINES),
        (chars < least * n) | (chars > most * n),
    )
    return dict(zip(KINDS, rules, strict=True))


def host_rates(measured: DataFrame, host: str = "source", counted: dict[str, Column] | None = None) -> DataFrame:
    """One row per host: ``host``, ``rates`` (kind to shrunk rate) and ``ok``.

    Rows are added up before the shuffle, so a host may hold any share of them.
    Only two numbers per kind, of the priors, go through the driver.
    """
    counted = counted or failures()
    raw = (
        measured.where(F.col(f"`{host}`").isNotNull())
        .groupBy(F.col(f"`{host}`").alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(k) for k, c in counted.items()))
    )
    hosts = write_stage(raw, "host-counts")
    moments = hosts.agg(*(f(F.col(k) / F.col("n")) for k in counted for f in (F.avg, F.var_pop))).first()
    rates, ok = [], F.lit(True)
    for i, kind in enumerate(counted):
        alpha, beta, limit = host_limit(*moments[2 * i : 2 * i + 2])
        rate = (F.col(kind) + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
        rates += [F.lit(kind), rate]
        ok = ok & (rate <= limit)
    return hosts.select("host", F.create_map(*rates).alias("rates"), ok.alias("ok"))


def host_limit(mean: float | None, spread: float | None) -> tuple[float, float, float]:
    """The prior of a kind of failures and the limit that follows from it."""
    alpha, beta = beta_prior(mean, spread)
    weight = alpha + beta
    deviation = (alpha * beta / (weight * weight * (weight + 1))) ** 0.5
    return alpha, beta, min(HOST_LIMITS[1], max(HOST_LIMITS[0], alpha / weight + SPREADS * deviation))


def beta_prior(mean: float | None, spread: float | None) -> tuple[float, float]:
    """The beta prior of that mean and variance, its weight kept within bounds."""
    if mean is None:
        return 0.5, 0.5
    low, high = PRIOR_WEIGHT
    weight = mean * (1 - mean) / spread - 1 if spread else high
    weight = min(max(weight, low), high)
    return mean * weight, (1 - mean) * weight


def judge(measured: DataFrame, host: str = "source", store: bool = True) -> DataFrame:
    """``measured`` (from :func:`with_metrics`) with ``host_rates`` and ``kept``.

    The measured rows are written once and read twice; with ``store=False``, for
    rows that carry texts, they are measured twice instead. The hosts' verdicts
    are joined without a hint: Spark broadcasts them while they are small, and
    otherwise splits hot hosts.
    """
    measured = measured.drop("host_rates", "kept")
    stored = write_stage(measured, "measured") if store else measured
    names = {n: fresh(stored, n) for n in ("host_", "ok_")}
    rates = write_stage(host_rates(stored, host), "host-rates").select(
        F.col("host").alias(names["host_"]), F.col("rates").alias("host_rates"), F.col("ok").alias(names["ok_"])
    )
    joined = stored.join(rates, F.col(f"`{host}`") == F.col(names["host_"]), "left")
    good = F.coalesce(F.col(names["ok_"]), F.lit(True))
    return joined.select(
        *(f"`{c}`" for c in stored.columns),
        "host_rates",
        (~F.col("base_failed") & good).alias("kept"),
    )


def kept_rows(judged: DataFrame) -> DataFrame:
    """The rows of ``judged`` that are kept, without storing them first.

    A filter on ``kept`` would be moved down to the scan, with the expressions of
    the rules written out once for each of their uses; a row generator stays.
    """
    name = fresh(judged, "stay_")
    stay = F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return judged.withColumn(name, F.explode(stay)).drop(name)
