"""Chat formatting by Spark expressions.

The turns of a conversation are collected as structs and sorted, adjacent turns
of one role become one block, and the blocks are joined to one text:

    <|role|>ROLE<|text|>TEXT<|next|>TEXT<|end|>\\n

``<|next|>`` parts the merged turns of a block, so the turns can be told apart
again. In roles and texts ``&``, ``<``, ``>`` and ``[`` are written ``&amp;``,
``&lt;``, ``&gt;`` and ``&#91;``, so that neither this template's marks nor
those of other common templates can occur inside a text; undoing the four in
reverse order gives the text back.

The loss mask is a list of runs (characters, whether they count), one for each
mark and each text in order; the runs add up to the formatted text.

Defined results: a null text is empty, a null role is the empty role; turns are
ordered by turn, then role, then text, nulls first, and repeated rows stay;
rows with a null conversation id form one conversation with a null id. Extra
columns are ignored. A conversation becomes one cell, so it has to fit in one
(2 GB); no other group is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_runs."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    sorted_turns = (
        turns.groupBy("conv_id")
        .agg(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))).alias("turns"))
        .select("conv_id", F.sort_array("turns").alias("turns"))
    )
    before = F.concat(
        F.array(F.lit(None).cast("string")),
        F.transform(F.slice("turns", F.lit(1), F.size("turns") - 1), lambda t: t["role"]),
    )
    # the mark before each text: a new block closes the one before it
    mark = lambda t, last: F.when(
        last == t["role"], F.lit(NEXT)
    ).otherwise(
        F.concat(
            F.when(last.isNull(), F.lit("")).otherwise(F.lit(END)),
            F.lit(ROLE),
            escape(t["role"]),
            F.lit(TEXT),
        )
    )
    pieces = F.zip_with(
        "turns",
        before,
        lambda t, last: F.struct(
            mark(t, last).alias("mark"),
            escape(t["text"]).alias("text"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    run = lambda chars, loss: F.struct(chars.alias("chars"), loss.alias("loss"))
    runs = F.flatten(
        F.transform(
            "pieces",
            lambda p: F.array(
                run(F.length(p["mark"]), F.lit(False)), run(F.length(p["text"]), p["loss"])
            ),
        )
    )
    return sorted_turns.select("conv_id", pieces.alias("pieces")).select(
        "conv_id",
        F.concat(
            F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), ""),
            F.lit(END),
        ).alias("formatted"),
        F.concat(runs, F.array(run(F.lit(len(END)), F.lit(False)))).alias("loss_runs"),
    )


def _quoted(mark: str) -> str:
    return mark.replace("|", r"\|")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, from the formatted text and its mask alone.

    The text is cut at its marks into the pieces that the runs describe; a mask
    whose lengths differ from the pieces stops the job.
    """
    blocks = F.split("formatted", _quoted(END), -1)
    head = lambda b: F.substring_index(b, TEXT, 1)
    texts = lambda b: F.split(F.substring_index(b, TEXT, -1), _quoted(NEXT), -1)
    role = lambda b: F.replace(head(b), F.lit(ROLE), F.lit(""))
    df = formatted.select(
        "conv_id",
        "loss_runs",
        F.slice(blocks, F.lit(1), F.size(blocks) - 1).alias("blocks"),
    ).select(
        "conv_id",
        "loss_runs",
        F.flatten(
            F.transform(
                "blocks",
                lambda b: F.transform(
                    texts(b), lambda t: F.struct(role(b).alias("role"), t.alias("text"))
                ),
            )
        ).alias("turns"),
    )
    # the runs at odd places are the texts
    masked = F.zip_with(
        "turns",
        F.filter("loss_runs", lambda _, i: i % 2 == 1),
        lambda t, r: F.when(
            F.coalesce(F.length(t["text"]) == r["chars"], F.lit(False)),
            F.when(r["loss"], unescape(t["text"])).otherwise(F.lit("")),
        ).otherwise(F.raise_error(F.lit("the loss mask does not fit the text")).cast("string")),
    )
    return df.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")),
        ).alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`read_back` gives, per conversation."""
    size = formatted.select(F.col("conv_id"), "formatted", "loss_runs")
    back = read_back(size.withColumn("conv_id", F.struct("conv_id", F.length("formatted").alias("n"))))
    script = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        F.col("conv_id.conv_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(script, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("conv_id.n").cast("long").alias("formatted_chars"),
    )
