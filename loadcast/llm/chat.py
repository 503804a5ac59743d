"""Chat formatting with Spark expressions only: collect, sort, merge, concatenate, and read back.

Template: ``<|role|>ROLE<|text|>TEXT[<|next|>TEXT ...]<|end|>`` per block; adjacent turns of one role
share a block. Roles and texts are escaped: every backslash is doubled and ``<|`` becomes ``<\\|``, so no
control string occurs inside them, and a backslash run between ``<`` and ``|`` is odd only where the
escape put one; both replacements are undone exactly.

One conversation is one output row, so its turns meet in one row by definition; before that, rows
are shuffled once by conv_id and nothing else is gathered.

Defined cases: NULL role or text is the empty string; turns sort by turn (NULL first), then role and
text, so ties and repeated rows have one order and all stay; a NULL conv_id is one conversation of its
own; extra columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed text: the control strings of the template.
ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``turns(conv_id, turn, role, text)`` to ``conv_id, formatted, loss_spans``: the formatted text and the
    spans array<struct<start, length>> (code points, 0-based) of the escaped texts of ``loss_role``."""
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    t = F.col("turns")
    first = F.transform(t, lambda x, i: (i == 0) | (x["role"] != F.element_at(t, F.greatest(i, F.lit(1)))["role"]))
    last = F.transform(t, lambda x, i: F.coalesce(F.get(F.col("first"), i + 1), F.lit(True)))
    # what stands before and after each escaped text
    parts = F.transform(F.arrays_zip("turns", "first", "last"), lambda x: F.struct(
        F.when(x["first"], F.concat(F.lit(ROLE), escape(x["turns"]["role"]), F.lit(TEXT))).otherwise(F.lit(NEXT)).alias("before"),
        escape(x["turns"]["text"]).alias("body"),
        F.when(x["last"], F.lit(END)).otherwise(F.lit("")).alias("after"),
        (x["turns"]["role"] == F.lit(loss_role)).alias("loss")))
    done = sorted_turns.withColumn("first", first).withColumn("last", last).withColumn("parts", parts)
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["before"])
        length = F.char_length(p["body"]).cast("bigint")
        spans = F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(start.alias("start"), length.alias("length"))))) \
            .otherwise(acc["spans"])
        return F.struct((start + length + F.char_length(p["after"])).alias("at"), spans.alias("spans"))

    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["before"], p["body"], p["after"])), "")
    return done.select("conv_id", formatted.alias("formatted"), F.reduce("parts", zero, add)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` array<struct<role, text>> and ``loss_texts`` array<string> (unescaped texts
    under the loss mask, in order), both taken from the formatted text alone and its spans."""
    pieces = F.slice(F.split("formatted", r"<\|end\|>", -1), F.lit(1), F.size(F.split("formatted", r"<\|end\|>", -1)) - 1)

    def turns_of(block: Column) -> Column:
        halves = F.split(F.substr(block, F.lit(len(ROLE) + 1)), r"<\|text\|>", 2)
        return F.transform(F.split(halves[1], r"<\|next\|>", -1),
                           lambda x: F.struct(unescape(halves[0]).alias("role"), unescape(x).alias("text")))

    texts = F.transform("loss_spans", lambda s: unescape(
        F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", F.flatten(F.transform(pieces, turns_of))).withColumn("loss_texts", texts)
