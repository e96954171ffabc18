"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, MORE, END = "<|im_start|>", "<|im_sep|>", "<|im_more|>", "<|im_end|>"


def escape(c: Column) -> Column:
    """Marks can't occur in the result: a backslash is doubled and ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _pieces(c: Column, mark: str) -> Column:
    return F.split(c, mark.replace("|", r"\|"))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", answerer: str = "assistant", segment: int = 256) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans): one row per conversation.

    Turns are ordered by (turn, role, text). Adjacent turns of a role share
    one block ``<|im_start|>role<|im_sep|>text<|im_more|>text<|im_end|>``;
    control strings in roles and texts are escaped reversibly, so
    ``read_turns`` gives back every turn. ``loss_spans`` holds the code points
    (start, end exclusive) of the texts of ``answerer`` in ``formatted``: the
    escaped texts alone, no marks.

    Turn structs are collected per (conversation, segment of ``segment`` turn
    numbers), sorted and merged there, and the segments, pre-aggregated to a
    string each, are joined per conversation; a very long conversation is many
    small groups before its one output row. Null texts and roles are empty;
    null turn numbers come first; null conversations form one; repeated rows
    are repeated turns. Other columns are ignored. An empty table gives an
    empty result.
    """
    rows = turns.select(F.col(conv).alias("conv_id"), F.floor(F.col(turn) / F.lit(segment)).alias("seg"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    collected = rows.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    start = F.struct(F.lit(None).cast("string").alias("role"), F.lit("").alias("body"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(s: Column, t: Column) -> Column:
        glue = F.when(s["role"].isNull(), F.lit("")).when(s["role"] == t["role"], F.lit(MORE)).otherwise(
            F.concat(F.lit(END + START), escape(t["role"]), F.lit(SEP)))
        at = F.length(s["body"]) + F.length(glue)
        return F.struct(
            t["role"].alias("role"), F.concat(s["body"], glue, escape(t["text"])).alias("body"),
            F.when(t["role"] == answerer, F.concat(s["spans"], F.array(F.struct(
                at.alias("start"), (at + F.length(escape(t["text"]))).alias("end"))))).otherwise(s["spans"]).alias("spans"))

    merged = collected.withColumn("m", F.aggregate("ts", start, add)).select(
        "conv_id", F.struct("seg", F.col("ts")[0]["role"].alias("first"), F.col("m.role").alias("last"),
                            F.size("ts").alias("n"), F.col("m.body").alias("body"),
                            F.col("m.spans").alias("spans")).alias("s"))
    joined = merged.groupBy("conv_id").agg(F.array_sort(F.collect_list("s")).alias("ss"))
    head = lambda s: F.concat(F.lit(START), escape(s["first"]), F.lit(SEP))

    def glue_of(s: Column, i: Column) -> Column:
        previous = F.get("ss", i - 1)
        return F.when(i == 0, head(s)).when(previous["last"] == s["first"], F.lit(MORE)).otherwise(
            F.concat(F.lit(END), head(s)))

    joined = joined.withColumn("gs", F.transform("ss", glue_of))
    joined = joined.withColumn("at", F.aggregate(
        F.arrays_zip("ss", "gs"), F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x["gs"]) + F.length(x["ss"]["body"])))))
    shifted = F.flatten(F.transform("ss", lambda s, i: F.transform(s["spans"], lambda p: F.struct(
        (p["start"] + F.get("at", i) + F.length(F.get("gs", i))).alias("start"),
        (p["end"] + F.get("at", i) + F.length(F.get("gs", i))).alias("end")))))
    body = F.concat(F.array_join(F.transform("ss", lambda s, i: F.concat(F.get("gs", i), s["body"])), ""), F.lit(END))
    return joined.select("conv_id", F.aggregate("ss", F.lit(0).cast("long"), lambda n, s: n + s["n"]).alias("n_turns"),
                         body.alias("formatted"), shifted.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted conversation holds."""
    blocks = F.filter(_pieces(formatted, END), lambda b: F.length(b) > 0)

    def turns_of(block: Column) -> Column:
        parts = _pieces(F.substring(block, len(START) + 1, 2147483647), SEP)
        role = unescape(F.get(parts, F.lit(0)))
        return F.transform(_pieces(F.get(parts, F.lit(1)), MORE),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda p: unescape(
        F.substring(formatted, p["start"] + 1, p["end"] - p["start"]))), "")
