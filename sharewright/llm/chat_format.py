"""Chat formatting with Spark expressions only.

Turn structs of a conversation are collected, sorted by (turn, role, text) with nulls first, adjacent turns of one role
share a header (their texts stay apart by a control string), and everything is concatenated. Control strings inside texts
and roles get one backslash more (``<|`` becomes ``<\\|``), which reading takes away again. ``loss_runs`` is the loss mask
as run lengths: signs to skip, then signs to learn, per turn. ``parts`` are the pieces of ``formatted``, one a turn, in which the
mask is applied in time linear in the text. A conversation is one row by definition of the format.

Null text and role count as empty; a null ``conv_id`` is a conversation of its own; repeated rows are repeated turns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~")))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, parts, loss_runs: one row per conversation."""
    empty = F.lit("")
    collected = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"),
                            F.coalesce("text", empty).alias("text")).alias("t")
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t, i):
        first = (i == 0) | (F.get("turns", i - 1)["role"] != t["role"])
        last = (i == F.size("turns") - 1) | (F.get("turns", i + 1)["role"] != t["role"])
        return F.struct(
            F.when(first, F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))).otherwise(F.lit(SEP)).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(last, F.lit(END + "\n")).otherwise(empty).alias("tail"),
            (t["role"] == F.lit(loss_role)).alias("loss"))

    pieces = collected.select("conv_id", F.transform("turns", piece).alias("pieces"))
    parts = F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"]))
    return pieces.withColumn("parts", parts).select(
        "conv_id", F.array_join("parts", "").alias("formatted"), "parts", F.transform("pieces", lambda p: F.struct(
            (F.length(p["head"]) + F.when(p["loss"], 0).otherwise(F.length(p["body"]))).alias("skip"),
            F.when(p["loss"], F.length(p["body"])).otherwise(0).alias("learn"),
            F.length(p["tail"]).alias("skip_after"))).alias("loss_runs"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda b: b != "")

    def block(b):
        body = F.substr(b, F.lit(len(START) + 1))
        at = F.instr(body, F.lit("\n"))
        role = unescape_role(F.substr(body, F.lit(1), at - 1))
        texts = F.split(F.substr(body, at + 1), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda s: F.struct(role.alias("role"), unescape(s).alias("text")))

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, block)))


def learnt_text(chats: DataFrame) -> DataFrame:
    """Adds ``learnt``: what the loss mask cuts out of the parts of ``formatted``, unescaped."""
    spans = F.zip_with("parts", "loss_runs", lambda p, r: unescape(F.substr(p, r["skip"] + 1, r["learn"])))
    return chats.withColumn("learnt", F.array_join(spans, ""))


def chat_digests(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """What a reader gets back from the formatted conversations, and what the loss mask cuts out of them."""
    back = learnt_text(read_chats(format_chats(turns, loss_role)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"),
                       "learnt", F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")
