"""Chat conversations as training text, from typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document.
`flatten` visits the parts in order and gives one string: texts with their
control strings escaped, and a placeholder for each other part. It records
what each placeholder refers to and how many tokens it will expand to. Turns
become `<|im_start|>ROLE\\nCONTENT<|im_end|>\\n`, a conversation their
concatenation by turn (equal turns by role, then content).

Escaping is reversible: `\\` becomes `\\\\`, then `<|` becomes `<\\|`, so no
escaped text holds a control string; in a role a line break becomes `<|nl|>`
as well. NULL roles and texts count as empty. One conversation is one string,
so a conversation's turns meet in one row; nothing else is gathered.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
PARTS = "array<struct<kind:string,text:string,ref:string,units:long>>"
# Tokens that a placeholder stands for, by unit: an image tile, a second of audio, a document's page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """The content of a turn that is one text."""
    null = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), null.alias("ref"),
                            F.lit(0).cast("long").alias("units"))).cast(PARTS)


def flatten(parts: Column, expands: Mapping[str, int] = TOKENS_PER_UNIT) -> tuple[Column, Column]:
    """(content, attachments) of a list of parts.

    Attachments are structs (kind, ref, tokens) in the order of their placeholders;
    a kind without an entry in `expands` takes no tokens. NULL parts vanish.
    """
    visible = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())

    def tokens(p: Column) -> Column:
        rate = F.lit(0)
        for kind, n in expands.items():
            rate = F.when(p["kind"] == kind, F.lit(n)).otherwise(rate)
        return (rate * F.coalesce(p["units"], F.lit(0))).cast("long")

    def is_text(p: Column) -> Column:
        return F.coalesce(p["kind"], F.lit("text")) == "text"

    content = F.array_join(F.transform(visible, lambda p: F.when(
        is_text(p), escape(F.coalesce(p["text"], F.lit("")))
    ).otherwise(F.concat(F.lit("<|"), escape(p["kind"]), F.lit("|>")))), "")
    attachments = F.transform(F.filter(visible, lambda p: ~is_text(p)), lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), tokens(p).alias("tokens")))
    return content, attachments


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", trained: str = "assistant") -> DataFrame:
    """One row per conversation: (conv, formatted, loss_spans, attachments, expanded_tokens).

    `loss_spans` are (start, end) code points of `formatted`, one per turn of the role
    `trained`, over its content only. A conversation id may be NULL; an empty table gives no row.
    """
    who = F.coalesce(F.col(role), F.lit(""))
    content, attachments = flatten(F.col(parts))
    head = F.concat(F.lit(START), F.replace(escape(who), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
    rendered = turns.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), head.alias("_head"), content.alias("_body"),
        (who == trained).alias("_learn"), attachments.alias("_files"))
    item = F.struct("_turn", "_head", "_body", "_learn", "_files")
    chats = rendered.groupBy("_conv").agg(F.array_sort(F.collect_list(item)).alias("_t"))
    sizes = F.transform("_t", lambda t: F.struct(
        F.length(t["_head"]).alias("head"), F.length(t["_body"]).alias("body"), t["_learn"].alias("learn")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["head"]
        end = start + s["body"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"),
                        F.when(s["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    files = F.flatten(F.transform("_t", lambda t: t["_files"]))
    return chats.select(
        F.col("_conv").alias(conv),
        F.array_join(F.transform("_t", lambda t: F.concat(t["_head"], t["_body"], F.lit(END + "\n"))), "")
        .alias("formatted"),
        F.aggregate(sizes, begin, step)["spans"].alias("loss_spans"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, f: n + f["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back: array of (role, text)."""
    pieces = F.split(formatted, "<\\|im_start\\|>", -1)
    turns = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def parse(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(head) + 2, F.length(p) - F.length(head) - F.lit(len(END) + 2))
        return F.struct(unescape(F.replace(head, F.lit(BREAK), F.lit("\n"))).alias("role"),
                        unescape(body).alias("text"))

    return F.transform(turns, parse)


def read_spans(formatted: Column, spans: Column) -> Column:
    """The texts under the spans, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
