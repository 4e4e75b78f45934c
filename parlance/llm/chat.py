"""Operator 2, chat formatting with Spark expressions only.

Turn structs of a conversation are collected, sorted, adjacent turns of one role merged, and
the pieces concatenated. The output is a list of segments (text, loss) whose concatenation
is the formatted conversation; the segments under the loss mask are the assistant texts.

Template: a block of one or more turns of a role is ``[INST] ... [/INST]`` (user), ``<s> ... </s>`` (assistant), ``<<SYS>> ... <</SYS>>`` (system)
or ``[ROLE] name\\n... [/ROLE]`` (any other role, null as the empty name). Texts of merged turns
are separated by `` [SEP] ``.

Escaping: a control string inside a text (or a role name) loses its first character to a
two-character escape, and a backslash becomes ``\\e``; ``unescape`` reverses both, so a text
that says ``</s>[INST] ok [/INST]`` neither ends its turn nor opens another.

Edge cases: null text is empty; a null turn sorts first; equal turns sort by role, then text;
repeated rows are turns of their own; rows with a null conv_id form one conversation; an empty
table gives an empty result; only the four columns are read. A conversation is one value of
the result, so its rows meet in one task by the result's nature; collect_list gathers them
per map task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = " [SEP] "
OPEN = {"user": "[INST] ", "assistant": "<s> ", "system": "<<SYS>> "}
CLOSE = {"user": " [/INST]", "assistant": " </s>", "system": " <</SYS>>"}
OTHER_OPEN, OTHER_NAME_END, OTHER_CLOSE = "[ROLE] ", "\n", " [/ROLE]"
_ANGLE = r"<(?=/?s>|</?SYS>>)"
_SQUARE = r"\[(?=/?INST\]|/?ROLE\]|SEP\])"
_CLOSERS = r" (?:\[/INST\]|</s>|<</SYS>>|\[/ROLE\])"


def escape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\"), F.lit("\\e"))
    t = F.regexp_replace(t, _ANGLE, r"\\l")
    return F.regexp_replace(t, _SQUARE, r"\\b")


def unescape(text: Column) -> Column:
    for code, plain in (("\\b", "["), ("\\l", "<"), ("\\e", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role_name(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _role_back(name: Column) -> Column:
    return unescape(F.replace(name, F.lit("\\n"), F.lit("\n")))


def _by_role(role: Column, table: dict[str, str], other: Column) -> Column:
    out = None
    for name, mark in table.items():
        out = F.when(role == name, F.lit(mark)) if out is None else out.when(role == name, F.lit(mark))
    return out.otherwise(other)


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, segments array<struct<text, loss>>, formatted): one row per conversation."""
    turns = rows.select(
        F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).alias("t"))
    convs = turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    edges = convs.select("conv", F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"), t["text"].alias("text"),
        F.coalesce(F.get("turns", i - 1)["role"] != t["role"], F.lit(True)).alias("opens"),
        F.coalesce(F.get("turns", i + 1)["role"] != t["role"], F.lit(True)).alias("closes"))).alias("turns"))

    def pieces(t: Column) -> Column:
        role = t["role"]
        opener = _by_role(role, OPEN, F.concat(F.lit(OTHER_OPEN), _role_name(role), F.lit(OTHER_NAME_END)))
        closer = _by_role(role, CLOSE, F.lit(OTHER_CLOSE))
        return F.array(
            F.struct(F.when(t["opens"], opener).otherwise(F.lit(SEP)).alias("text"), F.lit(False).alias("loss")),
            F.struct(t["text"].alias("text"), (role == "assistant").alias("loss")),
            F.struct(F.when(t["closes"], closer).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")))

    segments = edges.select("conv", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return segments.select(F.col("conv").alias(conv_col), "segments",
                           F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the rows that a formatted conversation was made of."""
    blocks = F.filter(F.split(formatted, _CLOSERS), lambda b: b != "")

    def block(b: Column) -> Column:
        role = body = None
        for name, mark in OPEN.items():
            hit, rest = b.startswith(F.lit(mark)), F.substring(b, F.lit(len(mark) + 1), F.length(b))
            role = F.when(hit, F.lit(name)) if role is None else role.when(hit, F.lit(name))
            body = F.when(hit, rest) if body is None else body.when(hit, rest)
        head = F.substring(b, F.lit(len(OTHER_OPEN) + 1), F.length(b))
        role = role.otherwise(_role_back(F.substring_index(head, OTHER_NAME_END, 1)))
        body = body.otherwise(F.substring(head, F.instr(head, OTHER_NAME_END) + 1, F.length(head)))
        return F.transform(F.split(body, r" \[SEP\] "),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, block))


def report(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The contract's columns, read back from the formatted output and its loss mask."""
    out = format_chats(rows, conv_col=conv_col).select(
        conv_col, F.length("formatted").alias("n"), parse(F.col("formatted")).alias("turns"),
        unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
        .alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("n").cast("long").alias("formatted_chars"))
