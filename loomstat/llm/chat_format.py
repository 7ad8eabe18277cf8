"""Chat formatting with Spark expressions only.

Rows of one conversation are collected as structs and sorted by (turn, role, text),
so ties have one order.  Adjacent turns of one role form one block:

    <|im_start|>ROLE\\nTEXT[<|im_sep|>TEXT...]<|im_end|>\\n

Texts are escaped: one backslash goes between ``<`` (with any backslashes after it)
and ``|``, so no text holds ``<|`` any more and every text can be read back.  In roles
backslashes and newlines are escaped too, as a newline ends the role.

NULL texts and roles count as empty; NULL turns sort first; rows with a NULL
conversation id form one conversation of their own; repeated rows are repeated turns.
An empty table gives an empty result; columns beyond the four named are not read.
A conversation is one output value, so it must fit one row; collection combines on
the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.expr import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*+)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    # two backslashes stand for one; what lies between such pairs holds escaped newlines only
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chats(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id`` and the ``formatted`` string."""
    turn = F.struct(
        rows[turn_col].alias("turn"),
        F.coalesce(rows[role_col], F.lit("")).alias("role"),
        F.coalesce(rows[text_col], F.lit("")).alias("text"),
    )
    chats = rows.groupBy(rows[conv_col].alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def block(turns: Column, first: Column, after: Column) -> Column:
        texts = F.transform(F.slice(turns, first + 1, after - first), lambda t: escape(t["text"]))
        role = _role_out(turns[first]["role"])
        return F.concat(F.lit(START), role, F.lit("\n"), F.array_join(texts, SEP), F.lit(END + "\n"))

    def merged(turns: Column, firsts: Column) -> Column:
        n, blocks = F.size(turns), F.size(firsts)
        return F.array_join(
            F.transform(firsts, lambda a, k: block(turns, a, F.when(k + 1 < blocks, F.try_element_at(firsts, k + 2)).otherwise(n))), ""
        )

    def formatted(turns: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(turns) - 1),
            lambda i: F.when(i == 0, F.lit(True)).otherwise(turns[i]["role"] != turns[F.greatest(i - 1, F.lit(0))]["role"]),
        )
        return let(starts, lambda firsts: merged(turns, firsts))

    return chats.select("conv_id", formatted(F.col("turns")).alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, texts array<string>>> of a formatted string."""
    blocks = F.array_remove(F.split(formatted, r"\Q" + END + r"\E\n"), "")

    def parsed(block: Column) -> Column:
        body = F.substring(block, len(START) + 1, 2147483647)
        cut = F.locate("\n", body)
        texts = F.split(F.substring(body, cut + 1, 2147483647), r"\Q" + SEP + r"\E")
        return F.struct(
            _role_in(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            F.transform(texts, unescape).alias("texts"),
        )

    return F.transform(blocks, parsed)


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """array<struct<start, end>>: code points of ``formatted`` that carry loss, one span per turn of ``role``."""
    blocks = F.split(formatted, r"(?<=\Q" + END + r"\E\n)")
    head = f"{START}{role}\n"
    none = F.array().cast("array<struct<start:int,end:int>>")

    def texts_of(spans: Column, pos: Column, block: Column) -> Column:
        body = F.substring(block, len(head) + 1, 2147483647)
        parts = F.split(F.substring(body, F.lit(1), F.length(body) - len(END) - 1), r"\Q" + SEP + r"\E")
        begin = F.struct((pos + len(head)).alias("at"), none.alias("out"))

        def step(acc: Column, part: Column) -> Column:
            end = acc["at"] + F.length(part)
            return F.struct(
                (end + len(SEP)).alias("at"),
                F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), end.alias("end")))).alias("out"),
            )

        return F.concat(spans, F.aggregate(parts, begin, step)["out"])

    def over(acc: Column, block: Column) -> Column:
        mine = F.startswith(block, F.lit(head))
        return F.struct(
            (acc["pos"] + F.length(block)).alias("pos"),
            F.when(mine, texts_of(acc["spans"], acc["pos"], block)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(blocks, F.struct(F.lit(0).alias("pos"), none.alias("spans")), over)["spans"]


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under a loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
