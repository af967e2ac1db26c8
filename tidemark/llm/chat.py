r"""Chat formatting (operator 7), in Spark expressions only.

The turns of a conversation are collected as structs and sorted (by turn,
role, text), adjacent turns of one role are merged into a block by array
functions (where a role begins, and slices between), and blocks are concatenated::

    [role]\n first text [+] second text </s>\n      (without the blanks)

``[role]``, ``[+]`` (between merged turns) and ``</s>`` are control strings.
In texts and roles a backslash follows each ``\``, ``[`` and ``<`` (in roles
also ``]``), so no text can spell one, and taking those backslashes away
restores it. The loss mask is a list of code-point ranges of the formatted
string, one for each assistant text, without control strings.

:func:`read_back` parses formatted strings into turns again.

Edge cases. A null text or role is empty. Turns that tie are put in order of
role and text; rows that repeat are turns of their own. Rows without a
conversation id form one conversation. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE = "assistant"
_END, _MORE = "</s>\n", "[+]"


def escape(x: Column, role: bool = False) -> Column:
    return F.regexp_replace(x, r"([\\\[<\]])" if role else r"([\\\[<])", r"$1\\")


def unescape(x: Column, role: bool = False) -> Column:
    return F.regexp_replace(x, r"([\\\[<\]])\\" if role else r"([\\\[<])\\", "$1")


def _blocks(turns: Column, starts: Column) -> Column:
    """Adjacent turns of one role merged, each block written out; ``starts``: where a block begins."""

    def block(s: Column, i: Column) -> Column:
        own = F.slice(turns, s + 1, F.coalesce(F.get(starts, i + 1), F.size(turns)) - s)
        texts = F.array_join(F.transform(own, lambda t: escape(t["text"])), _MORE)
        return F.concat(_head(own[0]["role"]), texts, F.lit(_END))

    return F.transform(starts, block)


def _head(role: Column) -> Column:
    return F.concat(F.lit("["), escape(role, True), F.lit("]\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss`` (array of ``start, end`` code points) of each conversation of ``turns(conv_id, turn, role, text)``.

    Work and memory grow with a conversation's characters: where a text lies in the
    formatted string is a running sum over the sorted turns, and no array is
    built up turn by turn.
    """
    own = turns.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.lag("role").over(order)
    first = before.isNull() | (before != F.col("role"))
    opening = F.length(_head(F.col("role"))) + F.when(before.isNull(), 0).otherwise(len(_END))
    own = own.withColumn("gap", F.when(first, opening).otherwise(len(_MORE))).withColumn("size", F.length(escape(F.col("text"))))
    end = F.sum(F.col("gap") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    own = own.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    chats = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "start", "end"))).alias("turns"))
    changes = lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.get(F.col("turns"), i - 1)["role"])
    chats = chats.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), changes))
    learnt = F.filter("turns", lambda t: t["role"] == ROLE)
    return chats.select(
        "conv_id",
        F.array_join(_blocks(F.col("turns"), F.col("starts")), "").alias("formatted"),
        F.transform(learnt, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: array of ``role, text``."""
    blocks = F.split(formatted, _END, -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        head = F.regexp_extract(block, r"(?s)^\[.*?\]\n", 0)
        role = unescape(F.substring(head, F.lit(2), F.length(head) - 3), True)
        texts = F.split(F.substring(block, F.length(head) + 1, F.length(block)), r"\[\+\]", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped.

    Cut from the string's UTF-32 bytes: a place in them is found at once, one in a UTF-8 string by
    counting from its beginning. (The one-element array binds them to a name; the leading space keeps
    a text's own U+FEFF from being read as a byte order mark.)
    """

    def cut(b: Column) -> Column:
        size = lambda s: s["end"] - s["start"]
        part = lambda s: F.decode(F.concat(F.lit(bytearray(b"\0\0\0 ")), F.substring(b, 4 * s["start"] + 1, 4 * size(s))), "UTF-32")
        return F.array_join(F.transform(loss, lambda s: unescape(F.substring(part(s), F.lit(2), size(s)))), "")

    return F.transform(F.array(F.encode(formatted, "UTF-32")), cut)[0]
