"""Chat formatting with a grammar round trip (DataFrame functions only).

A turn is rendered as ``### Header: text`` and a line ``</turn>``. Headers of the known
roles are fixed names; any other role is written URL-encoded behind ``=``, a null role is
``-``. A control string inside a text is written with one more backslash before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KNOWN = {"user": "User", "assistant": "Assistant", "system": "System"}
END = "\n</turn>\n"
#: Strings that the template uses as marks.
CONTROL = r"(###|</turn>)"


def _header(role):
    out = F.when(role.isNull(), F.lit("-"))
    for name, head in KNOWN.items():
        out = out.when(role == name, F.lit(head))
    return out.otherwise(F.concat(F.lit("="), F.url_encode(role)))


def _role(header):
    out = F.when(header == "-", F.lit(None).cast("string"))
    for name, head in KNOWN.items():
        out = out.when(header == head, F.lit(name))
    return out.otherwise(F.url_decode(F.substr(header, F.lit(2))))


def _escape(text):
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def _unescape(text):
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def _render(role, text):
    return F.concat(F.lit("### "), _header(role), F.lit(": "), text, F.lit(END))


def parse(formatted):
    """Array of (role, text, strict) of a formatted string column. ``strict`` is false where
    a text holds a control string that is not escaped, which the grammar forbids."""
    parts = F.split(formatted, END, -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    return F.transform(parts, lambda p: F.struct(
        _role(F.substr(F.substring_index(p, ": ", 1), F.lit(5))).alias("role"),
        _unescape(F.substr(p, F.char_length(F.substring_index(p, ": ", 1)) + 3)).alias("text"),
        (~F.rlike(F.regexp_replace(F.substr(p, F.char_length(F.substring_index(p, ": ", 1)) + 3),
                                   r"\\+" + CONTROL, " "), F.lit(CONTROL))).alias("strict")))


def render_turns(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with column ``rendered``: the plain rendering where its parse gives back
    the very turn, else the escaped one. A turn that even the escaped rendering does not
    give back stops the job instead of passing on changed text."""
    r, t = F.col(role), F.coalesce(F.col(text), F.lit(""))

    def same(rendered):
        x = parse(rendered)
        return (F.size(x) == 1) & F.get(x, F.lit(0))["strict"] & (
            F.get(x, F.lit(0))["text"] == t) & F.get(x, F.lit(0))["role"].eqNullSafe(r)

    out = turns.withColumn("__plain__", _render(r, t)).withColumn("__ok__", same(F.col("__plain__")))
    out = out.withColumn("rendered", F.when(F.col("__ok__"), F.col("__plain__")).otherwise(_render(r, _escape(t))))
    return out.withColumn("rendered", F.when(F.col("__ok__") | same(F.col("rendered")), F.col("rendered")).otherwise(
        F.raise_error(F.lit("a turn does not survive the round trip")))).drop("__plain__", "__ok__")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, formatted, turns (the parse of formatted), loss_spans
    (start and end, in code points, of the texts of role ``learn`` as they stand in formatted).

    Rows are ordered by turn, ties by role and text, nulls first. Turns are rendered, parsed
    and escaped row by row; the rows of a conversation then meet once, its output being one
    string, and that string is parsed again and compared to the source turns. Null text:
    empty; null role: kept as null; null conversation id: one conversation. Repeated rows
    are repeated turns. Empty table: empty result. Extra columns are not read. Very long texts
    are kept whole; a conversation must fit in a cell, as its output is one string.
    """
    t = turns.select(F.col(conv).alias("c"), F.col(turn).alias("n"), F.col(role).alias("r"),
                     F.coalesce(F.col(text), F.lit("")).alias("t"))
    before = Window.partitionBy("c").orderBy("n", "r", "t").rowsBetween(Window.unboundedPreceding, -1)
    t = render_turns(t, "r", "t").withColumn("at", F.coalesce(F.sum(F.char_length("rendered")).over(before), F.lit(0)))
    t = t.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("n", "r", "t", "rendered", "at"))).alias("src"))
    spans = F.transform(F.filter("src", lambda x: x["r"] == learn), lambda x: F.struct(
        (x["at"] + F.char_length(F.concat(F.lit("### "), _header(x["r"]), F.lit(": ")))).alias("start"),
        (x["at"] + F.char_length(x["rendered"]) - len(END)).alias("end")))
    t = t.withColumn("formatted", F.array_join(F.col("src.rendered"), "")).withColumn("loss_spans", spans)
    t = t.withColumn("turns", parse(F.col("formatted")))
    same = F.transform("src", lambda x: F.struct(x["r"].alias("role"), x["t"].alias("text"), F.lit(True).alias("strict")))
    return t.select(F.col("c").alias(conv), "formatted", F.when(F.to_json("turns") == F.to_json(same), F.col("turns"))
                    .otherwise(F.raise_error(F.lit("a conversation does not survive the round trip"))).alias("turns"), "loss_spans")


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digest columns read back from ``format_chats``: the masked text is cut from ``formatted`` by
    ``loss_spans`` and unescaped."""
    cut = lambda s: F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    masked = F.array_join(F.transform("loss_spans", lambda s: _unescape(cut(s))), "")
    told = F.array_join(F.transform("turns", lambda x: F.concat(
        F.coalesce(x["role"], F.lit("")), F.lit("\n"), x["text"], F.lit("\n"))), "")
    return (chats.withColumn("__masked__", masked).select(
        F.col(conv), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("__masked__").cast("long").alias("loss_chars"), F.sha2("__masked__", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars")))
