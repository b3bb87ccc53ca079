"""Chat formatting with relational expressions only.

Turn rows are collected per conversation as structs, sorted, cut into blocks
of adjacent turns with one role, and joined to one string::

    <s>[INST] role [TEXT] text [TEXT] next text of the same role [/INST][INST] ... [/INST]</s>

Inside roles and texts, every control string (also one that already carries
backslashes after its first character) gets one backslash more after its first
character. So no control string stands inside a text, and taking one backslash
away gives the text back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: control strings of the template
BOS, EOS = "<s>", "</s>"
OPEN, TEXT, CLOSE = "[INST] ", " [TEXT] ", " [/INST]"
#: first character, then what follows it, of each control string to escape
ESCAPED = r"(<)(\\*)(s>|/s>)|(\[)(\\*)(INST\]|/INST\]|TEXT\])"
UNESCAPED = r"(<)\\(\\*)(s>|/s>)|(\[)\\(\\*)(INST\]|/INST\]|TEXT\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$4\\$2$5$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPED, r"$1$4$2$5$3$6")


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, n_blocks, formatted``.

    Reads ``conv_id, turn, role, text``; other columns are ignored. Turns are
    ordered by turn, ties by role, then text; repeated rows stay as turns of
    their own; a null turn comes first; null roles and texts count as empty. A
    null conv_id is one conversation. No rows give no rows. One conversation
    is one output string, so it is held by one task; nothing else is gathered.
    """
    one = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                   F.coalesce(F.col("text"), F.lit("")).alias("text"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("s"))
    starts = F.filter(F.sequence(F.lit(0), F.size("s") - 1),
                      lambda i: (i == 0) | (F.get("s", i)["role"] != F.get("s", i - 1)["role"]))
    convs = convs.withColumn("a", starts)
    ends = F.concat(F.slice("a", 2, F.size("a")), F.array(F.size("s")))
    convs = convs.withColumn("blocks", F.zip_with("a", ends, lambda x, y: F.slice(F.col("s"), x + 1, y - x)))
    body = F.transform("blocks", lambda b: F.concat(
        F.lit(OPEN), escape(b[0]["role"]),
        F.array_join(F.transform(b, lambda t: F.concat(F.lit(TEXT), escape(t["text"]))), ""),
        F.lit(CLOSE)))
    return convs.select("conv_id", F.size("s").cast("long").alias("n_turns"), F.size("blocks").cast("long").alias("n_blocks"),
                        F.concat(F.lit(BOS), F.array_join(body, ""), F.lit(EOS)).alias("formatted"))


def _literal(control: str) -> str:
    return r"\Q" + control + r"\E"


def parse_chat(formatted: Column) -> Column:
    """Array of ``struct(role, text)`` read back from a formatted string, one
    per original turn. A string without a block gives an empty array."""
    inner = F.substring(formatted, F.lit(len(BOS) + 1), F.char_length(formatted) - len(BOS) - len(EOS))
    blocks = F.filter(F.split(inner, _literal(CLOSE)), lambda b: b != "")
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, F.lit(len(OPEN) + 1), F.char_length(b)), _literal(TEXT)))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.slice(p, F.lit(2), F.size(p)),
        lambda t: F.struct(unescape(p[0]).alias("role"), unescape(t).alias("text")))))


def loss_text(parsed: Column, role: str = "assistant") -> Column:
    """Text under the loss mask: each text of ``role`` once, in order, nothing between."""
    kept = F.filter(parsed, lambda t: t["role"] == role)
    return F.array_join(F.transform(kept, lambda t: t["text"]), "")


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Figures of each conversation, all read back from its formatted string."""
    back = formatted.select("conv_id", "n_blocks", "formatted", parse_chat(F.col("formatted")).alias("p"))
    said = F.array_join(F.transform("p", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.withColumn("loss", loss_text(F.col("p")))
    return back.select(
        "conv_id", F.size("p").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "n_blocks")
