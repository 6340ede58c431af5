"""Chat formatting by a grammar round trip, in SQL functions only.

Template, for each turn:  [INST]role[/INST]text</s>
A conversation starts with <s> if its texts went in as they are, and with <s\\>
if control strings inside them were escaped. Escaping puts one backslash into
each control string (and one more into each that has some), so it can always be taken back:
[INST] -> [\\INST], [/INST] -> [/\\INST], </s> -> </\\s>.

Each conversation is first rendered as it is and parsed again. Where the recovered
turns differ from the source, it is rendered with escapes, which always reads
back identically; ``round_trip`` states the result of that last comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
PLAIN, ESCAPED = "<s>", "<s\\>"
CONTROL = r"(\[/?|</)(\\*)(INST\]|s>)"
CONTROL_ESCAPED = r"(\[/?|</)\\(\\*)(INST\]|s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL_ESCAPED), F.lit("$1$2$3"))


def render(turns: Column, head: str, change=lambda c: c) -> Column:
    """The turns (array of role, text) as one string."""
    parts = F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), change(t["role"]), F.lit(MIDDLE), change(t["text"]), F.lit(CLOSE)))
    return F.concat(F.lit(head), F.array_join(parts, ""))


def parse(formatted: Column, head: str, change=lambda c: c) -> Column:
    """Turns of a rendered string: cut at CLOSE, each part is OPEN role MIDDLE text.

    A part without that form gives a turn with a NULL role and the part as text.
    """
    body = F.substring(formatted, len(head) + 1, 2**31 - 1)
    parts = F.split(body, r"</s>", -1)
    # What follows the last CLOSE is empty in a well-formed string.
    parts = F.filter(parts, lambda p, i: (p != "") | (i < F.size(parts) - 1))

    def turn(part: Column) -> Column:
        at = F.locate(MIDDLE, part)
        fine = part.startswith(OPEN) & (at > 0)
        role = F.when(fine, change(part.substr(F.lit(len(OPEN) + 1), at - len(OPEN) - 1)))
        text = F.when(fine, change(part.substr(at + len(MIDDLE), F.length(part)))).otherwise(part)
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(parts, turn)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """conv, formatted, turns (read back from it), escaped, round_trip.

    Turns stand by turn number; equal numbers by role, then text; NULL numbers
    come last. NULL roles and texts count as empty. Rows with a NULL
    conversation form one conversation. Repeated rows are turns of their own. An
    empty table gives no rows. A conversation has to fit one row, as its output
    is one string; other columns of the input are not read.
    """
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"))

    def before(a, b):
        """Turn numbers ascending, NULL last; then role and text."""
        def order(x, y):
            return F.when(x < y, -1).when(x > y, 1)
        number = (F.when(a["turn"].isNull() & b["turn"].isNotNull(), 1)
                  .when(a["turn"].isNotNull() & b["turn"].isNull(), -1).otherwise(order(a["turn"], b["turn"])))
        return F.coalesce(number, order(a["role"], b["role"]), order(a["text"], b["text"]), F.lit(0))

    source = (rows.select(F.col(conv).alias(conv), said.alias("said")).groupBy(conv)
              .agg(F.array_sort(F.collect_list("said"), before).alias("said"))
              .select(conv, F.transform("said", lambda s: F.struct(s["role"].alias("role"), s["text"].alias("text")))
                      .alias("source")))
    plain = source.select("*", render(F.col("source"), PLAIN).alias("plain"))
    first = plain.select("*", (parse(F.col("plain"), PLAIN) == F.col("source")).alias("same"))
    done = first.select(conv, "source", (~F.col("same")).alias("escaped"), F.when(F.col("same"), F.col("plain"))
                        .otherwise(render(F.col("source"), ESCAPED, escape)).alias("formatted"))
    read = done.select("*", read_back(F.col("formatted")).alias("turns"))
    return read.select(conv, "formatted", "turns", "escaped", (F.col("turns") == F.col("source")).alias("round_trip"))


def read_back(formatted: Column) -> Column:
    """Turns of a formatted conversation, escapes taken back."""
    return (F.when(formatted.startswith(ESCAPED), parse(formatted, ESCAPED, unescape))
            .otherwise(parse(formatted, PLAIN)))


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask: the texts of that role, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"]), "")


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The contract columns of formatted conversations, all from the turns read back."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = formatted.select(conv, "formatted", "escaped", "round_trip", F.size("turns").cast("long").alias("n_turns"),
                             told.alias("told"), loss_text(F.col("turns")).alias("masked"))
    return parts.select(
        conv, "n_turns", F.sha2(F.col("told"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "escaped", "round_trip")
