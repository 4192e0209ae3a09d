r"""Chat formatting with a grammar round trip, with DataFrame functions only.

A turn is rendered as ``### <role>: <text> </turn>`` and a line end. The parser is deterministic: turns end at the closing
mark with a space before it, the role ends at the first colon, and a backslash before backslashes and a control string
(``###`` or ``</turn>``) is taken away. A turn is first rendered as it is and reparsed; where role or text come back
changed, the control strings in the text get a backslash in front, and it is reparsed again; a turn that still comes back
changed is an error. Roles have no free text: in
them the colon, ``<`` and ``%`` are written as ``%`` and two hex digits.

The loss mask covers the texts of the assistant's turns. Conversations are formatted in parts of ``PART_TURNS`` turns, so
one with very many turns is not gathered in one task.

Null texts and roles are empty. Null conversation ids are one conversation, null turn numbers come first; turns with the
same number are ordered by role and text. Repeated rows are repeated turns, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 64
OPEN, CLOSE = "### ", " </turn>\n"
_CONTROL = r"(\\*(?:###|</turn>))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\{_CONTROL}", "$1")


def written_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A")), F.lit("<"), F.lit("%3C"))


def read_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), written_role(role), F.lit(": "), body, F.lit(CLOSE))


def parsed(text: Column) -> Column:
    """Rendered text -> array of (role, text)."""
    pieces = F.slice(F.split(text, CLOSE, -1), F.lit(1), F.size(F.split(text, CLOSE, -1)) - 1)
    colon = lambda piece: F.instr(piece, ": ")
    return F.transform(
        pieces,
        lambda piece: F.struct(
            read_role(F.substring(piece, F.lit(len(OPEN) + 1), colon(piece) - len(OPEN) - 1)).alias("role"),
            unescaped(F.substring(piece, colon(piece) + 2, F.length(piece))).alias("text"),
        ),
    )


def format_parts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part) -> n_turns, formatted, loss_spans (first and last character of each assistant text as rendered).

    Parts are numbered by turn; a conversation's text is the texts of its parts in order.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        said.alias("text"),
    ).withColumn("part", F.floor(F.col("turn") / PART_TURNS))
    same = lambda body: F.coalesce(
        parsed(rendered(F.col("role"), body)) == F.array(F.struct("role", "text")), F.lit(False)
    )
    changed = F.raise_error(F.concat(F.lit("turn changed by the round trip, conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    bodies = plain.withColumn(
        "body", F.when(same(F.col("text")), F.col("text")).when(same(escaped(F.col("text"))), escaped(F.col("text")))
        .otherwise(changed.cast("string"))
    )
    each = bodies.select("conv_id", "part", F.struct("turn", "role", "text", "body").alias("t"))
    grouped = each.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    lengths = F.transform("turns", lambda t: F.length(rendered(t.role, t.body)))
    ends = F.aggregate(
        lengths, F.array(F.lit(0)), lambda so_far, n: F.concat(so_far, F.array(F.element_at(so_far, -1) + n))
    )
    spans = F.transform(
        "turns",
        lambda t, i: F.struct(
            t.role.alias("role"),
            (F.get(F.col("starts"), i) + F.length(written_role(t.role)) + len(OPEN) + 3).alias("first"),
            (F.get(F.col("starts"), i) + F.length(written_role(t.role)) + len(OPEN) + 2 + F.length(t.body)).alias("last"),
        ),
    )
    return grouped.withColumns({
        "formatted": F.array_join(F.transform("turns", lambda t: rendered(t.role, t.body)), ""),
        "starts": ends,
    }).select(
        "conv_id", "part", F.size("turns").cast("long").alias("n_turns"), "formatted",
        F.filter(spans, lambda s: s.role == "assistant").alias("loss_spans"),
    )


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss_spans) -> turns as parsed, and the texts under the loss mask."""
    return parts.withColumns({
        "turns": parsed(F.col("formatted")),
        "loss": F.transform(
            "loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["first"], s["last"] - s["first"] + F.lit(1)))
        ),
    })
