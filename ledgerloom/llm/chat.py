"""Conversations as marked-up text that a small grammar reads back exactly.

    conversation = { turn }
    turn         = "### " role ": " body "</turn>" "\\n"

In a role or a body, ``\\`` makes the next character plain. Texts stay as they are
where the grammar reads them back unchanged; the others are escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN = "### "
BETWEEN = ": "
CLOSE = "</turn>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Control strings broken up by a backslash, backslashes doubled."""
    for plain, marked in (("\\", "\\\\"), ("###", "\\###"), ("</turn>", "<\\/turn>")):
        text = F.replace(text, F.lit(plain), F.lit(marked))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(": "), F.lit(":\\ "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BETWEEN), turn["body"], F.lit(CLOSE + "\n"))


def parse_turns(rendered: Column) -> Column:
    """Turns of a rendered conversation, in order.

    ``role, text`` as they were, ``begin, length``: where the body, still
    escaped, lies in the rendered text, in code points.
    """
    pieces = F.split(rendered, F.lit(r"</turn>\n"), -1)
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    cut = F.transform(
        pieces,
        lambda p: F.struct(
            F.locate(BETWEEN, p, 1).alias("at"), F.length(p).alias("length"), p.alias("piece")
        ),
    )
    # One pass carries the running offset; a piece is followed by CLOSE and a line end.
    ended = F.transform(cut, lambda c: c["length"] + F.lit(len(CLOSE) + 1))
    starts = F.aggregate(
        ended,
        F.struct(
            F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("bigint").alias("next")
        ),
        lambda state, n: F.struct(
            F.array_append(state["starts"], state["next"]).alias("starts"),
            (state["next"] + n).alias("next"),
        ),
        lambda state: state["starts"],
    )
    return F.zip_with(
        cut,
        starts,
        lambda c, start: F.struct(
            unescape(
                F.substring(c["piece"], F.lit(len(OPEN) + 1), c["at"] - F.lit(len(OPEN) + 1))
            ).alias("role"),
            unescape(F.substring(c["piece"], c["at"] + F.lit(2), c["length"])).alias("text"),
            (start + c["at"] + F.lit(1)).alias("begin"),
            (c["length"] - c["at"] - F.lit(1)).alias("length"),
        ),
    )


def _reads_back(turn: Column, raw: Column) -> Column:
    """Whether the grammar gives the raw role and body back as one turn."""
    rendered = _render(raw)
    one_close = F.locate(CLOSE, rendered, 1) == F.length(rendered) - F.lit(len(CLOSE))
    head = F.locate(BETWEEN, rendered, 1) == F.lit(len(OPEN) + 1) + F.length(raw["role"])
    plain = ~F.contains(raw["role"], F.lit("\\")) & ~F.contains(raw["body"], F.lit("\\"))
    marked = F.contains(raw["body"], F.lit("###")) | F.contains(raw["role"], F.lit("###"))
    return one_close & head & plain & ~marked


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, formatted, turns`` per conversation; ``turns`` as `parse_turns` reads them.

    Rows go by turn, NULL first, ties by role and text; repeated rows are
    repeated turns. NULL roles and texts are empty. Rows without ``conv_id`` are
    one conversation. Other columns are left out, no rows give no rows. A turn
    is rendered as it is when it reads back unchanged, and escaped otherwise;
    should the whole text still not read back, the query fails instead of
    giving wrong turns. One conversation is one text and so lies in one task.
    """
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    given = F.struct(
        F.col(turn_col).alias("turn"),
        text_of(role_col).alias("role"),
        text_of(text_col).alias("body"),
    )
    grouped = (
        turns.select(F.col(conv_col).alias("conv_id"), given.alias("_turn"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("_turn")).alias("_given"))
    )

    def marked_up(turn: Column) -> Column:
        escaped = F.struct(
            escape_role(turn["role"]).alias("role"), escape(turn["body"]).alias("body")
        )
        return F.when(_reads_back(turn, turn), _render(turn)).otherwise(_render(escaped))

    rendered = grouped.withColumn(
        "formatted", F.array_join(F.transform("_given", marked_up), "")
    )
    parsed = rendered.withColumn("turns", parse_turns(F.col("formatted")))
    pair = lambda t, text: F.struct(t["role"].alias("role"), t[text].alias("text"))
    same = F.transform("turns", lambda t: pair(t, "text")) == F.transform(
        "_given", lambda t: pair(t, "body")
    )
    wrong = F.raise_error(F.lit("a formatted conversation does not read back")).cast(
        parsed.schema["turns"].dataType
    )
    return parsed.select(
        "conv_id", "formatted", F.when(same, F.col("turns")).otherwise(wrong).alias("turns")
    )


def loss_text(formatted: Column, turns: Column, role: str = LOSS_ROLE) -> Column:
    """All text under the loss mask: the bodies of one role, cut from the rendered text."""
    masked = F.filter(turns, lambda t: t["role"] == role)
    bodies = F.transform(
        masked,
        lambda t: unescape(
            F.substring(formatted, t["begin"].cast("int") + F.lit(1), t["length"].cast("int"))
        ),
    )
    return F.array_join(bodies, "")
