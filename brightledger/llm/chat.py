"""Chat formatting with Spark expressions only.

Template, per block of adjacent turns of one role (``+`` is no part of it)::

    <|im_start|> + role + <|im_sep|> + text + <|im_next|> + text ... + <|im_end|>

Every marker starts with ``<|``. Inside roles and texts a backslash is doubled and ``<|``
becomes ``<\\|``, so no marker can occur there and the escape can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per ``conv_id`` of the rows (conv_id, turn, role, text).

    Returns ``conv_id``, ``formatted`` and ``loss_mask``, the run lengths of the loss mask
    over the code points of ``formatted`` as (chars, loss); the runs with ``loss`` are
    exactly the texts of ``trained_role``.

    The turn structs of a conversation are collected and sorted by (turn, role, text), so
    ties have one order and repeated rows stay. Whether a turn opens or closes a block of
    its role comes from the arrays of the roles before and after it; the pieces are put
    together with one ``array_join``, linear in the conversation. A null role or text is
    empty; a null turn sorts first; rows without conv_id are one conversation of their own;
    other columns are ignored; an empty table gives no rows. A conversation is one value of
    the result, so its turns meet in one row by definition.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    with_roles = collected.select("conv_id", "turns", F.transform("turns", lambda t: t["role"]).alias("roles"))
    nothing = F.array(F.lit(None).cast("string"))
    neighbours = with_roles.select(
        "conv_id",
        F.arrays_zip(
            F.col("turns").alias("turn"),
            F.concat(nothing, F.slice("roles", 1, F.size("roles") - 1)).alias("before"),
            F.concat(F.slice("roles", 2, F.size("roles")), nothing).alias("after"),
        ).alias("turns"),
    )

    def segments(t: Column) -> Column:
        role, text = t["turn"]["role"], escaped(t["turn"]["text"])
        opens, closes = ~t["before"].eqNullSafe(role), ~t["after"].eqNullSafe(role)
        lead = F.when(opens, F.concat(F.lit(START), escaped(role), F.lit(SEP))).otherwise(F.lit(NEXT))
        return F.struct(lead.alias("lead"), text.alias("text"), (role == trained_role).alias("loss"), closes.alias("closes"))

    pieces = neighbours.select("conv_id", F.transform("turns", segments).alias("pieces"))
    end = lambda p: F.when(p["closes"], F.lit(END)).otherwise(F.lit(""))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"], end(p))), "").alias("formatted"),
        F.flatten(
            F.transform(
                "pieces",
                lambda p: F.array(
                    F.struct(F.length(p["lead"]).alias("chars"), F.lit(False).alias("loss")),
                    F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("loss")),
                    F.struct(F.length(end(p)).alias("chars"), F.lit(False).alias("loss")),
                ),
            )
        ).alias("loss_mask"),
    )


# Between a marker and a text, and between a block's end and the next block's start.
_BORDERS = r"(?<=<\|im_(?:sep|next)\|>)|(?=<\|im_(?:next|end)\|>)|(?<=<\|im_end\|>)"


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and the trained texts of each conversation, from its
    ``formatted`` text and ``loss_mask`` alone, unescaped."""
    blocks = F.slice(F.split("formatted", r"<\|im_end\|>"), 1, F.size(F.split("formatted", r"<\|im_end\|>")) - 1)

    def of_block(block: Column) -> Column:
        halves = F.split(block, r"<\|im_sep\|>", 2)
        role = unescaped(F.substr(F.get(halves, F.lit(0)), F.lit(len(START) + 1)))
        texts = F.split(F.get(halves, F.lit(1)), r"<\|im_next\|>")
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")))

    # A run of no characters has no segment of its own in the split text.
    runs = F.filter("loss_mask", lambda run: run["chars"] > 0)
    segments = F.filter(F.split("formatted", _BORDERS), lambda s: F.length(s) > 0)
    paired = F.zip_with(runs, segments, lambda run, s: F.struct(run["loss"].alias("loss"), run["chars"].alias("chars"), s.alias("text")))
    return formatted.select(
        "*",
        F.flatten(F.transform(blocks, of_block)).alias("turns"),
        F.transform(F.filter(paired, lambda p: p["loss"]), lambda p: unescaped(p["text"])).alias("trained"),
        F.forall(paired, lambda p: F.length(p["text"]).eqNullSafe(p["chars"])).alias("mask_fits"),
    )
