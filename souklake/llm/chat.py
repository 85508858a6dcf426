"""Chat formatting: conversations rebuilt from event logs, rendered with a loss mask, and read back.

A log has rows (conv_id, seq, kind, message, role, text). Kinds:

- ``message`` sets role and text of a message anew;
- ``delta`` appends a streamed piece to it;
- ``edit`` replaces its text, and what followed the message is gone;
- ``regenerate`` empties it (the text given, if any, starts it), and what followed the message is gone.

Logs are partitioned by conversation and sorted by sequence; a window over the sorted log finds, for each
event, the last event that discards it, and the surviving pieces are joined in order. A conversation is one
row of the result, so its messages meet in one task at the end; nothing larger than that row is collected.

Template: ``<|im_start|>role``, line feed, text, ``<|im_end|>``, line feed. A control string inside a text
gets a backslash after its ``<`` (one more if some are there already), so that texts cannot end a turn, and
reading back takes it away. Line feeds and per cent signs in roles are per cent encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souklake.llm.common import bind

START, END = "<|im_start|>", "<|im_end|>"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def messages_as_log(rows: DataFrame) -> DataFrame:
    """Finished rows (conv_id, turn, role, text) as a log of whole messages, in the order of turns.

    Null turns come first; rows of one turn follow each other by role and text, and repeated rows stay.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order).cast("long")
    return rows.select(
        "conv_id", at.alias("seq"), F.lit(MESSAGE).alias("kind"), at.alias("message"), "role", "text"
    )


def replayed_log(rows: DataFrame) -> DataFrame:
    """Finished rows (conv_id, turn, role, text) as the log of a chat in which every message took some detours.

    The first attempt at a message breaks off half-way, a follow-up is drafted all the same, an edit throws that
    away, and a regeneration streams the text in three pieces. Folding it gives the rows back; a null text is
    empty, and the order is that of ``messages_as_log``.
    """
    done = messages_as_log(rows).withColumn("text", F.coalesce("text", F.lit("")))
    n, at = F.char_length("text"), F.col("message")
    third = F.floor(n / 3).cast("int")

    def piece(start: Column | int, length: Column) -> Column:
        return F.substr(F.col("text"), F.lit(start) if isinstance(start, int) else start, length)

    def event(kind: str, message: Column, role: Column, text: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), message.alias("message"), role.cast("string").alias("role"), text.alias("text")
        )

    events = F.array(
        event(MESSAGE, at, F.col("role"), piece(1, F.floor(n / 2).cast("int"))),
        event(MESSAGE, at + 1, F.lit("draft"), piece(1, F.lit(8))),
        event(EDIT, at, F.lit(None), F.reverse(piece(1, F.lit(8)))),
        event(REGENERATE, at, F.col("role"), piece(1, third)),
        event(DELTA, at, F.lit(None), piece(third + 1, third)),
        event(DELTA, at, F.lit(None), piece(2 * third + 1, n)),
    )
    told = done.select("conv_id", F.col("seq").alias("_turn"), F.posexplode(events).alias("_step", "_event"))
    return told.select("conv_id", (F.col("_turn") * 8 + F.col("_step")).alias("seq"), "_event.*")


def fold(log: DataFrame) -> DataFrame:
    """conv_id, message, role, text of the messages that a log ends with.

    Null texts are empty pieces. The role is the latest one given. Events of equal sequence count in the
    order of kind and text. A message of which only discarded events exist does not appear.
    """
    kind = F.col("kind")
    resets = F.when(kind != DELTA, F.col("seq"))
    branches = F.when(kind.isin(EDIT, REGENERATE), F.col("seq"))
    own = Window.partitionBy("conv_id", "message")
    earlier = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    marked = log.withColumn("_own", F.max(resets).over(own)).withColumn("_branch", F.max(branches).over(earlier))
    # An event counts from its message's last reset on, and not before an earlier message's last branch.
    alive = marked.where(
        (F.col("_own").isNull() | (F.col("seq") >= F.col("_own")))
        & (F.col("_branch").isNull() | (F.col("seq") > F.col("_branch")))
    )
    piece = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    return (
        alive.groupBy("conv_id", "message")
        .agg(F.sort_array(F.collect_list(piece)).alias("_pieces"))
        .select(
            "conv_id",
            "message",
            F.element_at(
                F.concat(F.array(F.lit("")), F.filter(F.transform("_pieces", lambda p: p["role"]), lambda r: r.isNotNull())), -1
            ).alias("role"),
            F.array_join(F.transform("_pieces", lambda p: p["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """conv_id, formatted, turns: one row per conversation.

    ``turns`` has, per turn, its start, the start and end of its text in code points of ``formatted``, and
    whether the loss covers the text. A conversation without messages has no row.
    """
    text = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turn = messages.select(
        "conv_id",
        "message",
        (F.coalesce("role", F.lit("")) == trained_role).alias("loss"),
        F.char_length(head).alias("_head"),
        F.concat(head, text, F.lit(END + "\n")).alias("_turn"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("_turn").cast("long")
    placed = turn.withColumn("_at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    spans = F.struct(
        "message",
        F.col("_at").alias("start"),
        (F.col("_at") + F.col("_head")).alias("text_start"),
        (F.col("_at") + size - len(END) - 1).alias("text_end"),
        "loss",
        "_turn",
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(spans)).alias("_all"))
        .select(
            "conv_id",
            F.array_join(F.transform("_all", lambda t: t["_turn"]), "").alias("formatted"),
            F.transform("_all", lambda t: t.dropFields("message", "_turn")).alias("turns"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns: role, text and trained text (null outside the loss) parsed from the formatted string.

    Turns are found by their marks; the trained text is what the mask's span cuts out of its turn.
    """
    # The first chunk is the empty string before the first mark.
    chunks = F.split("formatted", START.replace("|", r"\|"))

    def parse(chunk: Column, mask: Column) -> Column:
        role = F.substring_index(chunk, "\n", 1)
        text = F.substr(
            chunk, F.char_length(role) + 2, F.char_length(chunk) - F.char_length(role) - len(END) - 2
        )
        inside = F.substr(
            chunk,
            (mask["text_start"] - mask["start"] - len(START) + 1).cast("int"),
            (mask["text_end"] - mask["text_start"]).cast("int"),
        )
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(text).alias("text"),
            F.when(mask["loss"], unescape(inside)).alias("trained"),
        )

    turns = bind(chunks, lambda c: F.transform("turns", lambda mask, i: parse(F.get(c, i + 1), mask)))
    return formatted.select("conv_id", turns.alias("turns"), "formatted")


def format_log(log: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Fold a log and render it."""
    return render(fold(log), trained_role)
