"""Chat transcripts rebuilt from event logs and rendered with a template.

An event log has columns conv_id, seq, message_id, kind, role, text. In the order of seq

* ``message`` opens a message and sets its text,
* ``delta`` adds a piece of text,
* ``edit`` replaces the text so far,
* ``regenerate`` throws the text away; later deltas build it anew (its own text, if any, starts it).

Folding is associative: a stretch of events comes down to (was the text reset, text since then).
So each message is folded first in short stretches of its log and then over the stretches, which
keeps a message or conversation with most of the log from meeting event by event in one task.

Null text or role is empty, a null kind counts as ``message``, an unknown kind as ``delta``; null
seq sorts first, ties of seq by kind and text. Messages come in the order of their first seq, ties
by role, text and message_id. A null conv_id is a conversation of its own.

The template writes each turn as ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Inside texts
``<``, any number of backslashes and ``|`` get one more backslash, so no text can hold a control
string and reading back takes it away again.

A rendered conversation is kept in stretches of turns, (conv_id, stretch, formatted, loss) rows, which
end between turns and are read back one by one. So a conversation of any length is rows of bounded size;
only render() joins it to one value, which Spark holds up to 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
STRETCH = 256
RESETS = ("message", "edit", "regenerate")
c = F.col


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role must also stay on its line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def _fold(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Fold rows (at, reset, text) of a key into one such row; role and seq of the first."""
    steps = F.sort_array(F.collect_list(F.struct("at", "tie", "reset", "text", "role", "seq")))
    folded = parts.groupBy(*keys).agg(steps.alias("s"))
    last = F.array_max(F.transform(c("s"), lambda x, i: F.when(x.reset, i)))
    since = F.slice(c("s"), F.coalesce(last, F.lit(0)) + 1, F.size("s"))
    return folded.withColumn("last", last).select(
        *keys,
        c("s")[0]["seq"].alias("seq"),
        c("s")[0]["role"].alias("role"),
        c("last").isNotNull().alias("reset"),
        F.array_join(F.transform(since, lambda x: x.text), "").alias("text"),
    )


def rebuild(events: DataFrame) -> DataFrame:
    """(conv_id, message_id, seq, role, text): the final messages of an event log."""
    kind = F.coalesce(c("kind"), F.lit("message"))
    steps = events.select(
        "conv_id",
        "message_id",
        F.floor(c("seq") / STRETCH).alias("stretch"),
        c("seq").alias("at"),
        F.struct(kind != "message", kind, "text").alias("tie"),
        kind.isin(*RESETS).alias("reset"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("role", F.lit("")).alias("role"),
        "seq",
    )
    message = ["conv_id", "message_id"]
    stretches = _fold(steps, [*message, "stretch"])
    return _fold(stretches.withColumns({"at": c("stretch"), "tie": F.lit(0)}), message).drop("reset")


def _joined(df: DataFrame, *keys: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct("at", "out", "loss")))
    return df.groupBy(*keys).agg(parts.alias("p")).select(
        *keys,
        F.array_join(F.transform("p", lambda x: x.out), "").alias("out"),
        F.flatten(F.transform("p", lambda x: x.loss)).alias("loss"),
    )


def render_stretches(messages: DataFrame) -> DataFrame:
    """(conv_id, stretch, formatted, loss): ``loss`` has one entry per turn, the (start, length) of its
    text under the loss in code points from the turn's start tag; length 0 where nothing is learned.
    Stretches of a conversation are in the order of their numbers."""
    role, text = escape_role(c("role")), escape(c("text"))
    turns = messages.select(
        "conv_id",
        F.floor(c("seq") / STRETCH).alias("stretch"),
        F.struct("seq", "role", "text", "message_id").alias("at"),
        F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
        text.alias("body"),
        (c("role") == "assistant").alias("learn"),
    ).select(
        "conv_id",
        "stretch",
        "at",
        F.concat("head", "body", F.lit(f"{END}\n")).alias("out"),
        F.array(
            F.struct(
                F.length("head").alias("start"), F.when(c("learn"), F.length("body")).otherwise(0).alias("length")
            )
        ).alias("loss"),
    )

    return _joined(turns, "conv_id", "stretch").withColumnRenamed("out", "formatted")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the same with each conversation as one value."""
    stretches = render_stretches(messages).select("conv_id", c("stretch").alias("at"), c("formatted").alias("out"), "loss")
    return _joined(stretches, "conv_id").withColumnRenamed("out", "formatted")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats``, whole or in stretches, with turns and learned in place of loss: the turns (role, text)
    parsed from the formatted text, and the texts under the loss."""
    kept = [x for x in chats.columns if x != "loss"]
    pieces = F.filter(F.split(c("formatted"), START.replace("|", r"\|"), -1), lambda p, i: i > 0)
    cut = chats.select(*chats.columns, pieces.alias("pieces"))
    tail = len(END) + 1

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        start = F.length(role) + 2
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substring(p, start, F.length(p) - tail - start + 1)).alias("text"),
        )

    learned = F.zip_with(
        "pieces", "loss", lambda p, x: unescape(F.substring(p, x.start - len(START) + 1, x.length))
    )
    return cut.select(*kept, F.transform("pieces", turn).alias("turns"), learned.alias("learned"))


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log with one event per row.
    Equal rows are turns of their own."""
    rows = conversations.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    numbered = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), c("n"))))
    return numbered.select(
        "conv_id",
        c("turn").alias("seq"),
        F.struct("turn", "role", F.xxhash64("text").alias("text"), "copy").alias("message_id"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


def format_chats(events: DataFrame) -> DataFrame:
    return render(rebuild(events))
