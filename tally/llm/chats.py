"""Conversations from event logs, and their training texts.

A log has one row an event: conversation, sequence, kind, message, role, text. Kinds are

* ``message`` opens a message with its role and, if the text comes at once, its text;
* ``delta`` appends streamed text to its message;
* ``edit`` replaces the text that its message has so far;
* ``regenerate`` drops the text of its message, to be streamed anew, and all messages opened since.

Folding is local to a message: what counts is the text from its last reset on (``message``,
``edit`` or ``regenerate``), joined in order of sequence. Discarded text is left out before
anything is gathered, so a task holds the text that stays of one message. Which messages a
regeneration dropped is a running maximum over the messages of a conversation.

Rendered, a turn is ``### role``, its text and ``</turn>``, each on lines of its own. A control string
inside a text gets a backslash in front, whatever stands there already, and loses one when read
back, so that any text survives. Roles are on one line: line ends and backslashes are spelt out
in them. The loss mask lists the code points of assistant texts in the rendered conversation.

Events of unknown kind or message null are errors of the log and take no part; a null text is
empty, a null role is an empty role. Sequences order events; of equal ones, kind and text decide.
Null conversations are one conversation. A message that was never opened has no place and is
left out. Extra columns take no part, whatever their names. An empty log gives no rows. A whole
conversation, as rendered, must fit one row (2 GB), as the training text of it is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESETS = ("message", "edit", "regenerate")
KINDS = (*RESETS, "delta")
HEAD, END = "### ", "</turn>"
LEARNT = "assistant"


def fold(events: DataFrame) -> DataFrame:
    """Final messages (``conv_id``, ``opened``, ``role``, ``text``) of a log (``conv_id``, ``seq``, ``kind``, ``message``, ``role``, ``text``).

    ``seq`` and ``message`` may be of any type that can be ordered; ``opened`` is the sequence of the opening.
    """
    own = Window.partitionBy("conv_id", "message")
    known = events.select("conv_id", "seq", "kind", "message", "role", "text").where(F.col("kind").isin(*KINDS) & F.col("message").isNotNull())
    reset = F.when(F.col("kind").isin(*RESETS), F.struct("seq"))
    live = known.withColumn("since", F.max(reset).over(own))
    live = live.where((F.struct("seq") >= F.col("since")) | (F.col("kind") != "delta"))
    # Of earlier events only the opening and regenerations matter.
    piece = F.when(F.struct("seq") >= F.col("since"), F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")))
    messages = live.groupBy("conv_id", "message").agg(
        F.min(F.when(F.col("kind") == "message", F.struct("seq", "role"))).alias("first"),
        F.max(F.when(F.col("kind") == "regenerate", F.struct("seq"))).alias("again"),
        F.collect_list(piece).alias("pieces"))
    texts = F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["text"]), "")
    messages = messages.where("first IS NOT NULL").select(
        "conv_id", F.struct("first.seq").alias("opened"), "message", "again", F.coalesce("first.role", F.lit("")).alias("role"), texts.alias("text"))
    before = Window.partitionBy("conv_id").orderBy("opened", "message").rowsBetween(Window.unboundedPreceding, -1)
    kept = messages.withColumn("dropped", F.coalesce(F.max("again").over(before) > F.col("opened"), F.lit(False))).where("NOT dropped")
    return kept.select("conv_id", "opened", "message", "role", "text")


def escape(text: Column) -> Column:
    """A backslash in front of each control string."""
    for control in (HEAD, END):
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


def unescape(text: Column) -> Column:
    for control in (HEAD, END):
        text = F.replace(text, F.lit("\\" + control), F.lit(control))
    return text


def _one_line(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _role(line: Column) -> Column:
    return F.replace(F.replace(unescape(line), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def render(messages: DataFrame) -> DataFrame:
    """Training texts (``conv_id``, ``formatted``, ``loss_spans``) of folded messages; spans are code points, end exclusive.

    Offsets are a running sum over the turns of a conversation, in order of opening.
    """
    head = F.concat(F.lit(HEAD), _one_line(F.col("role")), F.lit("\n"))
    turns = messages.select("conv_id", "opened", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(f"\n{END}\n")))
    order = Window.partitionBy("conv_id").orderBy("opened", "message")
    size = F.char_length("turn").cast("long")
    start = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.char_length("head")
    span = F.when(F.col("role") == LEARNT, F.struct(start.alias("start"), (start + F.char_length("body")).alias("end")))
    placed = turns.select("conv_id", F.struct(F.row_number().over(order).alias("at"), "turn", span.alias("span")).alias("own"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("own")).alias("own"))
    return whole.select("conv_id", F.array_join("own.turn", "").alias("formatted"), F.filter("own.span", lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Turns (``role``, ``text``) of a rendered conversation: an end mark without a backslash ends one."""
    pieces = F.filter(F.split(formatted, rf"(?<!\\){END}\n"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        inner = F.substr(piece, F.char_length(line) + 2, F.char_length(piece) - F.char_length(line) - 2)
        return F.struct(_role(F.substr(line, F.lit(len(HEAD) + 1))).alias("role"), unescape(inner).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the mask, unescaped, span by span.

    Cut out of four-byte code points, whose places are known; the outer array makes Spark encode once.
    """
    def cut(points: Column, s: Column) -> Column:
        return unescape(F.decode(F.substr(points, (s["start"] * 4 + 1).cast("int"), ((s["end"] - s["start"]) * 4).cast("int")), "UTF-32"))

    return F.array_join(F.flatten(F.transform(F.array(F.encode(formatted, "UTF-32")), lambda p: F.transform(spans, lambda s: cut(p, s)))), "")
