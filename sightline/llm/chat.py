"""Chat formatting from event logs.

A log holds events of conversations: a message starts, text streams in as
deltas, a text is edited, an answer is generated anew. Folding the events in
order gives the final messages, which are rendered with turn marks; whatever
looks like a mark inside a text is escaped and can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# An event is (conv_id, seq, message_id, kind, role, text).
KINDS = ("start", "delta", "edit", "regenerate", "delete")

# Deltas that the query's events carry, in characters.
DELTA_CHARS = 4096

# Turn marks. Escaped texts hold neither # nor <, and roles no colon either.
OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""``\``, ``#`` and ``<`` as ``\b``, ``\h`` and ``\l``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undoes ``escape``: every backslash of an escaped text begins one of its escapes."""
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def log_of(turns: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log: every message starts, and its text streams in as deltas.

    Turns are numbered in the order of (turn, role, text), nulls first;
    repeated rows are turns of their own. A null text is an empty one.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("message_id", F.row_number().over(order).cast("long"))
    text = F.coalesce("text", F.lit(""))
    # Cut in one pass: a substring would count characters from the start for every chunk.
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    deltas = F.transform(chunks, lambda c, i: F.struct((i + 1).alias("step"), F.lit("delta").alias("kind"), c.alias("text")))
    start = F.array(F.struct(F.lit(0).alias("step"), F.lit("start").alias("kind"), F.lit("").alias("text")))
    events = rows.select("conv_id", "message_id", "role", F.explode(F.concat(start, deltas)).alias("e"))
    # The step within a message is the low half of the sequence number.
    seq = F.shiftleft(F.col("message_id"), 32) + F.col("e.step")
    return events.select("conv_id", seq.alias("seq"), "message_id", F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, place, role, text) of a log of events.

    Within a message ``start``, ``edit`` and ``regenerate`` set the text anew
    and ``delta`` appends; ``delete`` takes the message out unless a later
    event sets it anew. A message stands where its first event is, ties by id. Editing or
    regenerating a message also takes out the messages that stand behind it
    and were begun before, as they answer a text that is gone. Events are
    ordered by (seq, kind, text); an event that is repeated exactly, as a log
    that is sent again does, counts once. Nulls: a null seq comes first, null
    text is empty, the role is that of the last event that has one, else
    empty; kinds not listed above change nothing. Rows without a conversation
    are one conversation.
    """
    kind, text = F.coalesce("kind", F.lit("")), F.coalesce("text", F.lit(""))
    events = events.select(
        "conv_id", "message_id", F.coalesce("seq", F.lit(-(2**63))).alias("seq"), kind.alias("kind"), "role", text.alias("text")
    )
    # One task meets a message's own events; the texts of one message are one value anyway.
    logs = events.groupBy("conv_id", "message_id").agg(
        F.array_sort(F.collect_set(F.struct("seq", "kind", "text", "role"))).alias("log")
    )
    resets = F.filter("log", lambda e: e.kind.isin("start", "edit", "regenerate"))
    last = F.coalesce(F.array_max(F.transform(resets, lambda e: e.seq)), F.lit(-(2**63)))
    gone = F.coalesce(F.array_max(F.transform(F.filter("log", lambda e: e.kind == "delete"), lambda e: e.seq)) > last, F.lit(False))
    parts = F.filter("log", lambda e: (e.seq >= F.col("last")) & e.kind.isin("start", "edit", "regenerate", "delta"))
    roles = F.filter(F.transform("log", lambda e: e.role), lambda r: r.isNotNull())
    changes = F.transform(F.filter("log", lambda e: e.kind.isin("edit", "regenerate")), lambda e: e.seq)
    messages = (
        logs.withColumn("last", last)
        .withColumn("gone", gone)
        .select(
            "conv_id",
            "message_id",
            F.array_min(F.transform("log", lambda e: e.seq)).alias("place"),
            F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
            F.array_join(F.transform(parts, lambda e: e.text), "").alias("text"),
            F.array_max(changes).alias("changed"),
            "gone",
        )
    )
    # Of the changes at earlier places the latest decides whether a message was begun before it.
    before = Window.partitionBy("conv_id").orderBy("place", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.coalesce(F.max("changed").over(before) > F.col("place"), F.lit(False))
    return messages.withColumn("cut", cut).where(~F.col("cut") & ~F.col("gone")).select(
        "conv_id", "place", "message_id", "role", "text"
    )


def render(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, formatted, segments): the text, and its pieces with whether they count for the loss.

    The pieces joined are the text. A conversation becomes one row, as a
    training example is one value. An empty conversation has no row.
    """
    loss = F.col("role") == trained_role
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MIDDLE))
    pieces = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.col("text")).alias("text"), loss.alias("loss")),
        F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
    )
    turn = F.struct("place", "message_id", pieces.alias("pieces"))
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: t.pieces))
    return turns.select("conv_id", segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s.text), "")
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered text, as an array of (role, text)."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t != "")

    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit(MIDDLE))
        role = F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        text = F.substring(piece, at + len(MIDDLE), F.char_length(piece))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered rows hold, read back from them."""
    turns = rendered.withColumn("turns", parse(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text)), "")
    return turns.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    return digests(render(fold(log_of(turns))))
