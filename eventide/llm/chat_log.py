"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

:func:`fold` partitions an event log by conversation once. The events of each
message, in order of ``seq``, are folded to its final text: ``start`` opens the
message, ``delta`` adds to it, ``edit`` puts a new text in its place,
``regenerate`` empties it and drops every message that started after it and
before the regeneration; later deltas fill it again. :func:`render` writes each
message as a marked turn and joins the turns of a conversation to one string;
``loss`` has one span ``(start, length)`` per turn, in code points of that
string, over the assistant's text and empty (length 0) for the others.
:func:`read_back` parses the string into turns again.

A turn is ``[INST] text [/INST]`` (user), ``[OUT] text</s>`` (assistant),
``[SYS] text [/SYS]`` (system), and for any other role ``[ROLE] role[:]text
[/ROLE]``; ``<s>`` opens a conversation. In texts and roles a backslash is
doubled and a control string gets one after its first character; no marker
begins or ends inside another, so reading back is exact.

All steps after the one exchange keep its partitioning. A message is folded
from its own events and a conversation is joined from rendered turns, each a
row, so what one task must hold at once is one finished conversation, which is
one cell of the result (up to 2 GB, as any Spark string). Very long texts come
as many deltas.

Null ``conv_id`` is a conversation of its own; null texts and roles count as
empty; an unknown or null kind counts as ``delta``; a message without ``start``
begins at its first event. Messages that start together are ordered by role and
text; rows repeated in a table are turns of their own. An empty log gives no
rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LOG = ("conv_id", "message", "seq", "kind", "role", "text")
PIECE = 512                  # code points of a delta that a stored text is streamed in

# The template; fixed values of the format.
BEGIN = "<s>"
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER, COLON = ("[ROLE] ", " [/ROLE]"), "[:]"
CONTROL = r"(/?s>|/?(?:INST|OUT|SYS|ROLE)\]|:\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Control strings broken by a backslash after their first character; backslashes doubled."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([\[<])" + CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def log_of_turns(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """Event log of a table ``conv_id, turn, role, text``: each row is a message
    whose text arrives in deltas of ``piece`` code points."""
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("message"))
    parts = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % piece), F.lit(0))
    parts = F.concat(F.array(F.lit("")), parts)
    events = rows.select("conv_id", "turn", "role", "message", F.posexplode(parts).alias("part", "text"))
    return events.select("conv_id", "message", F.struct("turn", "part").alias("seq"),
                         F.when(F.col("part") == 0, "start").otherwise("delta").alias("kind"),
                         F.when(F.col("part") == 0, F.col("role")).alias("role"), "text")


def fold(log: DataFrame) -> DataFrame:
    """Log ``conv_id, message, seq, kind, role, text`` -> one row per final message:
    ``conv_id, pos`` (from 0), ``role, text``. ``seq`` is any type with an order."""
    events = log.select(*LOG).repartition("conv_id")
    one = F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    again = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again")
    messages = events.groupBy("conv_id", "message").agg(F.min("seq").alias("start"), again, F.sort_array(F.collect_list(one)).alias("events"))
    whole = F.array_max(F.transform(F.filter("events", lambda e: e["kind"].isin("start", "edit", "regenerate")), lambda e: e["seq"]))
    live = F.filter("events", lambda e: F.col("reset").isNull() | (e["seq"] >= F.col("reset")))
    texts = F.transform(live, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    named = F.get(F.filter("events", lambda e: e["role"].isNotNull()), F.lit(0))["role"]
    messages = messages.withColumn("reset", whole).select("conv_id", "message", "start", "again", F.coalesce(named, F.lit("")).alias("role"),
                                                          F.array_join(texts, "").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("start", "role", "text", "message")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    undone = F.max("again").over(before)
    kept = messages.withColumn("undone", undone).where(F.col("undone").isNull() | (F.col("undone") < F.col("start")))
    return kept.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text`` -> one row per conversation: ``conv_id, formatted, loss``."""
    head, tail, is_known = F.lit(None), F.lit(None), F.col("role").isin(*TURNS)
    for role, (a, b) in TURNS.items():
        head = F.when(F.col("role") == role, F.lit(a)).otherwise(head)
        tail = F.when(F.col("role") == role, F.lit(b)).otherwise(tail)
    head = F.when(is_known, head).otherwise(F.concat(F.lit(OTHER[0]), escape(F.col("role")), F.lit(COLON)))
    tail = F.when(is_known, tail).otherwise(F.lit(OTHER[1]))
    pieces = (messages.select("conv_id", "pos", (F.col("role") == LOSS_ROLE).alias("learned"), head.alias("head"), escape(F.col("text")).alias("body"),
                              tail.alias("tail"))
              .withColumn("piece", F.concat("head", "body", "tail")))
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")) + len(BEGIN) + F.length("head")
    span = F.struct(F.col("start"), F.when(F.col("learned"), F.length("body").cast("long")).otherwise(F.lit(0).cast("long")).alias("length"))
    turns = pieces.withColumn("start", start).select("conv_id", F.struct("pos", "piece", span.alias("span")).alias("turn"))
    joined = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return joined.select("conv_id", F.concat(F.lit(BEGIN), F.array_join(F.col("turns.piece"), "")).alias("formatted"),
                         F.col("turns.span").alias("loss"))


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "[]" else c for c in text)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns parsed from ``conv_id, formatted, loss``: ``conv_id, pos, role, text,
    learned`` (the unescaped text under the loss mask, empty outside it)."""
    kinds = {**TURNS, None: OTHER}
    turn = "(?s)" + "|".join(_quoted(a) + ".*?" + _quoted(b) for a, b in kinds.values())
    segments = F.regexp_extract_all("formatted", F.lit(turn), F.lit(0))
    rows = (formatted.select("conv_id", F.posexplode(F.arrays_zip(segments.alias("segment"), F.col("loss").alias("span"))).alias("pos", "turn"))
            .select("conv_id", "pos", "turn.segment", "turn.span"))
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0).cast("long")) + len(BEGIN)
    rows = rows.withColumn("begin", begin)
    inner, role = F.lit(None), F.lit(None)
    for name, (a, b) in kinds.items():
        fits = F.startswith("segment", F.lit(a))
        cut = F.substring("segment", F.lit(len(a) + 1), F.length("segment") - len(a) - len(b))
        at = F.locate(COLON, "segment") - len(a) - 1
        inner = F.when(fits, cut if name else F.substring(cut, at + len(COLON) + 1, F.length(cut))).otherwise(inner)
        role = F.when(fits, F.lit(name) if name else unescape(F.substring(cut, F.lit(1), at))).otherwise(role)
    masked = F.substring("segment", (F.col("span.start") - F.col("begin") + 1).cast("int"), F.col("span.length").cast("int"))
    return rows.select("conv_id", "pos", role.alias("role"), unescape(inner).alias("text"),
                       F.when(F.col("span.length") > 0, unescape(masked)).otherwise(F.lit("")).alias("learned"),
                       (F.col("begin") + F.length("segment")).alias("end"))


def digests(turns: DataFrame) -> DataFrame:
    """Turns as :func:`read_back` gives them -> per conversation ``n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    one = F.struct("pos", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"), "learned")
    rows = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.max("end").alias("formatted_chars"),
                                        F.sum(F.length("learned")).cast("long").alias("loss_chars"),
                                        F.sort_array(F.collect_list(one)).alias("turns"))
    return rows.select("conv_id", "n_turns", F.sha2(F.array_join(F.col("turns.said"), "").cast("binary"), 256).alias("turns_sha256"), "loss_chars",
                       F.sha2(F.array_join(F.col("turns.learned"), "").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
