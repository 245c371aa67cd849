r"""Chat formatting from event logs, in DataFrame functions only.

A conversation is a log of events in the order of ``seq``: ``message`` starts a turn with a role and a text, ``delta``
appends to a turn's text, ``edit`` replaces it, ``regenerate`` empties it so that later deltas build it anew.  The
fold needs no state machine: a turn's text is what its last edit or regeneration (else its message) left, followed by
the deltas after it.  The turns are then rendered by a template and read back by it.

Template: ``[INST] {user} [/INST]``, `` {assistant} </s>`` and, for any other role, ``<<{role}>> {text} <</{role}>>``
(in a role's name everything but letters and digits is written as ``_`` and its code in hex, so a null role, an empty
one and any other stay apart).  Control strings inside texts get a backslash after their first character, ``<\/s>``;
one that already has backslashes there gets one more, and reading takes one away, so every text comes back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A control string: its first character, any backslashes, the rest.
_CONTROL = r"(\[)(\\*)(/?INST\])|(<)(\\*)(/?s>|</?\w*>>)"
_ESCAPED = r"(\[)(\\)(\\*/?INST\])|(<)(\\)(\\*(?:/?s>|</?\w*>>))"
_TURN = r"(?s)\[INST\] (.*?) \[/INST\]|<<(\w*)>> (.*?) <</\w*>>| (.*?) </s>"


def escaped(text: Column) -> Column:
    # A group that took no part gives an empty string, so one replacement serves both alternatives.
    return F.regexp_replace(text, _CONTROL, r"$1$4\\$2$5$3$6")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$4$3$6")


def _tag(role: Column) -> Column:
    """A role as a word: letters and digits as they are, other characters as _hex_, null as __."""
    chars = F.transform(F.split(role, ""), lambda c: F.when(c.rlike("^[A-Za-z0-9]$") | (c == ""), c).otherwise(F.concat(F.lit("_"), F.lower(F.hex(F.encode(c, "UTF-8"))), F.lit("_"))))
    return F.coalesce(F.array_join(chars, ""), F.lit("__"))


def _role(tag: Column) -> Column:
    parts = F.split(tag, "_")  # every second part is a character's code
    read = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.decode(F.unhex(F.upper(p)), "UTF-8")).otherwise(p))
    return F.when(tag != "__", F.array_join(read, ""))


def rendered(role: Column, text: Column) -> Column:
    """One turn by the template."""
    inner = escaped(F.coalesce(text, F.lit("")))
    tag = _tag(role)
    other = F.concat(F.lit("<<"), tag, F.lit(">> "), inner, F.lit(" <</"), tag, F.lit(">>"))
    user, assistant = F.concat(F.lit("[INST] "), inner, F.lit(" [/INST]")), F.concat(F.lit(" "), inner, F.lit(" </s>"))
    return F.when(role == "user", user).when(role == "assistant", assistant).otherwise(other)


def turns_of(formatted: Column) -> Column:
    """The (role, text) structs of a formatted conversation, texts unescaped."""

    def turn(whole: Column) -> Column:
        user, assistant = F.startswith(whole, F.lit("[INST] ")), F.startswith(whole, F.lit(" "))
        start = F.when(user, 8).when(assistant, 2).otherwise(F.instr(whole, ">> ") + 3)
        tag = F.substring(whole, F.lit(3), F.instr(whole, ">> ") - 3)
        stop = F.when(user, 8).when(assistant, 5).otherwise(F.length(tag) + 6)
        role = F.when(user, "user").when(assistant, "assistant").otherwise(_role(tag))
        return F.struct(role.alias("role"), unescaped(F.substring(whole, start, F.length(whole) - stop - start + 1)).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


#: Characters of the draft that a stored user message began with, and of the attempt that an assistant's one replaced.
DRAFT = 16


def as_events(messages: DataFrame, piece: int = 4096) -> DataFrame:
    """(conv_id, turn, seq, kind, role, text) events of stored messages (conv_id, turn, role, text).

    The log is the one that a client writes while such a message comes about.  An assistant's turn opens empty, has an
    attempt of DRAFT characters streamed, is regenerated, and then streamed in deltas of ``piece`` characters.  Any
    other turn opens with a draft of DRAFT characters, is edited to its first piece, and streamed on.  ``seq`` orders a
    conversation's whole log: place, then step.  Each row is a turn of its own, also where (conv_id, turn) repeats;
    rows of one turn go by role and a hash of the text, null turns come last.
    """
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("role").cast("string")
    at = F.col("turn").cast("bigint")
    # Equal rows differ by their number alone, and it doesn't matter which is which.
    turn = F.struct(at.isNull().alias("late"), at.alias("at"), role.alias("role"), F.xxhash64(text).alias("mark"), F.monotonically_increasing_id().alias("row"))
    base = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    cuts = F.greatest(F.lit(1), F.ceil(F.length("text") / piece)).cast("int")
    event = lambda kind, text_: F.struct(F.lit(kind).alias("kind"), text_.alias("text"))
    pieces = lambda first: F.when(cuts > first, F.transform(F.sequence(F.lit(first), cuts - 1), lambda i: event("delta", F.substring("text", i * piece + 1, F.lit(piece))))).otherwise(F.array().cast("array<struct<kind:string,text:string>>"))
    draft = F.substring("text", 1, DRAFT)
    streamed = F.concat(F.array(event("message", F.lit("")), event("delta", draft), event("regenerate", F.lit(None).cast("string"))), pieces(0))
    edited = F.concat(F.array(event("message", draft), event("edit", F.substring("text", 1, piece))), pieces(1))
    log = F.when(F.col("role") == "assistant", streamed).otherwise(edited)
    rows = base.select("conv_id", "turn", "role", F.posexplode(log).alias("step", "e"))
    return rows.select("conv_id", "turn", F.struct("turn", "step").alias("seq"), "e.kind", "role", "e.text")


def by_conversation(events: DataFrame) -> DataFrame:
    """The log dealt to tasks by conversation: the one exchange of the texts; all that follows keeps to it."""
    return events.repartition("conv_id")


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): each turn's final message.

    ``events`` has conv_id, turn (any type with an order), seq, kind, role and text.  Events of one turn apply in the
    order of seq (ties: kind, then text); unknown kinds and null texts change nothing; a turn's role is its last
    non-null one.  A turn that has deltas only starts empty.
    """
    event = F.struct("seq", "kind", "text", "role")
    turns = events.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["kind"].isin("message", "edit", "regenerate"), i).otherwise(-1))

    def text(e: Column, i: Column) -> Column:
        empty = F.lit("")
        reset = F.when(e["kind"] == "regenerate", empty).otherwise(F.coalesce(e["text"], empty))
        added = F.when(e["kind"] == "delta", F.coalesce(e["text"], empty)).otherwise(empty)
        return F.when(i < F.col("from"), empty).when(i == F.col("from"), reset).otherwise(added)

    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    wide = turns.withColumn("from", F.array_max(resets))
    return wide.select("conv_id", "turn", F.try_element_at(roles, F.lit(-1)).alias("role"), F.array_join(F.transform("log", text), "").alias("text"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): conversations rendered in the order of their turns.

    ``mask`` has a span of ``formatted`` for each assistant text as it is written there, the text that a loss applies
    to: start and length in code points, byte_start and byte_length in UTF-8 bytes, all from 0.
    """
    out = turns.select("conv_id", "turn", "role", rendered(F.col("role"), F.col("text")).alias("out"))
    before = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    start, byte_start = (F.coalesce(F.sum(f("out")).over(before), F.lit(0)) for f in (F.length, F.octet_length))
    one = F.struct("turn", "role", "out", start.alias("start"), byte_start.alias("byte_start"))
    convs = out.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    # One blank before the text, " </s>" behind it.
    spans = F.transform(
        F.filter("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False))),
        lambda t: F.struct((t["start"] + 1).alias("start"), (F.length(t["out"]) - 6).alias("length"), (t["byte_start"] + 1).alias("byte_start"), (F.octet_length(t["out"]) - 6).alias("byte_length")),
    )
    return convs.select("conv_id", F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"), spans.alias("mask"))


def masked(formatted_: Column, mask: Column) -> Column:
    """The texts under a mask, unescaped, in order; each is cut from the bytes, so a long conversation is read once."""

    def cut(raw: Column) -> Column:
        part = lambda m: F.decode(F.substring(raw, m["byte_start"].cast("int") + 1, m["byte_length"].cast("int")), "UTF-8")
        return F.transform(mask, lambda m: unescaped(part(m)))

    # The bytes are bound once, not made anew for each span.
    return F.flatten(F.transform(F.array(F.encode(formatted_, "UTF-8")), cut))


def format_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output.

    turns_sha256 is of role, newline, text, newline for each turn that reading ``formatted`` gives; loss_* are of what
    the mask's spans cut from it, unescaped, in order with nothing between.  Null texts are empty, a null role is
    written as an empty one in the digest, null turns come last, equal (conv_id, turn) go by role and a hash of the
    text, repeated rows are turns of their own, rows whose conv_id is null are one conversation.  Other columns are
    ignored; an empty table gives an empty table.  A conversation is one row of the result, so one task renders it.
    """
    return read_back(formatted(folded(by_conversation(as_events(messages)))))


def read_back(out: DataFrame) -> DataFrame:
    """:func:`format_conversations`' digests of (conv_id, formatted, mask)."""
    read = out.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), turns_of(F.col("formatted")).alias("turns"), F.array_join(masked(F.col("formatted"), F.col("mask")), "").alias("loss"))
    line = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
