"""Chat formatting from an event log.

A log has one row per event: conv_id, turn, message_id, seq, kind, role, at, cut, text.
Kinds are ``open`` (a message begins, of ``role``), ``delta`` (``text`` is appended),
``edit`` (``cut`` characters from ``at`` on are replaced by ``text``) and ``regenerate``
(what the message holds so far is discarded). Folding a message's events in the order
of seq gives its final text.

The log is partitioned by conversation and message, since messages fold on their own: a
conversation that holds a third of all events is split. A task streams sorted events and
holds one message. Each message is rendered as

    <s>[ROLE]role[/ROLE]text</s>

with a newline after it. In role and text a backslash, and the first character of each of
the template's control strings, are written as a backslash and a letter, so that no
control string of a text survives and the original can be read back. The loss mask is
the range of the text in messages of the role ``assistant``.

Null text or role is empty; messages of one turn are in the order of role and text; a
null turn comes first; rows with a null conv_id are one conversation; repeated rows are
messages of their own. Events of unknown kinds are ignored, and a message without ``open``
has an empty role. An event that is delivered again, with the same seq and content, is
applied once; different events of one seq are in the order of kind, place, cut and text; events
without seq come first, in that order, and are applied each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template and the strings that control it or chat templates like it.
HEAD, MIDDLE, END = "<s>[ROLE]", "[/ROLE]", "</s>\n"
CONTROL = re.compile(r"\\|<(?=/?s>|</?SYS>>)|\[(?=/?(?:INST|ROLE)\])")
ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
ORIGINALS = {"\\": "\\", "l": "<", "b": "["}
LEARNED = "assistant"
PIECE = 64
EVENTS = "conv_id long, turn long, message_id string, seq int, kind string, role string, at int, cut int, text string"
MESSAGES = "conv_id long, turn long, message_id string, role string, text string"


def escaped(text: str) -> str:
    return CONTROL.sub(lambda m: ESCAPES[m[0]], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: ORIGINALS[m[1]], text)


def fold(events) -> tuple[str, str]:
    """Final role and text of one message: ``events`` are (kind, role, at, cut, text) in order."""
    role, parts = "", []
    for kind, who, at, cut, text in events:
        text = text or ""
        if kind == "open":
            role = who or ""
        elif kind == "delta":
            parts.append(text)
        elif kind == "regenerate":
            parts = []
        elif kind == "edit":
            body, at = "".join(parts), max(int(at or 0), 0)
            parts = [body[:at], text, body[at + max(int(cut or 0), 0) :]]
    return role, "".join(parts)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """The message in the template, and where its text begins and ends there."""
    begin = HEAD + escaped(role) + MIDDLE
    body = escaped(text)
    return begin + body + END, len(begin), len(begin) + len(body)


def read_back(piece: str) -> tuple[str, str]:
    role, _, text = piece.removeprefix(HEAD).partition(MIDDLE)
    return unescaped(role), unescaped(text.removesuffix(END))


def _clean(value):
    return None if value is None or value is pd.NA or value != value else value


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, events, last = None, [], None

    def message():
        role, text = fold(events)
        piece, begin, end = rendered(role, text)
        learned = role == LEARNED
        return (*key, role, piece, begin if learned else 0, end if learned else 0)

    for frame in frames:
        done = []
        rows = zip(*(frame[c].astype(object) for c in "conv_id turn message_id seq kind role at cut text".split()))
        for conv, turn, mid, *event in rows:
            now = (_clean(conv), _clean(turn), _clean(mid))
            if now != key:
                if key is not None:
                    done.append(message())
                key, events, last = now, [], None
            event = tuple(_clean(x) for x in event)
            if event[0] is None or event != last:
                events.append(event[1:])
            last = event
        if done:
            yield _frame(done)
    if key is not None:
        yield _frame([message()])


def _frame(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns="conv_id turn message_id role formatted loss_begin loss_end".split(), dtype=object)
    return out


def reconstruct(events: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, message_id, role, formatted, loss_begin, loss_end (code points)."""
    cols = [c.split()[0] for c in EVENTS.split(", ")]
    return (
        events.select(*cols)
        .repartition("conv_id", "turn", "message_id")
        .sortWithinPartitions("conv_id", "turn", "message_id", "seq", "kind", "at", "cut", "text", "role")
        .mapInPandas(
            _folded,
            "conv_id long, turn long, message_id string, role string, formatted string, loss_begin int, loss_end int",
        )
    )


def event_log(messages: DataFrame, piece: int = PIECE) -> DataFrame:
    """A streaming log that yields ``messages`` (conv_id, turn, role, text) when it is folded.

    Texts are streamed in pieces. Every assistant message is first answered by its text
    reversed and then regenerated; every user message loses its first characters to a typing
    error that an edit mends.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    once = (
        messages.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .groupBy("conv_id", "turn", "role", "text")
        .count()
        .withColumn("copy", F.explode(F.expr("sequence(1L, count)")))
        .withColumn("message_id", F.concat_ws("-", F.md5(F.concat_ws("\n", "role", "text").cast("binary")), "copy"))
    )
    wrong = F.when(F.col("role") == "user", F.overlay("text", F.lit("##"), 1)).otherwise(F.col("text"))

    def streamed(body):
        cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(body) - 1) / piece).cast("int")))
        return F.transform(cuts, lambda i: event("delta", text=F.substring(body, i * piece + 1, F.lit(piece))))

    def event(kind, at=None, cut=None, text=None):
        none = F.lit(None)
        return F.struct(
            F.lit(kind).alias("kind"),
            (none if at is None else at).cast("int").alias("at"),
            (none if cut is None else cut).cast("int").alias("cut"),
            (none if text is None else text).cast("string").alias("text"),
        )

    draft = F.when(
        F.col("role") == LEARNED, F.concat(streamed(F.reverse("text")), F.array(event("regenerate")))
    ).otherwise(F.array().cast("array<struct<kind:string,at:int,cut:int,text:string>>"))
    mend = F.when(
        F.col("role") == "user",
        F.array(event("edit", F.lit(0), F.lit(2), F.substring("text", 1, 2))),
    ).otherwise(F.array().cast("array<struct<kind:string,at:int,cut:int,text:string>>"))
    events = F.concat(F.array(event("open")), draft, streamed(F.col("wrong")), mend)
    return (
        once.withColumn("wrong", wrong)
        .select("conv_id", "turn", "message_id", "role", F.posexplode(events).alias("seq", "e"))
        .select("conv_id", "turn", "message_id", "seq", "e.kind", "role", "e.at", "e.cut", "e.text")
    )


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals of each conversation from its sorted messages, read back from their formatted form."""
    names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()
    started, key, state = False, None, None

    def row():
        turns, all_, chars, loss, size = state
        return key, turns, all_.hexdigest(), chars, loss.hexdigest(), size

    for frame in frames:
        done = []
        rows = zip(*(frame[c].astype(object) for c in ("conv_id", "formatted", "loss_begin", "loss_end")))
        for conv, piece, begin, end in rows:
            conv = _clean(conv)
            if not started or conv != key:
                if started:
                    done.append(row())
                started, key, state = True, conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_back(piece)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            learned = unescaped(piece[int(begin) : int(end)])
            state[2] += len(learned)
            state[3].update(learned.encode())
            state[4] += len(piece)
        if done:
            yield pd.DataFrame(done, columns=names)
    if started:
        yield pd.DataFrame([row()], columns=names)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``reconstruct``'s rows.

    A digest over all turns is sequential, so a conversation is one task's; it streams them.
    """
    order = F.coalesce("turn", F.lit(-(1 << 62)))
    return (
        formatted.select("conv_id", order.alias("turn"), "role", "formatted", "loss_begin", "loss_end", "message_id")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "formatted", "message_id")
        .mapInPandas(
            _digests,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
