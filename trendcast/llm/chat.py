"""Chat formatting, verified by a grammar round trip.

A turn is an opening mark, the text and a closing mark. A deterministic parser reads them back: each mark is a control
string, and a control string with backslashes behind its first character stands for itself with one backslash fewer. A
turn is first written as it is; if the parser does not recover it, its conflicting strings are escaped, until it does.
The text of a whole segment is then parsed once more, and what comes out must equal its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from trendcast.llm.shared import written
from trendcast.llm.turns import _arrow_types, as_batch, same, segments, streamed, turns

# Opening and closing marks by role. A role not listed writes its name between OTHER and NAMED.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER, NAMED, OTHER_END = "[ROLE]", "[IS]", "[/ROLE]"
CONTROL = r"<\\*/?s>|\[\\*(?:/?INST|/?SYS|/?ROLE|IS)\]"
STRING = re.compile(CONTROL)
BARE = re.compile(CONTROL.replace(r"\\*", ""))
OPENED = {start: role for role, (start, _) in MARKS.items()}

FORMATTED = "n_turns long, formatted string, loss array<struct<start:long,end:long>>"
REPORT = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escaped(text: str) -> str:
    return STRING.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescaped(text: str) -> str:
    return STRING.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text) if "\\" in text else text


class NotATurn(ValueError):
    """The text at a place does not follow the grammar."""


def _upto(text: str, at: int, mark: str) -> int:
    """Where ``mark`` stands, if it is the next control string."""
    found = BARE.search(text, at)
    if not found or found[0] != mark:
        raise NotATurn(f"{mark} expected after {at}")
    return found.start()


def parsed_turn(text: str, at: int) -> tuple[str, str, tuple[int, int], int]:
    """The turn that starts at ``at``: role, content, where the content stands, and where the turn ends."""
    found = BARE.match(text, at)
    opening = found[0] if found else ""
    at += len(opening)
    if opening == OTHER:
        end = _upto(text, at, NAMED)
        role, closing = unescaped(text[at:end]), OTHER_END
        at = end + len(NAMED)
    elif opening in OPENED:
        role = OPENED[opening]
        closing = MARKS[role][1]
    else:
        raise NotATurn(f"no turn at {at}")
    end = _upto(text, at, closing)
    return role, unescaped(text[at:end]), (at, end), end + len(closing)


def parsed(text: str) -> Iterator[tuple[str, str, tuple[int, int]]]:
    """The turns of a formatted text: role, content and the place of the content."""
    at = 0
    while at < len(text):
        role, content, span, at = parsed_turn(text, at)
        yield role, content, span


def _recovered(piece: str, role: str, text: str) -> bool:
    try:
        found = parsed_turn(piece, 0)
    except NotATurn:
        return False
    return (found[0], found[1], found[3]) == (role, text, len(piece))


def rendered_turn(role: str, text: str) -> str:
    """The turn as the parser recovers it: plain, else with its text escaped, else with the name of its role too."""
    for name, content in ((role, text), (role, escaped(text)), (escaped(role), escaped(text))):
        start, end = MARKS.get(role) or (f"{OTHER}{name}{NAMED}", OTHER_END)
        piece = f"{start}{content}{end}"
        if _recovered(piece, role, text):
            return piece
    raise AssertionError("a turn with all its control strings escaped must be recovered")


def _of_segment(conv_id, at, rows) -> tuple:
    source = [(role, text) for _, role, text in rows]
    formatted = "".join(rendered_turn(*turn) for turn in source)
    found = list(parsed(formatted))
    if [f[:2] for f in found] != source:
        raise AssertionError("the formatted text does not read back as its turns")
    return len(rows), formatted, [{"start": a, "end": b} for role, _, (a, b) in found if role == "assistant"]


def formatted(conversations: DataFrame, **bounds: int) -> DataFrame:
    """The conversations as text: one row for each segment (``turns``), conv_id, ``at`` and ``FORMATTED``.

    The texts of a conversation's segments, in order of ``at``, make up the conversation. ``loss`` gives the places of
    the assistant's words in a segment's text, in code points. A null role or text is empty, a null conv_id is a
    conversation of its own, rows go by turn with nulls first and ties by role and text, repeated rows are repeated
    turns, an empty text is an empty turn, other columns are not looked at, and an empty table gives no rows.
    """
    return segments(turns(conversations, ""), _of_segment, FORMATTED, **bounds)


def _report(parts) -> tuple:
    """What the formatted segments of a conversation hold, read back from them alone."""
    all_turns, under_loss = hashlib.sha256(), hashlib.sha256()
    n = loss = chars = 0
    for text, spans in parts:
        chars += len(text)
        for role, content, _ in parsed(text):
            n += 1
            all_turns.update(f"{role}\n{content}\n".encode())
        for span in spans:
            content = unescaped(text[span["start"]:span["end"]])
            loss += len(content)
            under_loss.update(content.encode())
    return n, all_turns.hexdigest(), loss, under_loss.hexdigest(), chars


def reports(texts: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id and ``REPORT``, read back from what ``formatted`` returns.

    Conversations of one segment are read in place; those of several come together as a stream, segment by segment.
    """
    texts = written(texts, "formatted")
    several = written(texts.groupBy(F.col("conv_id").alias("several_id")).agg(F.count("*").alias("n")).where("n > 1").select(
        "several_id"), "in-segments")
    is_several = same(texts["conv_id"], several["several_id"])
    rows = texts.select("conv_id", "at", "formatted", "loss")
    names = ["conv_id", *[part.split()[0] for part in REPORT.split(", ")]]
    full = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {REPORT}"
    types = _arrow_types(rows.sparkSession, full)

    def read(batches):
        for batch in batches:
            out = [(conv_id, *_report([part])) for conv_id, _, *part in zip(*(c.to_pylist() for c in batch.columns))]
            if out:
                yield as_batch(out, names, types)

    whole = rows.join(several, is_several, "left_anti").mapInArrow(read, full)
    return whole.unionByName(streamed(rows.join(several, is_several, "left_semi"), _report, REPORT))
