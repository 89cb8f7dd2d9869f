"""Chat formatting by typed content parts.

A turn's content is a list of parts: text, image, audio and document. A visitor flattens them, in order, into text with
placeholders, notes each attachment's reference and place, and counts the tokens that its placeholder expands to. A plain
text is a list of one text part and goes the same way. The template marks turns with control strings; where a text has one
of these itself, an escape sign goes before it, which the reader takes out again. Placeholders are control strings too: only
those that the visitor set are read as attachments.

    <s>[TURN user[:] See <|image_1|> [/TURN]</s>

Each turn is formatted by itself, so a conversation of any length is a run of rows in order, never one large value.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bounded_batches

#: The sign before control strings, and before itself, inside texts.
ESCAPE = "\\"
#: Control strings; all begin with < or [, which is what is escaped inside texts.
TURN, CLOSE, END = "<s>[TURN ", "[:]\n", "\n[/TURN]</s>\n"
#: Kinds of attachments, and the placeholder of one.
KINDS = ("image", "audio", "document", "unknown")
HOLDER = rf"<\|({'|'.join(KINDS)})_(\d+)\|>"
_PLAIN = r"[^\\\[<]++|\\."
_HEAD = re.compile(f"{re.escape(TURN)}((?:{_PLAIN})*+){re.escape(CLOSE)}", re.S)
_BODY = re.compile(f"(?:{_PLAIN}|{HOLDER})*+", re.S)
_TOKEN = re.compile(f"({_PLAIN})|{HOLDER}", re.S)
PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
_FIELDS = [x.split(" ")[0] for x in PART.split(", ")]
FLAT = "body string, attachments array<struct<kind:string,ref:string,at:long,tokens:long>>, attached_tokens long"
_ATTACHMENT = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
_FLAT = pa.struct([("body", pa.string()), ("attachments", pa.list_(_ATTACHMENT)), ("attached_tokens", pa.int64())])


@dataclass
class Flattener:
    """Visits parts in order. patch: pixels along a side of an image token; rate: audio tokens a second."""

    patch: int = 14
    rate: float = 25.0
    page_tokens: int = 600
    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * self.rate))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * self.page_tokens)

    def visit_other(self, part: dict) -> None:
        self._attach("unknown", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.length, "tokens": max(1, tokens)})
        self._add(f"<|{kind}_{len(self.attachments)}|>")

    def _add(self, text: str) -> None:
        self.text.append(text)
        self.length += len(text)


def escape(text: str) -> str:
    return text.replace(ESCAPE, ESCAPE * 2).replace("<", ESCAPE + "<").replace("[", ESCAPE + "[")


def unescape(text: str) -> str:
    """Each escape sign goes, what follows it stays."""
    if ESCAPE not in text:
        return text
    out, at = [], 0
    while (k := text.find(ESCAPE, at)) >= 0:
        out += [text[at:k], text[k + 1 : k + 2]]
        at = k + 2
    return "".join([*out, text[at:]])


def escaped(text: Column) -> Column:
    """escape() as a column."""
    for c in (ESCAPE, "<", "["):
        text = F.replace(text, F.lit(c), F.lit(ESCAPE + c))
    return text


def _flattened(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """What the visitor makes of each turn's parts."""
    for lists in batches:
        parts, ends = lists.flatten(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        there = parts.is_valid().to_pylist()
        columns = zip(*(parts.field(i).to_pylist() for i in range(len(_FIELDS))), strict=True)
        visited = zip(there, columns, strict=True)
        rows, at = [], 0
        for end in ends:
            f = Flattener()
            for known, part in islice(visited, end - at):
                if known:
                    f.visit(dict(zip(_FIELDS, part, strict=True)))
            rows.append({"body": "".join(f.text), "attachments": f.attachments, "attached_tokens": sum(a["tokens"] for a in f.attachments)})
            at = end
        yield pa.array(rows, _FLAT)


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_from, loss_to, attachments, attached_tokens) of every turn.

    turns has conv_id, turn, role and either text or parts, a list of structs with the fields of PART. segment is the
    turn's formatted text; a conversation's segments, by turn, are its formatted text. loss_from and loss_to are code points
    of the segment between which an assistant's body stands, equal for other roles. at, of an attachment, counts from the
    body's start. Null texts and lists are empty, a null role is "", rows that repeat are turns of their own. Other columns
    are not looked at.
    """
    bounded_batches(turns.sparkSession)
    kind = f"array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>"
    if "parts" in turns.columns:
        parts = F.col("parts").cast(kind)
    else:
        none = [F.lit(None).alias(name) for name in _FIELDS[2:]]
        parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").cast("string").alias("text"), *none)).cast(kind)
    role = escaped(F.coalesce(F.col("role").cast("string"), F.lit("")))
    flat = F.arrow_udf(_flattened, FLAT).asNondeterministic()  # else each use of a field would flatten again
    flat = turns.select("conv_id", "turn", "role", flat(parts).alias("flat")).select("conv_id", "turn", "role", "flat.*")
    head = F.concat(F.lit(TURN), role, F.lit(CLOSE))
    begin = F.length(head).cast("long")
    end = begin + F.when(F.col("role") == "assistant", F.length("body")).otherwise(0)
    return flat.select("conv_id", "turn", F.concat(head, "body", F.lit(END)).alias("segment"), begin.alias("loss_from"), end.alias("loss_to"), "attachments", "attached_tokens")


def _turn(segment: str) -> tuple[str, str]:
    """Role and escaped body of a formatted turn. No control string but placeholders begins inside the body."""
    head = _HEAD.match(segment)
    body = segment[head.end() : -len(END)] if head else ""
    if not head or not segment.endswith(END) or len(segment) < head.end() + len(END) or not _BODY.fullmatch(body):
        raise ValueError("not a formatted turn")
    return unescape(head[1]), body


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn, placeholders as they stand."""
    role, body = _turn(segment)
    return role, unescape(body)


def read_parts(segment: str, attachments: list[dict]) -> tuple[str, list[tuple[str, str]]]:
    """Role and parts of a formatted turn: (text, the text) and (kind, the reference). Neighbouring texts are one."""
    role, body = _turn(segment)
    out: list[tuple[str, str]] = []
    seen = 0
    for m in _TOKEN.finditer(body):
        if m[1] is None:
            a = attachments[seen] if seen < len(attachments) else {"kind": None}
            if (a["kind"], int(m[3]), a.get("at")) != (m[2], seen + 1, m.start()):
                raise ValueError(f"placeholder {m[0]} has no attachment")
            out.append((a["kind"], a["ref"]))
            seen += 1
        elif out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + unescape(m[1]))
        else:
            out.append(("text", unescape(m[1])))
    if seen != len(attachments):
        raise ValueError("an attachment has no placeholder")
    return role, out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and turn in, a row for each conversation out; one is held at a time, as digests."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attached_tokens"]
    state: list | None = None
    kind = None

    def row(s: list) -> tuple:
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), *s[5:]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    for batch in batches:
        kind = batch.schema.field(0).type
        out = []
        for conv, segment, a, b, attached in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_from", "loss_to", "attachments")), strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    out.append(row(state))
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            if attached:
                read_parts(segment, attached)  # each placeholder must have its attachment
            role, text = parse(segment)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            under = unescape(segment[a:b])
            state[3] += len(under)
            state[4].update(under.encode())
            state[5] += len(segment)
            state[6] += len(attached)
            state[7] += sum(x["tokens"] for x in attached)
        if out:
            yield batch_of(out)
    if state is not None:
        yield batch_of([row(state)])


def read_back(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, attached_tokens) of every
    conversation, from its segments. In digests an attachment is its placeholder.

    Turns with one number follow each other by their segments. A null conv_id is a conversation of its own.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = segments.select("conv_id", "turn", "segment", "loss_from", "loss_to", "attachments").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.mapInArrow(_read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attached_tokens long")
