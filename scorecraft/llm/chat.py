"""Chat formatting (operator 5) with typed content parts.

A turn is a list of typed parts: text, image, audio or document. A visitor
with one method per type flattens them into the turn's text, in order: text is
escaped, every other part becomes a placeholder and an attachment record
(reference, place, the tokens it expands to in a model's input).

Template of a turn: ``<|turn|>`` role ``<|says|>`` body ``<|end|>``. In texts
``\\`` becomes ``\\\\`` and ``<|`` becomes ``\\<|``, so a control string never
occurs inside a text and ``unescape`` gives the text back exactly.

One conversation is one output string, so its turns meet in one task; they are
gathered with a native aggregate on conv_id.

Defined cases: turns sort by (turn, role, text), nulls first; a null text is
empty, a null role is the empty role; rows with a null conv_id are one
conversation; repeated rows are turns of their own; an unknown part type is an
error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.common import arrow_map

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
_CONTROL = re.compile(r"\\(?:\\|<\|)|<\|[a-z]+(?: [^|]*)?\|>")

# a part: type, text (of a text part), ref, and its extent: pixels of an image,
# seconds of a recording, pages of a document
PART = "struct<type:string,text:string,ref:string,width:double,height:double,seconds:double,pages:double>"

PATCH, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 512


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "\\<|")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|<\|)", r"\1", text)


@dataclass
class Flattened:
    """The visitor: one method per part type, in the order of the parts."""

    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part['type']}", None)
        if method is None:
            raise ValueError(f"unknown content part type: {part['type']!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.body.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * TOKENS_A_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, math.ceil(part["pages"] or 0) * TOKENS_A_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.body.append(f"<|{kind} {len(self.attachments)}|>")
        self.attachments.append({"ref": part["ref"], "kind": kind, "tokens": max(1, tokens)})


def render(turns: list[tuple[str, list[dict]]], trained_role: str = "assistant"):
    """The formatted conversation, the code point spans under the loss mask, and the attachments."""
    out, at, spans, flat = [], 0, [], Flattened()
    for role, parts in turns:
        flat.body = []
        for part in parts:
            flat.visit(part)
        head, body = TURN + escape(role) + SAYS, "".join(flat.body)
        if role == trained_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans, flat.attachments


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns read back: (role, text); placeholders stay as they are. Reads the
    whole string or fails."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(TURN, at):
            raise ValueError(f"no turn at {at}")
        says = _find(formatted, SAYS, at + len(TURN))
        end = _find(formatted, END, says + len(SAYS))
        turns.append((unescape(formatted[at + len(TURN):says]), unescape(formatted[says + len(SAYS):end])))
        at = end + len(END)
    return turns


def _find(text: str, control: str, at: int) -> int:
    for m in _CONTROL.finditer(text, at):
        if m[0] == control:
            return m.start()
    raise ValueError(f"{control} is missing")


def text_part(text: Column) -> Column:
    """A turn of plain text as a list of parts."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text")))


def format_conversations(turns: DataFrame, parts: Column | None = None, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_start, loss_end, refs, kinds, tokens): one row per
    conversation. ``parts`` is an array of ``PART`` structs; by default each turn
    is its ``text``."""
    body = parts if parts is not None else text_part(F.col(text))
    rows = turns.select(F.col(conv_id).cast("long").alias("_conv"), F.struct(
        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.to_json(body).alias("parts")).alias("t"))
    gathered = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("t")).alias("ts")).select(
        "_conv", F.col("ts.role").alias("roles"), F.col("ts.parts").alias("parts"))

    def fmt(batch) -> dict:
        import json

        blank = dict.fromkeys(("type", "text", "ref", "width", "height", "seconds", "pages"))
        cols = {k: [] for k in ("formatted", "loss_start", "loss_end", "refs", "kinds", "tokens")}
        for roles, ps in zip(batch.column("roles").to_pylist(), batch.column("parts").to_pylist()):
            s, spans, files = render([(r, [blank | x for x in json.loads(p or "[]") if x]) for r, p in zip(roles, ps)], trained_role)
            cols["formatted"].append(s)
            cols["loss_start"].append([a for a, _ in spans])
            cols["loss_end"].append([b for _, b in spans])
            for k in ("ref", "kind", "tokens"):
                cols[k if k == "tokens" else k + "s"].append([f[k] for f in files])
        return cols | {"conv_id": batch.column("_conv")}

    return arrow_map(gathered, fmt, "conv_id long, formatted string, loss_start long[], loss_end long[], "
                                    "refs string[], kinds string[], tokens long[]")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each formatted conversation, parsed from the string and its loss mask."""

    def read(batch) -> dict:
        cols = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for s, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("formatted", "loss_start", "loss_end"))):
            turns, loss = parse(s), "".join(unescape(s[a:b]) for a, b in zip(starts, ends))
            cols["n_turns"].append(len(turns))
            cols["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            cols["loss_chars"].append(len(loss))
            cols["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
            cols["formatted_chars"].append(len(s))
        return cols | {"conv_id": batch.column("conv_id")}

    return arrow_map(formatted, read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
