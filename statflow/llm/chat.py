"""Operator 9: chat formatting of typed content parts.

A turn's content is a text or an array of typed parts. A visitor walks the
parts in order: texts are escaped and joined, and every image, audio or
document part becomes a numbered placeholder; its reference and the number of
tokens it expands to are recorded. A turn is then marked as

    <s>role[INST] content [/INST]</s>

Escaping is reversible and leaves no control string in a role or a text: a
backslash doubles, and a backslash goes after the first character of each
control string. So the output can always be read back, turn by turn.

Each turn is formatted where it lies. Digests of a conversation run over its
turns in order, streamed from a partition sorted by conversation and turn:
memory does not grow with a conversation.

Defined results: a null text is empty; a null role reads back as the empty
role. Turns that tie are ordered by role, then text; repeated rows are turns
of their own; null turns come first. Rows with a null ``conv_id`` form one
conversation. Unknown part types become placeholders without tokens. Extra
columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's marks, and marks of other templates that texts must not forge.
TURN_OPEN, TURN_CLOSE, BODY_OPEN, BODY_CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
PLACEHOLDER_OPEN = "<part:"
CONTROL = (TURN_OPEN, TURN_CLOSE, BODY_OPEN, BODY_CLOSE, PLACEHOLDER_OPEN, "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

#: Tokens: an image has one per patch, audio one per tick, a document so many per page.
PATCH_PIXELS = 14
AUDIO_PER_SECOND = 25
DOCUMENT_PER_PAGE = 256

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PARTS = f"array<{PART}>"
FORMATTED = (
    "conv_id string, turn string, role string, formatted string, loss_start long, loss_end long, "
    "attachments array<struct<ordinal:int,type:string,ref:string,tokens:long>>, expanded_tokens long"
)

_CONTROL = re.compile("\\\\|" + "|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_TURN = re.compile(
    re.escape(TURN_OPEN) + "(.*?)" + re.escape(BODY_OPEN) + " (.*?) " + re.escape(BODY_CLOSE + TURN_CLOSE), re.DOTALL
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of ``escape``."""
    return _UNESCAPE.sub(lambda m: m[1] or m[0][0], text)


# Placeholders of the output; those that texts spell out are escaped.
_PLACEHOLDER = re.compile(re.escape(PLACEHOLDER_OPEN) + r"(\d+)>")

# A doubled backslash is one; a backslash after the first character of a control string goes.
_UNESCAPE = re.compile(r"\\(\\)|" + "|".join(re.escape(c[0]) + r"\\(?=" + re.escape(c[1:]) + ")" for c in CONTROL))


class PartVisitor:
    """Flattens the parts of one turn into its content, attachments and token count."""

    def __init__(self):
        self.content: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.content.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        w, h = part.get("width") or 0, part.get("height") or 0
        self.attach(part, math.ceil(w / PATCH_PIXELS) * math.ceil(h / PATCH_PIXELS))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, math.ceil((part.get("seconds") or 0) * AUDIO_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part.get("pages") or 0) * DOCUMENT_PER_PAGE)

    def visit_other(self, part: dict) -> None:
        self.attach(part, 0)

    def attach(self, part: dict, tokens: int) -> None:
        k = len(self.attachments)
        self.attachments.append({"ordinal": k, "type": part.get("type"), "ref": part.get("ref"), "tokens": tokens})
        self.content.append(f"{PLACEHOLDER_OPEN}{k}>")


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """(formatted, start and end of the content in it, attachments)."""
    visitor = PartVisitor()
    for p in parts:
        visitor.visit(p)
    content = "".join(visitor.content)
    head = f"{TURN_OPEN}{escape(role or '')}{BODY_OPEN} "
    formatted = f"{head}{content} {BODY_CLOSE}{TURN_CLOSE}"
    return formatted, len(head), len(head) + len(content), visitor.attachments


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of every turn of a formatted conversation, unescaped."""
    return [(unescape(r), unescape(c)) for r, c in _TURN.findall(formatted)]


def _format(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for conv_id, turn, role, text, parts in frame.itertuples(index=False):
            role = role if isinstance(role, str) else None
            items = [dict(p) for p in parts if p is not None] if parts is not None else [{"type": "text", "text": text}]
            formatted, start, end, attachments = format_turn(role, items)
            loss = (start, end) if role == "assistant" else (0, 0)
            rows.append((conv_id, turn, role, formatted, *loss, attachments, sum(a["tokens"] for a in attachments)))
        yield pd.DataFrame(
            rows, columns=["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "attachments", "expanded_tokens"]
        )


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn (``FORMATTED``). A conversation's output is its turns' ``formatted``, in order.

    ``turns`` has conv_id, turn, role, and text or parts (``PARTS``; null: take the text).
    """
    names = {c.lower() for c in turns.columns}
    column = lambda c, kind: (F.col(c) if c in names else F.lit(None)).cast(kind).alias(c)
    slim = turns.select(
        column("conv_id", "long").cast("string"), column("turn", "long").cast("string"), column("role", "string"), column("text", "string"), column("parts", PARTS)
    )
    formatted = slim.mapInPandas(_format, FORMATTED)  # ids as text: pandas would round large ones beside a null
    return formatted.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))


class _Digest:
    """What is known of a conversation after some of its turns."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss, self.attached = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.attachments, self.tokens = 0, 0

    def add(self, formatted: str, start: int, end: int, attachments: list[dict]) -> None:
        self.chars += len(formatted)
        for role, content in read_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
        masked = unescape(formatted[start:end])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode("utf-8", "surrogatepass"))
        for k in _PLACEHOLDER.findall(formatted) if PLACEHOLDER_OPEN in formatted else ():
            found = attachments[int(k)]
            self.attachments += 1
            self.tokens += found["tokens"]
            line = f"{found['type'] or ''}\t{found['ref'] or ''}\t{found['tokens']}\n"
            self.attached.update(line.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        text = (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
        return (*text, self.attachments, self.tokens, self.attached.hexdigest())


READ_BACK = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_attachments long, expanded_tokens long, attachments_sha256 string"
)


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in READ_BACK.split(", ")]
    now, rows = None, []
    for frame in frames:
        for conv_id, formatted, start, end, attachments in frame.itertuples(index=False):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    rows.append(now.row())
                now = _Digest(conv_id)
            now.add(formatted, int(start), int(end), attachments)
        yield pd.DataFrame(rows, columns=columns)
        rows = []
    if now is not None:
        yield pd.DataFrame([now.row()], columns=columns)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted turns and what was recorded of their
    attachments. Each placeholder of the output is looked up by its number:
    ``attachments_sha256`` runs over type, reference and tokens (tab, tab, line feed) in
    the order of the output."""
    ordered = formatted.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "attachments")
    return (
        ordered.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "formatted")
        .select(F.col("conv_id").cast("string"), "formatted", "loss_start", "loss_end", "attachments")
        .mapInPandas(_read_back, READ_BACK)
        .withColumn("conv_id", F.col("conv_id").cast("long"))
    )
