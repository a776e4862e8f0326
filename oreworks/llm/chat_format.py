"""Chat turns of typed parts as one marked text, and back.

A turn is `<|turn|>role\\nbody<|end|>\\n`. Texts are escaped so that no mark can occur in
them: a backslash is doubled, and one is put after the first character of anything that is
or resembles a mark. Other parts become placeholders, in their order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
IMAGE, AUDIO, DOCUMENT, DOCUMENT_END = "<|image|>", "<|audio|>", "<|document|>", "<|/document|>"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double>"
FORMATTED = (
    "struct<formatted:string,loss:array<struct<start:int,stop:int>>,"
    "attachments:array<struct<type:string,ref:string,tokens:bigint>>,expanded_tokens:bigint>"
)

_MARKS = re.compile(r"\\|<(?=\||/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|turn\|>((?:\\.|[^\\\n])*)\n(.*)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _MARKS.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and body of a turn; the body is still escaped."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), found[2]


@dataclass
class Flattener:
    """Visits the parts of a turn and collects its body.

    An image counts patch x patch pixels as a token and at least one, a second of audio counts
    audio_rate tokens, a document its text's characters by four. An image without size has
    one token, audio without length none.
    """

    patch: int = 28
    audio_rate: float = 25.0
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        visitor = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown type of part: {kind!r}")
        visitor(part)

    def visit_text(self, part: dict) -> None:
        self.body.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across = math.ceil((part.get("width") or 1) / self.patch)
        down = math.ceil((part.get("height") or 1) / self.patch)
        self._attach("image", part, IMAGE, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, AUDIO, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        text = part.get("text") or ""
        self._attach("document", part, DOCUMENT, math.ceil(len(text) / 4))
        self.body += [escape(text), DOCUMENT_END]

    def _attach(self, kind: str, part: dict, mark: str, tokens: int) -> None:
        self.body.append(mark)
        self.attachments.append({"type": kind, "ref": part.get("ref"), "tokens": tokens})


def format_turn(role: str | None, parts: list[dict] | None, loss_roles: tuple[str, ...]) -> dict:
    flat = Flattener()
    for part in parts or []:
        flat.visit(part)
    head = f"{OPEN}{escape_role(role or '')}\n"
    body = "".join(flat.body)
    return {
        "formatted": head + body + CLOSE,
        "loss": [{"start": len(head), "stop": len(head) + len(body)}] if role in loss_roles else [],
        "attachments": flat.attachments,
        "expanded_tokens": sum(a["tokens"] for a in flat.attachments),
    }


def formatted(
    role: Column, parts: Column, loss_roles: tuple[str, ...] = ("assistant",)
) -> Column:
    """struct<formatted, loss, attachments, expanded_tokens> of each turn.

    loss holds first and past-the-end code points in formatted. A null role is empty, null
    parts are none, null texts are empty; a part without type is text, one of an unknown
    type fails.
    """

    @F.arrow_udf(FORMATTED)
    def made(roles: pa.Array, turns: pa.Array) -> pa.Array:
        rows = [
            format_turn(r, p, loss_roles) for r, p in zip(roles.to_pylist(), turns.to_pylist())
        ]
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        kind = pa.struct([("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
        return pa.array(
            rows,
            pa.struct(
                [
                    ("formatted", pa.string()),
                    ("loss", span),
                    ("attachments", pa.list_(kind)),
                    ("expanded_tokens", pa.int64()),
                ]
            ),
        )

    return made(role, parts)


def text_parts(text: Column) -> Column:
    """A turn that is one text."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            none.cast("string").alias("ref"),
            none.cast("int").alias("width"),
            none.cast("int").alias("height"),
            none.cast("double").alias("seconds"),
        )
    )


def format_turns(
    turns: DataFrame,
    parts: Column,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per turn: conv, turn, formatted, loss, attachments, expanded_tokens.

    A conversation is its turns' texts, one after another by turn. Turns with equal numbers go
    by their formatted text; a null number comes first. Turns without conversation form one of
    their own. Other columns are left out, an empty table gives an empty one.
    """
    made = turns.select(
        F.col(conv), F.col(turn), formatted(F.col(role), parts, loss_roles).alias("made")
    )
    return made.select(conv, turn, "made.*")


def read_back(
    formatted_turns: DataFrame, conv: str = "conv_id", turn: str = "turn"
) -> DataFrame:
    """Digests of each conversation, from its formatted text alone.

    Rows come sorted and pass through one running hash per conversation, so no conversation
    is ever held whole. A digest needs a conversation's text in order, and so one task.
    """
    schema = (
        f"{conv} {formatted_turns.schema[conv].dataType.simpleString()}, n_turns bigint,"
        " turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now.key != row["conv"]:
                    if now is not None:
                        done.append(now.row(conv))
                    now = _Digest(row["conv"])
                now.add(row["formatted"], row["loss"])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row(conv)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))
    ordered = (
        formatted_turns.select(
            F.col(conv).alias("conv"), F.col(turn).alias("turn"), "formatted", "loss"
        )
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "formatted")
    )
    return ordered.select("conv", "formatted", "loss").mapInArrow(digest, schema)


class _Digest:
    def __init__(self, key):
        self.key, self.turns, self.chars, self.loss_chars = key, 0, 0, 0
        self.text_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict]) -> None:
        role, body = parse_turn(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.text_hash.update(f"{role}\n{unescape(body)}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["stop"]])
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode())

    def row(self, conv: str) -> dict:
        return {
            conv: self.key,
            "n_turns": self.turns,
            "turns_sha256": self.text_hash.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss_hash.hexdigest(),
            "formatted_chars": self.chars,
        }
