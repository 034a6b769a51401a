"""Chat formatting of typed content parts.

A turn is a list of parts (text, image, audio, document).  A visitor
flattens them in order: text is escaped, every other part becomes one
placeholder, its attachment is recorded with its place, and the number of
tokens it will expand to is counted.  Each turn is one row of output, so a
conversation is never gathered; its running sums are taken while its turns
pass by in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The strings of this template, and of other common ones, that
#: must not appear inside a text.
START, MIDDLE, STOP = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROL = [START, MIDDLE, STOP, *PLACEHOLDERS.values(), "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>",
           "<|start_header_id|>", "<|end_header_id|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>"]
#: Tokens an attachment takes: per image tile, per second of audio, per page.
TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS, TILE = 85, 25, 300, 512

# a control string with any number of backslashes after its first character
_MARKED = re.compile("|".join(re.escape(c[0]) + r"(\\*)" + re.escape(c[1:]) for c in CONTROL))
_PIECES = re.compile("(" + "|".join(map(re.escape, CONTROL)) + ")")

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = ("conv_id bigint, position bigint, role string, formatted string, loss_start bigint, loss_end bigint, "
             "attachments array<struct<kind:string,uri:string,at:bigint,tokens:bigint>>, n_tokens bigint")


def escape(text: str) -> str:
    """Put one backslash more into every control string; no control string is
    left, and a text without any is unchanged."""
    return _MARKED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Take one backslash out of every marked control string."""
    return _MARKED.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


class Flattener:
    """Visits the parts of one turn in order."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.tokens = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_text)(part)

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.tokens += len(text.split())
        self.put(escape(text))

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "at": self.length, "tokens": tokens})
        self.tokens += tokens
        self.put(PLACEHOLDERS[kind])

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, -(-(part.get(side) or 1) // TILE)) for side in ("width", "height"))
        self.attach("image", part, TILE_TOKENS * across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, round((part.get("seconds") or 0) * SECOND_TOKENS)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, PAGE_TOKENS * max(1, part.get("pages") or 1))


def format_turn(role: str, parts: list[dict]) -> dict:
    """One formatted turn; the loss mask covers an assistant's content."""
    flat = Flattener()
    flat.put(START + escape(role) + MIDDLE)
    start = flat.length
    for part in parts:
        flat.visit(part)
    end = flat.length
    flat.put(STOP)
    loss = role == "assistant"
    return {"formatted": "".join(flat.pieces), "loss_start": start if loss else 0, "loss_end": end if loss else 0,
            "attachments": flat.attachments, "n_tokens": flat.tokens}


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn."""
    conv, position, offset = None, 0, 0
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("uri", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            out = []
            for row in batch.slice(at, 500).to_pylist():
                if row["conv_id"] != conv or position == 0:
                    conv, position, offset = row["conv_id"], 0, 0
                role = row["role"] or ""
                turn = format_turn(role, row["parts"] or [])
                for a in turn["attachments"]:
                    a["at"] += offset
                if turn["loss_end"]:
                    turn["loss_start"] += offset
                    turn["loss_end"] += offset
                out.append({"conv_id": conv, "position": position, "role": role, **turn})
                position += 1
                offset += len(turn["formatted"])
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
                ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", kinds), ("n_tokens", pa.int64())]))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted turns of ``turns`` (``conv_id``, ``turn``, ``role``, and
    ``parts``, an array of ``PART``, or else ``text``).

    One row per turn: its ``position`` in the conversation, the formatted
    text, the loss span and the attachments' places as code points from the
    conversation's start, and the token count after placeholders expand.  A
    conversation's text is its rows' ``formatted`` in order of ``position``.

    Turns are ordered by ``turn`` (nulls first), then role and text, so ties
    have one order and repeated rows are repeated turns.  Null texts, parts
    and roles count as empty; rows without conv_id form one conversation.
    Unknown kinds of parts are read as text.  Other columns are ignored; an
    empty table gives no rows."""
    text = F.col("text") if "text" in turns.columns else F.lit(None).cast("string")
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None)
    own = F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("uri"),
                           *[F.lit(None).cast(t).alias(n) for n, t in (("width", "int"), ("height", "int"),
                                                                       ("seconds", "double"), ("pages", "int"))]))
    rows = turns.select("conv_id", "turn", "role", F.coalesce(parts, own).cast(f"array<{PART}>").alias("parts"),
                        text.alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .drop("text", "turn").mapInArrow(_format, FORMATTED))


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn without attachments."""
    pieces = _PIECES.split(formatted)
    if [pieces[1], pieces[3], pieces[5]] != [START, MIDDLE, STOP] or len(pieces) != 7 or pieces[0] or pieces[6]:
        raise ValueError("not one formatted turn")
    return unescape(pieces[2]), unescape(pieces[4])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted turns in order, read back: one row per conversation.  Hashes
    are fed turn by turn, so a long conversation needs no more memory."""
    held = None

    def done(h: dict) -> dict:
        return {"conv_id": h["conv_id"], "n_turns": h["n"], "turns_sha256": h["turns"].hexdigest(),
                "loss_chars": h["loss_chars"], "loss_sha256": h["loss"].hexdigest(), "formatted_chars": h["chars"],
                "n_tokens": h["tokens"]}

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("n_tokens", pa.int64())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["position"] == 0:
                if held:
                    out.append(done(held))
                held = {"conv_id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss_chars": 0,
                        "loss": hashlib.sha256(), "chars": 0, "tokens": 0}
            role, text = parse_turn(row["formatted"])
            held["turns"].update(f"{role}\n{text}\n".encode())
            masked = unescape(row["formatted"][max(0, row["loss_start"] - held["chars"]):
                                               max(0, row["loss_end"] - held["chars"])])
            held["loss"].update(masked.encode())
            held["loss_chars"] += len(masked)
            held["n"] += 1
            held["chars"] += len(row["formatted"])
            held["tokens"] += row["n_tokens"]
        yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([done(held)], schema)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_tokens`` per conversation, read back from the output
    of ``format_conversations`` (text parts only)."""
    return (formatted.select("conv_id", "position", "formatted", "loss_start", "loss_end", "n_tokens")
            .repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .mapInArrow(_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                 "loss_sha256 string, formatted_chars bigint, n_tokens bigint"))
