"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor
flattens them in order into one string; every part that isn't text leaves a
placeholder there and a record of what it stands for and how many tokens it
expands to. The template marks turns by control strings. These can't occur in a
text, because ``<|`` is escaped there, reversibly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import map_batches

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

PART_TYPE = (
    "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
)
OUT_TYPE = (
    "conv_id long, formatted string, loss_spans array<struct<start: bigint, stop: bigint>>, "
    "attachments array<struct<place: int, turn: int, kind: string, ref: string, start: bigint, tokens: bigint>>, "
    "expanded_tokens long"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_ATTACHMENTS = pa.list_(
    pa.struct(
        [("place", pa.int32()), ("turn", pa.int32()), ("kind", pa.string()), ("ref", pa.string())]
        + [("start", pa.int64()), ("tokens", pa.int64())]
    )
)
_OUT = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", _SPANS), ("attachments", _ATTACHMENTS)]
    + [("expanded_tokens", pa.int64())]
)
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def escape(text: str) -> str:
    """No ``<|`` is left; ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    """As a text, and without a line break, which ends the role."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


@dataclass
class PartVisitor:
    """Flattens the parts of a conversation; ``at`` is the number of code points written so far."""

    patch: int = 28
    tokens_per_second: float = 25.0
    tokens_per_page: int = 1024
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)
    at: int = 0

    def write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def visit(self, part: dict, turn: int) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part, turn)

    def visit_text(self, part: dict, turn: int) -> None:
        self.pending.append(part["text"] or "")

    def flush(self) -> None:
        """Write the text parts that follow each other as one text, so a control string across their border is seen."""
        if self.pending:
            self.write(escape("".join(self.pending)))
            self.pending.clear()

    def visit_image(self, part: dict, turn: int) -> None:
        across, down = (math.ceil((part[side] or 0) / self.patch) for side in ("width", "height"))
        self.attach("image", part, turn, across * down)

    def visit_audio(self, part: dict, turn: int) -> None:
        self.attach("audio", part, turn, math.ceil((part["seconds"] or 0) * self.tokens_per_second))

    def visit_document(self, part: dict, turn: int) -> None:
        self.attach("document", part, turn, (part["pages"] or 0) * self.tokens_per_page)

    def visit_other(self, part: dict, turn: int) -> None:
        self.attach("other", part, turn, 0)

    def attach(self, kind: str, part: dict, turn: int, tokens: int) -> None:
        self.flush()
        self.attachments.append(
            {"place": len(self.attachments), "turn": turn, "kind": kind, "ref": part["ref"], "start": self.at}
            | {"tokens": tokens}
        )
        self.write(f"<|{kind}|>")


def format_turns(turns: list[dict], **counts: float) -> dict:
    """One conversation; ``counts`` are the visitor's token rules."""
    visitor, spans = PartVisitor(**counts), []
    for number, turn in enumerate(turns):
        role = turn["role"] or ""
        visitor.write(f"{START}{escape_role(role)}\n")
        start = visitor.at
        for part in turn["parts"] or []:
            if part is not None:
                visitor.visit(part, number)
        visitor.flush()
        if role == ASSISTANT:
            spans.append({"start": start, "stop": visitor.at})
        visitor.write(f"{END}\n")
    return {
        "formatted": "".join(visitor.pieces),
        "loss_spans": spans,
        "attachments": visitor.attachments,
        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read from the formatted string; placeholders stay as they are."""
    turns = []
    for block in formatted.split(START)[1:]:
        role, _, rest = block.partition("\n")
        turns.append((unescape_role(role), unescape(rest.removesuffix(f"{END}\n"))))
    return turns


def text_part(text: Column) -> Column:
    """A message of one text part; null text is empty."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"))]
    nothing += [F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")]
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *nothing))


def format_conversations(messages: DataFrame, **counts: float) -> DataFrame:
    """One row per conv_id of ``messages`` (conv_id, turn, role, parts), turns in their order.

    Returns conv_id, formatted, loss_spans (code points of the formatted string
    that hold assistant content), attachments in order and expanded_tokens.

    Equal turn numbers are ordered by role and parts; null turns come first, a
    null role is empty, null parts and null messages add nothing, an unknown
    kind leaves ``<|other|>``. Rows with a null conv_id are one conversation
    with a null id. Repeated rows are repeated turns. Further columns are
    ignored. A conversation becomes one string, so it is the unit of memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"conv_id": conv} | format_turns(turns, **counts)
                for conv, turns in zip(batch["conv_id"].to_pylist(), batch["turns"].to_pylist())
            ]
            yield pa.RecordBatch.from_pylist(rows, _OUT)

    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "parts")))
    grouped = messages.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(ordered.alias("turns"))
    return map_batches(grouped, run, OUT_TYPE)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) from the output of ``format_conversations`` alone.

    ``turns`` are (role, text) unescaped, ``loss_text`` is all text under the loss mask, unescaped.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turns", _TURNS), ("loss_text", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                whole = row["formatted"]
                loss = "".join(unescape(whole[s["start"] : s["stop"]]) for s in row["loss_spans"])
                turns = [{"role": r, "text": t} for r, t in parse_turns(whole)]
                rows.append(
                    {"conv_id": row["conv_id"], "turns": turns, "loss_text": loss, "formatted_chars": len(whole)}
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    out = "conv_id long, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars long"
    return map_batches(formatted.select("conv_id", "formatted", "loss_spans"), run, out)
