"""Conversations through a compiled template, with the spans a loss applies to, and back.

Turns of a conversation are sorted next to each other and rendered one after the other: a
worker holds one turn and one chunk of output, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import quoted
from orderloom.llm.template import compile_template

#: Turns, each between control strings; only what the assistant says is generated.
TEMPLATE = (
    "{% for m in messages %}"
    "<turn {{ m.role | escape }}>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>\n"
    "{% endfor %}"
)
#: Every control string of the template begins and ends with a bracket, so texts keep none.
ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
ESCAPED = {v: k for k, v in ESCAPES.items()}
TURN = re.compile(r"<turn ([^<>]*)>([^<>]*)</turn>\n")
CHUNK_CHARS = 1_000_000

FORMATTED = "conv_id bigint, chunk bigint, text string, loss_begins array<bigint>, loss_ends array<bigint>"
DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def escape(text: object) -> str:
    return re.sub(r"[\\<>]", lambda m: ESCAPES[m[0]], "" if text is None else str(text))


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lg]", lambda m: ESCAPED[m[0]], text)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["conv_id", "chunk", "text", "loss_begins", "loss_ends"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """(conv_id, chunk, text, loss_begins, loss_ends): the formatted text in chunks, in order.

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Rows of a conversation
    are ordered by turn, ties by role, then text; repeated rows are turns of their own. NULL
    role or text is empty, NULL turn comes first, NULL conv_id is one conversation. Loss spans
    count code points from the chunk's start. A chunk ends between pieces of output, when it
    has ``chunk_chars``; most conversations are one chunk. Chunks of a conversation are
    consecutive rows of one partition.
    """
    ordered = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        compiled = compile_template(template, {"escape": escape})
        ready, held = [], 0
        for conv_id, rows in groupby(_turns(batches), key=lambda row: row[0]):
            messages = ({"role": role, "text": text} for _, _, role, text in rows)
            parts, begins, ends, size, chunk = [], [], [], 0, 0
            for piece, generated in compiled.render(messages=messages):
                if size >= chunk_chars:
                    ready.append((conv_id, chunk, "".join(parts), begins, ends))
                    yield _rows(ready)
                    ready, held, parts, begins, ends, size, chunk = [], 0, [], [], [], 0, chunk + 1
                if generated:
                    begins.append(size)
                    ends.append(size + len(piece))
                parts.append(piece)
                size += len(piece)
            ready.append((conv_id, chunk, "".join(parts), begins, ends))
            held += size
            if held >= chunk_chars:
                yield _rows(ready)
                ready, held = [], 0
        if ready:
            yield _rows(ready)

    return ordered.mapInArrow(run, FORMATTED)


class _Reader:
    """Reads one formatted conversation back, chunk by chunk."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.loss_chars, self.chars, self.rest = conv_id, 0, 0, 0, ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, begins: list[int], ends: list[int]) -> None:
        for begin, end in zip(begins, ends, strict=True):
            said = unescape(text[begin:end])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.chars += len(text)
        self.rest += text
        done = 0
        for m in TURN.finditer(self.rest):
            if m.start() != done:
                break
            self.n += 1
            self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            done = m.end()
        self.rest = self.rest[done:]

    def result(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv_id} cannot be read back: {self.rest[:80]!r}")
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text of every conversation, parsed from what ``format_conversations`` made with ``TEMPLATE``."""

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        reader, done = None, []

        def batch():
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for conv_id, chunk, text, begins, ends in _turns(batches):
            if chunk == 0:
                if reader:
                    done.append(reader.result())
                reader = _Reader(conv_id)
            reader.read(text, begins, ends)
            if len(done) >= 10_000:
                yield batch()
                done.clear()
        if reader:
            done.append(reader.result())
        if done:
            yield batch()

    return formatted.select(*[quoted(c) for c in ("conv_id", "chunk", "text", "loss_begins", "loss_ends")]).mapInArrow(run, DIGEST)
