"""Conversations as training text with the spans to be learned, and back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame

from stocktide.llm.templates import BEGIN, END, Controls, Template

#: What opens a turn, ends its role and closes its text.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>"
TURNS = ("{% for m in messages %}" + OPEN + "{{ m.role | escape }}" + AFTER_ROLE
         + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
         + CLOSE + "\n{% endfor %}")
CONTROLS = (OPEN, AFTER_ROLE, CLOSE)
PIECE = 1 << 20
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
FORMATTED = "conv_id bigint, piece bigint, formatted string, loss array<struct<begin: bigint, end: bigint>>"
READ_BACK = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


@lru_cache(maxsize=8)
def compiled(source: str, controls: tuple[str, ...]) -> Template:
    return Template(source, Controls(*controls))


def _rows(batches, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def format_conversations(conversations: DataFrame, template: str = TURNS, controls: tuple[str, ...] = CONTROLS, piece_chars: int = PIECE) -> DataFrame:
    """Each conversation written by a template: its pieces in order, and in each the spans under the loss mask (code points).

    ``conversations``: (conv_id, turn, role, text). Turns are ordered by turn, then role, then text; a null turn comes first.
    Rows are shuffled once, by conversation, and sorted within their tasks; a template that loops once over the messages is
    written from that order as it is read, so a task holds one message and one piece, however long the conversation. The
    result has the rows of a conversation one after the other in one task. A piece ends once it has ``piece_chars``: short
    conversations are one piece; only written values are never cut, so a piece may be longer by one text.

    Null role or text: written as empty. Rows of null conv_id are one conversation. Repeated rows are repeated turns. Other
    columns aren't read. An empty table gives an empty result.
    """

    def write(batches):
        program = compiled(template, controls)
        names = ("conv_id", "role", "text")
        out: list[tuple] = []
        size = 0
        for conv_id, group in groupby(_rows(batches, *names), itemgetter(0)):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in group)
            number, texts, spans, at, open_at = 0, [], [], 0, None
            for part in program.pieces(messages):
                if part is BEGIN:
                    open_at = at
                elif part is END:
                    spans.append((open_at, at))
                    open_at = None
                else:
                    texts.append(part)
                    at += len(part)
                if at >= piece_chars:
                    if open_at is not None:
                        spans.append((open_at, at))
                        open_at = 0
                    out.append((conv_id, number, "".join(texts), spans))
                    size, number, texts, spans, at = size + at, number + 1, [], [], 0
                    if size >= PIECE:
                        yield _batch(out)
                        out, size = [], 0
            if texts or not number:
                out.append((conv_id, number, "".join(texts), spans))
                size += at
            elif spans:  # a mark that ended with the last piece
                out.append((conv_id, number, "", spans))
            if size >= PIECE:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    rows = conversations.selectExpr("cast(conv_id as bigint) conv_id", "turn", "cast(role as string) role", "cast(text as string) text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(write, FORMATTED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, numbers, texts, spans = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string()),
         pa.array([[{"begin": a, "end": b} for a, b in s] for s in spans], SPANS)], ["conv_id", "piece", "formatted", "loss"])


def turns_of(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Role and text of every turn that ``TURNS`` wrote, from its pieces; holds one turn and one piece."""
    text = ""
    for piece in pieces:
        text, at = text + piece, 0
        while (end := text.find(CLOSE + "\n", at)) >= 0:
            if not text.startswith(OPEN, at):
                raise ValueError(f"no turn begins at {text[at : at + 20]!r}")
            middle = text.index(AFTER_ROLE, at + len(OPEN))
            yield Controls.unescape(text[at + len(OPEN) : middle]), Controls.unescape(text[middle + len(AFTER_ROLE) : end])
            at = end + len(CLOSE) + 1
        text = text[at:]
    if text:
        raise ValueError("a turn isn't closed")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the pieces that ``format_conversations`` wrote with ``TURNS`` and their loss spans alone: number
    and digest of its turns, length and digest of what is learned, length of what was written.

    ``formatted`` must come as it was written: the pieces of a conversation in order, in one task. A digest of a whole
    conversation has to be taken in order; it is taken as the pieces stream by, with one turn held.
    """

    def read(batches):
        out = []
        for conv_id, group in groupby(_rows(batches, "conv_id", "formatted", "loss"), itemgetter(0)):
            sizes = {"loss": 0, "formatted": 0, "turns": 0}
            turns, loss = hashlib.sha256(), hashlib.sha256()

            def watched(group=group, sizes=sizes, loss=loss):
                for _, text, spans in group:
                    sizes["formatted"] += len(text)
                    for span in spans:
                        learned = Controls.unescape(text[span["begin"] : span["end"]])
                        sizes["loss"] += len(learned)
                        loss.update(learned.encode())
                    yield text

            for role, text in turns_of(watched()):
                sizes["turns"] += 1
                turns.update(f"{role}\n{text}\n".encode())
            out.append((conv_id, sizes["turns"], turns.hexdigest(), sizes["loss"], loss.hexdigest(), sizes["formatted"]))
            if len(out) >= 10_000:
                yield _digests(out)
                out = []
        if out:
            yield _digests(out)

    return formatted.mapInArrow(read, READ_BACK)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in READ_BACK.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
