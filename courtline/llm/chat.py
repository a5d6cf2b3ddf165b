"""Chat formatting by a compiled template (operator 11), and its exact way back.

Rows are dealt by ranges of (conv_id, turn) and sorted, so that a conversation's rows follow each other and one that
holds a third of all rows is spread over several tasks.  A task streams its rows through the closures of the template
(``templates.py``) and puts out pieces: whole conversations, or, of one that is longer than ``PIECE`` code points or
crosses the edge of a range, stretches that are cut between turns.  No conversation is ever held as a whole.

``read_back`` streams the stored pieces through a reader of the default template.  Pieces that are whole
conversations are read where they lie; only stretches are brought together by conversation, in order.  The digests of
one conversation are sequential, so the stretches of a conversation pass through one task, a piece at a time.

Turns are ordered by turn (null first), then role and text.  Defined cases: a null text or role is the empty one; rows
with a null conv_id are one conversation; repeated rows are turns each; a text of any length is one turn; control
strings, line breaks and backslashes in roles and texts come back as they were; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import saved, ship
from courtline.llm.templates import Template, TemplateError, joined, unescape

CONTROLS = ("### ", "</turn>")
CHAT = """
{%- for m in messages -%}
  {%- if m.role == 'assistant' -%}### Assistant: {% generation %}{{ m.text | escape }}{% endgeneration %}
  {%- elif m.role == 'user' -%}### User: {{ m.text | escape }}
  {%- elif m.role == 'system' -%}### System: {{ m.text | escape }}
  {%- else -%}### Role {{ m.role | escape(': ') }}: {{ m.text | escape }}
  {%- endif -%}</turn>{{ '\\n' }}
{%- endfor -%}
"""
PIECE = 1_000_000  # code points after which a piece ends, between turns

# Possessive repeats: a turn is read in one pass, with no way back.
_TURN = re.compile(r"### (?:(Assistant|User|System)|Role ((?:[^\\:]++|\\.|:(?! ))*+)): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)

PIECES = "conv_id long, part int, piece int, whole boolean, n_turns long, formatted string, loss array<struct<start:long,end:long>>"
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                     ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a text that the default template wrote."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise TemplateError(f"no turn begins at code point {at}")
        yield m[1].lower() if m[1] else unescape(m[2]), unescape(m[3])
        at = m.end()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        names = b.schema.names
        for values in zip(*(b.column(k).to_pylist() for k in range(len(names)))):
            yield dict(zip(names, values))


def _batched(rows: Iterator[dict], schema: pa.Schema, text: str | None, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most 5,000, or of about ``most`` code points of the column ``text``."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[text]) if text else 0
        if len(held) >= 5000 or size > most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _stretches(rows: Iterator[dict], part: int, template: Template) -> Iterator[dict]:
    """The pieces of a task's sorted rows; ``whole`` holds for conversations that surely lie inside the task."""
    pairs, size, n, piece = [], 0, 0, 0
    conv, first_conv, last_turn = None, True, object()

    def one(whole: bool) -> dict:
        text, spans = joined(pairs)
        return {"conv_id": conv, "part": part, "piece": piece, "whole": whole and piece == 0, "n_turns": n, "formatted": text,
                "loss": [{"start": a, "end": e} for a, e in spans]}

    begun, waiting = False, next(rows, None)
    while (row := waiting) is not None:
        waiting = next(rows, None)
        if begun and row["conv_id"] != conv:
            if n:
                yield one(not first_conv)
            pairs, size, n, piece, first_conv, last_turn = [], 0, 0, 0, False, object()
        conv, begun = row["conv_id"], True
        first = last = False
        if template.edges:  # rows of one turn lie in one task: the first and the last of them are the conversation's
            first = row["turn"] == row["first_turn"] and last_turn != row["turn"]
            last = row["turn"] == row["last_turn"] and (waiting is None or (waiting["conv_id"], waiting["turn"]) != (conv, row["turn"]))
        last_turn = row["turn"]
        for pair in template.message({k: row[k] for k in ("role", "text", "turn")}, first, last):
            pairs.append(pair)
            size += len(pair[0])
        n += 1
        if size > PIECE:
            yield one(False)
            pairs, size, n, piece = [], 0, 0, piece + 1
    if n:
        yield one(False)


def _format(source: str, controls: tuple[str, ...], variables: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source, controls, variables)
        yield from _batched(_stretches(_rows(batches), TaskContext.get().partitionId(), template), _PIECES, "formatted")
    return run


def formatted(conversations: DataFrame, source: str = CHAT, controls: tuple[str, ...] = CONTROLS, **variables) -> DataFrame:
    """Pieces of formatted conversations: conv_id, part, piece (their order), whole, n_turns, formatted, loss.

    ``loss`` has a span (code points of the piece, end exclusive) for each text that the template puts out between
    ``{% generation %}`` and its end.  ``variables`` are constants that the template may name.
    """
    ship(conversations.sparkSession)
    edges = Template(source, controls, variables).edges  # a bad template fails here, before any task
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    if edges:
        ends = rows.groupBy(F.col("conv_id").alias("c")).agg(
            F.when(F.count("*") == F.count("turn"), F.min("turn")).alias("first_turn"), F.max("turn").alias("last_turn"))
        rows = rows.join(ends, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    dealt = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format(source, controls, variables), PIECES)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    """A row for each run of pieces of one conversation; of the texts only one piece is held."""
    conv, state = None, None

    def ended() -> dict:
        n, all_turns, chars, loss, size = state
        return {"conv_id": conv, "n_turns": n, "turns_sha256": all_turns.hexdigest(), "loss_chars": chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": size}

    for r in rows:
        if state is None or r["conv_id"] != conv:
            if state is not None:
                yield ended()
            conv, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
        for role, text in turns(r["formatted"]):
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
        for span in r["loss"]:
            text = unescape(r["formatted"][span["start"]:span["end"]])
            state[2] += len(text)
            state[3].update(text.encode())
        state[4] += len(r["formatted"])
    if state is not None:
        yield ended()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(_digests(_rows(batches)), _READ, None)


def read_back(pieces: DataFrame) -> DataFrame:
    """From stored pieces of the default template: turns, loss text and sizes per conversation, as digests."""
    cols = ["conv_id", "formatted", "loss"]
    inside = pieces.filter("whole").select(*cols).mapInArrow(_read, READ)
    across = pieces.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select(*cols)
    return inside.unionByName(across.mapInArrow(_read, READ))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """The conversations formatted, stored, and read back from what is stored."""
    return read_back(saved(formatted(conversations), "chat"))
