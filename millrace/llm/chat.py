"""Chat formatting from event logs.

A log holds what a chat service recorded: a message is opened, its text streams in as
deltas, it may be edited, generated anew or deleted. ``fold`` brings the events of a message
together in the order of their sequence numbers and keeps what they come to; messages in the order of
their turns are then rendered by a ``Template`` that marks turns and escapes
control strings, with the places that count for the training loss.

The log is range-partitioned by conversation, turn and message and sorted by sequence, so one
pass over each partition folds and renders. A conversation of any length may lie in many
partitions and comes out in parts of bounded size; only a message, which is one text, is never cut. ``read_back``
parses parts by the template alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = 512  # characters of a delta of ``as_log``
PART = 1 << 20  # characters of a part after which the next turn starts a new one
LOG = ["conv_id", "turn", "message", "seq", "kind", "role", "text"]
KINDS = ("open", "delta", "edit", "regenerate", "delete")


@dataclass(frozen=True)
class Template:
    """``before`` role ``named`` text ``after``; control strings never appear inside roles and texts.

    A backslash is doubled, and one goes behind the first character of every control string,
    so neither a reader nor a tokenizer with these strings as tokens can take text for a mark.
    """

    before: str = "<turn "
    named: str = ">\n"
    after: str = "\n</turn>\n"
    controls: tuple[str, ...] = ("<turn ", "</turn>")
    loss_roles: tuple[str, ...] = ("assistant",)
    _marks: re.Pattern = field(init=False, repr=False)
    _turns: re.Pattern = field(init=False, repr=False)

    def __post_init__(self) -> None:
        if not all(len(c) > 1 and "\\" not in c for c in self.controls):
            raise ValueError("control strings need two characters and no backslash")
        if not any(c in self.after for c in self.controls) or not self.after.startswith("\n"):
            raise ValueError("the end of a turn needs a line of its own with a control string")
        marks = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.controls)
        object.__setattr__(self, "_marks", re.compile(rf"(?=\\)|{marks}"))
        role = rf"((?:[^\\{re.escape(self.named[0])}]|\\.)*)"
        turn = f"{re.escape(self.before)}{role}{re.escape(self.named)}(.*?){re.escape(self.after)}"
        object.__setattr__(self, "_turns", re.compile(turn, re.DOTALL))

    def escape(self, text: str) -> str:
        if "\\" not in text and not any(c in text for c in self.controls):
            return text
        return self._marks.sub(r"\\", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace(self.named[0], "\\" + self.named[0])

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn, and where its text starts and ends in it."""
        head = self.before + self.escape_role(role) + self.named
        body = self.escape(text)
        return head + body + self.after, len(head), len(head) + len(body)

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of every turn; raises on anything else."""
        at = 0
        while at < len(formatted):
            found = self._turns.match(formatted, at)
            if not found:
                raise ValueError(f"no turn at character {at}")
            yield self.unescape(found[1]), self.unescape(found[2])
            at = found.end()


def as_log(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """The log that finished turns would have left: each opened, then streamed in deltas of ``piece`` characters.

    Rows with the same turn come in the order of role and md5 of the text. Null roles and texts are empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    named = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text"))
    message = F.concat("role", F.lit("\n"), F.md5("text"))
    event = lambda seq, kind, role, text: F.struct(seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    nothing = F.lit(None).cast("string")
    deltas = F.transform(pieces, lambda x, i: event(i + 1, "delta", nothing, x))
    opened = event(F.lit(0), "open", F.col("role"), nothing)
    events = named.select("conv_id", "turn", message.alias("message"), F.explode(F.concat(F.array(opened), deltas)).alias("e"))
    return events.select("conv_id", "turn", "message", "e.*")


class _Message:
    """What the events of one message have come to so far."""

    def __init__(self, key: tuple) -> None:
        self.key = key
        self.times = 0  # how often the message was opened by the same event
        self.role = ""
        self.pieces: list[str] = []
        self.last: tuple | None = None
        self.repeated = False

    def apply(self, seq, kind: str, role: str | None, text: str | None) -> None:
        now = (seq, kind, role, text)
        if now == self.last:  # delivered again
            self.times += kind == "open"
            return
        self.last = now
        if kind == "open":
            self.times, self.role, self.pieces = 1, role or "", [text or ""]
        elif not self.times:
            pass  # not open: never opened, or deleted
        elif kind == "delta":
            self.pieces.append(text or "")
        elif kind == "edit":
            self.pieces = [text or ""]
        elif kind == "regenerate":
            self.pieces = [text or ""]
            self.role = self.role if role is None else role
        elif kind == "delete":
            self.times, self.pieces = 0, []


class _Part:
    """Rendered turns of one conversation, up to about ``PART`` characters."""

    def __init__(self, message: _Message, number: int) -> None:
        self.key, self.number = message.key, number
        self.texts: list[str] = []
        self.loss: list[dict[str, int]] = []
        self.turns = self.size = 0

    def add(self, role: str, text: str, template: Template) -> None:
        turn, start, end = template.render(role, text)
        if role in template.loss_roles:
            self.loss.append({"start": self.size + start, "end": self.size + end})
        self.texts.append(turn)
        self.size += len(turn)
        self.turns += 1

    def row(self) -> tuple:
        return (*self.key, self.number, self.turns, "".join(self.texts), self.loss)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[_Message]:
    """Messages of a sorted partition, each with all of its events applied."""
    message = None
    for batch in batches:
        for conv, turn, name, seq, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if message is None or message.key != (conv, turn, name):
                if message is not None:
                    yield message
                message = _Message((conv, turn, name))
            message.apply(seq, kind, role, text)
    if message is not None:
        yield message


def _parts(batches: Iterator[pa.RecordBatch], template: Template, size: int, each: bool) -> Iterator[_Part]:
    part = None
    for message in _folded(batches):
        text = "".join(message.pieces)
        for _ in range(message.times if each else min(message.times, 1)):
            if part is not None and (part.key[0] != message.key[0] or part.size >= size):
                yield part
                part = _Part(message, part.number + 1)
            part = part or _Part(message, 0)
            part.add(message.role, text, template)
    if part is not None:
        yield part


def render(log: DataFrame, template: Template | None = None, part: int = PART, each: bool = False) -> DataFrame:
    """Final messages of the conversations of ``log``, rendered: one row per part.

    ``log``: ``conv_id``, ``turn`` (order of messages), ``message`` (tells messages of a turn
    apart, and orders them), ``seq`` (order of a message's events), ``kind``, ``role``, ``text``;
    other columns are ignored, and nulls are keys like others and come first. Kinds:
    ``open`` starts a message with its role, empty but for ``text`` (a second one starts it anew); ``delta`` appends;
    ``edit`` replaces the text; ``regenerate`` drops it, deltas that follow give the new one, and a
    role replaces the old; ``delete`` removes the message. Events of a message that isn't open and of other kinds do
    nothing. Events with the same ``seq`` apply in the order of ``KINDS``, then of their texts; equal ones count once, as logs are delivered
    at least once, but with ``each`` a message opened n times by equal events is n messages.

    Columns: ``conv_id``, ``turn`` and ``message`` of the part's first message, ``part`` (with
    them orders the parts of a conversation), ``n_turns``, ``text``, ``loss`` (starts and ends, in
    characters, of texts that count). Memory of a task: one part or message, and a batch.
    """
    template = template or Template()
    known = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    log = log.select(*LOG).where(F.col("kind").isin(*KINDS))
    dealt = log.repartitionByRange("conv_id", "turn", "message")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "message", "seq", known, "role", "text")
    keys = [T.StructField(c, log.schema[c].dataType) for c in LOG[:3]]
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    rest = [("part", T.LongType()), ("n_turns", T.LongType()), ("text", T.StringType()), ("loss", spans)]
    schema = T.StructType(keys + [T.StructField(n, t) for n, t in rest])
    names = schema.names

    def format_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        first, rows, held = None, [], 0

        def batch() -> pa.RecordBatch:
            kinds = [*(first.schema.field(c).type for c in LOG[:3]), *types]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal first
            for b in batches:
                first = first or b
                yield b

        for one in _parts(seen(batches), template, part, each):
            rows.append(one.row())
            held += one.size
            if held >= 4 * part or len(rows) >= 1000:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    return ordered.mapInArrow(format_partition, schema)


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What the rendered parts of each conversation say: ``n_turns``, digests, ``loss_chars``, ``formatted_chars``.

    ``turns_sha256`` is of role, \\n, text, \\n of every turn; ``loss_sha256`` and ``loss_chars``
    are of the text under the loss mask, unescaped. A digest of a whole conversation takes its parts one
    after the other, a part in memory at a time.
    """
    template = template or Template()
    id_type = formatted.schema["conv_id"].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, kind, state = None, None, None

        def finish() -> None:
            if state is not None:
                turns, loss, n, loss_chars, chars = state
                out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for one, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss")), strict=True):
                if state is None or one != conv:
                    finish()
                    conv, state = one, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, said in template.parse(text):
                    state[0].update(f"{role}\n{said}\n".encode())
                    state[2] += 1
                for span in spans:
                    said = template.unescape(text[span["start"] : span["end"]])
                    state[1].update(said.encode())
                    state[3] += len(said)
                state[4] += len(text)
            if len(out) >= 1000:
                yield table(out, kind)
                out.clear()
        finish()
        if out:
            yield table(out, kind)

    def table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=schema.names)

    names = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]
    schema = T.StructType([T.StructField("conv_id", id_type)] + [T.StructField(n, t) for n, t in names])
    order = ["conv_id", "turn", "message", "part"]
    dealt = formatted.select(*order, "text", "loss").repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(read, schema)
