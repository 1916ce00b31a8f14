"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens it: text is escaped, every
attachment becomes a numbered placeholder and is recorded with its reference, its place and the number of tokens
its placeholder stands for. Turns are formatted where they lie; then the turns of a conversation are brought together
in order and streamed, so a long conversation is never held in memory: it comes out in chunks.

Template: ``<turn ROLE>BODY</turn>`` and a line break, placeholders ``<|KIND NUMBER|>``. In roles and texts a backslash and
both angle brackets are escaped, so no control string can occur in them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,at:bigint,tokens:bigint>"
SPAN = "struct<begin:bigint,end:bigint>"
CHUNK = 1 << 20  # code points of a chunk, unless a single turn is longer

ESCAPES = {"\\": "\\\\", "<": "\\(", ">": "\\)"}
PLAIN = {v: k for k, v in ESCAPES.items()}
CONTROL = re.compile(r"[\\<>]")
ESCAPED = re.compile(r"\\[\\()]")
TURN = re.compile(r"<turn ([^<>]*)>(.*?)</turn>\n", re.DOTALL)
MARK = re.compile(r"<\|[^<>]*\|>")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: ESCAPES[m.group()], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: PLAIN[m.group()], text)


@dataclass(frozen=True)
class Costs:
    """Tokens that a placeholder stands for: per square patch of an image, per second, per page."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 256


@dataclass
class Flattener:
    """Visits the parts of one turn in order. ``learn``: its text counts for the loss."""

    costs: Costs
    learn: bool
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        begin = self.length
        self.add(escape(part["text"] or ""))
        if self.learn and self.length > begin:
            self.loss.append({"begin": begin, "end": self.length})

    def visit_image(self, part: dict) -> None:
        patches = [math.ceil(max(0, part[side] or 0) / self.costs.patch) for side in ("width", "height")]
        self.attach(part, "image", patches[0] * patches[1])

    def visit_audio(self, part: dict) -> None:
        self.attach(part, "audio", math.ceil(max(0.0, part["seconds"] or 0.0) * self.costs.per_second))

    def visit_document(self, part: dict) -> None:
        self.attach(part, "document", max(0, part["pages"] or 0) * self.costs.per_page)

    def visit_other(self, part: dict) -> None:
        self.attach(part, "other", 0)

    def attach(self, part: dict, kind: str, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.length, "tokens": tokens})
        self.add(f"<|{kind} {len(self.attachments)}|>")


def text_part(text: Column) -> Column:
    """Content of one text part, for tables with a plain text column."""
    values = {"kind": F.lit("text"), "text": text.cast("string")}
    fields = T._parse_datatype_string(PART).fields
    return F.array(F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)))


def format_turns(
    turns: DataFrame,
    conversation: str,
    turn: str,
    role: str,
    parts: str,
    learned: tuple[str, ...] = ("assistant",),
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per turn, in place: ``conversation``, ``turn``, ``piece``, ``loss`` (spans of code points in the piece),
    ``attachments`` (numbered within the turn; ``at``: place in the piece).

    ``parts`` is an array of ``PART``. Null roles, contents and texts count as empty; a null kind is text, an unknown one is
    an attachment of kind ``other``. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for who, content in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist()):
                flat = Flattener(costs, who in learned)
                flat.add(f"<turn {escape(who or '')}>")
                for part in content or []:
                    if part is not None:
                        flat.visit(part)
                flat.add("</turn>\n")
                found.append(flat)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conversation"),
                    batch.column("turn"),
                    pa.array(["".join(x.pieces) for x in found], pa.string()),
                    pa.array([x.loss for x in found], pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()}))),
                    pa.array([x.attachments for x in found], pa.list_(ATTACHED)),
                ],
                names=["conversation", "turn", "piece", "loss", "attachments"],
            )

    rows = turns.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(parts).cast(f"array<{PART}>").alias("parts"),
    )
    schema = T.StructType(
        [
            rows.schema["conversation"],
            rows.schema["turn"],
            *T._parse_datatype_string(f"piece string, loss array<{SPAN}>, attachments array<{ATTACHMENT}>").fields,
        ]
    )
    return rows.mapInArrow(run, schema)


ATTACHED = pa.struct({"kind": pa.string(), "ref": pa.string(), "at": pa.int64(), "tokens": pa.int64()})


def assemble(pieces: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Conversations from the rows of ``format_turns``, as chunks of whole turns in order: ``conversation``, ``number`` (of the
    chunk, from 0), ``begin`` (code points before it), ``turns``, ``text``, ``loss`` and ``attachments`` with places in the
    conversation, ``tokens`` (expanded, of its attachments).

    Turns are ordered by ``turn`` (null first), equal turns by their text; repeated turns are kept. All null conversations are
    one. The chunks of a conversation follow one another in a partition. A task holds one chunk at a time, however
    long the conversation.
    """
    rows = pieces.repartition("conversation").sortWithinPartitions("conversation", "turn", "piece")
    kind = rows.schema["conversation"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([current], key_type),
                    pa.array([number], pa.int64()),
                    pa.array([begin], pa.int64()),
                    pa.array([len(held)], pa.int64()),
                    pa.array(["".join(held)]),
                    pa.array([loss], pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()}))),
                    pa.array([attached], pa.list_(ATTACHED)),
                    pa.array([sum(x["tokens"] for x in attached)], pa.int64()),
                ],
                names=["conversation", "number", "begin", "turns", "text", "loss", "attachments", "tokens"],
            )

        started, current, number, begin, size = False, None, 0, 0, 0
        held, loss, attached = [], [], []
        for batch in batches:
            key_type = batch.column("conversation").type
            columns = (batch.column(c) for c in ("conversation", "piece", "loss", "attachments"))
            for one, piece, spans, files in zip(*(c.to_pylist() for c in columns)):
                fresh = not started or one != current
                if held and (fresh or size + len(piece) > chunk):
                    yield from flush()
                    number, begin, size, held, loss, attached = number + 1, begin + size, 0, [], [], []
                if fresh:
                    started, current, number, begin = True, one, 0, 0
                at = begin + size
                loss += [{"begin": x["begin"] + at, "end": x["end"] + at} for x in spans]
                attached += [x | {"at": x["at"] + at} for x in files]
                held.append(piece)
                size += len(piece)
        if held:
            yield from flush()

    schema = T.StructType(
        [
            kind,
            *T._parse_datatype_string(
                f"number long, begin long, turns long, text string, loss array<{SPAN}>, "
                f"attachments array<{ATTACHMENT}>, tokens long"
            ).fields,
        ]
    )
    return rows.mapInArrow(run, schema)


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests read from the chunks as ``assemble`` returns them (not reordered): ``conversation``, ``n_turns``, ``turns_sha256`` (role,
    line break, text, line break, per turn), ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    The text is parsed with the template; roles and texts are unescaped and placeholders left out. What the loss
    covers is cut out of the formatted text by its spans.
    """
    names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            row = [current, turns, whole.hexdigest(), loss_chars, learned.hexdigest(), chars]
            arrays = [pa.array([row[0]], key_type)] + [pa.array([x]) for x in row[1:]]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        current, turns = None, -1
        for batch in batches:
            key_type = batch.column("conversation").type
            columns = (batch.column(c) for c in ("conversation", "number", "begin", "text", "loss"))
            for one, number, begin, text, spans in zip(*(c.to_pylist() for c in columns)):
                if number == 0:
                    if turns >= 0:
                        yield done()
                    current, turns, loss_chars, chars = one, 0, 0, 0
                    whole, learned = hashlib.sha256(), hashlib.sha256()
                for role, body in TURN.findall(text):
                    turns += 1
                    whole.update(f"{unescape(role)}\n{unescape(MARK.sub('', body))}\n".encode())
                for span in spans:
                    part = unescape(text[span["begin"] - begin : span["end"] - begin])
                    loss_chars += len(part)
                    learned.update(part.encode())
                chars += len(text)
        if turns >= 0:
            yield done()

    kind = chunks.schema["conversation"]
    schema = T.StructType(
        [
            kind,
            *T._parse_datatype_string(
                "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
            ).fields,
        ]
    )
    return chunks.select("conversation", "number", "begin", "text", "loss").mapInArrow(run, schema)
