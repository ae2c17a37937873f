"""Chat formatting with a loss mask (operator 10).

Turns are assembled by columns: for a slice of turns numpy computes the length
of every header, content and footer, their offsets in the result and scatter
indices, and copies all bytes into one preallocated buffer that becomes an
Arrow string column without another copy.

Template.  A turn is ``<|role|>\\n`` + text + ``</s>\\n``.  Control strings
start with ``<|`` or ``</``.  Inside a text, every ``<``, followed by any
number of backslashes, followed by ``|`` or ``/``, gets one more backslash
before that last character, so neither control string can occur; taking one
backslash away undoes it exactly.  In a role, ``%``, ``<``, ``>``, ``|`` and
the newline are written as ``%`` and two hex digits.

Conversations are shuffled by id and sorted by turn inside a partition (an
external sort), and then streamed: a task holds one slice and at most
``part_bytes`` of an unfinished conversation.  A longer conversation leaves in
several parts cut between turns, so a conversation of any length needs bounded
memory.

Defined cases: a null text is empty; a null role is the empty role; rows with
a null id are one conversation; turns that tie are ordered by role, then text
(nulls first); repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

FOOTER = b"</s>\n"
MASK = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ROLE_SPECIAL = re.compile(r"[%<>|\n]")


def role_header(role: str | None) -> bytes:
    return b"<|" + _ROLE_SPECIAL.sub(lambda m: f"%{ord(m[0]):02X}", role or "").encode() + b"|>\n"


def read_role(header: bytes) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), header.decode())


def unescape(text: bytes) -> bytes:
    return re.sub(rb"<(\\*)\\([|/])", rb"<\1\2", text)


def _escapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of ``|`` and ``/`` that need a backslash before them."""
    at = np.flatnonzero((data == 0x7C) | (data == 0x2F))
    if not len(at):
        return at
    plain = np.maximum.accumulate(np.where(data != 0x5C, np.arange(len(data)), -1))
    before = np.where(at > 0, plain[np.maximum(at - 1, 0)], -1)
    first = offsets[np.searchsorted(offsets, at, side="right") - 1]  # of the text that holds it
    return at[(before >= first) & (data[np.maximum(before, 0)] == 0x3C)]


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after another."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def assemble(roles: list[str | None], texts: pa.Array):
    """Bytes of all turns, the start of each turn and of its content, and the
    content's end; one preallocated buffer."""
    data, off = C.text_buffers(texts)
    esc = _escapes(data, off)
    row_of = np.searchsorted(off, esc, side="right") - 1
    extra = np.bincount(row_of, minlength=len(off) - 1)
    body = np.diff(off) + extra
    kinds = {r: i for i, r in enumerate(dict.fromkeys(roles))}
    heads = [role_header(r) for r in kinds]
    head_at = np.cumsum([0, *map(len, heads)])
    kind = np.array([kinds[r] for r in roles], np.int64)
    head = np.diff(head_at)[kind]
    total = head + body + len(FOOTER)
    start = np.concatenate([[0], np.cumsum(total)])
    content = start[:-1] + head
    out = np.empty(int(start[-1]), np.uint8)
    out[_runs(start[:-1], head)] = np.frombuffer(b"".join(heads), np.uint8)[_runs(head_at[:-1][kind], head)]
    # a byte moves by its text's shift and by the backslashes up to it
    pushed = np.zeros(len(data), np.int64)
    pushed[esc] = 1
    pushed = np.cumsum(pushed)
    earlier = np.cumsum(extra) - extra
    target = np.repeat(content - off[:-1] - earlier, np.diff(off)) + np.arange(len(data)) + pushed
    out[target] = data
    out[target[esc] - 1] = 0x5C
    out[(content + body)[:, None] + np.arange(len(FOOTER))] = np.frombuffer(FOOTER, np.uint8)
    return out, start, content, content + body


def _emit(rows: pa.Table, first_part: int, learn: frozenset[str]) -> pa.RecordBatch:
    """One output row for each run of rows with the same id."""
    ids, roles = rows.column(0).combine_chunks(), rows.column(1).to_pylist()
    learned = np.array([r in learn for r in roles], bool)
    out, start, content, end = assemble(roles, rows.column(2).combine_chunks())
    cuts = _id_cuts(ids)
    points = C.code_points(out)
    base = np.repeat(points[start[cuts[:-1]]], np.diff(cuts))
    spans = pa.StructArray.from_arrays([pa.array((points[content] - base)[learned]), pa.array((points[end] - base)[learned])], ["start", "end"])
    n_learned = np.concatenate([[0], np.cumsum(learned)])
    mask = pa.ListArray.from_arrays(pa.array(n_learned[cuts].astype(np.int32)), spans)
    part = np.zeros(len(cuts) - 1, np.int64)
    if len(part):
        part[0] = first_part
    return pa.RecordBatch.from_arrays([ids.take(pa.array(cuts[:-1])), pa.array(part), pa.array(np.diff(cuts)),
                                       C.string_array(out, start[cuts]), mask], names=["id", "part", "n_turns", "formatted", "loss_mask"])


def _id_cuts(ids: pa.Array) -> np.ndarray:
    """Positions at which a new id begins, and the end."""
    if len(ids) < 2:
        return np.array([0, len(ids)]) if len(ids) else np.zeros(1, np.int64)
    a, b = ids.slice(0, len(ids) - 1), ids.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[0], np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1, [len(ids)]])


def _format(learn: frozenset[str], part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, last_id = None, 0, object()
        for batch in batches:
            for piece in C.byte_slices(batch, "text", min(C.SLICE_BYTES, part_bytes)):
                piece = pa.Table.from_batches([piece])
                rows = pa.concat_tables([held, piece]) if held is not None else piece
                cut = int(_id_cuts(rows.column(0).combine_chunks())[-2])
                if cut == 0 and rows.nbytes >= part_bytes:
                    cut = rows.num_rows  # a conversation over the limit: its turns so far leave as a part
                if cut:
                    first, end_id = rows.column(0)[0].as_py(), rows.column(0)[cut - 1].as_py()
                    part = part + 1 if first == last_id else 0
                    done = _emit(rows.slice(0, cut), part, learn)
                    part = part if done.num_rows == 1 else 0
                    last_id = end_id
                    yield done
                held = rows.slice(cut) if cut < rows.num_rows else None
        if held is not None:
            yield _emit(held, part + 1 if held.column(0)[0].as_py() == last_id else 0, learn)
    return run


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learn: tuple[str, ...] = ("assistant",), part_bytes: int = 16 << 20) -> DataFrame:
    """(id, part, n_turns, formatted, loss_mask) in the order of id and part
    within each partition.  ``loss_mask`` lists the spans of ``formatted``, in
    code points, that hold the texts of the roles in ``learn``."""
    C.prepared(turns.sparkSession)
    rows = turns.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"),
                        F.col(f"`{turn_col}`").alias("turn"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    schema = T.StructType([T.StructField("id", turns.schema[id_col].dataType), T.StructField("part", T.LongType()), T.StructField("n_turns", T.LongType()),
                           T.StructField("formatted", T.StringType()), T.StructField("loss_mask", MASK)])
    return ordered.mapInArrow(_format(frozenset(learn), part_bytes), schema).withColumnRenamed("id", id_col)


_TURN = re.compile(rb"<\|([^|]*)\|>\n(.*?)</s>\n", re.S)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the parts of each conversation; a running hash needs no whole conversation."""
    def row(state):
        return pa.RecordBatch.from_arrays([pa.array([state["id"]], id_type)] + [pa.array([v]) for v in (
            state["n"], state["all"].hexdigest(), state["loss"], state["learned"].hexdigest(), state["chars"])],
            names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    state, id_type = None, None
    for batch in batches:
        id_type = batch.column(0).type
        for conv, part, formatted, mask in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
            if state is None or part == 0:
                if state is not None:
                    yield row(state)
                state = {"id": conv, "n": 0, "all": hashlib.sha256(), "loss": 0, "learned": hashlib.sha256(), "chars": 0}
            for m in _TURN.finditer(formatted.encode()):
                state["n"] += 1
                state["all"].update(read_role(m[1]).encode() + b"\n" + unescape(m[2]) + b"\n")
            for span in mask:
                text = unescape(formatted[span["start"]:span["end"]].encode())
                state["loss"] += len(text.decode())
                state["learned"].update(text)
            state["chars"] += len(formatted)
    if state is not None:
        yield row(state)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted conversations hold, decoded from
    ``formatted`` and ``loss_mask`` alone; takes ``format_conversations``'s
    result as it is (parts in order)."""
    kind = formatted.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    return formatted.mapInArrow(_digests, schema).withColumnRenamed("id", id_col)
