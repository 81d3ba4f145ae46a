"""Chat formatting: token-level assembly.

Each turn's role and text are encoded by themselves and spliced between three reserved ids, the first that the
vocabulary doesn't use: ``HEAD role BODY text END``. The loss mask comes from marks at the segments' borders, +1
where an assistant's text begins and -1 where it ends, by a prefix sum. The written form of a turn is
``### role: text\\n</turn>\\n``. Where a text holds one of the template's control strings (``### `` or
``</turn>``) with n backslashes before it, one more is put before; that is undone by taking one away.
In a role, backslashes, colons and line ends get a backslash.

A conversation's rows stay rows: one per turn, in parallel, and no task needs a whole conversation to
format it. Readers go through them by conversation and turn as a stream.

Nulls: a null text or role is empty, a null turn comes first, and rows with a null conversation id are
a conversation. Turns with equal numbers are ordered by role, then by tokens; repeated rows are turns
of their own. An empty table gives an empty one. Other columns aren't read. A turn of any length is encoded as a
whole: its task holds its text, its ids and the vocabulary (one file of ranks, whatever its number of ids; ids beyond 16
bits go by four bytes in a shuffle instead of two).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark.llm.common import col, map_arrow, ship, slices
from meadowlark.llm.tokens import PLAIN, encoder, first_free, ranks_file

LEARNED = "assistant"
_CONTROL = re.compile(r"(\\*)(### |</turn>)")
_ESCAPED = re.compile(r"\\(\\*)(### |</turn>)")
FORMATTED = "conv_id long, turn long, role string, ids array<int>, loss array<byte>"


def reserved(vocabulary: bytes) -> tuple[int, int, int]:
    """HEAD, BODY and END: ids that no text can encode to."""
    free = first_free(vocabulary)
    return free, free + 1, free + 2


def width_of(vocabulary: bytes) -> str:
    """How an id is written in a shuffle: big-endian, so that bytes sort as ids do."""
    return ">u2" if reserved(vocabulary)[-1] < 1 << 16 else ">u4"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return re.sub(r"([\\:\n])", r"\\\1", role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\:\n])", r"\1", role)


def written(role: str, text: str) -> str:
    """The written form of a turn whose role and text are escaped."""
    return f"### {role}: {text}\n</turn>\n"


def format_turns(turns: DataFrame, vocabulary: bytes | None = None, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, ``ids`` and ``loss`` (1 where the loss counts)."""
    ship(turns.sparkSession)
    vocabulary = vocabulary or ranks_file(name=PLAIN)
    sent, (head, body, end) = turns.sparkSession.sparkContext.broadcast(vocabulary), reserved(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_ordinary
        for batch in batches:
            for part in slices(batch, 1 << 20):
                ids: list[int] = []
                marks: list[tuple[int, int]] = []
                ends = [0]
                for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    ids += [head, *encode(escape_role(r or "")), body]
                    begin = len(ids)
                    ids += encode(escape(t or ""))
                    if r == LEARNED:
                        marks += [(begin, 1), (len(ids), -1)]
                    ids.append(end)
                    ends.append(len(ids))
                change = np.zeros(len(ids) + 1, np.int8)
                for at, by in marks:
                    change[at] += by
                loss = np.cumsum(change[:-1], dtype=np.int8)
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(loss, pa.int8()))], ["conv_id", "turn", "role", "ids", "loss"])

    rows = turns.select(col(conv_id).cast("long").alias("conv_id"), col(turn).cast("long").alias("turn"), col(role).alias("role"), col(text).alias("text"))
    return map_arrow(rows, run, FORMATTED)


def packed(width: str):
    """What turns rows (conv_id, turn, role, ids, loss) into ones with both lists as bytes for a shuffle: an id by ``width``
    and a bit a mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, loss = batch.column(3), batch.column(4)
            as_bytes = [ids[i].values.to_numpy().astype(width).tobytes() for i in range(batch.num_rows)]
            as_bits = [np.packbits(loss[i].values.to_numpy().view(np.uint8)).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(as_bytes, pa.binary()), pa.array(as_bits, pa.binary())], ["conv_id", "turn", "role", "ids", "loss"])

    return run


def read_back(formatted: DataFrame, vocabulary: bytes | None = None) -> DataFrame:
    """One row per conversation, from its tokens alone: the digests of the turns and of what is under
    the loss mask, and the length of the written form. Turns pass one by one, so a conversation of any
    length needs no more memory than its longest turn."""
    ship(formatted.sparkSession)
    vocabulary = vocabulary or ranks_file(name=PLAIN)
    sent, middle, width = formatted.sparkSession.sparkContext.broadcast(vocabulary), reserved(vocabulary)[1], width_of(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(sent.value).decode_bytes
        string = lambda ids: decode(ids).decode("utf-8", "surrogatepass")
        key, state, done = None, None, []

        def closed():
            n, turns, learned, chars, length = state
            return key, n, turns.hexdigest(), chars, learned.hexdigest(), length

        for batch in batches:
            for part in slices(batch, 1 << 20):
                for conv, raw, bits in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if state is None or conv != key:
                        done += [closed()] if state else []
                        key, state = conv, (0, hashlib.sha256(), hashlib.sha256(), 0, 0)
                    own = np.frombuffer(raw, width)
                    mask = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own))
                    body = int(np.flatnonzero(own == middle)[0])
                    role, text = string(own[1:body].tolist()), string(own[body + 1 : -1].tolist())
                    learned = unescape(string(own[mask == 1].tolist()))
                    n, a, b, chars, length = state
                    a.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                    b.update(learned.encode("utf-8", "surrogatepass"))
                    state = n + 1, a, b, chars + len(learned), length + len(written(role, text))
                if done:
                    yield batch_of(done)
                    done = []
        if state:
            yield batch_of([closed()])

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    small = map_arrow(formatted.select("conv_id", "turn", "role", "ids", "loss"), packed(width), "conv_id long, turn long, role string, ids binary, loss binary")
    ordered = small.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids").select("conv_id", "ids", "loss")
    return map_arrow(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digest(turns: DataFrame) -> DataFrame:
    """The query's rows: all conversations and number -7, whose texts hold control strings."""
    said = r"\### Assistant: </turn> ok"
    extra = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    return read_back(format_turns(rows))
