"""Packing of documents into token sequences, online and in bounded space.

Every task encodes its documents one after another, ends each with the id ``END`` and cuts off pieces of a whole sequence; they are
sequences of their own. What remains of a document goes into one of at most ``OPEN`` open windows: the one that it fills best. When it
fits none and all windows are open, the fullest is given out and a new one opened. The windows still open at the end of a task are
merged: their pieces are packed again, largest first, the windows of about ``FAN_IN`` tasks in one, round after round, until one task is
left, which cuts its last pieces so that all sequences but one are full. Each task of a round holds a bounded number of windows,
whatever the size of the corpus.

A sequence is padded to its full length, except at a power of two.

Defined cases: a null or empty text is the end id alone; a document of any length is cut; repeated rows and doc_ids are packed like any
others, null doc_ids too; further columns are not kept; an empty table gives no piece. The sequence ids of different runs differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from patronlens.llm.bytewords import slices_by_bytes
from patronlens.llm.tokens import Encoder
from patronlens.shared import new_path

LENGTH = 1024
OPEN = 64
FAN_IN = 16
END = 0
SLICE_BYTES = 1 << 20
PIECES = "start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
_NAMES = ("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")


class Windows:
    """At most ``most`` open sequences of up to ``length`` tokens; a piece is (length, whatever the caller needs)."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.used: list[int] = []
        self.pieces: list[list] = []

    def place(self, size: int, piece: object) -> list | None:
        """Place a piece where it leaves least room; the pieces of the window that had to be given out for it, if one had."""
        best = -1
        for i, used in enumerate(self.used):
            if used + size <= self.length and (best < 0 or used > self.used[best]):
                best = i
        if best >= 0:
            self.used[best] += size
            self.pieces[best].append(piece)
            return self.take(best) if self.used[best] == self.length else None
        given = self.take(max(range(len(self.used)), key=self.used.__getitem__)) if len(self.used) >= self.most else None
        self.used.append(size)
        self.pieces.append([piece])
        return given

    def take(self, i: int) -> list:
        given = self.pieces[i]
        self.used[i], self.pieces[i] = self.used[-1], self.pieces[-1]
        self.used.pop()
        self.pieces.pop()
        return given


class Sequences:
    """Numbers sequences and collects their pieces as columns. ``prefix`` keeps the numbers of tasks and rounds apart."""

    def __init__(self, prefix: int):
        self.next = prefix << 40
        self.rows: list[tuple] = []

    def add(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, size, total, ids in pieces:
            self.rows.append((doc_id, start, size, total, ids, self.next, offset))
            offset += size
        self.next += 1

    def batch(self, doc_id: pa.DataType, is_open: bool) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in _NAMES]
        long = pa.int64()
        kinds = (doc_id, long, long, long, pa.binary(), long, long)
        arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds)]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(np.full(len(arrays[0]), is_open))], names=[*_NAMES, "open"]
        )


def filled_up(windows: list[list[tuple]], length: int) -> Iterator[list[tuple]]:
    """The pieces of the last windows, one after another and cut where a sequence is full: at most the last is not."""
    own, room = [], length
    for doc_id, start, size, total, ids in (piece for pieces in windows for piece in pieces):
        while size:
            part = min(size, room)
            own.append((doc_id, start, part, total, ids[: 4 * part]))
            start, size, room, ids = start + part, size - part, room - part, ids[4 * part :]
            if room == 0:
                yield own
                own, room = [], length
    if own:
        yield own


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit numbers), sequence_id, offset."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, {PIECES}, open boolean"
    end = np.array([END], dtype="<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, opened = Encoder(tokenizer), Windows(length, windows)
        sequences, doc_type = Sequences(TaskContext.get().partitionId()), None
        for batch in slices_by_bytes(batches, 1, SLICE_BYTES):
            doc_type = batch.column(0).type
            texts = batch.column(1).fill_null("").to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                total = len(ids) // 4
                whole = total // length * length
                for start in range(0, whole, length):
                    sequences.add([(doc_id, start, length, total, ids[4 * start : 4 * (start + length)])])
                if whole < total:
                    rest = (doc_id, whole, total - whole, total, ids[4 * whole :])
                    if given := opened.place(total - whole, rest):
                        sequences.add(given)
            yield sequences.batch(doc_type, False)
        if doc_type is not None:
            for pieces in opened.pieces:
                sequences.add(pieces)
            yield sequences.batch(doc_type, True)

    def again(level: int, last: bool):
        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened = Windows(length, windows)
            sequences = Sequences((level << 20) + TaskContext.get().partitionId())
            pieces: list[tuple] = []  # of a bounded number of windows
            for batch in batches:
                doc_type = batch.column(0).type
                pieces += zip(*(batch.column(i).to_pylist() for i in range(5)))
            if not pieces:
                return
            for piece in sorted(pieces, key=lambda piece: -piece[2]):
                if given := opened.place(piece[2], piece):
                    sequences.add(given)
            yield sequences.batch(doc_type, False)
            for pieces in filled_up(opened.pieces, length) if last else opened.pieces:
                sequences.add(pieces)
            yield sequences.batch(doc_type, not last)

        return merge

    packed, tables, level = docs.select("doc_id", "text").mapInArrow(first, schema), [], 0
    while True:
        tables.append(new_path(spark, f"packed-{level}"))
        packed.write.option("compression", "zstd").parquet(tables[-1])
        left = spark.read.schema(schema).parquet(tables[-1]).where("open")
        remaining = left.select("sequence_id").distinct().count()
        if remaining == 0:
            break
        level, tasks = level + 1, -(-remaining // (FAN_IN * windows))
        packed = left.select(*_NAMES).repartition(tasks).mapInArrow(again(level, tasks == 1), schema)
    return spark.read.schema(schema).parquet(*tables).where("NOT open").select(*_NAMES)
