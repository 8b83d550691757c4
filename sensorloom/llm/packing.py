"""Cost-balanced packing of documents into sequences of bounded length.

Attention makes the cost of a piece of `n` tokens linear plus quadratic in `n`. A document is first cut into whole
sequences, as far as it goes; what is left of each document waits in a pool. When the pool is full (a bound on memory,
in tokens), as many sequences are opened as its tokens need, and the pieces are dealt out in descending order, each to
the sequence of the lowest cost so far among those with room for it. A piece that fits nowhere is cut to fill the
emptiest sequence. So a pool pads by less than one sequence in all.

Each task packs what it reads: no shuffle, and no state beyond a pool.
"""

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorloom.llm.encoding import encoder
from sensorloom.llm.frames import text_of

LENGTH = 1024
POOL = 1 << 21
# Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1 / 1024

_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Room:
    """Open sequences by the room they have left, and among those with room enough the one of the lowest cost."""

    def __init__(self, count: int, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.heaps: list[list] = [[] for _ in range(self.size)]
        self.best: list = [None] * (2 * self.size)
        self.rooms = [length] * count
        self.heaps[length] = [(0.0, i) for i in range(count)]
        self._update(length)

    def _update(self, room: int) -> None:
        at = room + self.size
        self.best[at] = self.heaps[room][0] if self.heaps[room] else None
        while at > 1:
            at //= 2
            a, b = self.best[2 * at], self.best[2 * at + 1]
            self.best[at] = _lower(a, b)

    def cheapest(self, least: int) -> tuple[int, int, float] | None:
        """Takes out a sequence with that much room: its room, number and cost."""
        low, high, found = least + self.size, 2 * self.size, None
        while low < high:
            if low % 2:
                found = _lower(found, self.best[low])
                low += 1
            if high % 2:
                high -= 1
                found = _lower(found, self.best[high])
            low, high = low // 2, high // 2
        return self._take(found)

    def emptiest(self) -> tuple[int, int, float]:
        at = 1
        while at < self.size:
            at = 2 * at + (self.best[2 * at + 1] is not None)
        return self._take(self.best[at], at - self.size)

    def _take(self, entry, room: int | None = None):
        if entry is None:
            return None
        room = self.rooms[entry[1]] if room is None else room
        heapq.heappop(self.heaps[room])
        self._update(room)
        return room, entry[1], entry[0]

    def put(self, number: int, room: int, cost: float) -> None:
        self.rooms[number] = room
        if room:
            heapq.heappush(self.heaps[room], (cost, number))
            self._update(room)


def _lower(a: tuple | None, b: tuple | None) -> tuple | None:
    return b if a is None or (b is not None and b < a) else a


def deal(sizes: list[int], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in it, tokens). `sizes` are tokens per piece, below `length` each."""
    count = -(-sum(sizes) // length)
    room = Room(count, length)
    sequences: list[list] = [[] for _ in range(count)]
    waiting = [(-size, i, 0) for i, size in enumerate(sizes) if size]
    heapq.heapify(waiting)
    while waiting:
        size, piece, start = heapq.heappop(waiting)
        size = -size
        left, number, cost = room.cheapest(size) or room.emptiest()
        taken = min(size, left)
        sequences[number].append((piece, start, taken))
        room.put(number, left - taken, cost + LINEAR * taken + QUADRATIC * taken * taken)
        if taken < size:
            heapq.heappush(waiting, (taken - size, piece, start + taken))
    return sequences


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    length: int = LENGTH,
    pool: int = POOL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: `doc_id`, `start` and `length` of the piece among its document's ids, `ids_crc32` of its ids,
    `doc_tokens`, and `sequence_id` and `offset`, its place. A document's ids are the text's and then `end_id`.

    A null text is empty, so its document is one `end_id`; a null identifier is carried; repeated rows are documents of
    their own; other columns are ignored; an empty table gives an empty result. Sequence ids hold the number of the task
    and are unique, not consecutive.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], *(StructField(c, LongType()) for c in _COLUMNS)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ending = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        number = TaskContext.get().partitionId() << 33
        out: list[list] = [[] for _ in range(7)]
        rest: list[tuple] = []  # identifier, start, ids, tokens of the document
        waiting = 0

        def put(doc, start, ids, tokens, sequence, offset):
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), tokens, sequence, offset)
            for column, value in zip(out, row):
                column.append(value)

        def emptied():
            nonlocal number, rest, waiting
            for sequence in deal([len(ids) // 4 for _, _, ids, _ in rest], length):
                offset = 0
                for piece, start, taken in sequence:
                    doc, before, ids, tokens = rest[piece]
                    put(doc, before + start, ids[4 * start : 4 * (start + taken)], tokens, number, offset)
                    offset += taken
                number += 1
            rest, waiting = [], 0

        def batch(like: pa.DataType):
            arrays = [pa.array(out[0], like), *(pa.array(np.array(c, np.int64)) for c in out[1:])]
            for column in out:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_COLUMNS])

        kind = None
        for rows_in in batches:
            kind = rows_in.schema.field("doc_id").type
            texts = encode(text.as_py() for text in rows_in.column("text"))
            for doc, ids in zip(rows_in.column("doc_id").to_pylist(), texts):
                ids += ending
                tokens = len(ids) // 4
                whole = tokens - tokens % length
                for start in range(0, whole, length):
                    put(doc, start, ids[4 * start : 4 * (start + length)], tokens, number, 0)
                    number += 1
                if whole < tokens:
                    rest.append((doc, whole, ids[4 * whole :], tokens))
                    waiting += tokens - whole
                if waiting >= pool:
                    emptied()
            if len(out[0]) >= 10_000:
                yield batch(kind)
        emptied()
        if out[0]:
            yield batch(kind)

    return rows.mapInArrow(packed, schema)
