"""Token ids on disk, bit-packed at a fixed width.

An id takes the least bits that hold every id of the vocabulary. Ids are stored in ascending order of `doc_id`, in blocks
of whole documents; a block is a row of a Parquet table, which any store Spark can read may hold:

* `shard`, `block`: place in the order; `first`: ids before the block in its shard; `n_ids`, `bits`;
* `doc_ids`, `doc_starts`: its documents and where each begins in the block;
* `payload`: id `i` in bits `i * bits` to `(i + 1) * bits`, counted from the lowest bit of the first byte.

As the width is fixed, any range of ids is found without reading what comes before it (`unpack` with `start`, `stop`),
and a block is unpacked by a handful of numpy operations.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.encoding import encoder
from sensorloom.llm.frames import stored, text_of

BLOCK = 1 << 16
MAX_BITS = 32


def bits_for(vocabulary: int) -> int:
    """Bits that hold the ids 0 to `vocabulary - 1`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids at a time: they fill `bits` bytes."""
    rows = -(-len(ids) // 8)
    padded = np.zeros(8 * rows, np.uint64)
    padded[: len(ids)] = ids
    padded = padded.reshape(rows, 8)
    out = np.zeros((rows, bits + 8), np.uint8)
    for i in range(8):
        byte, shift = divmod(i * bits, 8)
        moved = padded[:, i] << np.uint64(shift)
        for k in range((bits + shift + 7) // 8):
            out[:, byte + k] |= (moved >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()[: -(-len(ids) * bits // 8)]


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids `start` to `stop` as 32-bit integers."""
    first, last = start * bits // 8, -(-stop * bits // 8)
    padded = payload[first:last] + bytes(8)
    windows = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at = np.arange(start, stop, dtype=np.int64) * bits - 8 * first
    ids = (windows[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)
    return ids.astype("<u4")


def token_blocks(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The blocks of all documents, to be written as they are.

    A null text is empty: its document is the `end_id` alone. Null identifiers come first; repeated rows are stored as
    often as they occur; other columns are ignored; an empty table gives no block. A document longer than a block makes a
    block of its own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    sorted_rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, block int, first bigint, n_ids int, bits int, doc_ids array<{kind}>, doc_starts array<int>, payload binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = encoder(tokenizer)
        bits, ending = bits_for(max(source.size, end_id + 1)), end_id.to_bytes(4, "little")
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, starts, parts, size, like = [], [], [], 0, None

        def row():
            nonlocal number, first, doc_ids, starts, parts, size
            values = (shard, number, first, size, bits)
            arrays = [pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
            arrays += [pa.array([doc_ids], pa.list_(like)), pa.array([starts], pa.list_(pa.int32()))]
            arrays.append(pa.array([pack(np.frombuffer(b"".join(parts), "<u4"), bits)], pa.binary()))
            number, first = number + 1, first + size
            doc_ids, starts, parts, size = [], [], [], 0
            names = ["shard", "block", "first", "n_ids", "bits", "doc_ids", "doc_starts", "payload"]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            like = batch.schema.field("doc_id").type
            texts = source.encode(text.as_py() for text in batch.column("text"))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), texts):
                ids += ending
                if size and size + len(ids) // 4 > block:
                    yield row()
                doc_ids.append(doc)
                starts.append(size)
                parts.append(ids)
                size += len(ids) // 4
        if size:
            yield row()

    return sorted_rows.mapInArrow(blocks, schema)


def documents_of(blocks: DataFrame) -> DataFrame:
    """Per stored document: `doc_id`, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`."""
    # One row per shard, so per task that wrote: a running sum over those is small.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = blocks.join(F.broadcast(shards.select("shard", before.alias("before"))), "shard")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                ids = memoryview(unpack(row["payload"], row["bits"], 0, row["n_ids"]).tobytes())
                edges = np.array([*row["doc_starts"], row["n_ids"]], np.int64)
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:])]
                arrays = [
                    pa.array(row["doc_ids"], like),
                    pa.array(edges[:-1] + (row["before"] + row["first"])),
                    pa.array(np.diff(edges)),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    columns = ("before", "first", "n_ids", "bits", "doc_ids", "doc_starts", "payload")
    return placed.select(*columns).mapInArrow(read, schema)


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Round trip: the blocks written to the shared folder, and the documents as read back from there."""
    return documents_of(stored(token_blocks(docs, tokenizer, end_id)))
