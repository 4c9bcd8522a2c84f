"""Packing: concatenate all documents and cut the stream into sequences.

Two passes. The first turns texts into token ids and writes them, with each document's
place inside its partition. Prefix sums over the partitions' token totals then give every
document its place in the whole stream, and the second pass cuts documents where a window
ends. Nothing is sorted or shuffled, and no token is dropped or padded but in the last
sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearbook.llm.columns import passes, texts_of
from yearbook.llm.pieces import encoder
from yearbook.session import stored

PASS_BYTES = 8 << 20
#: Up to so many partitions the prefix sums (24 bytes each) are broadcast; beyond, joined.
BROADCAST_PARTITIONS = 1_000_000

_PIECES = "id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Stored ``(id, part, at, n, ids)``: the ids of every document with ``end_id`` behind
    them (little-endian unsigned 32 bits), the partition that wrote it, and the tokens
    of that partition before it."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in passes(batches, 1, PASS_BYTES):
            counts, flat = encoder(tokenizer)(texts_of(batch, 1))
            # one end id behind each document
            flat = np.insert(flat, np.cumsum(counts), np.uint32(end_id)).astype("<u4")
            counts = counts + 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
            ids = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            part = batch.column(2)
            yield pa.RecordBatch.from_arrays([batch.column(0), part, pa.array(at + ends - counts), pa.array(counts), ids.cast(pa.binary())], names=["id", "part", "at", "n", "ids"])
            at += int(ends[-1])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(encode, f"id {kind}, part int, at bigint, n bigint, ids binary"))


def part_offsets(tokens: DataFrame) -> DataFrame:
    """``(part, base)``: the tokens of all earlier partitions. One row for each partition,
    so the window over all of them is as small as the job's own list of tasks."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces ``(id, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` are the piece's token ids, little-endian unsigned 32 bits. Pieces of a
    sequence lie end to end from offset 0; all sequences but the last are full.

    Null and empty texts are a document of the end id alone; repeated rows are documents
    of their own; an empty table gives no pieces; other columns are not read. A retried
    task writes the same rows once (Spark's commit), so places never overlap.
    """
    tokens = token_table(docs, tokenizer, end_id, id_col, text_col)
    bases = stored(part_offsets(tokens))
    if bases.count() <= BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    kind = tokens.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 3, PASS_BYTES):
            first, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            raw = batch.column(3).cast(pa.large_binary())
            starts = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            pieces = (first + n - 1) // length - first // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] // length + nth
            begin = np.maximum(first[row], sequence * length)
            size = np.minimum(first[row] + n[row], (sequence + 1) * length) - begin
            # pieces of a row are contiguous, and so are rows: the ids need no copy
            offsets = np.append(starts[:-1][row] + 4 * (begin - first[row]), starts[-1])
            ids = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int64)), raw.buffers()[2]])
            columns = [batch.column(0).take(pa.array(row)), pa.array(begin - first[row]), pa.array(size), ids.cast(pa.binary()), pa.array(n[row]), pa.array(sequence), pa.array(begin - sequence * length)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = tokens.join(bases, "part").select("id", (F.col("base") + F.col("at")).alias("first"), "n", "ids")
    return placed.mapInArrow(cut, _PIECES.format(kind=kind)).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the pieces put together. A sequence has ``length`` tokens
    at most, so a group is bounded however many documents there are. Equal pieces have
    places of their own; without pieces there are no rows."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(joined.alias("parts"))
    return grouped.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
