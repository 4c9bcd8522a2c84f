"""Token files: static range asymmetric numeral systems over interleaved blocks.

A file set is a folder of two tables.

``model``: ``(symbol, frequency)``; frequencies add up to ``2 ** SCALE_BITS``. It is
counted over all tokens and shared by every block.

``segments``: a row for some whole documents, in stream order. ``first`` is the number of
tokens before it, ``doc_ids`` and ``doc_tokens`` its documents, ``payload`` its blocks and
``blocks`` their checkpoints ``(n, at, size, crc32)``: tokens, place in the payload, bytes
and checksum. A block stands for itself: ``LANES`` 64-bit states, then the 32-bit words
that the lanes share, all little-endian. Token i of a block belongs to lane ``i % LANES``;
in each step every lane decodes one token, and lanes whose state has fallen under
``2 ** 31`` take the next words in lane order. A block is sound if its checksum holds and
all states end as ``2 ** 31``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from yearbook.llm.columns import passes, texts_of
from yearbook.llm.packing import BROADCAST_PARTITIONS, part_offsets
from yearbook.llm.pieces import encoder
from yearbook.llm.tables import drop, written

SCALE_BITS = 20
LANES = 128
BLOCK = 1 << 16
#: A segment closes at the end of the document with which it passes so many tokens.
SEGMENT = 1 << 20

_U = np.uint64
_LOW = _U(1 << 31)


class Model:
    """Frequencies of symbols 0 to n - 1, scaled to ``2 ** SCALE_BITS``."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(_U)
        self.before = np.cumsum(self.frequency) - self.frequency
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64))

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Counts as frequencies: at least 1 for each symbol that occurs, the rest in
        proportion, with what rounding leaves over on the most frequent ones."""
        room = 1 << SCALE_BITS
        if not counts.any():
            return np.zeros(len(counts), np.int64)
        seen = counts > 0
        if seen.sum() > room:
            raise ValueError(f"more than {room} symbols")
        share = (counts.astype(np.float64) * (room - seen.sum()) / counts.sum()).astype(np.int64) + seen
        share[np.argmax(counts)] += room - share.sum()
        return share


def _pack(model: Model, tokens: np.ndarray) -> list[bytes]:
    """Blocks of equal length, one in each row of ``tokens``."""
    blocks, n = tokens.shape
    steps = -(-n // LANES)
    padded = np.full((blocks, steps * LANES), np.argmax(model.frequency), np.uint32)
    padded[:, :n] = tokens
    symbols = padded.reshape(blocks, steps, LANES).transpose(1, 0, 2)
    state = np.full((blocks, LANES), _LOW, _U)
    words = np.empty((steps, blocks, LANES), np.uint32)
    spilled = np.empty((steps, blocks, LANES), bool)
    for t in range(steps - 1, -1, -1):
        f, c = model.frequency[symbols[t]], model.before[symbols[t]]
        full = state >= f << _U(63 - SCALE_BITS)
        spilled[t] = full
        words[t] = state.astype(np.uint32)
        state = np.where(full, state >> _U(32), state)
        whole, rest = np.divmod(state, f)
        state = (whole << _U(SCALE_BITS)) + rest + c
    return [state[b].astype("<u8").tobytes() + words[:, b][spilled[:, b]].astype("<u4").tobytes() for b in range(blocks)]


def _unpack(model: Model, blocks: list[bytes], n: int) -> np.ndarray:
    """The tokens of blocks that hold ``n`` each."""
    steps = -(-n // LANES)
    state = np.stack([np.frombuffer(b, "<u8", LANES) for b in blocks])
    words = np.concatenate([np.frombuffer(b, "<u4", offset=8 * LANES) for b in blocks] + [np.zeros(LANES, "<u4")])
    sizes = np.array([len(b) // 4 - 2 * LANES for b in blocks])
    at = (np.cumsum(sizes) - sizes)[:, None]
    out = np.empty((steps, len(blocks), LANES), np.uint32)
    mask = _U((1 << SCALE_BITS) - 1)
    for t in range(steps):
        slot = state & mask
        symbol = model.symbol[slot]
        out[t] = symbol
        state = model.frequency[symbol] * (state >> _U(SCALE_BITS)) + slot - model.before[symbol]
        low = state < _LOW
        taken = np.cumsum(low, axis=1)
        more = words[np.minimum(at + taken - 1, len(words) - 1)]
        state = np.where(low, state << _U(32) | more, state)
        at = at + taken[:, -1:]
    if (state != _LOW).any() or (at[:, 0] != np.cumsum(sizes)).any():
        raise ValueError("a block does not end as it should")
    return out.transpose(1, 0, 2).reshape(len(blocks), -1)[:, :n]


def encode(model: Model, tokens: np.ndarray) -> tuple[list[dict], bytes]:
    """Checkpoints and payload of one segment."""
    whole = len(tokens) // BLOCK * BLOCK
    parts: list[tuple[int, bytes]] = []
    for a in range(0, whole, 32 * BLOCK):  # so many at once, however long a document is
        some = tokens[a : min(a + 32 * BLOCK, whole)].reshape(-1, BLOCK)
        parts += [(BLOCK, b) for b in _pack(model, some)]
    if whole < len(tokens):
        parts += [(len(tokens) - whole, _pack(model, tokens[None, whole:])[0])]
    blocks, at = [], 0
    for n, raw in parts:
        blocks.append({"n": n, "at": at, "size": len(raw), "crc32": zlib.crc32(raw)})
        at += len(raw)
    return blocks, b"".join(raw for _, raw in parts)


def decode(model: Model, blocks: list[dict], payload: bytes) -> np.ndarray:
    """The tokens of some blocks; any run of a segment's checkpoints will do."""
    raw = [payload[b["at"] : b["at"] + b["size"]] for b in blocks]
    for b, own in zip(blocks, raw, strict=True):
        if zlib.crc32(own) != b["crc32"]:
            raise ValueError("a block's checksum does not hold")
    out, i = [np.zeros(0, np.uint32)], 0
    while i < len(blocks):
        j = i
        while j < min(i + 32, len(blocks)) and blocks[j]["n"] == blocks[i]["n"]:
            j += 1
        out.append(_unpack(model, raw[i:j], blocks[i]["n"]).ravel())
        i = j
    return np.concatenate(out)


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Segments with plain ids, in ascending order of ids inside and across partitions,
    and for each partition a row of its token counts (``seq`` -1). Ids of a segment take two
    bytes each where all of them fit."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("part", "seq", "at", "n")]
        + [T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("doc_tokens", T.ArrayType(T.LongType()))]
        + [T.StructField(n, T.BinaryType()) for n in ("tokens", "counts")]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, sizes, held, size, part, seq, at, counted = [], [], [], 0, 0, 0, 0, np.zeros(0, np.int64)

        def plain(tokens: np.ndarray) -> bytes:
            return tokens.astype("<u2" if tokens.max() < 1 << 16 else "<u4").tobytes()

        def row(seq: int, n: int, doc_ids: list, sizes: list, tokens: bytes, counts: bytes | None) -> pa.RecordBatch:
            values = (part, seq, at, n, doc_ids, sizes, tokens, counts)
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, values, strict=True))], schema=arrow)

        for batch in passes(batches, 1, 8 << 20):
            part = batch.column(2)[0].as_py()
            lengths, flat = encoder(tokenizer)(texts_of(batch, 1))
            flat = np.insert(flat, np.cumsum(lengths), np.uint32(end_id)).astype("<u4")
            own = np.bincount(flat, minlength=len(counted))
            own[: len(counted)] += counted
            counted = own
            ends = np.cumsum(lengths + 1)
            for doc_id, n, end in zip(batch.column(0).to_pylist(), (lengths + 1).tolist(), ends.tolist(), strict=True):
                doc_ids.append(doc_id)
                sizes.append(n)
                held.append(flat[end - n : end])
                size += n
                if size >= SEGMENT:
                    yield row(seq, size, doc_ids, sizes, plain(np.concatenate(held)), None)
                    at, seq, doc_ids, sizes, held, size = at + size, seq + 1, [], [], [], 0
        if size:
            yield row(seq, size, doc_ids, sizes, plain(np.concatenate(held)), None)
        if len(counted):
            yield row(-1, 0, [], [], b"", counted.astype("<i8").tobytes())

    # the text breaks ties, so that rows that share an id can be dealt to several tasks
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    return ordered.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, schema)


def _counts(tokenised: DataFrame) -> np.ndarray:
    """How often each symbol occurs: at most one row for each symbol reaches the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts = np.frombuffer(raw, "<i8")
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["symbol", "n"])

    totals = tokenised.where("seq = -1").select("counts").mapInArrow(each, "symbol bigint, n bigint")
    rows = totals.groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["symbol"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the file set of all ``docs`` to ``folder``, in ascending order of ids.

    Texts are shuffled once, by ranges of ids; token counts are summed over all of them;
    then every segment is coded by itself. Null and empty texts are the end id alone;
    rows without an id come first; repeated rows are documents of their own; an empty
    table gives an empty file set; other columns are not read. Spark's writers commit
    each task's rows once, also after executors are lost.
    """
    spark = docs.sparkSession
    tokenised, path = written(_tokenised(docs, tokenizer, end_id, id_col, text_col), "token-ids")
    frequency = Model.scaled(_counts(tokenised))
    seen = np.flatnonzero(frequency)
    spark.createDataFrame(list(zip(seen.tolist(), frequency[seen].tolist(), strict=True)), "symbol bigint, frequency bigint").coalesce(1).write.parquet(f"{folder}/model")
    segments = tokenised.where("seq >= 0")
    bases, bases_path = written(part_offsets(segments), "token-parts")
    if bases.count() <= BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    placed = segments.join(bases, "part").select((F.col("base") + F.col("at")).alias("first"), "n", "doc_ids", "doc_tokens", "tokens")
    kind = placed.schema["doc_ids"].dataType.simpleString()
    schema = f"first bigint, n bigint, doc_ids {kind}, doc_tokens array<bigint>, payload binary, blocks array<struct<n: bigint, at: bigint, size: bigint, crc32: bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(frequency)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                raw = row.column(4)[0].as_buffer()
                blocks, payload = encode(model, np.frombuffer(raw, "<u2" if raw.size == 2 * row.column(1)[0].as_py() else "<u4"))
                columns = [*row.columns[:4], pa.array([payload], pa.binary()), pa.array([blocks], _BLOCKS)]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "n", "doc_ids", "doc_tokens", "payload", "blocks"])

    placed.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{folder}/segments")
    drop(spark, path)
    drop(spark, bases_path)
    return folder


_BLOCKS = pa.list_(pa.struct([(n, pa.int64()) for n in ("n", "at", "size", "crc32")]))


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, ids)`` of every document in a file set: the tokens before it, and its
    own, little-endian unsigned 32 bits. Segments are decoded in parallel; a block whose
    checksum or end state is wrong stops the job."""
    model_rows = spark.read.parquet(f"{folder}/model").toPandas()  # one row for each symbol
    frequency = np.zeros(int(model_rows["symbol"].max()) + 1 if len(model_rows) else 1, np.int64)
    frequency[model_rows["symbol"].to_numpy(np.int64)] = model_rows["frequency"].to_numpy(np.int64)
    segments = spark.read.parquet(f"{folder}/segments")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(frequency)
        for batch in batches:
            for i in range(batch.num_rows):
                first, sizes = batch.column(0)[i].as_py(), np.array(batch.column(2)[i].as_py(), np.int64)
                tokens = decode(model, batch.column(4)[i].as_py(), batch.column(3)[i].as_py()).astype("<u4")
                ends = np.cumsum(sizes)
                if len(tokens) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a segment has other tokens than its documents")
                offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
                ids = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(tokens)])
                yield pa.RecordBatch.from_arrays([batch.column(1)[i].values, pa.array(first + ends - sizes), ids.cast(pa.binary())], names=["id", "start", "ids"])

    rows = segments.select("first", "doc_ids", "doc_tokens", "payload", "blocks")
    return rows.mapInArrow(run, f"id {kind}, start bigint, ids binary").withColumnRenamed("id", id_col)
