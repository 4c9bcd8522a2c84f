"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.llm.columns import passes, texts_of
from yearbook.llm.pieces import encoder

#: Bytes of text in one numpy pass; a longer text is a pass of its own.
PASS_BYTES = 8 << 20


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    ``tokenizer`` is the path of a file that every executor has: a ``.json`` of the
    tokenizers library, or a ``.model`` of SentencePiece. Byte-level and lower-casing BPE is
    encoded in pieces (``pieces.py``), any other kind whole. Counts hold neither begin nor end
    tokens; special strings inside a text count as the library's default has it.

    One narrow job, no shuffle: batches are dealt by bytes of text, long texts are cut at
    safe places, and only numbers leave the function. Null and empty texts have 0 bytes
    and 0 tokens; repeated rows each have their row; an empty table gives no rows; other
    columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 1, PASS_BYTES):
            texts = texts_of(batch, 1)
            n, _ = encoder(tokenizer)(texts, False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts), pa.array(n)], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
