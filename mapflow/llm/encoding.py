"""Operator 1: BPE encoding and decoding of documents (method in `mapflow.llm.bpe`)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapflow.llm.bpe import encoded, encoder
from mapflow.llm.common import text_or_empty


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Documents with an array column of token ids. A null or empty text has no ids; no shuffle."""

    @F.pandas_udf("array<int>")
    def ids_of(texts):
        dtype = encoder(path).dtype
        out = [np.frombuffer(b, dtype).astype("i4") for b in encoded(path, texts.tolist())]
        return texts.iloc[:0].__class__(out, index=texts.index, dtype=object)

    return docs.withColumn(ids, ids_of(text_or_empty(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Documents with the text of their ids, special tokens kept. Null ids count as none."""

    @F.pandas_udf("string")
    def text_of(rows):
        return rows.map(encoder(path).decode)

    return docs.withColumn(text, text_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, sha256 of the ids written in decimal, sha256 of the decoded text.

    Rows are kept one for one, repeated doc_ids too; further columns do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        numbers = list(map(str, range(len(bpe.tokens))))
        for batch in batches:
            counts, written, decoded = [], [], []
            for data in encoded(path, batch.column("text").to_pylist()):
                ids = np.frombuffer(data, bpe.dtype).tolist()
                counts.append(len(ids))
                written.append(hashlib.sha256(" ".join(map(numbers.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
