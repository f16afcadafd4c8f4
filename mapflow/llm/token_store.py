"""Operator 3: token ids in directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id,
level k the k-th chunk of those ids that reach so far; a bitmap beside each level says
which ids continue, and a rank directory counts the set bits before every 512th. So the
chunk that belongs to id i on the next level stands at rank(i), and any id, or any run
of ids, is read without decoding what stands before it.

On storage: Parquet, one row for a segment of about a million ids (documents are never
cut), in ascending order of doc_id, with the documents' ids and ends, and next to it a
small table of every segment's first position. Spark's writer commits a task's files as a
whole, so a lost executor leaves nothing half written.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapflow.llm.bpe import encoded, encoder
from mapflow.llm.common import hash_bitmap, may_hold, text_or_empty

BITS = 8
RANK_BLOCK = 512
SEGMENT_IDS = 1_000_000
ENCODED = 512  # texts whose ids are handed on at a time
SAMPLED = 50
BEGINNING = 64  # characters by which the rows of a repeated doc_id are dealt
LEVEL = pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())])
SEGMENT = pa.schema(
    [("shard", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("levels", pa.list_(LEVEL))]
)
SEGMENT_DDL = (
    "shard int, segment int, n_ids long, docs array<long>, ends array<long>, "
    "levels array<struct<chunks: binary, bitmap: binary, ranks: binary>>"
)


def to_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Chunk levels of unsigned ids; no ids give one empty level."""
    levels, rest = [], ids
    while True:
        higher = rest >> BITS
        goes_on = higher > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(goes_on) // RANK_BLOCK) * RANK_BLOCK, bool)
        padded[: len(goes_on)] = goes_on
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BLOCK).sum(1))]).astype("<u4")
        chunks = (rest & ((1 << BITS) - 1)).astype("u1")
        levels.append({"chunks": chunks.tobytes(), "bitmap": bitmap.tobytes(), "ranks": ranks.tobytes()})
        rest = higher[goes_on]
        if not len(rest):
            return levels


class Codes:
    """Random access to a segment's ids."""

    def __init__(self, levels: list[dict[str, bytes]]):
        self.levels = [
            (np.frombuffer(x["chunks"], "u1"), np.frombuffer(x["bitmap"], "u1"), np.frombuffer(x["ranks"], "<u4")) for x in levels
        ]

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: int) -> int:
        """Set bits before position `at`: the directory, then fewer than 512 bits."""
        block = at // RANK_BLOCK
        bits = np.unpackbits(bitmap[block * RANK_BLOCK // 8 : -(-at // 8)], bitorder="little")
        return int(ranks[block]) + int(bits[: at - block * RANK_BLOCK].sum())

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions start to stop, as unsigned 32-bit integers."""
        ids = np.zeros(stop - start, "<u4")
        where = slice(None)
        for depth, (chunks, bitmap, ranks) in enumerate(self.levels):
            if start == stop:
                break
            ids[where] |= chunks[start:stop].astype("<u4") << np.uint32(depth * BITS)
            bits = np.unpackbits(bitmap[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start]
            first = self._rank(bitmap, ranks, start)
            ahead = np.flatnonzero(bits)
            where = ahead if isinstance(where, slice) else where[ahead]
            start, stop = first, first + len(ahead)
        return ids

    def __getitem__(self, at: int) -> int:
        return int(self.run(at, at + 1)[0])


def _position(doc: int | None, order: str) -> tuple[bool, int, str]:
    """Where a row stands: null ids first, then by id, then by text."""
    return doc is not None, doc or 0, order


def _bounds(keys: DataFrame, n_shards: int) -> list[tuple[bool, int, str]]:
    """The first positions of all shards but one, from about `SAMPLED` rows a shard; they decide about sizes only."""
    share = min(1.0, SAMPLED * n_shards / max(1, keys.count()))
    rows = sorted(_position(*r) for r in keys.sample(share, seed=3).collect())
    return sorted({rows[len(rows) * k // n_shards] for k in range(1, n_shards)}) if rows else []


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode documents, end each with `end_id`, and write them below `path` in ascending doc_id order.

    A null or empty text is the end id alone. Rows of one doc_id follow each other by
    text; a null doc_id comes first; equal rows stay. No documents: no segments. Texts are
    encoded where they are read and only their ids are shuffled. The rows of a doc_id that
    repeats bring their text along as well, for its order, and are dealt to tasks by how
    it begins, so that such a doc_id may fill any number of them.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        end = np.array([end_id], bpe.dtype).tobytes()
        place = lambda doc, order: bisect_right(bounds, _position(doc, order[:BEGINNING]))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), ENCODED):
                part = batch.slice(at, ENCODED)
                ids = [coded + end for coded in encoded(tokenizer, texts[at : at + ENCODED], ENCODED)]
                shards = map(place, part.column("doc_id").to_pylist(), part.column("order").to_pylist())
                columns = [pa.array(shards, pa.int32()), part.column("doc_id"), part.column("order"), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "order", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(tokenizer).dtype
        shard, segment = 0, 0
        docs_in: list[int | None] = []
        data: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(d) // kind.itemsize for d in data]).tolist()
            levels = to_levels(np.frombuffer(b"".join(data), kind))
            row = {"shard": shard, "segment": segment, "n_ids": ends[-1], "docs": docs_in, "ends": ends, "levels": levels}
            return pa.RecordBatch.from_pylist([row], SEGMENT)

        for batch in batches:
            if batch.num_rows:
                shard = batch.column("shard")[0].as_py()  # a task has one
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                docs_in.append(doc)
                data.append(ids)
                size += len(ids) // kind.itemsize
                if size >= segment_ids:
                    yield flush()
                    docs_in, data, size, segment = [], [], 0, segment + 1
        if docs_in:
            yield flush()

    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    several = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.xxhash64("doc_id").alias("hash"))
    order = F.when(may_hold(hash_bitmap(several), F.xxhash64("doc_id")), F.col("text")).otherwise("")
    keyed = texts.select("doc_id", order.alias("order"), "text")
    n_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(keyed.select("doc_id", F.substring("order", 1, BEGINNING).alias("order")), n_shards)
    (
        keyed.mapInArrow(encode, "shard int, doc_id long, order string, ids binary")
        .repartitionById(n_shards, "shard")
        .sortWithinPartitions("doc_id", "order")
        .mapInArrow(run, SEGMENT_DDL)
        .write.parquet(f"{path}/segments")
    )
    sizes = spark.read.parquet(f"{path}/segments").select("shard", "segment", "n_ids")
    # One row for each task that wrote, so the only window without a key stays as small as the plan.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select("shard", before.alias("shard_start"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    (
        sizes.withColumn("within", F.coalesce(within, F.lit(0)))
        .join(shards, "shard")
        .select("shard", "segment", (F.col("shard_start") + F.col("within")).alias("first"))
        .write.parquet(f"{path}/directory")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start among all ids, n_tokens, ids_crc32 (little-endian 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a segment is some megabytes: one at a time
                row = batch.slice(at, 1).to_pylist()[0]
                ids = Codes(row["levels"]).run(0, row["n_ids"])
                starts = [0, *row["ends"][:-1]]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, row["ends"], strict=True)]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()),
                        pa.array(row["docs"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([b - a for a, b in zip(starts, row["ends"], strict=True)], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    docs = spark.read.parquet(f"{path}/segments").mapInArrow(
        run, "shard int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return docs.join(spark.read.parquet(f"{path}/directory"), ["shard", "segment"]).select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_run(spark: SparkSession, path: str, start: int, length: int) -> list[int]:
    """Any run of ids by global position; only the segments that hold it are read, and only the ids asked for decoded.

    Positions beyond the last id give nothing.
    """
    directory = spark.read.parquet(f"{path}/directory")
    segments = spark.read.parquet(f"{path}/segments")
    n = segments.select("shard", "segment", "n_ids").join(directory, ["shard", "segment"])
    hit = n.where((F.col("first") < start + length) & (F.col("first") + F.col("n_ids") > start)).orderBy("first").collect()
    out: list[int] = []
    for x in hit:  # as many rows as the run asked for spans
        levels = segments.where((F.col("shard") == x["shard"]) & (F.col("segment") == x["segment"])).select("levels").first()[0]
        a, b = max(0, start - x["first"]), min(x["n_ids"], start + length - x["first"])
        out += Codes([r.asDict() for r in levels]).run(a, b).tolist()
    return out
