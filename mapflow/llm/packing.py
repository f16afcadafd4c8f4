"""Operator 7: cost-balanced packing of token sequences.

Attention makes a sequence cost a linear plus a quadratic share of its pieces' lengths:
``cost(n) = n + n * n / balance``. Documents are cut at every full window; such pieces
are sequences of their own. The other pieces are dealt at random to groups of bounded
size (by a hash of document and start, so that no source or copy can crowd one), and
within a group, longest first, each goes to the cheapest sequence that has room left.
A group opens as many sequences as its tokens need, and one more whenever nothing fits.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapflow.llm.bpe import TABLE_SIZE, encoded, encoder
from mapflow.llm.common import stored, text_or_empty

WINDOW = 4096
PIECES_PER_GROUP = 8192
BALANCE = 1024
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row_id long"


def pieces(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, table_size: int = TABLE_SIZE) -> DataFrame:
    """Every document's ids and `end_id`, cut at each full window, with a crc32 for each piece.

    A null or empty text is the end id alone. Rows are kept one for one: `row_id` tells
    rows of a repeated doc_id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        for batch in batches:
            dtype = encoder(path, table_size).dtype
            rows: list[tuple] = []
            ids = batch.column("doc_id").to_pylist()
            numbers = batch.column("row_id").to_pylist()
            coded = encoded(path, batch.column("text").to_pylist(), table_size=table_size)
            for doc, number, data in zip(ids, numbers, coded, strict=True):
                tokens = np.append(np.frombuffer(data, dtype).astype("<u4"), end)
                total = len(tokens)
                for at in range(0, total, window):
                    part = tokens[at : at + window]
                    rows.append((doc, at, len(part), zlib.crc32(part), total, number))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_id"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row_id")
    ).mapInArrow(run, PIECE)


class _Levels:
    """Sequences by their fill: a heap of costs for each number of tokens, and a tree of the least over the levels."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(window + 1)]
        self.least: list[tuple[float, int]] = [_NONE] * (2 * self.size)

    def _renew(self, level: int) -> None:
        heap, least = self.heaps[level], self.least
        at = level + self.size
        least[at] = heap[0] if heap else _NONE
        while at > 1:
            at >>= 1
            left, right = least[2 * at], least[2 * at + 1]
            least[at] = left if left <= right else right

    def put(self, level: int, entry: tuple[float, int]) -> None:
        heapq.heappush(self.heaps[level], entry)
        if self.heaps[level][0] is entry:
            self._renew(level)

    def take(self, level: int) -> None:
        """Remove the cheapest sequence of a level."""
        heapq.heappop(self.heaps[level])
        self._renew(level)

    def cheapest(self, most: int) -> tuple[float, int]:
        """The cheapest sequence of at most `most` tokens."""
        found, least = _NONE, self.least
        a, b = self.size, self.size + most + 1
        while a < b:
            if a & 1:
                found = min(found, least[a])
                a += 1
            if b & 1:
                b -= 1
                found = min(found, least[b])
            a, b = a >> 1, b >> 1
        return found


_NONE = (math.inf, -1)


def deal(lengths: np.ndarray, window: int = WINDOW, balance: int = BALANCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset for each of a group's pieces, given longest first."""
    levels = _Levels(window)
    used = [0] * -(-int(lengths.sum()) // window)
    levels.heaps[0] = [(0.0, s) for s in range(len(used))]
    levels._renew(0)
    sequence, offset = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    for i, length in enumerate(lengths.tolist()):
        cost, chosen = levels.cheapest(window - length)
        if chosen < 0:
            cost, chosen = 0.0, len(used)
            used.append(0)
        else:
            levels.take(used[chosen])
        sequence[i], offset[i] = chosen, used[chosen]
        used[chosen] += length
        levels.put(used[chosen], (cost + length + length * length / balance, chosen))
    return sequence, offset


def pack(cut: DataFrame, window: int = WINDOW, group_size: int = PIECES_PER_GROUP) -> DataFrame:
    """Adds `sequence_id` (unique, not dense) and `offset` to pieces of at most `window` tokens.

    Groups hold about `group_size` pieces whatever the input's size, and each is packed
    in one task. `cut` is read twice, so it should be a stored table.
    """
    rest = cut.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_size))
    spread = F.pmod(F.xxhash64("doc_id", "start", "row_id"), F.lit(groups))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "row_id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sequence, offset = deal(frame["length"].to_numpy(), window)
        return frame.assign(sequence_id=frame["pack_group"] + sequence * groups, offset=offset).drop(columns="pack_group")

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    packed = (
        rest.withColumn("pack_group", spread)
        .groupBy("pack_group")
        .applyInPandas(run, f"{fields}, sequence_id long, offset long")
    )
    # Full pieces are sequences by themselves, with negative numbers: document row and window.
    alone = cut.where(F.col("length") == window).select(
        *cut.columns,
        (-1 - (F.monotonically_increasing_id())).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone)


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, table_size: int = TABLE_SIZE
) -> DataFrame:
    """Pieces of all documents with their places: each id lies in exactly one piece.

    `table_size` bounds the encoded pieces that a worker remembers; results do not depend on it.
    """
    return pack(stored(pieces(docs, path, end_id, window, table_size), "pieces"), window).drop("row_id")
