"""Operator 9: language-model scores by deleted interpolation.

Tokens are words (stretches without white space, A-Z lower-cased) and one end for each
document. Estimates of word trigrams and bigrams are mixed with a model of classes, in
which the most frequent words are classes of their own and all others share one:

    P(w | u, v) = a * ML(w | u, v) + (1 - a) * (b * ML(w | v) + (1 - b) * C(w | u, v))
    C(w | u, v) = P(class(w) | u, v) * P(w | class(w))
    P(class | u, v) = c * ML(class | u, v) + (1 - c) * (d * ML(class | v) + (1 - d) * ML(class))
    P(w | class) = (1 - m) * ML(w | class) + m / (types of the class + 1)

The maximum-likelihood estimates come from the training documents. The weights a, b, c
and d depend on how often the history was seen, in buckets of powers of two. They and m
are learned by expectation-maximisation on held-out counts: estimates from nine tenths of
the training documents, counts from the other tenth. For a and b those counts are summed
by bucket and by the quotient of the two estimates (steps of 1/16 of its binary logarithm,
which is all that the method needs), so the driver sees a table of fixed size.

What grows with the corpus stays in Spark. Texts are split once, into a stored table of
chunks of about `CHUNK` tokens: a chunk's distinct words, and its tokens as numbers of
them, compressed. Counts of the whole corpus come in three rounds, for words, pairs and
trigrams: each chunk sends its distinct n-grams with its own counts to buckets by a hash of
the n-gram, a bucket adds them up and answers in the order asked, so answers need no names;
it also says whether another chunk has asked for the same. The first round also gives every
word a number, small ones to frequent words, so n-grams are named exactly, by their words'
numbers, and sorted lists of them compress well. A chunk asks for a pair only where
both words, and for a trigram only where both pairs, are shared with other chunks: elsewhere
its own counts are the corpus's. A common n-gram is asked for once a chunk, however often
it occurs. The number of buckets grows with the corpus. Tables by chunk are bucketed by
chunk, so that joining answers to chunks moves neither. The count tables of classes have
fixed sizes, (2^10)^2 and 2^4 * 2^6 * 2^10 cells, and are summed in Spark before the
driver sees them.

Defined results: a null or empty text is its end alone. Without any training token, scores
are the base scores. A row without doc_id is scored and not learned from; held_out false.
Repeated rows are learned from and scored one by one. An empty table gives an empty result.
A text of more than a chunk is split between words; its chunks' scores are added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import WordNumbers, fold, stored, text_or_empty
from mapflow.session import scratch_path

FOLDS = 10
HELD_OUT = 0
WEIGHTS_FOLD = 1
ESTIMATED, DELETED, NEITHER = 0, 1, 2  # what a document is to the estimates
ADDED = 0.1
CLASSES = 1024  # class 0: all words that have no class of their own
FAR, NEAR = 16, 64  # classes of the word before the last and of the last word in a history of two
BUCKETS = 40  # of the history's count
END = b"\n"  # no word is white space; the end is word 0 of every chunk, and class 1
ROUNDS = 25
STEPS = 16  # of a quotient's binary logarithm
NEVER = -100_000  # step of the quotient 0
CHUNK = 500_000  # tokens of a chunk
BUCKET_CHUNKS = 4  # chunks for each bucket of names
PIECE = 2_000_000  # bytes of a text that are split at once
BLANK = re.compile(rb"[\x20\x09-\x0D]")
ODD = np.uint64(0x9E3779B97F4A7C15)
NUMBER_BITS = 42  # of a word's number; a trigram's name is three of them in two 64-bit integers

CHUNK_SCHEMA = (
    "chunk long, row_ids array<long>, doc_ids array<long>, held_out array<boolean>, parts array<int>, starts array<long>, "
    "n_tokens long, words binary, tokens binary, end long"
)
CHUNK_COLUMNS = ["chunk", "row_ids", "doc_ids", "held_out", "parts", "starts", "n_tokens", "words", "tokens", "end"]


def pieces(text: str | None, most: int = PIECE) -> Iterator[list[bytes]]:
    """The tokens of a text, some megabytes at a time; the end is the last."""
    data = (text or "").encode().lower()
    at = 0
    while len(data) - at > most and (blank := BLANK.search(data, at + most)):
        yield data[at : blank.start()].split()
        at = blank.start()
    yield [*data[at:].split(), END]


def tokens(text: str | None) -> list[bytes]:
    return [word for piece in pieces(text) for word in piece]


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Integers from 0 on in as few bytes as hold the largest."""
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(f"u{next(w for w in (1, 2, 4, 8) if not most >> (8 * w))}", copy=False)


def packed(numbers: np.ndarray) -> bytes:
    """An array's bytes in order of their significance, those beyond the largest integer left out, compressed."""
    if numbers.dtype.kind != "f":
        numbers = _narrow(numbers)
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return bytes([numbers.itemsize]) + compressed(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(decompressed(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    numbers = np.ascontiguousarray(planes.T)
    return numbers.view(kind).ravel() if np.dtype(kind).kind == "f" else numbers.view(f"u{data[0]}").ravel().astype(kind)


def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def decompressed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes from 0 on, and which each is: one sort of plain integers, the places in their low bits."""
    bits = len(codes).bit_length()
    if len(codes) and int(codes.max()).bit_length() + bits > 64:
        return np.unique(codes, return_inverse=True)
    keyed = (codes.astype(np.uint64) << np.uint64(bits)) | np.arange(len(codes), dtype=np.uint64)
    keyed.sort()
    codes = (keyed >> np.uint64(bits)).astype(np.int64)
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    each = np.empty(len(codes), np.int32)
    each[(keyed & np.uint64((1 << bits) - 1)).astype(np.int64)] = np.cumsum(first, dtype=np.int32) - 1
    return codes[first], each


class _ChunkWriter:
    """Gathers texts until a chunk is full."""

    def __init__(self) -> None:
        self.numbers = WordNumbers({END: 0})
        self.rows: list[tuple] = []
        self.tokens: list[np.ndarray] = []
        self.starts: list[int] = []
        self.size = 0

    def add(self, row: tuple, before: list[bytes], words: list[bytes]) -> None:
        """A stretch of a row's tokens, with the two words before it."""
        self.rows.append(row)
        self.starts.append(self.size)
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, before + words), np.uint32, 2 + len(words)))
        self.size += 2 + len(words)

    def batch(self, chunk: int) -> pa.RecordBatch:
        row_ids, doc_ids, held_out, parts = map(list, zip(*self.rows, strict=True))
        schema = pa.schema(
            [
                ("chunk", pa.int64()), ("row_ids", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
                ("held_out", pa.list_(pa.bool_())), ("parts", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
                ("n_tokens", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("end", pa.int64()),
            ]
        )
        words = list(self.numbers)
        order = np.argsort(_hashes(words))
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        # In order of their hashes, the words of a bucket stand together, however many buckets there will be.
        joined = compressed(b" ".join([words[i] for i in order.tolist()]))
        values = [chunk, row_ids, doc_ids, held_out, parts, self.starts, self.size, joined, packed(rank[np.concatenate(self.tokens)]), int(rank[0])]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema, strict=True)], schema=schema)


def chunks(docs: DataFrame, chunk_tokens: int = CHUNK, piece_bytes: int = PIECE) -> DataFrame:
    """All documents as chunks of numbered tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        held = _ChunkWriter()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id", "held_out", "part")), strict=True)
            for row, text in zip(rows, batch.column("text"), strict=True):
                before = [END, END]
                for words in pieces(text.as_py(), piece_bytes):
                    held.add(row, before, words)
                    before = (before + words[-2:])[-2:]
                    if held.size > chunk_tokens:
                        yield held.batch(chunk)
                        held = _ChunkWriter()
                        chunk += 1
        if held.rows:
            yield held.batch(chunk)

    number = F.coalesce(fold(FOLDS), F.lit(HELD_OUT))
    part = F.when(number == HELD_OUT, NEITHER).when(number == WEIGHTS_FOLD, DELETED).otherwise(ESTIMATED)
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_id"),
        F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        part.cast("int").alias("part"),
        text_or_empty().alias("text"),
    )
    return marked.mapInArrow(run, CHUNK_SCHEMA)


def _mixed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A hash of names of two integers."""
    with np.errstate(over="ignore"):
        key = (high * ODD) ^ (high >> np.uint64(29))
        key = (key + low) * ODD
        return (key ^ (key >> np.uint64(32))) * ODD


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _by_bucket(bucket: np.ndarray) -> np.ndarray:
    """The order of the buckets, the same names' own order within."""
    return np.argsort(_narrow(bucket), kind="stable")  # up to 16 bits are sorted by their digits


def _in_order(bucket: np.ndarray, answers: list[np.ndarray]) -> np.ndarray:
    """Answers of the buckets, put where their questions stood."""
    out = np.empty((len(bucket), answers[0].shape[1] if answers else 3), np.int64)
    if len(bucket):
        out[_by_bucket(bucket)] = np.concatenate(answers)
    return out


def _columns(blob: bytes, width: int) -> np.ndarray:
    return unpacked(blob, np.uint64).reshape(width, -1).T


class Chunk:
    """A row of the table of chunks, with the answers joined to it: its tokens and its distinct n-grams."""

    def __init__(self, row: dict, buckets: int = 1) -> None:
        self.row, self.buckets = row, buckets
        every = unpacked(row["tokens"], np.int32)
        self.end = row["end"]
        if row.get("word_answers"):
            answers = row["word_answers"]  # in order of the buckets, as the words are
            numbers = np.concatenate([unpacked(a["numbers"], np.uint64) for a in answers])
            counts = np.concatenate([_columns(a["counts"], 3) for a in answers])
            # From here on the chunk's own numbers stand in the order of the corpus's.
            order = np.argsort(numbers)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            every, self.end = rank[every], int(rank[self.end])
            self.numbers, counts = numbers[order], counts[order].astype(np.int64)
            self.word_counts, self.shared_words = counts[:, :2], counts[:, 2] > 0
        starts = np.array(row["starts"], np.int64)
        lengths = np.diff(starts, append=len(every))
        stretch = np.repeat(np.arange(len(starts), dtype=np.int32), lengths)
        place = np.arange(len(every), dtype=np.int32)
        place -= np.repeat(starts, lengths)
        self.every, self.place = every, place
        self.at = np.flatnonzero(place >= 2)
        self.firsts = np.flatnonzero(place[self.at] == 2)  # each stretch's first token
        self.stretch = stretch[self.at]
        self.stretches = len(starts)
        self.part = np.array(row["parts"], np.int8)[self.stretch]
        self.u, self.v, self.w = every[self.at - 2], every[self.at - 1], every[self.at]

    @cached_property
    def words(self) -> list[bytes]:
        return decompressed(self.row["words"]).split(b" ")

    @cached_property
    def n_words(self) -> int:
        return len(self.numbers) if self.row.get("word_answers") else len(self.words)

    def tally(self, each: np.ndarray, size: int) -> np.ndarray:
        """How often each of something occurs in the two training parts: shape (size, 2)."""
        return np.bincount(each * 3 + self.part, minlength=3 * size).reshape(size, 3)[:, : DELETED + 1]

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of neighbours, those before a stretch included, and the pair that ends at each place."""
        second = np.flatnonzero(self.place >= 1)
        codes, found = _distinct(self.every[second - 1] * np.int64(self.n_words) + self.every[second])
        ends = np.full(len(self.every), -1, np.int32)
        ends[second] = found
        return codes, ends

    @cached_property
    def _triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams (pair before, word), and each token's."""
        return _distinct(self._pairs[1][self.at - 1] * np.int64(self.n_words) + self.w)

    @cached_property
    def triples(self) -> dict[str, np.ndarray]:
        """Of each distinct trigram: words u, v and w, and the pairs (u, v) and (v, w)."""
        codes, each = self._triples
        history, w = np.divmod(codes, self.n_words)
        u, v = np.divmod(self._pairs[0][history], self.n_words)
        pair = np.empty(len(codes), np.int32)
        pair[each] = self._pairs[1][self.at]
        return {"u": u, "v": v, "w": w, "history": history, "pair": pair}

    @cached_property
    def own_pairs(self) -> np.ndarray:
        return self.tally(self._pairs[1][self.at], len(self._pairs[0]))

    @cached_property
    def own_triples(self) -> np.ndarray:
        return self.tally(self._triples[1], len(self._triples[0]))

    @cached_property
    def asked_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those whose words are shared, and their names."""
        v, w = np.divmod(self._pairs[0], self.n_words)
        asked = np.flatnonzero(self.shared_words[v] & self.shared_words[w])
        return asked, self.numbers[v[asked]], self.numbers[w[asked]]

    def _answered(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the whole corpus, and which are shared with other chunks."""
        asked, high, low = getattr(self, f"asked_{kind}s")
        answers = _in_order(_bucket_of(_mixed(high, low), self.buckets), [_columns(x, 3) for x in self.row[f"{kind}_answers"] or []])
        counts = getattr(self, f"own_{kind}s").copy()
        shared = np.zeros(len(counts), bool)
        counts[asked], shared[asked] = answers[:, :2], answers[:, 2] > 0
        return counts, shared

    @cached_property
    def _pair_answers(self) -> tuple[np.ndarray, np.ndarray]:
        return self._answered("pair")

    @property
    def pair_counts(self) -> np.ndarray:
        return self._pair_answers[0]

    @cached_property
    def asked_triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those whose pairs are shared, and their names."""
        shared = self._pair_answers[1]
        asked = np.flatnonzero(shared[self.triples["history"]] & shared[self.triples["pair"]])
        u, v, w = (self.numbers[self.triples[x][asked]] for x in "uvw")
        rest = NUMBER_BITS - (64 - NUMBER_BITS)  # bits of v beside w
        high = (u << np.uint64(64 - NUMBER_BITS)) | (v >> np.uint64(rest))
        low = ((v & np.uint64(2**rest - 1)) << np.uint64(NUMBER_BITS)) | w
        return asked, high, low

    @cached_property
    def triple_counts(self) -> np.ndarray:
        return self._answered("triple")[0]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of chunks, one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def by_chunk(df: DataFrame, label: str) -> DataFrame:
    """A stored table that is bucketed by chunk: joins by chunk with others of its kind move no rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = "mapflow_" + re.sub(r"\W", "_", path.rstrip("/").rsplit("/", 1)[-1])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(partitions, "chunk").option("path", path).saveAsTable(name)
    return spark.table(name)


def _slices(bucket: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """Buckets in use and their stretches, of sorted bucket numbers."""
    found, first = np.unique(bucket, return_index=True)
    return found.astype(np.int64), [slice(a, b) for a, b in zip(first, np.append(first, len(bucket))[1:], strict=True)]


def numbered_words(parts: DataFrame, buckets: int) -> DataFrame:
    """Of every bucket, for each chunk the numbers and counts of its words; with a null chunk all the bucket's words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            chunk = Chunk(row, buckets)
            found, slices = _slices(_bucket_of(_hashes(chunk.words), buckets))
            counts = chunk.tally(chunk.w, chunk.n_words)
            words = [b" ".join(chunk.words[s]) for s in slices]
            columns = [
                pa.array(found),
                pa.array([row["chunk"]] * len(found), pa.int64()),
                pa.array(map(compressed, words), pa.binary()),
                pa.array([packed(counts[s].T.ravel()) for s in slices], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "words", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("chunk")  # the same numbers whenever a task is run again; frequent words get small ones
        bucket = asked.column("bucket")[0].as_py()
        numbers = WordNumbers()
        lists = [decompressed(x.as_py()).split(b" ") for x in asked.column("words")]
        ids = [np.fromiter(map(numbers.__getitem__, x), np.int64, len(x)) for x in lists]
        counts = np.zeros((len(numbers), 3), np.uint64)
        for at, blob in zip(ids, asked.column("counts"), strict=True):
            counts[at, :2] += _columns(blob.as_py(), 2)  # a chunk's words are distinct
            counts[at, 2] += np.uint64(1)
        order = np.lexsort((-counts[:, :2].sum(axis=1).astype(np.int64), -counts[:, 2].astype(np.int64)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts[:, 2] = counts[:, 2] > 1  # shared
        called = lambda at: (1 + place[at] * buckets + bucket).astype(np.uint64)
        rows = [
            {"chunk": c.as_py(), "bucket": bucket, "numbers": packed(called(at)), "counts": packed(counts[at].T.ravel()), "words": None}
            for c, at in zip(asked.column("chunk"), ids, strict=True)
        ]
        words = compressed(b" ".join(numbers))
        every = {"chunk": None, "bucket": bucket, "numbers": packed(called(np.arange(len(numbers)))), "counts": packed(counts.T.ravel()), "words": words}
        kinds = [("chunk", pa.int64()), ("bucket", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary()), ("words", pa.binary())]
        return pa.Table.from_pylist([*rows, every], pa.schema(kinds))

    asked = parts.mapInArrow(ask, "bucket long, chunk long, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, numbers binary, counts binary, words binary")


def vocabulary(answers: DataFrame) -> DataFrame:
    """`word, number, estimated, deleted`: counts in the nine tenths and the tenth of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            words = decompressed(row["words"]).split(b" ")
            numbers, counts = unpacked(row["numbers"], np.uint64).astype(np.int64), _columns(row["counts"], 3).astype(np.int64)
            columns = [pa.array(words, pa.binary()), *(pa.array(x.copy()) for x in (numbers, counts[:, 0], counts[:, 1]))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "number", "estimated", "deleted"])

    rows = answers.where(F.col("chunk").isNull()).select("words", "numbers", "counts")
    return rows.mapInArrow(run, "word binary, number long, estimated long, deleted long")


def asked_counts(parts: DataFrame, kind: str, buckets: int) -> DataFrame:
    """`chunk, <kind>_answers`: counts over all chunks of what each asks for, `kind` being pair or triple."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            chunk = Chunk(row, buckets)
            asked, high, low = getattr(chunk, f"asked_{kind}s")
            bucket = _bucket_of(_mixed(high, low), buckets)
            order = _by_bucket(bucket)
            found, slices = _slices(bucket[order])
            high, low, counts = high[order], low[order], getattr(chunk, f"own_{kind}s")[asked[order]]
            middle, last = (low >> np.uint64(NUMBER_BITS)).astype(np.uint32), low & np.uint64(2**NUMBER_BITS - 1)
            columns = [
                pa.array(found),
                pa.array([row["chunk"]] * len(found), pa.int64()),
                pa.array([packed(np.diff(high[s], prepend=np.uint64(0))) for s in slices], pa.binary()),
                pa.array([packed(middle[s]) for s in slices], pa.binary()),
                pa.array([packed(last[s]) for s in slices], pa.binary()),
                pa.array([packed(counts[s].T.ravel()) for s in slices], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "high", "middle", "last", "counts"])

    asked = parts.mapInArrow(ask, "bucket long, chunk long, high binary, middle binary, last binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(added_up, "chunk long, bucket long, counts binary")
    return answers.groupBy("chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bucket", "counts"))), lambda x: x["counts"]).alias(f"{kind}_answers")
    )  # the answers to one chunk


def _equal_names(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal names stand together, and whether each is the first of its kind there."""
    wide = (high | low).max() >> np.uint64(32)
    key = _mixed(high, low) if wide else (high << np.uint64(32)) | low
    order = np.argsort(key)
    key, high, low = key[order], high[order], low[order]
    first = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
    if (first[1:] & (key[1:] == key[:-1])).any():  # different names of one hash
        again = np.lexsort((low, high))
        order, high, low = order[again], high[again], low[again]
        first = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
    return order, first


def added_up(asked: pa.Table) -> pa.Table:
    """Answers of one bucket: for each question the counts over all of them and whether it is shared, in its order."""
    lists = lambda name: [unpacked(x.as_py(), np.uint64) for x in asked.column(name)]
    high = [np.cumsum(x, dtype=np.uint64) for x in lists("high")]
    edges = np.cumsum([0, *map(len, high)])
    high = np.concatenate(high)
    low = (np.concatenate(lists("middle")) << np.uint64(NUMBER_BITS)) | np.concatenate(lists("last"))
    counts = np.concatenate([unpacked(x.as_py(), np.uint32).reshape(2, -1).T for x in asked.column("counts")])
    order, first = _equal_names(high, low)
    del high, low
    starts = np.flatnonzero(first)
    total = np.add.reduceat(counts[order], starts, axis=0, dtype=np.uint64)
    askers = np.diff(starts, append=len(order))
    found = np.empty(len(order), np.int64)
    found[order] = np.cumsum(first) - 1
    sums = _narrow(total.T.ravel()).reshape(2, -1)
    answer = np.stack([sums[0], sums[1], (askers > 1).astype(sums.dtype)])
    blobs = pa.array([packed(answer[:, found[a:b]].ravel()) for a, b in zip(edges, edges[1:], strict=False)], pa.binary())
    return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "counts": blobs})


def with_counts(docs: DataFrame, chunk_tokens: int = CHUNK, piece_bytes: int = PIECE) -> tuple[DataFrame, DataFrame, int]:
    """The chunks with the counts that `Chunk` reads, the vocabulary, and the number of buckets."""
    parts = by_chunk(chunks(docs, chunk_tokens, piece_bytes), "chunks")
    size = parts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-size // (chunk_tokens * BUCKET_CHUNKS)))
    numbered = stored(numbered_words(parts, buckets), "words")
    answers = F.array_sort(F.collect_list(F.struct("bucket", "numbers", "counts"))).alias("word_answers")
    words = by_chunk(numbered.where(F.col("chunk").isNotNull()).groupBy("chunk").agg(answers), "word-answers")
    parts = parts.join(words, "chunk")
    for kind in ("pair", "triple"):
        parts = parts.join(by_chunk(asked_counts(parts, kind, buckets), f"{kind}-answers"), "chunk", "left")
    return parts, vocabulary(numbered), buckets


def class_words(vocab: DataFrame) -> list[int]:
    """Numbers of the words that are classes 1, 2, ...: the end, then the most frequent ones, ties in byte order."""
    total = F.col("estimated") + F.col("deleted")
    is_end = F.col("word") == F.lit(END)
    first = vocab.where((total > 0) | is_end).orderBy(F.desc(is_end), F.desc(total), "word").limit(CLASSES - 1)
    return [r["number"] for r in first.select("number").collect()]  # fewer than CLASSES


def _classes(chunk: Chunk, classed: list[int]) -> np.ndarray:
    """Class of each of the chunk's words."""
    numbers = np.array(classed, np.uint64)
    order = np.argsort(numbers)
    at = np.minimum(np.searchsorted(numbers[order], chunk.numbers), len(numbers) - 1)
    return np.where(numbers[order][at] == chunk.numbers, order[at] + 1, 0)


def _cells(classes: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the two count tables of classes for words and the two before them."""
    far, near, last = classes[u], classes[v], classes[w]
    two = near * CLASSES + last
    three = (np.where(far < FAR, far, 0) * NEAR + np.where(near < NEAR, near, 0)) * CLASSES + last
    return two, three


def class_counts(parts: DataFrame, classed: list[int], buckets: int) -> np.ndarray:
    """Counts of both tables, for both parts of the training documents: shape (2 parts, cells of two and three)."""
    cells = CLASSES * CLASSES
    size = cells + FAR * NEAR * CLASSES
    ranges = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        for row in _each(batches):
            chunk = Chunk(row, buckets)
            two, three = _cells(_classes(chunk, classed), chunk.u, chunk.v, chunk.w)
            for part in (ESTIMATED, DELETED):
                some = chunk.part == part
                counts[part, :cells] += np.bincount(two[some], minlength=cells)
                counts[part, cells:] += np.bincount(three[some], minlength=size - cells)
        if counts.any():
            blobs = pa.array([packed(x) for x in np.split(counts.reshape(-1), ranges)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(range(ranges), pa.int64()), blobs], ["range", "counts"])

    def summed(some: pa.Table) -> pa.Table:
        counts = np.zeros(2 * size // ranges, np.int64)
        for blob in some.column("counts"):
            counts += unpacked(blob.as_py(), np.int64)
        return pa.table({"range": some.column("range")[:1], "counts": pa.array([packed(counts)], pa.binary())})

    schema = "range long, counts binary"
    table = parts.mapInArrow(run, schema).groupBy("range").applyInArrow(summed, schema).collect()  # 64 rows, 34 MB unpacked
    out = np.zeros((ranges, 2 * size // ranges), np.int64)
    for row in table:
        out[row["range"]] = unpacked(row["counts"], np.int64)
    return out.reshape(2, size)


def _bucket(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(seen + 1.0)), BUCKETS - 1).astype(np.int64)


def mixture_weights(upper: np.ndarray, lower: np.ndarray, times: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Weight of the upper estimate in each bucket, by expectation-maximisation on held-out counts.

    A bucket without held-out counts gets the weight of the nearest bucket of rarer histories, the first one 0.
    """
    weight = np.full(BUCKETS, 0.5)
    total = np.bincount(buckets, times, BUCKETS)
    for _ in range(ROUNDS):
        mixed = weight[buckets] * upper
        whole = mixed + (1 - weight[buckets]) * lower
        share = np.divide(mixed, whole, out=np.zeros_like(whole), where=whole > 0)
        weight = np.divide(np.bincount(buckets, share * times, BUCKETS), total, out=weight, where=total > 0)
    before = 0.0
    for b in range(BUCKETS):
        before = weight[b] = weight[b] if total[b] else before
    return weight


def _conditional(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates along the last axis, and how often each history was seen."""
    seen = counts.sum(-1)
    return np.divide(counts, seen[..., None], out=np.zeros(counts.shape), where=seen[..., None] > 0), seen


def interpolated(counts: np.ndarray, parts: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables for scoring: P(class | v); c * ML(class | u, v); 1 - c for each history of two. One part: without the deleted counts."""
    cells = CLASSES * CLASSES
    two = counts[:, :cells].reshape(2, CLASSES, CLASSES)
    three = counts[:, cells:].reshape(2, FAR * NEAR, CLASSES)

    def one(table: np.ndarray) -> np.ndarray:
        """ML(class), with one more for class 0, which a small corpus may lack."""
        count = table.sum(0).astype(float)
        count[0] += 1
        return count / count.sum()

    def mixed_two(table: np.ndarray, weights: np.ndarray) -> np.ndarray:
        estimate, seen = _conditional(table)
        b = weights[_bucket(seen)][:, None]
        return b * estimate + (1 - b) * one(table)

    estimate, seen = _conditional(two[0])
    single = one(two[0])
    v, w = np.nonzero(two[1])
    b = mixture_weights(estimate[v, w], single[w], two[1][v, w].astype(float), _bucket(seen)[v])
    lower = mixed_two(two[0], b)
    # Where a history of two knows only the class of its last word: the mean over that class.
    share = two[0].sum(1).astype(float)
    coarse = lower[:NEAR].copy()
    others = np.concatenate([[0], np.arange(NEAR, CLASSES)])
    if share[others].sum() > 0:
        coarse[0] = share[others] @ lower[others] / share[others].sum()
    estimate, seen = _conditional(three[0])
    h, w = np.nonzero(three[1])
    a = mixture_weights(estimate[h, w], coarse[h % NEAR, w], three[1][h, w].astype(float), _bucket(seen)[h])
    estimate, seen = _conditional(three[:parts].sum(0))
    a = a[_bucket(seen)]
    return mixed_two(two[:parts].sum(0), b).astype("f4"), (a[:, None] * estimate).astype("f4"), (1 - a).astype("f4")


def unseen_share(rare: DataFrame) -> float:
    """Weight m of rare words' even share, by the same method on counts of counts."""
    rows = rare.groupBy(F.least("estimated", F.lit(1_000_000)).alias("c")).agg(
        F.sum("deleted").cast("double").alias("times"), F.sum("estimated").cast("double").alias("mass"), F.count(F.lit(1)).alias("types")
    ).collect()  # rare words have few distinct counts
    mass, types = sum(r["mass"] for r in rows), sum(r["types"] for r in rows if r["c"] > 0)
    if not mass:
        return 0.5
    even = np.full(len(rows), 1 / (types + 1))
    likely = np.array([r["c"] / mass for r in rows])
    times = np.array([r["times"] for r in rows])
    return float(1 - mixture_weights(likely, even, times, np.zeros(len(rows), np.int64))[0]) if times.sum() else 0.5


def _share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    return np.divide(count, of, out=np.zeros(len(of)), where=of > 0)


class Estimates:
    """The estimates that are mixed for some trigrams u, v, w, from counts of them, their pairs (v, w) and (u, v) and all words."""

    def __init__(
        self, chunk: Chunk, model: dict, every: bool, gram: list[np.ndarray], words: np.ndarray, counts: list[np.ndarray]
    ) -> None:
        triples, pairs, self.seen_two = counts
        u, v, w = gram
        self.seen_one = words[v]
        self.three = _share(triples, self.seen_two)
        self.two = _share(pairs, self.seen_one)
        classes = _classes(chunk, model["classes"])
        lower, upper, left = model["tables"][int(every)]
        two, three = _cells(classes, u, v, w)
        by_class = upper.reshape(-1)[three].astype(float) + left[three // CLASSES] * lower.reshape(-1)[two].astype(float)
        within = (1 - model["even"]) * words / max(1, model["masses"][int(every)]) + model["even"] / (model["types"] + 1)
        self.classed = np.maximum(by_class * np.where(classes > 0, 1.0, within)[w], 1e-30)

    def pairs_mixed(self, weights: np.ndarray) -> np.ndarray:
        b = np.where(self.seen_one > 0, weights[_bucket(self.seen_one)], 0.0)
        return b * self.two + (1 - b) * self.classed

    def mixed(self, b: np.ndarray, a: np.ndarray) -> np.ndarray:
        a = np.where(self.seen_two > 0, a[_bucket(self.seen_two)], 0.0)
        return a * self.three + (1 - a) * self.pairs_mixed(b)


HELD = {"seen_one": np.int32, "seen_two": np.int32, "two": np.float32, "three": np.float32, "times": np.int32}


def token_counts(parts: DataFrame, model: Broadcast, buckets: int) -> DataFrame:
    """Per chunk, as packed arrays: of each token the counts of its trigram and pair, of each stretch's first one the count
    of its history (of the others, that is the count of the pair before), and of each deleted trigram how often (`times`),
    buckets of its histories, and its estimates over the class's."""
    names = ["triples", "pairs", "histories", *HELD]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            chunk = Chunk(row, buckets)
            grams, each = chunk.triples, chunk._triples[1]

            def counted(words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> list[np.ndarray]:
                # What stands before a document was seen once a document, like the end.
                before = np.where(grams["v"] == chunk.end, words[chunk.end], pairs[grams["history"]])  # noqa: B023
                return [triples, pairs[grams["pair"]], before]  # noqa: B023

            known = chunk.word_counts, chunk.pair_counts, chunk.triple_counts
            every = counted(*(x.sum(axis=1) for x in known))
            times = chunk.own_triples[:, DELETED]
            some = np.flatnonzero(times)
            estimated = [x[some] for x in counted(*(x[:, ESTIMATED] for x in known))]
            found = Estimates(chunk, model.value, False, [grams[x][some] for x in "uvw"], known[0][:, ESTIMATED], estimated)
            held = [_bucket(found.seen_one), _bucket(found.seen_two), found.two / found.classed, found.three / found.classed, times[some]]
            tokens = each, each, each[chunk.firsts]
            blobs = [packed(_narrow(x)[at]) for x, at in zip(every, tokens, strict=True)] + [packed(x.astype(k)) for x, k in zip(held, HELD.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (row["chunk"], *blobs)], ["chunk", *names])

    return parts.mapInArrow(run, "chunk long, " + ", ".join(f"{n} binary" for n in names))


def held_out_estimates(counts: DataFrame) -> DataFrame:
    """The deleted trigrams of `token_counts` as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(row[n], k)) for n, k in HELD.items()], list(HELD))

    return counts.select(*HELD).mapInArrow(run, "seen_one int, seen_two int, two float, three float, times int")


def held_out_weights(held: DataFrame, seen: str, quotient: Column) -> np.ndarray:
    """Weights of the upper estimate by bucket of the history's count, from its quotients to the lower one."""
    step = F.greatest(F.lit(-1000), F.least(F.lit(1000), F.round(STEPS * F.log2(quotient)).cast("int")))
    step = F.when(quotient > 0, step).otherwise(NEVER)
    cells = held.groupBy(F.col(seen).alias("bucket"), step.alias("step")).agg(F.sum("times").alias("times")).collect()  # at most BUCKETS * 2002 rows
    values = np.array([2.0 ** (r["step"] / STEPS) if r["step"] != NEVER else 0.0 for r in cells])
    times = np.array([float(r["times"]) for r in cells])
    return mixture_weights(values, np.ones(len(cells)), times, np.array([r["bucket"] for r in cells], np.int64))


def scores(docs: DataFrame, chunk_tokens: int = CHUNK, piece_bytes: int = PIECE) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    context = docs.sparkSession.sparkContext
    parts, vocab, buckets = with_counts(docs, chunk_tokens, piece_bytes)
    total = F.col("estimated") + F.col("deleted")
    whole = lambda x: F.coalesce(F.sum(x), F.lit(0))
    sums = vocab.agg(whole(total).alias("n"), F.count_if(total > 0).alias("v")).first()
    n, v = int(sums["n"]), int(sums["v"])
    divisor = n + ADDED * (v + 1)
    classes = class_words(vocab)
    rare = vocab.where((total > 0) & ~F.col("number").isin(classes))
    masses = rare.agg(whole(F.col("estimated")), whole(total), F.count(F.lit(1))).first()
    counts = class_counts(parts.select(*CHUNK_COLUMNS, "word_answers"), classes, buckets)
    model = context.broadcast(  # 18 MB, whatever the corpus
        {
            "classes": classes,
            "tables": (interpolated(counts, 1), interpolated(counts)),
            "even": unseen_share(rare),
            "masses": (int(masses[0]), int(masses[1])),
            "types": int(masses[2]),
        }
    )
    counts = by_chunk(token_counts(parts, model, buckets), "token-counts")
    held = held_out_estimates(counts)
    b = held_out_weights(held, "seen_one", F.col("two").cast("double"))
    weight = F.get(F.array(*(F.lit(float(x) if i else 0.0) for i, x in enumerate(b))), F.col("seen_one"))  # bucket 0: never seen
    a = held_out_weights(held, "seen_two", F.col("three").cast("double") / (weight * F.col("two") + 1 - weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            chunk = Chunk(row, buckets)
            known = [unpacked(row[n], np.int64) for n in ("triples", "pairs")]
            known.append(np.roll(known[1], 1))
            known[2][chunk.firsts] = unpacked(row["histories"], np.int64)
            words = chunk.word_counts.sum(axis=1)
            found = Estimates(chunk, model.value, True, [chunk.u, chunk.v, chunk.w], words, known)
            summed = lambda values: np.bincount(chunk.stretch, values, chunk.stretches)  # noqa: E731, B023
            base = np.log10((words + ADDED) / divisor)[chunk.w]
            value = np.log10(found.mixed(b, a)) if n else base
            columns = [
                pa.array(row["row_ids"], pa.int64()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["held_out"], pa.bool_()),
                *(pa.array(summed(x).astype(np.int64)) for x in (np.ones(len(base)), (words > 0)[chunk.w])),
                *(pa.array(summed(x)) for x in (base, value)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"])

    schema = "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"
    known = parts.select(*CHUNK_COLUMNS, "word_answers").join(counts.select("chunk", "triples", "pairs", "histories"), "chunk")
    rows = known.mapInArrow(run, schema).groupBy("row_id", "doc_id", "held_out")  # more than one only where a text has several chunks
    return rows.agg(*(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "model"))).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        F.col("model").alias("score"),
    )
