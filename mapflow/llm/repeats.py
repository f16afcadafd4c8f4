"""Operator 4: repeated passages, found by merging Burrows-Wheeler transforms of shards.

Every byte is removed that lies in a string of `WINDOW` bytes which also starts anywhere
else, in the same text or another. Strings do not cross documents; they are judged on the
input.

*Where to look.* A window's anchor is the smallest hash of its strings of `ANCHOR` bytes.
Equal windows have equal anchors, so only windows under one anchor need be compared. A run
of neighbouring windows with one anchor is a segment. Whole texts that occur twice are
settled by grouping, and so are segments that occur twice; of the others only segments
whose anchor also belongs to a different segment go on.

*Merging.* A task gets the segments of some anchors and cuts them into shards. The alphabet
is that of strings of `SYMBOL` bytes. A shard's suffixes are sorted once, which gives its
transform: before each suffix stands the symbol that precedes it. The shards' transforms
are then merged without sorting suffixes of different shards: the interleave says, for
every place in the merged order, which shard's next suffix stands there. It starts as shard
after shard; each round deals it anew by the preceding symbols, after which suffixes are in
order by one symbol more. Borders between blocks that a round adds tell the length of the
common prefix; after WINDOW / SYMBOL rounds the blocks of more than one suffix are the
repeated intervals.

*Hot anchors.* The segments under one anchor are held in one task only up to `MOST_BYTES`.
Beyond, their windows are named by 128-bit hashes and counted by an aggregation, which
spreads over all tasks; the result is the same.

Defined results: null and empty texts keep their zero bytes; texts shorter than a window
lose nothing; rows repeated in full are copies of each other like any two equal texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.llm.common import stored, text_or_empty

WINDOW = 200
ANCHOR = 64
SYMBOL = 50
SHARD_BYTES = 1 << 16
TASK_BYTES = 1 << 20
MOST_BYTES = 1 << 22
FILTER_BITS = 25
_RANDOM = np.random.default_rng(20240413)
BYTE_VALUES = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64)
ODD = _RANDOM.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of the string of that length at every position, by doubling."""
    values, size, step = BYTE_VALUES[data], 1, 0
    while size * 2 <= length:
        values = values[:-size] * ODD[step] + values[size:]
        size, step = size * 2, step + 1
    if size < length:
        more = length - size
        values = values[:-more] * ODD[step] + values[more:]
    values = (values ^ (values >> np.uint64(29))) * ODD[15]
    return values ^ (values >> np.uint64(32))


def segments(data: bytes, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its hash, first window, the one after the last, whether it stands there twice.

    The smallest hash is sought on its leading bits, with the position in the others, so
    that the leftmost place wins and each place is known.
    """
    if len(data) < window:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(bool)
    hashes = string_hashes(np.frombuffer(data, np.uint8), anchor)
    bits = np.uint64(len(hashes).bit_length())
    least, size, reach = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64), 1, window - anchor + 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        more = reach - size
        least = np.minimum(least[:-more], least[more:])
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    value = hashes[least[change] & ((np.uint64(1) << bits) - np.uint64(1))]
    new = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    start, places = change[new], np.diff(np.append(new, len(value)))
    # The smallest hashes have small leading bits; spread them again, since slots are leading bits.
    return (value[new] * ODD[7]).view(np.int64), start, np.append(start[1:], len(least)), places > 1


# --- merging ----------------------------------------------------------------------


def stable_order(codes: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Stable ascending order of codes below 2^32, from `order` on, by two passes over sixteen bits."""
    for half in (codes & 0xFFFF, codes >> 16):
        digits = half.astype(np.uint16)
        order = np.argsort(digits, kind="stable") if order is None else order[np.argsort(digits[order], kind="stable")]
    return order


def shard_order(symbols: np.ndarray, follows: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of one shard sorted by their next `depth` symbols; symbol 0 ends a segment.

    `follows` gives each position's next suffix, or the last place, which holds symbol 0.
    """
    keys, at = [], np.arange(len(follows) - 1)
    for _ in range(depth):
        keys.append(symbols[at])
        at = follows[at]
    order = None
    for key in reversed(keys):
        order = stable_order(key, order)
    return order


def merge_shards(symbol: list[np.ndarray], before: list[np.ndarray], last: list[np.ndarray], rounds: int) -> np.ndarray:
    """Blocks of suffixes that share `rounds` symbols, by refining the interleave of shards.

    Per shard, in its suffix order: each suffix's first symbol, the symbol before it (0:
    none), and whether no suffix follows it. Returns the block number of every suffix,
    shard after shard in their orders.
    """
    preceding = np.concatenate(before)
    sizes = [len(x) for x in symbol]
    n = len(preceding)
    # Suffixes that nothing follows do not come from another suffix: they open every round.
    ends = np.concatenate([s[e] for s, e in zip(symbol, last, strict=True)])
    end_shards = np.repeat(np.arange(len(sizes), dtype=np.uint16), [int(e.sum()) for e in last])
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    block = np.zeros(n, np.int64)
    place = np.empty(n, np.int64)
    for done in range(rounds):
        # The k-th place of a shard in the interleave is its k-th suffix.
        place[np.argsort(interleave, kind="stable")] = np.arange(n)
        symbols = preceding[place]
        goes = np.flatnonzero(symbols)
        symbols = np.concatenate([ends, symbols[goes]])
        shards = np.concatenate([end_shards, interleave[goes]])
        # One symbol suffices in the first round; later on, an end has too few and is a block apart.
        blocks = np.concatenate([np.full(len(ends), -1 if done else 0), block[goes]])
        order = stable_order(symbols)
        symbols, blocks, interleave = symbols[order], blocks[order], shards[order]
        border = (symbols[1:] != symbols[:-1]) | (blocks[1:] != blocks[:-1])
        block = np.concatenate([[0], np.cumsum(border)])
    place[np.argsort(interleave, kind="stable")] = np.arange(n)
    out = np.empty(n, np.int64)
    out[place] = block
    return out


def repeated_windows(pieces: list[bytes], window: int = WINDOW, symbol: int = SYMBOL, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each piece whether the window at each position also stands elsewhere in the pieces."""
    lengths = np.array([len(p) for p in pieces])
    first = np.concatenate([[0], np.cumsum(lengths)])
    n = int(first[-1])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.repeat(first[1:], lengths)
    at = np.arange(n)
    inside = at + symbol <= ends  # a whole symbol stands here
    names = np.zeros(n, np.uint64)
    names[: max(0, n - symbol + 1)] = string_hashes(data, symbol) if n >= symbol else 0
    codes = np.zeros(n, np.int32)
    codes[inside] = np.unique(names[inside], return_inverse=True)[1] + 1
    shard_of = np.repeat(first[:-1] // shard_bytes, lengths)
    parts = np.flatnonzero(np.concatenate([[True], shard_of[1:] != shard_of[:-1]])).tolist() + [n]
    number = np.full(n + symbol, -1)  # position -> place among a shard's suffixes
    orders, symbols, before, last = [], [], [], []
    for a, b in zip(parts[:-1], parts[1:], strict=True):
        suffixes = a + np.flatnonzero(inside[a:b])
        number[suffixes] = np.arange(len(suffixes))
        own = np.append(codes[suffixes], 0)
        follows = np.where(suffixes + symbol < ends[suffixes], number[np.minimum(suffixes + symbol, n - 1)], -1)
        follows = np.append(np.where(follows < 0, len(suffixes), follows), len(suffixes))
        order = shard_order(own, follows, window // symbol)
        starts = first[np.searchsorted(first, suffixes, side="right") - 1]
        previous = np.where(suffixes - symbol >= starts, codes[np.maximum(suffixes - symbol, 0)], 0)
        orders.append(suffixes[order])
        symbols.append(own[:-1][order])
        before.append(previous[order])
        last.append((follows[:-1] == len(suffixes))[order])
    repeated = np.zeros(n, bool)
    if orders:
        suffixes = np.concatenate(orders)
        block = merge_shards(symbols, before, last, window // symbol)
        several = np.bincount(block)[block] > 1
        whole = suffixes + window <= ends[suffixes]
        repeated[suffixes[several & whole]] = True
    return [repeated[a : b - window + 1] for a, b in zip(first[:-1], first[1:], strict=True)]


def ranges(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true marks."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


# --- on Spark ---------------------------------------------------------------------


def _names() -> list[Column]:
    """A text's 128-bit name."""
    return [F.xxhash64(text_or_empty()).alias("text_a"), F.xxhash64(F.lit(1), text_or_empty()).alias("text_b")]


def _bitmap(spark: SparkSession, hashes: DataFrame) -> np.ndarray:
    """Which of 2^25 slots the hashes fall in, as 4 MB of bits whatever their number; a full one filters nothing."""
    slot = F.shiftrightunsigned("anchor", 64 - FILTER_BITS)
    bits = hashes.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")
    )
    table = bits.toArrow()  # at most 2^19 rows
    out = np.zeros(2**FILTER_BITS // 64, np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint8)


def _with_texts(docs: DataFrame) -> DataFrame:
    return docs.select(*_names(), text_or_empty().alias("text"))


def _anchors(docs: DataFrame) -> DataFrame:
    """`anchor, place` of every segment; `place` names text and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, places = [], []
            with np.errstate(over="ignore"):
                names = batch.column("text_a").to_numpy().view(np.uint64) * ODD[3] + batch.column("text_b").to_numpy().view(np.uint64)
                for name, text in zip(names, batch.column("text"), strict=True):
                    anchor, start, _, twice = segments(text.as_py().encode())
                    anchor, start = np.concatenate([anchor, anchor[twice]]), np.concatenate([start, start[twice] + 1])
                    place = (start.astype(np.uint64) * ODD[0] ^ name) * ODD[1]
                    anchors.append(anchor)
                    places.append((place ^ (place >> np.uint64(31))).view(np.int64))
            if anchors:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchors)), pa.array(np.concatenate(places))], ["anchor", "place"])

    return _with_texts(docs).mapInArrow(run, "anchor long, place long")


SEGMENT_ROWS = "text_a long, text_b long, anchor long, segment long, start int, windows int, twice boolean, bytes binary"


def _candidates(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Segments, with their bytes, whose anchor's slot is wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            rows: list[tuple] = []
            with np.errstate(over="ignore"):
                for a, b, text in zip(*(batch.column(c) for c in ("text_a", "text_b", "text")), strict=True):
                    data = text.as_py().encode()
                    anchor, start, stop, twice = segments(data)
                    slot = anchor.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
                    hit = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    if not len(hit):
                        continue
                    name = (a.as_py(), b.as_py())
                    for h, i, j, t in zip(*(x[hit].tolist() for x in (anchor, start, stop, twice)), strict=True):
                        piece = data[i : j + WINDOW - 1]
                        digest = xxhash.xxh3_64_intdigest(piece)
                        rows.append((*name, h, digest - (1 << 64) if digest >> 63 else digest, i, j - i, t, piece))
            for at in range(0, len(rows), 20_000):
                columns = list(zip(*rows[at : at + 20_000], strict=True))
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["text_a", "text_b", "anchor", "segment", "start", "windows", "twice", "bytes"],
                )

    return _with_texts(docs).mapInArrow(run, SEGMENT_ROWS)


RANGE_ROWS = "anchor long, segment long, low int, high int"


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a task's segments. An anchor's only segment repeats nothing, unless the anchor stands in it twice."""
    alone = frame.groupby("anchor")["segment"].transform("size") == 1
    several = frame[~alone | frame["twice"]]
    rows: list[tuple] = []
    if len(several):
        several = several.sort_values(["anchor", "segment"])
        with np.errstate(over="ignore"):
            found = repeated_windows(several["bytes"].tolist())
        for anchor, segment, settled, marks in zip(several["anchor"], several["segment"], several["settled"], found, strict=True):
            if not settled:
                rows += [(anchor, segment, a, b) for a, b in zip(*ranges(marks), strict=True)]
    return pd.DataFrame(rows, columns=["anchor", "segment", "low", "high"])


def _counted(hot: DataFrame) -> DataFrame:
    """The same for segments of hot anchors, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, segment, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "bytes")), strict=True):
                n = len(data) - WINDOW + 1
                hashes = [xxhash.xxh3_128_digest(data[i : i + WINDOW]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(hashes, pa.binary())],
                    ["anchor", "segment", "low", "hash"],
                )

    windows = hot.select("anchor", "segment", "bytes").mapInArrow(run, "anchor long, segment long, low int, hash binary")
    place = F.xxhash64("anchor", "segment", "low")
    several = windows.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("hash")
    return windows.join(several, "hash").select("anchor", "segment", "low", (F.col("low") + 1).alias("high"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """`text_a, text_b, spans`: byte ranges (low, high) that repeat, for texts that have some; ranges may touch or overlap."""
    twice = _anchors(docs).groupBy("anchor").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a <> b").select("anchor")
    found = stored(_candidates(docs, _bitmap(docs.sparkSession, stored(twice, "anchors"))), "segments")
    place = F.xxhash64("text_a", "text_b", "start")
    distinct = found.groupBy("anchor", "segment").agg(
        (F.min(place) != F.max(place)).alias("settled"), F.max("windows").alias("windows"), F.max("twice").alias("twice"), F.first("bytes").alias("bytes")
    )
    distinct = stored(distinct, "distinct-segments")
    size = F.sum(F.length("bytes"))
    total = distinct.agg(F.coalesce(size, F.lit(0))).first()[0]
    hot = stored(distinct.groupBy("anchor").agg(size.alias("size")).where(F.col("size") > MOST_BYTES).select("anchor"), "hot-anchors")
    tasks = max(1, -(-int(total) // TASK_BYTES))
    merged = (
        distinct.join(hot, "anchor", "left_anti")
        .withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(tasks)))
        .groupBy("task")
        .applyInPandas(_merged, RANGE_ROWS)
    )
    counted = _counted(distinct.join(hot, "anchor", "left_semi"))
    settled = distinct.where("settled").select("anchor", "segment", F.lit(0).alias("low"), F.col("windows").alias("high"))
    ranged = stored(merged.unionByName(counted).unionByName(settled), "repeated-ranges")
    spans = found.select("text_a", "text_b", "anchor", "segment", "start").join(ranged, ["anchor", "segment"]).select(
        "text_a",
        "text_b",
        F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + WINDOW - 1).alias("high")).alias("span"),
    )
    return spans.groupBy("text_a", "text_b").agg(F.collect_set("span").alias("spans"))


def joined_ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that remain)."""
    copies = docs.select(*_names()).groupBy("text_a", "text_b").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    known = repeated_spans(docs).join(copies, ["text_a", "text_b"], "full").withColumn("copies", F.coalesce("copies", F.lit(1)))
    known = stored(known, "text-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, text, spans, copies in zip(*(batch.column(c) for c in ("doc_id", "text", "spans", "copies")), strict=True):
                data, several = text.as_py().encode(), copies.as_py() or 1
                if several > 1 and len(data) >= WINDOW:
                    gone = [(0, len(data))]
                else:
                    gone = joined_ranges([(s["low"], s["high"]) for s in spans.as_py() or []])
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(rows, (doc.as_py(), len(data), len(data) - len(kept), len(gone), kept), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_names(), text_or_empty().alias("text"))
    return (
        rows.join(known, ["text_a", "text_b"], "left")
        .select("doc_id", "text", "spans", "copies")
        .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def digests(docs: DataFrame) -> DataFrame:
    """`without_repeats` with the sha256 of the kept bytes in their place."""
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
