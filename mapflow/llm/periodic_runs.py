"""Operator 13: periodic runs, stretches of a text that repeat a block of words over and over.

A run is a stretch of consecutive words with smallest period q that is at least `least` words
long, holds at least `times` periods, and that no neighbouring word extends keeping q.

Descending-LCP Kruskal, many texts at once: the suffixes of the texts are sorted by doubling
(words carry their text's number, so suffixes of two texts have nothing in common), and the
neighbours in that order become edges weighted by their longest common prefix (LCP). Edges are
taken by falling LCP and unite suffix classes in a union-find whose classes keep their positions
in order. Two positions i < j that become neighbours in a class at LCP L, with j - i <= L, are a
run of period j - i that covers i to j + L, and start it where the words before them differ. A
start and its first repetition have no third position between them in their class (the run would
have a smaller period), so no run is missed; of seeds of one stretch the smallest period counts.

A run needs an LCP of `least_prefix`, so classes are united down to that and no further, and only
texts that hold some window of so many words twice are sorted at all. Both leave nothing out.

Defined results: a null or empty text has no words and no runs. Repeated rows are separate
texts, kept one for one; a null doc_id is kept; further columns, whatever their names, are passed
on by `collapse` and ignored by the rest. An empty table gives an empty result. Ties of exact
exponents go to the smallest start, then the smallest period. A text is worked on as a whole in
one task, in memory linear in its words (times the logarithm of its longest repeated stretch).
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import WordNumbers, text_or_empty

LEAST_WORDS = 24
LEAST_TIMES = 3
#: Words that are sorted together; a longer text is taken alone.
BLOCK_WORDS = 200_000
#: Positions in one bucket of an ordered set.
BUCKET = 1024


class Positions:
    """An ordered set of positions in buckets, so that a large one takes an insertion anywhere."""

    def __init__(self, ordered: list[int]):
        self.buckets = [ordered[i : i + BUCKET] for i in range(0, len(ordered), BUCKET)]
        self.firsts = [b[0] for b in self.buckets]
        self.size = len(ordered)

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        for bucket in self.buckets:
            yield from bucket

    def add(self, x: int) -> tuple[int, int]:
        """Insert a position; its neighbours, -1 where there is none."""
        at = max(bisect_right(self.firsts, x) - 1, 0)
        bucket = self.buckets[at]
        i = bisect_left(bucket, x)
        before = bucket[i - 1] if i else -1
        after = bucket[i] if i < len(bucket) else self.firsts[at + 1] if at + 1 < len(self.firsts) else -1
        bucket.insert(i, x)
        self.firsts[at] = bucket[0]
        self.size += 1
        if len(bucket) > 2 * BUCKET:
            self.buckets[at : at + 1] = [bucket[:BUCKET], bucket[BUCKET:]]
            self.firsts[at : at + 1] = [bucket[0], bucket[BUCKET]]
        return before, after


def least_prefix(least: int, times: int) -> int:
    """The common prefix that a run's start has with its first repetition, at least."""
    return max(1, min(max(least - q, (times - 1) * q) for q in range(1, least + 1)))


def _repeating(keys: np.ndarray, width: int) -> np.ndarray:
    """Positions whose next words (the largest power of two up to `width`) may stand elsewhere too."""
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    reach = 1
    while reach * 2 <= width:
        ahead = np.zeros_like(h)
        ahead[:-reach] = h[reach:]
        h = (h * np.uint64(0xBF58476D1CE4E5B9)) ^ (ahead + (ahead >> np.uint64(31)))
        reach *= 2
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return np.zeros(len(h), bool)
    return twice[np.minimum(np.searchsorted(twice, h), twice.size - 1)] == h


def sorted_prefixes(keys: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their next 1, 2, 4, ... keys, until all differ; equal prefixes share a rank."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)
    levels: list[np.ndarray] = []
    active, first, second = order, np.zeros(n, np.int64), keys[order]
    reach = 0
    while True:
        index = np.arange(len(active))
        old = np.ones(len(active), bool)
        old[1:] = first[1:] != first[:-1]
        new = old.copy()
        new[1:] |= second[1:] != second[:-1]
        group, part = (np.maximum.accumulate(np.where(edge, index, 0)) for edge in (old, new))
        rank = rank.copy()
        rank[active] = first + part - group
        levels.append(np.append(rank, -1).astype(np.int32))
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        if not len(active):
            return levels
        reach = max(1, reach * 2)
        ahead = active + reach
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(rank[active] * (n + 1) + second)
        active, second = active[order], second[order]
        first = rank[active]


def common_prefixes(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with an LCP of `least` or more: earlier one, later one, LCP."""
    rank = levels[-1][:-1]
    suffixes = np.empty(len(rank), np.int64)
    suffixes[rank] = np.arange(len(rank))
    a, b = suffixes[:-1], suffixes[1:]
    known = levels[min(least.bit_length() - 1, len(levels) - 1)]
    close = known[a] == known[b]
    a, b = a[close], b[close]
    i, j, lcp = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = np.where(levels[k][i] == levels[k][j], 1 << k, 0)
        i, j, lcp = i + step, j + step, lcp + step
    long = lcp >= least
    return a[long], b[long], lcp[long]


def _unite(edges: tuple[np.ndarray, np.ndarray, np.ndarray], ids: list[int], least: int, times: int) -> dict[tuple[int, int], int]:
    """Smallest period of each run by its start and end, from edges taken by falling LCP."""
    order = np.argsort(-edges[2], kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int] | Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        above = parent.setdefault(x, x)
        while above != x:
            parent[x] = above = parent[above]
            x, above = above, parent[above]
        return x

    def add(ordered: list[int] | Positions, x: int) -> tuple[int, int]:
        if isinstance(ordered, Positions):
            return ordered.add(x)
        at = bisect_left(ordered, x)
        near = (ordered[at - 1] if at else -1, ordered[at] if at < len(ordered) else -1)
        ordered.insert(at, x)
        return near

    for a, b, lcp in zip(*(e[order].tolist() for e in edges), strict=True):
        a, b = root(a), root(b)
        large, small = members.pop(a, [a]), members.pop(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        last = -1
        for x in small:
            before, after = add(large, x)
            # Two positions of the smaller class met at a larger LCP already.
            for i, j in ((before if before != last else -1, x), (x, after)):
                period = j - i
                if 0 <= i < j and period * (times - 1) <= lcp and period + lcp >= least and (i == 0 or ids[i - 1] != ids[j - 1]):
                    run = i, j + lcp
                    found[run] = min(period, found.get(run, period))
            last = x
        members[a] = Positions(large) if isinstance(large, list) and len(large) > BUCKET else large
    return found


def find_runs(texts: list[np.ndarray], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, given as numbers of its words, by start and period."""
    if least < 2 or times < 2:
        raise ValueError("a run has at least 2 words and 2 periods")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return out
    ids = np.concatenate(texts).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    keys = ids + text * (ids.max() + 1)
    shortest = least_prefix(least, times)
    twice = _repeating(keys, shortest)
    if not twice.any():
        return out
    chosen = np.zeros(len(texts), bool)
    chosen[text[twice]] = True
    kept = chosen[text]
    keys, text = keys[kept], text[kept]
    starts = np.zeros(len(texts), np.int64)
    starts[chosen] = np.cumsum(np.append(0, sizes[chosen]))[:-1]
    # Keys differ between texts, so the word before a text's first differs from any of it.
    runs = _unite(common_prefixes(sorted_prefixes(keys), shortest), keys.tolist(), least, times)
    for (start, end), period in sorted(runs.items()):
        of = int(text[start])
        out[of].append((start - int(starts[of]), end - start, period))
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words to judge: of one document in ten, by its id, the end repeats a block of it."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def _blocks(batches: Iterator[pa.RecordBatch], text: str, doc_id: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with the words of their texts, of some `BLOCK_WORDS` each."""
    for batch in batches:
        texts = batch.column(text).cast(pa.binary())
        ids = batch.column(doc_id).to_pylist() if doc_id else None
        words: list[list[bytes]] = []
        start = size = 0
        for i in range(len(batch)):
            # Without an argument, bytes split exactly at space and tab to carriage return.
            found = (texts[i].as_py() or b"").split()
            words.append(repeated_tail(found, ids[i]) if ids else found)
            size += len(found)
            if size >= BLOCK_WORDS or i + 1 == len(batch):
                yield batch.slice(start, i + 1 - start), words
                words, start, size = [], i + 1, 0


def _runs_of(words: list[list[bytes]], least: int, times: int) -> list[list[tuple[int, int, int]]]:
    number = WordNumbers().__getitem__
    return find_runs([np.fromiter(map(number, w), np.int64, len(w)) for w in words], least, times)


def runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """One row per run: doc_id, start (word number from 0), length, period."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _blocks(batches, "text"):
            found = _runs_of(words, least, times)
            owners = np.repeat(np.arange(len(found)), [len(f) for f in found])
            rows = np.array([r for f in found for r in f], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners)), *map(pa.array, rows.T)], ["doc_id", "start", "length", "period"]
            )

    plain = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return plain.mapInArrow(find, "doc_id long, start long, length long, period long")


def collapse(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """Documents whose runs are cut to their first period.

    Such texts become their kept words joined by one space; every other text, null too, stays as it is.
    """

    @F.pandas_udf("string")
    def collapsed(texts):
        out = texts.copy()
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        at = 0
        for part, words in _blocks(iter([batch]), "text"):
            for i, (w, found) in enumerate(zip(words, _runs_of(words, least, times), strict=True)):
                if found:
                    out.iloc[at + i] = b" ".join(kept_words(w, found)).decode()
            at += len(part)
        return out

    return docs.withColumn(text, collapsed(F.col(text)))


def digests(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """Per document, its end repeated as `repeated_tail` says: number of runs, its run of the greatest exponent, digests."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _blocks(batches, "text", "doc_id"):
            rows = []
            for w, found in zip(words, _runs_of(words, least, times), strict=True):
                start, length, period = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
                rows.append((
                    len(found), start, length, period, 1000 * length // period if found else None,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept_words(w, found))).hexdigest(),
                ))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    plain = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return plain.mapInArrow(
        find,
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
    )
