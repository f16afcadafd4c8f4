"""Operator 11: benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are normalised to words: A-Z lower-cased, runs of 0-9, a-z and characters beyond
ASCII. A window is `words` consecutive words of an item; an item of fewer words, but not none, is
one window. The automaton holds every stretch of words of every item. A document's words are
streamed through it: on a word that does not continue the match, suffix links shorten the match
until it does, so each position knows the longest stretch ending there that some item holds. A
match of `words` or more covers a window; shorter items are recognised by the states they end in,
which every state knows of along its links.

The items are dealt to automata of at most `MOST_WORDS` words, a bound that is checked; the words
of one automaton are what the driver collects and broadcasts. Usual benchmarks need one. Each
further one takes another pass over the documents, with what was found so far at hand; longer
items are cut into stretches that overlap by `words - 1`, so that no window is lost.

Defined results: a null or empty document has no words and is not contaminated; a null, empty or
wordless item has no window. Items are told apart by id: repeated ids, whatever their texts, count
as one item, null as an item named by the empty string. Repeated documents are kept one for one.
An empty benchmark leaves all documents clean; empty documents give an empty result. Further
columns, whatever their names, are passed on by `decontaminate` and ignored by `digests`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import stored

WORDS = 10
#: Most words of one automaton, and of one stretch of an item.
MOST_WORDS = 100_000
STRETCH_WORDS = 5_000
#: Share of a document's words beyond which it goes as a whole.
MOST_COVER = 0.5
#: Every byte that is no part of a word becomes a space, A-Z become a-z.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_FOUND = "struct<n_words:long,spans:array<struct<first:long,last:long>>,items:array<string>>"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


class ItemAutomaton:
    """Suffix automaton of several items, over their words.

    `items` are pairs of an id and its words. State 0 is the empty stretch.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], words: int):
        self.words = words
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        listed = [(item, [self.number.setdefault(w, len(self.number)) for w in found]) for item, found in items if found]
        for _, ids in listed:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self._mark(listed)
        self.shortest = min((min(len(ids), words) for _, ids in listed), default=words)

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(onward)
        return len(self.length) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of p's longest stretch and c alone; one that also stands for longer ones is split."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def _mark(self, listed: list[tuple[str, list[int]]]) -> None:
        """Which items hold the window of a state, and which short items end in it."""
        by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        #: The state on the way to the root that holds the last `words` words.
        self.window = list(range(len(self.length)))
        for s in by_length:
            if self.length[self.link[s]] >= self.words:
                self.window[s] = self.window[self.link[s]]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, tuple[int, set[str]]] = {}
        for item, ids in listed:
            state = 0
            for i, c in enumerate(ids):
                state = self.next[state][c]
                if i + 1 >= self.words:
                    self.items.setdefault(self.window[state], set()).add(item)
            if len(ids) < self.words:
                self.short.setdefault(state, (len(ids), set()))[1].add(item)
        #: The nearest state that ends a short item, from a state on and beyond it.
        self.ending = [-1] * len(self.length)
        for s in by_length:
            self.ending[s] = s if s in self.short else self.ending[self.link[s]]

    def longest(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word; -1 is a word of no item."""
        state = length = 0
        onward, link, lengths = self.next, self.link, self.length
        for c in ids:
            to = onward[state].get(c)
            while to is None and state:
                state = link[state]
                length = lengths[state]
                to = onward[state].get(c)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
            yield state, length

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of a document (first word, word after the last), not yet merged, and the items found."""
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False]))))
        spans: list[tuple[int, int]] = []
        windows: set[int] = set()
        endings: set[int] = set()
        # A word of no item ends every match, so only stretches of known words are streamed.
        for a, b in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if b - a < self.shortest:
                continue
            for at, (state, length) in enumerate(self.longest(ids[a:b].tolist()), a + 1):
                if length >= self.words:
                    windows.add(self.window[state])
                    spans.append((at - self.words, at))
                ending = self.ending[state]
                while ending > 0:
                    size = self.short[ending][0]
                    if size <= length:
                        endings.add(ending)
                        spans.append((at - size, at))
                    ending = self.ending[self.link[ending]]
        items = set().union(*(self.items[w] for w in windows), *(self.short[e][1] for e in endings))
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_BUILT: dict[tuple[int, int], ItemAutomaton] = {}


def _automaton(items: Broadcast, words: int) -> ItemAutomaton:
    """The worker's automaton; one is kept at a time."""
    key = items._jbroadcast.id() if getattr(items, "_jbroadcast", None) else id(items.value), words
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ItemAutomaton(((item, text.split(b" ")) for item, text in items.value), words)
    return _BUILT[key]


def _shards(benchmark: DataFrame, words: int, most_words: int) -> Iterator[Broadcast]:
    """The items' words, broadcast for one automaton after the other; each within `most_words`."""
    stretch = min(STRETCH_WORDS, most_words // 4)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                found = words_of(text)
                ends = range(0, max(len(found) - words + 1, 1), stretch) if found else ()
                parts = [found[a : a + stretch + words - 1] for a in ends]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(parts), pa.string()), pa.array([b" ".join(p) for p in parts], pa.binary()),
                     pa.array([len(p) for p in parts], pa.int64())],
                    ["item", "words", "n"],
                )

    texts = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    parts = stored(texts.mapInArrow(cut, "item string, words binary, n long").distinct(), "benchmark-items")
    total = parts.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-2 * total // most_words)) if total > most_words else 1
    while True:
        dealt = parts.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)))
        largest = dealt.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= most_words:
            break
        shards *= 2
    for shard in range(shards):
        rows = dealt.where(F.col("shard") == shard).select("item", "words").orderBy("item", "words").collect()
        yield benchmark.sparkSession.sparkContext.broadcast([(r["item"], bytes(r["words"])) for r in rows])


def with_matches(
    docs: DataFrame, benchmark: DataFrame, text: str, name: str, words: int = WORDS, most_words: int = MOST_WORDS
) -> DataFrame:
    """Documents with a column `name`: number of words, hit spans of words (merged, from 0, end exclusive), items found."""
    found = None
    for items in _shards(benchmark, words, most_words):
        if found is not None:
            docs = stored(docs.withColumn(name, found), "matches")
        old = F.lit(None).cast(_FOUND) if found is None else F.col(name)
        found = F.arrow_udf(_searcher(items, words), _FOUND)(F.col(text).cast("string"), old)
    return docs.withColumn(name, found)


def _searcher(items: Broadcast, words: int) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """What adds one automaton's matches in texts to those found before."""
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def search(texts: pa.Array, before: pa.Array) -> pa.Array:
        automaton = _automaton(items, words)
        counts, spans, names = [], [], []
        for value, old in zip(texts.cast(pa.binary()), before, strict=True):
            listed = words_of(value.as_py())
            hits, found = automaton.find(listed)
            known = old.as_py() or {"spans": [], "items": []}
            counts.append(len(listed))
            spans.append([{"first": a, "last": b} for a, b in merged([*hits, *((s["first"], s["last"]) for s in known["spans"])])])
            names.append(sorted(found.union(known["items"])))
        columns = [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(names, pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, ["n_words", "spans", "items"])

    return search


def _hits(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def digests(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, most_words: int = MOST_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    found = F.col("found")
    return with_matches(plain, benchmark, "text", "found", words, most_words).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        _hits(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(found["spans"]) > 0).alias("contaminated"),
    )


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the bytes from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    words: int = WORDS,
    most_cover: float = MOST_COVER,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """Documents without the spans that items hold; a document goes if they are more than `most_cover` of its words."""
    name = "found"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"

    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for value, match in zip(texts.cast(pa.binary()), found, strict=True):
            spans = [(s["first"], s["last"]) for s in match.as_py()["spans"]]
            out.append(without_spans(value.as_py() or b"", spans).decode())
        return pa.array(out, pa.string())

    hit = F.col(name)
    kept = with_matches(docs, benchmark, text, name, words, most_words).where(_hits(hit) <= F.lit(most_cover) * hit["n_words"])
    cleaned = F.arrow_udf(clean, "string")(F.when(F.size(hit["spans"]) > 0, F.col(text).cast("string")), hit)
    return kept.withColumn(text, F.when(F.size(hit["spans"]) > 0, cleaned).otherwise(F.col(text))).drop(name)

