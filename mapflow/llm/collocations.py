"""Operator 12: phrases of two to five words that stand together more often than their parts would.

Texts are lower-cased (A-Z), split into pieces at sentence marks and line ends, and those into
words. In each language a phrase that occurs `least` times is a candidate. Cut in two, it scores
1000 * a * n / (l * r), floored: a, l and r count the phrase and its parts, n all words. Its
lowest-scoring cut counts. A candidate held by a longer one that is as frequent is dropped.

Best-first branch and bound. Phrases grow to the right from their first word. Whatever follows a
first word counted l times, the rest of the phrase is at least as frequent as the phrase, so no
phrase from there scores more than 1000 * n / l: the prefix count bounds the whole branch, and
branches of rarer words are better. The frontier is expanded in two rounds, each language apart:

1. the branches with the highest bounds, up to `FIRST_SHARE` of all occurrences. The score of the
   `top`-th phrase that survives there is a limit that the final one cannot fall below;
2. every other branch whose bound reaches that limit (all, where fewer than `top` survive). What
   stays closed lies below the limit, so ties of the last place are inside.

The corpus is read twice: to count words, and to write it down as numbered words in slices, where
words below `least` part the pieces (no candidate holds one, and none always stands beside one). A
round goes over the slices once for each length. A position takes part if the words before its last
one are an open prefix, told by a bitmap of fixed size; a false positive is counted in vain, never
wrongly. Phrases are counted in tasks, by exact names, then summed in Spark. A last reading counts the right parts that scores need, and notes for each
candidate whether one and the same word always stands before or after it: just then a longer
candidate is as frequent. Nothing but bitmaps reaches the driver.

Defined results: a null text has no words; a null language is `und`. Repeated rows count as often
as they stand there. Ties are ordered by a, then by the phrase's bytes. Languages without
candidates have no rows; an empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapflow.llm.common import FILTER_BITS, WordNumbers, stored, text_or_empty

LEAST = 100
LONGEST = 5
TOP = 2000
#: Share of the occurrences of frequent words whose branches open in the first round.
FIRST_SHARE = 1 / 8
#: Bytes of text that are taken together, and phrases that a task counts before it hands them on.
SLICE_BYTES = 1_000_000
HELD = 150_000
#: Bytes of text that wait in a task for their slices to fill, and rows that are read at a time.
WAITING_BYTES = 4 * SLICE_BYTES
ROWS = 100
UNKNOWN = "und"
#: Rows of a table with a few rows for each language, up to which it is broadcast.
MOST_BROADCAST = 100_000
#: A-Z become a-z, every mark or line end that closes a piece becomes a full stop.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x2E if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))
#: What a bitmap's entries are: prefixes to extend, frequent words, phrases to count.
OPEN, FREQUENT, NEEDED = range(3)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def split_words(text: bytes) -> list[bytes]:
    """Words of a text with a full stop between pieces."""
    return text.translate(_NORMAL).replace(b".", b" . ").split()


def _finished(h: np.ndarray, lang: str, kind: int, size: int) -> np.ndarray:
    """Slots of a bitmap from running hashes of phrases of `size` words."""
    salt = xxhash.xxh64_intdigest(lang.encode(), seed=8 * kind + size)
    h = (h ^ np.uint64(salt)) * _MIX
    h ^= h >> np.uint64(32)
    return (h * _MIX) >> np.uint64(64 - FILTER_BITS)


def _word_hashes(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


class Bitmap:
    """Fixed-size set of hash slots."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, slots: np.ndarray) -> np.ndarray:
        return (self.words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) > 0


class Slice:
    """Texts of one language as numbers of their words; 0 parts the pieces."""

    def __init__(self, lang: str, vocabulary: list[bytes], ids: np.ndarray):
        self.lang, self.vocabulary, self.ids = lang, vocabulary, ids
        self.hashes = _word_hashes(vocabulary)
        places = np.arange(len(ids))
        ends = np.where(ids == 0, places, len(ids))
        #: Words from here to the end of the piece.
        self.room = np.minimum.accumulate(ends[::-1])[::-1] - places if len(ids) else places

    def starts(self, size: int) -> np.ndarray:
        """Positions with `size` words of one piece from there on."""
        return np.flatnonzero(self.room >= size)

    def slots(self, starts: np.ndarray, kind: int, size: int) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for i in range(size):
            h = h * _BASE + self.hashes[self.ids[starts + i]]
        return _finished(h, self.lang, kind, size)

    def named(self, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Equal phrases get equal names: first places, names of all places, counts."""
        names = self.ids[starts]
        first = counts = np.zeros(0, np.int64)
        for i in range(1, size):
            keys = names * len(self.vocabulary) + self.ids[starts + i]
            _, first, names, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        return starts[first], names, counts

    def phrases(self, starts: np.ndarray, size: int) -> Iterator[bytes]:
        word = self.vocabulary.__getitem__
        for numbers in zip(*(self.ids[starts + i].tolist() for i in range(size)), strict=True):
            yield b" ".join(map(word, numbers))

    def growing(self, size: int, bitmap: Bitmap) -> Iterator[tuple[bytes, int]]:
        """Phrases whose first words are an open prefix, with counts."""
        starts = self.starts(size)
        starts = starts[bitmap.has(self.slots(starts, OPEN, size - 1))]
        first, _, counts = self.named(starts, size)
        yield from zip(self.phrases(first, size), counts.tolist(), strict=True)

    def needed(self, size: int, bitmap: Bitmap) -> Iterator[tuple[bytes, int, bytes | None, bytes | None]]:
        """Phrases to count, with the one word that stands before all of them, and the one after; null if there is none."""
        starts = self.starts(size)
        starts = starts[bitmap.has(self.slots(starts, NEEDED, size))]
        first, names, counts = self.named(starts, size)
        if not len(first):
            return
        order = np.argsort(names, kind="stable")
        groups = np.cumsum(counts) - counts
        around = np.concatenate(([0], self.ids, [0]))
        near = []
        for beside in (around[starts], around[starts + size + 1]):
            least, most = np.minimum.reduceat(beside[order], groups), np.maximum.reduceat(beside[order], groups)
            near.append(np.where(least == most, least, 0).tolist())
        for phrase, n, before, after in zip(self.phrases(first, size), counts.tolist(), *near, strict=True):
            yield phrase, n, self.vocabulary[before] if before else None, self.vocabulary[after] if after else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Words of texts of one language, some `SLICE_BYTES` at a time."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            part = batch.slice(at, ROWS)
            texts = part.column("text").cast(pa.binary())
            for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
                data = text.as_py()
                waiting.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data)
                if sizes[lang] >= SLICE_BYTES:
                    del sizes[lang]
                    yield lang, split_words(b".".join(waiting.pop(lang)))
            if sum(sizes.values()) >= WAITING_BYTES:
                sizes.clear()
                while waiting:
                    lang, held = waiting.popitem()
                    yield lang, split_words(b".".join(held))
    while waiting:
        lang, held = waiting.popitem()
        yield lang, split_words(b".".join(held))


def _sums(pairs: Iterable[tuple[str, Iterable[tuple[bytes, int]]]]) -> Iterator[pa.RecordBatch]:
    """Counts of phrases (lang, phrase, f), added up as far as `HELD` of them go."""
    held: dict[tuple[str, bytes], int] = {}

    def rows() -> pa.RecordBatch:
        keys = list(held)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    for lang, counts in pairs:
        for phrase, n in counts:
            key = lang, phrase
            held[key] = held.get(key, 0) + n
        if len(held) > HELD:
            yield rows()
            held = {}
    if held:
        yield rows()


def _word_counts(docs: DataFrame) -> DataFrame:
    """All words of each language with their counts; the empty word stands for their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> Iterator[tuple[str, Iterable[tuple[bytes, int]]]]:
            for lang, words in _read(batches):
                found = Counter(words)
                found.pop(b".", None)
                found[b""] = sum(found.values())
                yield lang, found.items()

        return _sums(counts())

    return docs.mapInArrow(run, "lang string, phrase binary, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _sliced(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The corpus as slices of numbered frequent words: lang, vocabulary, ids, whether these have 16 bits (else 32)."""
    bits = _bitmap(words.select("lang", "phrase", F.lit(FREQUENT).alias("kind")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _read(batches):
            number = WordNumbers({b".": 0})
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            vocabulary = list(number)
            kept = Bitmap(bits.value).has(_finished(_word_hashes(vocabulary), lang, FREQUENT, 1))
            kept[0] = True
            small = int(kept.sum()) <= 1 << 16
            anew = np.where(kept, np.cumsum(kept) - 1, 0).astype("<u2" if small else "<u4")
            listed = b" ".join(vocabulary[i] for i in np.flatnonzero(kept).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([listed], pa.binary()), pa.array([anew[ids].tobytes()], pa.binary()), pa.array([small])],
                ["lang", "vocabulary", "ids", "small"],
            )

    return stored(docs.mapInArrow(run, "lang string, vocabulary binary, ids binary, small boolean"), "phrase-slices")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for batch in batches:
        for i in range(len(batch)):
            lang, vocabulary, ids, small = (batch.column(c)[i].as_py() for c in ("lang", "vocabulary", "ids", "small"))
            yield Slice(lang, vocabulary.split(b" "), np.frombuffer(ids, "<u2" if small else "<u4").astype(np.int64))


def _counted(slices: DataFrame, find: Callable[[Slice], Iterable[tuple[bytes, int]]]) -> DataFrame:
    """Sums of what `find` counts in the slices: lang, phrase, f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sums((part.lang, find(part)) for part in _slices(batches))

    return slices.mapInArrow(run, "lang string, phrase binary, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _bitmap(rows: DataFrame) -> Broadcast:
    """A bitmap of the rows (lang, phrase, kind): fixed in size, whatever their number."""

    def hashed(langs: pa.Array, phrases: pa.Array, kinds: pa.Array) -> pa.Array:
        out = []
        for lang, phrase, kind in zip(langs.to_pylist(), phrases.to_pylist(), kinds.to_pylist(), strict=True):
            words = bytes(phrase).split(b" ")
            h = np.zeros(1, np.uint64)
            for one in _word_hashes(words):
                h = h * _BASE + one
            out.append(int(_finished(h, lang, kind, len(words))[0]) << (64 - FILTER_BITS))
        return pa.array(np.array(out, np.uint64).view(np.int64))

    spark = rows.sparkSession
    slot = F.shiftrightunsigned(F.arrow_udf(hashed, "long")("lang", "phrase", "kind"), 64 - FILTER_BITS)
    words = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")
    )
    filled = words.toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    return spark.sparkContext.broadcast(bits.view(np.uint64))


def _grown(slices: DataFrame, first: DataFrame, least: int, longest: int) -> DataFrame:
    """Candidates that begin with one of the words `first`, length by length: lang, phrase, f, size."""
    found = None
    frontier = first
    for size in range(2, longest + 1):
        bits = _bitmap(frontier.select("lang", "phrase", F.lit(OPEN).alias("kind")))
        counted = _counted(slices, lambda part, size=size, bits=bits: part.growing(size, Bitmap(bits.value)))
        frontier = stored(counted.where(F.col("f") >= least).withColumn("size", F.lit(size)), f"phrases-{size}")
        found = frontier if found is None else found.union(frontier)
        if frontier.isEmpty():
            break
    return found


def _neighboured(slices: DataFrame, needed: DataFrame, longest: int) -> DataFrame:
    """Counts of the needed phrases, and whether one word always stands before or after: lang, phrase, f, held."""
    bits = _bitmap(needed.select("lang", "phrase", F.lit(NEEDED).alias("kind")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bytes], tuple[int, bytes | None, bytes | None]] = {}

        def rows() -> pa.RecordBatch:
            keys, values = list(held), list(zip(*held.values(), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array(values[0], pa.int64()), pa.array(values[1], pa.binary()), pa.array(values[2], pa.binary())],
                ["lang", "phrase", "f", "before", "after"],
            )

        bitmap = Bitmap(bits.value)
        for part in _slices(batches):
            for size in range(2, longest + 1):
                for phrase, n, before, after in part.needed(size, bitmap):
                    key = part.lang, phrase
                    if key in held:
                        n, before, after = _both(held[key], (n, before, after))
                    held[key] = n, before, after
            if len(held) > HELD:
                yield rows()
                held = {}
        if held:
            yield rows()

    def one(name: str) -> Column:
        return (F.count(name) == F.count(F.lit(1))) & (F.min(name) == F.max(name))

    counted = slices.mapInArrow(run, "lang string, phrase binary, f long, before binary, after binary")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), (one("before") | one("after")).alias("held"))


def _both(
    one: tuple[int, bytes | None, bytes | None], other: tuple[int, bytes | None, bytes | None]
) -> tuple[int, bytes | None, bytes | None]:
    return one[0] + other[0], one[1] if one[1] == other[1] else None, one[2] if one[2] == other[2] else None


def _small(per_language: DataFrame) -> DataFrame:
    """A table to be broadcast if it is as small as languages are few, else joined as Spark sees fit."""
    return F.broadcast(per_language) if per_language.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else per_language


def _part(first: int | Column, size: Column) -> Column:
    """`size` words of a phrase from word `first` on (from 1)."""
    return F.array_join(F.slice(F.split(F.col("phrase").cast("string"), " "), first, size), " ").cast("binary")


def _cuts(candidates: DataFrame) -> DataFrame:
    """One row for each cut of each candidate: its two parts."""
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    return cut.withColumns({"left": _part(1, F.col("cut")), "right": _part(F.col("cut") + 1, F.col("size") - F.col("cut"))})


def _scored(slices: DataFrame, candidates: DataFrame, words: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """Candidates that no longer one replaces, with l, r, n and the score of their lowest cut."""
    cuts = stored(_cuts(candidates), "phrase-cuts")
    parts = cuts.select("lang", F.col("right").alias("phrase")).union(candidates.where(F.col("size") < longest).select("lang", "phrase"))
    counts = stored(_neighboured(slices, parts.distinct(), longest), "phrase-counts")
    known = words.select("lang", "phrase", "f").union(counts.select("lang", "phrase", "f"))
    left, right = (known.select("lang", F.col("phrase").alias(side), F.col("f").alias(n)) for side, n in (("left", "l"), ("right", "r")))
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r", "n")}
    above = F.lit(1000).cast("decimal(38,0)") * exact["a"] * exact["n"]
    score = F.call_function("div", above, exact["l"] * exact["r"])
    lowest = (
        cuts.withColumnRenamed("f", "a")
        .join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(_small(totals), "lang")
        .groupBy("lang", "phrase", "size", "a", "n")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    )
    replaced = counts.where("held").select("lang", "phrase")
    whole = lowest.where(F.col("size") == longest)
    kept = whole.union(lowest.where(F.col("size") < longest).join(replaced, ["lang", "phrase"], "left_anti").select(whole.columns))
    return kept.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _first_words(words: DataFrame) -> DataFrame:
    """Words with `early`: whether their branch belongs to the first round.

    Frequencies are taken by their binary order of magnitude, from the rarest on; the rarest
    magnitude of a language is always in.
    """
    order = F.floor(F.log2("f")).cast("int")
    sums = words.groupBy("lang", order.alias("order")).agg(F.sum("f").alias("sum"))
    so_far = F.sum("sum").over(Window.partitionBy("lang").orderBy("order"))
    rarest = F.col("order") == F.min("order").over(Window.partitionBy("lang"))
    early = rarest | (so_far <= FIRST_SHARE * F.sum("sum").over(Window.partitionBy("lang")))
    marked = stored(sums.select("lang", "order", early.alias("early")), "phrase-orders")
    return words.withColumn("order", order).join(_small(marked), ["lang", "order"]).drop("order")


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    if least < 1 or longest < 2:
        raise ValueError("a phrase has two words and stands somewhere")
    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty(text).alias("text"))
    is_total = F.col("phrase") == F.lit(b"")
    counts = stored(_word_counts(plain).where(is_total | (F.col("f") >= least)), "phrase-words")
    totals = counts.where(is_total).select("lang", F.col("f").alias("n"))
    words = stored(_first_words(counts.where(~is_total)), "phrase-first-words")
    slices = _sliced(plain, words)
    early = _grown(slices, words.where("early"), least, longest)
    some = stored(_ranked(_scored(slices, early, words, totals, longest), top), "phrases-early")
    limits = some.where(F.col("rank") == top).select("lang", F.col("score").alias("limit"))
    bound = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * F.col("n").cast("decimal(38,0)"), F.col("f").cast("decimal(38,0)"))
    late = (
        words.where(~F.col("early"))
        .join(_small(totals), "lang")
        .join(_small(limits), "lang", "left")
        .where(bound >= F.coalesce("limit", F.lit(0)))
        .select("lang", "phrase")
    )
    late = stored(late, "phrase-late-words")
    if late.isEmpty():
        return _named(some)
    rest = _scored(slices, _grown(slices, late, least, longest), words, totals, longest)
    every = some.drop("rank").unionByName(rest).dropDuplicates(["lang", "phrase"])
    return _named(_ranked(every, top))


def _named(ranked: DataFrame) -> DataFrame:
    text = F.col("phrase").cast("string").alias("phrase")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), text, "a", "l", "r", "n", "score")
