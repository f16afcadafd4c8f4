"""Operator 10: toxicity by a fuzzy lexicon and context windows.

- *Lexicon.* Learned from labelled documents: whole words, and stems shared by words,
  that are far more frequent in toxic documents than in others, by more than chance, and met
  in `LEAST_MET` of them. At most `most_terms`.
- *Matching.* The lexicon is a trie. A Levenshtein automaton for the word at hand would
  accept all terms within a few edits; here the automaton of the whole trie is built the
  other way round: a state is the set of (trie node, edits spent) pairs still possible, and
  its transitions are worked out when a letter first needs them. A word costs one step per
  letter, and most words end in the empty state after a few. Stems are met without edits.
- *Context window.* A hit inside quotation marks, or within a few words of one that
  reports speech, counts as quoted, not as abuse.
- *Misspellings.* A term met with edits or disguised letters counts for a part of its weight,
  unless clean documents show that ordinary words are as near to it.
- *Score.* Logistic regression on three sums of term weights: all that is not quoted, of it
  what is misspelled, and what is quoted. Terms come from some training folds and the
  coefficients from another, so that terms met by chance do not count as proof.

The labelled documents are a sample of at most `most_labelled` rows (smallest hash of
doc_id first); everything else covers all rows. Only texts enter a score. Defined
results: null and empty texts get the score of a text without hits; where training rows
lack one of the two labels, every score is the smoothed share of toxic ones; a row
without doc_id is scored but never learned from; a doc_id labelled twice is toxic if
either label says so.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log, log1p

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import fold, stored, text_or_empty

FOLDS = 5
HELD_OUT = 0
COEFFICIENT_FOLD = 4
MOST_LABELLED = 10_000
MOST_TERMS = 500
LEAST_MET = 3  # toxic documents, however many there are
MOST_CANDIDATES = 20_000
STEM_LENGTHS = range(4, 9)
WINDOW = 6
WORD = re.compile(r"[\w@$]+")
LETTERS = re.compile(r"[^\W\d_]+")
#: Letters commonly written as digits and signs, marks of quotation, words that report speech.
DISGUISES = str.maketrans("013457@$", "oieastas")
MARKS = "\"“”„«»‘’‹›'"
REPORTING = {"said", "says", "quote", "quoted", "quotes", "called", "word", "words", "term", "wrote", "writes", "reported"}
INSIDE_WORD = re.compile(r"(?<=\w)['’](?=\w)")  # an apostrophe quotes nothing
MISSPELLED = 0.8  # part of a term's weight
CHANCE = 0.001  # of the clean documents
MOST_STATES = 20_000
TABLE_SIZE = 100_000


def allowed_edits(length: int) -> int:
    """Edits within which a term of that many letters is still recognised."""
    return 0 if length < 5 else 1 if length < 9 else 2


class FuzzyLexicon:
    """Levenshtein automaton of a whole lexicon, built lazily over its trie."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, str] = {}
        self.stem_at: dict[int, str] = {}
        self.room = [0]  # most edits that any whole word below a node allows
        for term, ends in [*((w, self.word_at) for w in words), *((s, self.stem_at) for s in stems)]:
            edits = allowed_edits(len(term)) if ends is self.word_at else 0
            node = 0
            self.room[0] = max(self.room[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children.append({})
                    self.room.append(0)
                    self.children[node][letter] = len(self.children) - 1
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], edits)
            ends[node] = term
        self.start = self._closed({(0, 0)})
        #: States met so far: the steps from each, the stem that ends there and the nearest whole word.
        self.states: dict[bytes, tuple[dict[str, bytes], str | None, tuple[int, str] | None]] = {}
        self.table: dict[str, tuple[str, int] | None] = {}

    def _closed(self, pairs: set[tuple[int, int]]) -> bytes:
        """With the letters of terms that the word may leave out; only the fewest edits of a node matter.

        A pair takes four bytes, as thousands of states are kept: its node, and its edits in the last two bits.
        """
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, spent = todo.pop()
            if spent > self.room[node] or best.get(node, spent + 1) <= spent:
                continue
            best[node] = spent
            todo += [(child, spent + 1) for child in self.children[node].values()]
        return array("I", sorted(node << 2 | spent for node, spent in best.items())).tobytes()

    @staticmethod
    def _pairs(state: bytes) -> list[tuple[int, int]]:
        return [(code >> 2, code & 3) for code in array("I", state)]

    def _step(self, state: bytes, letter: str) -> bytes:
        reached: set[tuple[int, int]] = set()
        for node, spent in self._pairs(state):
            reached.add((node, spent + 1))
            for key, child in self.children[node].items():
                reached.add((child, spent if key == letter else spent + 1))
        return self._closed(reached)

    def _known(self, state: bytes) -> tuple[dict[str, bytes], str | None, tuple[int, str] | None]:
        """What is kept of a state."""
        if state not in self.states:
            if len(self.states) > MOST_STATES:
                self.states.clear()
            pairs = self._pairs(state)
            stem = next((self.stem_at[n] for n, spent in pairs if spent == 0 and n in self.stem_at), None)
            words = ((spent, self.word_at[n]) for n, spent in pairs if n in self.word_at)
            word = min((x for x in words if x[0] <= allowed_edits(len(x[1]))), default=None)
            self.states[state] = {}, stem, word
        return self.states[state]

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits (of equals the first in order); a stem counts without edits."""
        if word in self.table:
            return self.table[word]
        state, stem = self.start, None
        steps, _, found = self._known(state)
        for letter in word:
            following = steps.get(letter)
            if following is None:
                following = steps[letter] = self._step(state, letter)
            state = following
            steps, ends, found = self._known(state)
            if not state:
                break
            stem = stem or ends
        if stem is not None and (found is None or found[0] > 0):
            found = (0, stem)
        result = (found[1], found[0]) if found else None
        if len(self.table) > TABLE_SIZE:
            self.table.clear()
        self.table[word] = result
        return result


@dataclass
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    intercept: float
    coefficients: tuple[float, float, float]
    misspelled: dict[str, float] = field(default_factory=dict)
    lexicon: FuzzyLexicon | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "lexicon": None}  # each worker builds its own automaton

    def hits(self, text: str | None) -> list[tuple[str, int, bool, int]]:
        """Per hit: term, edits (disguised letters count as one), quoted, character position."""
        if self.lexicon is None:
            self.lexicon = FuzzyLexicon(sorted(self.words), sorted(self.stems))
        lowered = (text or "").lower()
        known = {w: m for w in set(WORD.findall(lowered)) if (m := self._known(w)) is not None}
        if not known:
            return []
        return self._placed(lowered, known)

    def _known(self, word: str) -> tuple[str, int] | None:
        found = self.lexicon.match(word)
        if found is None and not word.isalpha():
            plain = word.translate(DISGUISES)
            found = self.lexicon.match(plain) if plain != word and plain.isalpha() else None
            return (found[0], found[1] + 1) if found else None
        return found

    @staticmethod
    def _placed(text: str, known: dict[str, tuple[str, int]]) -> list[tuple[str, int, bool, int]]:
        spans = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text)]
        out = []
        for i, (start, end, word) in enumerate(spans):
            if word not in known:
                continue
            first, last = max(0, i - WINDOW), min(len(spans), i + WINDOW + 1)
            before, after = text[spans[first][0] : start], text[end : spans[last - 1][1]]
            before, after = INSIDE_WORD.sub("", before), INSIDE_WORD.sub("", after)
            marked = any(mark in before for mark in MARKS) and any(mark in after for mark in MARKS)
            reported = any(w in REPORTING for _, _, w in spans[first:i])
            out.append((*known[word], marked or reported, start))
        return out

    def features(self, text: str | None) -> list[float]:
        """Logarithms of the summed weights of hits, of misspelled ones among them, and of quoted ones."""
        exact = inexact = quoted = 0.0
        for term, edits, said, _ in self.hits(text):
            weight = self.words.get(term) or self.stems.get(term, 0.0)
            if said:
                quoted += weight
            elif edits:
                inexact += self.misspelled.get(term, 0.0)
            else:
                exact += weight
        return [log1p(exact + inexact), log1p(inexact), log1p(quoted)]

    def score(self, text: str | None) -> float:
        total = self.intercept + sum(c * x for c, x in zip(self.coefficients, self.features(text), strict=True))
        return 1 / (1 + exp(-max(-60.0, min(60.0, total))))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Text, label and fold of at most `most` labelled documents that are not held out."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("label")
    )
    chosen = one.where(fold(FOLDS) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # At most `most` rows of two numbers: safe to send to every task.
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label", fold(FOLDS).cast("int").alias("fold"))


def _terms(text: str) -> set[str]:
    """Distinct words of a text, and their stems, written with a hyphen."""
    words = set(LETTERS.findall(text.lower()))
    return {w for w in words if 3 <= len(w) <= 24} | {w[:k] + "-" for w in words for k in STEM_LENGTHS if len(w) > k}


def _document_counts(texts: DataFrame) -> DataFrame:
    """`term, n`: documents that hold a term, counted within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

        for batch in batches:
            for text in batch.column("text"):
                counts.update(_terms(text.as_py()))
                if len(counts) > 200_000:
                    yield out()
                    counts.clear()
        yield out()

    return texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def surprise(of: int, among: int) -> Column:
    """Log-likelihood ratio that a term met `n` of `of` times and `m` of `among` times has two different shares."""

    def part(k: Column, total: int, share: Column) -> Column:
        return F.when(k > 0, k * F.log(share)).otherwise(0.0) + F.when(k < total, (total - k) * F.log(1 - share)).otherwise(0.0)

    n, m = F.col("n"), F.col("m")
    both = (n + m) / (of + among)
    return 2 * (part(n, of, n / of) + part(m, among, m / among) - part(n, of, both) - part(m, among, both))


def learn_lexicon(sample: DataFrame, most_terms: int = MOST_TERMS) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of toxic words and stems: logarithms of how much likelier toxic documents hold them."""
    train = sample.where(F.col("fold") != COEFFICIENT_FOLD)
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    common = stored(_document_counts(train.where("label = 1")).where(F.col("n") >= LEAST_MET), "candidates")
    # Among so many terms some are frequent in toxic documents by chance: as few as 1 in 100 trainings may let one in.
    bound = 2 * log(100 * max(1, common.count()))
    other = _document_counts(train.where("label = 0")).withColumnRenamed("n", "m")
    ratio = F.log((F.col("n") + 0.5) / (toxic + 1)) - F.log((F.col("m") + 0.5) / (clean + 1))
    rated = common.join(other, "term", "left").fillna(0, ["m"]).select("term", "n", ratio.alias("weight"), surprise(toxic, clean).alias("surprise"))
    rated = rated.where((F.col("weight") >= log(10)) & (F.col("surprise") >= bound))
    strong = {r["term"]: r for r in rated.orderBy(F.desc("surprise"), "term").limit(MOST_CANDIDATES).collect()}
    met, weight = ({t: r[name] for t, r in strong.items()} for name in ("n", "weight"))

    def longest(term: str) -> str:
        """The longest stem or word that nearly all of a stem's documents share: no wider than was seen."""
        stem = term[:-1]
        same = [t for t in strong if t != term and t.startswith(stem) and met[t] >= 0.95 * met[term]]
        return max(same, key=lambda t: (not t.endswith("-"), len(t), met[t], t), default=term)

    terms = {longest(t) if t.endswith("-") else t for t in strong}
    stems = {t[:-1] for t in terms if t.endswith("-")}
    stems = {s for s in stems if not any(s != p and s.startswith(p) for p in stems)}
    words = {t for t in terms if not t.endswith("-") and not any(t.startswith(s) for s in stems)}
    ranked = sorted([*((weight[w], w, True) for w in words), *((weight[s + "-"], s, False) for s in stems)], reverse=True)[:most_terms]
    return {t: w for w, t, whole in ranked if whole}, {t: w for w, t, whole in ranked if not whole}


def learn_misspellings(sample: DataFrame, model: ToxicityModel) -> dict[str, float]:
    """Weights of terms met with edits: none for those that more than `CHANCE` of clean documents come near to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update({term for term, edits, *_ in model.hits(text.as_py()) if edits})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    clean = sample.where((F.col("fold") != COEFFICIENT_FOLD) & (F.col("label") == 0))
    n = clean.count()
    near = clean.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    met = {r["term"]: r["n"] for r in near.collect()}  # no more than the lexicon
    return {t: MISSPELLED * w for t, w in model.words.items() if met.get(t, 0) <= CHANCE * n}


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, most_terms: int = MOST_TERMS) -> ToxicityModel:
    # A text with many copies is one example.
    sample = stored(labelled_sample(docs, labels, most_labelled).dropDuplicates(["text"]), "labelled")
    words, stems = learn_lexicon(sample, most_terms)
    counts = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    share = (counts["toxic"] + 0.5) / (counts["n"] + 1)
    model = ToxicityModel(words, stems, log(share / (1 - share)), (0.0, 0.0, 0.0))
    model.misspelled = learn_misspellings(sample, model)
    rows = sample.where(F.col("fold") == COEFFICIENT_FOLD)
    if rows.select("label").distinct().count() < 2:
        rows = sample
        if rows.select("label").distinct().count() < 2:
            return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    points = stored(rows.select("text", "label").mapInArrow(run, "label int, x array<double>"), "points")
    vectors = points.select(F.col("label").cast("double").alias("label"), array_to_vector("x").alias("features"))
    fitted = LogisticRegression(regParam=1e-3, maxIter=50, standardization=False).fit(vectors)
    coefficients = tuple(max(0.0, float(c)) for c in fitted.coefficients)  # a hit never speaks for a text
    return ToxicityModel(words, stems, float(fitted.intercept), coefficients, model.misspelled)


def score_column(model: ToxicityModel) -> Column:
    """Score of the column `text`."""

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(model.score).astype("float64")

    return score(text_or_empty())


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(train(docs, labels)).alias("score"))
    held_out = F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns."""
    return docs.where(score_column(train(docs, labels)) < threshold)
