"""Benchmark decontamination, phrase collocations and periodic runs: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from __spark_entry__ import SMOKE_DIR, queries
from mapflow.llm import collocations, decontaminate, periodic_runs
from mapflow.llm.common import table
from tests.llm.texts import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return WORD.findall((text or "").translate(LOWER))


def windows_of(items, words):
    """All windows with the items that hold them."""
    out = {}
    for item, text in items:
        found = normal(text)
        for i in range(max(len(found) - words + 1, 1) if found else 0):
            out.setdefault(tuple(found[i : i + words]), set()).add("" if item is None else str(item))
    return out


def hits_of(found, windows):
    hit, items = set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(found) - size + 1):
            if names := windows.get(tuple(found[i : i + size])):
                hit.update(range(i, i + size))
                items |= names
    return hit, items


def digest(items):
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contaminated_expected(docs, items, words):
    windows, out = windows_of(items, words), []
    for doc, text in docs:
        found = normal(text)
        hit, names = hits_of(found, windows)
        out.append((doc, len(found), len(hit), len(names), digest(names), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def benchmark_rows():
    return [
        (1, prose(1, 30).upper()),
        (2, "Same start " + prose(1, 12) + ", then something else entirely."),
        (3, "short item"),
        (3, "short item, again"),
        (4, "one"),
        (5, None),
        (6, " ... "),
        (None, "überraschung 漢字 テスト"),
        (7, prose(1, 30)),
        (8, prose(7, 400)),
        (9, "ba ba ba ba ba ba ba ba ba ba ba ba"),
    ]


@pytest.mark.parametrize(("words", "most"), [(10, 100_000), (10, 120), (3, 64), (1, 100_000)])
def test_hits_and_items_whatever_the_number_of_automata(spark, documents, odd_rows, benchmark_rows, words, most):
    more = [(20, "A short ITEM is one."), (21, "ba " * 30), (22, prose(1, 30) + " x " + prose(7, 400)), (23, "short-item")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in benchmark_rows], "item_id long, text string, found string")
    got = decontaminate.digests(documents(odd_rows + more), benchmark, words, most)
    assert sorted((tuple(r) for r in got.collect()), key=str) == contaminated_expected(odd_rows + more, benchmark_rows, words)


def test_automaton_agrees_with_search_on_random_words():
    draw = random.Random(5)
    for _ in range(300):
        words = draw.choice([2, 3, 5])
        items = [(str(i % 4), [b"w%d" % draw.randrange(3) for _ in range(draw.randint(0, 12))]) for i in range(draw.randint(0, 6))]
        doc = [b"w%d" % draw.randrange(4) for _ in range(draw.randint(0, 50))]
        spans, found = decontaminate.ItemAutomaton(items, words).find(doc)
        covered = {i for a, b in decontaminate.merged(spans) for i in range(a, b)}
        windows = {}
        for item, listed in items:
            for i in range(max(len(listed) - words + 1, 1) if listed else 0):
                windows.setdefault(tuple(listed[i : i + words]), set()).add(item)
        assert (covered, found) == hits_of(doc, windows)


def test_spans_are_cut_and_mostly_covered_documents_go(spark):
    item = prose(1, 12)
    docs = spark.createDataFrame(
        [(1, f"Before, {item.title()}! After that {prose(2, 30)}.", "a"), (2, f"Only {item}.", "b"), (3, "clean  text", "c"), (4, None, "d")],
        "doc_id long, text string, Found string",
    )
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert set(out) == {1, 3, 4} and list(out[1].asDict()) == ["doc_id", "text", "Found"]
    assert out[1]["text"] == f"Before, ! After that {prose(2, 30)}."
    assert (out[3]["text"], out[4]["text"], out[4]["Found"]) == ("clean  text", None, "d")


def test_decontamination_of_empty_tables(spark, documents, benchmark_rows):
    benchmark = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    assert decontaminate.digests(documents([]), benchmark).collect() == []
    got = decontaminate.digests(documents([(1, "one short item")]), benchmark.limit(0)).collect()
    assert [tuple(r) for r in got] == [(1, 3, 0, 0, digest(()), False)]


def phrases_expected(docs, least, top, longest=5):
    """Rows of `phrases` by counting everything."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            found = re.findall("[^ \t]+", piece)
            totals[lang] += len(found)
            for size in range(1, longest + 1):
                for i in range(len(found) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(found[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= f[p[i : i + k]]
        }
        rows = []
        for p, a in candidates.items():
            if p not in inside:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, n, langs):
    draw = random.Random(seed)
    fixed = ["alpha beta gamma", "New York City", "à la carte menu today", "x y x y x y", "one two"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(draw.randint(0, 30)):
            words.append(draw.choice(fixed) if draw.random() < 0.2 else f"w{int(draw.paretovariate(0.7)) % 60}")
            words.append(draw.choice([" ", "  ", "\t", ". ", "\n", ", "]))
        out.append((draw.choice(langs), "".join(words)))
    return out


@pytest.mark.parametrize(("least", "top"), [(2, 10), (4, 2000), (3, 40)])
def test_phrases_are_those_of_full_counting(spark, least, top):
    docs = [*corpus(least, 150, ["en", "de", None, "und"]), ("fr", None), ("fr", ""), ("xx", "a a a a a a a a"), ("xx", "...,\x0b;")]
    frame = spark.createDataFrame([(l, t, "p", 0.5) for l, t in docs], "lang string, text string, phrase string, score double").repartition(3)
    got = collocations.phrases(frame, least=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == phrases_expected(docs, least, top)


def test_equal_scores_at_the_last_place(spark):
    docs = [("en", f"p{i} q{i}") for i in range(6) for _ in range(2)] + [("en", "r s t")]
    frame = spark.createDataFrame(docs, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.phrases(frame, least=2, top=4).collect())
    assert got == phrases_expected(docs, 2, 4) and [r[2] for r in got] == ["p0 q0", "p1 q1", "p2 q2", "p3 q3"]
    assert collocations.phrases(frame.limit(0)).collect() == []


def runs_expected(words, least, times):
    """Runs by looking at every period; of one stretch the smallest counts."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (4, 3), (10, 4), (2, 2)])
def test_runs_are_those_of_every_period(least, times):
    draw = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(draw.randint(0, 4)):
            words = [draw.randrange(draw.choice([1, 2, 3])) for _ in range(draw.randint(0, 50))]
            block = words[: draw.randint(1, 9)] * 30
            texts.append(np.array(words[:20] + block[: draw.randint(0, 70)] + words[20:], np.int64))
        assert periodic_runs.find_runs(texts, least, times) == [runs_expected(t.tolist(), least, times) for t in texts]


def test_positions_stay_in_order_in_large_sets():
    numbers = random.Random(1).sample(range(100_000), 9000)
    ordered = periodic_runs.Positions([numbers[0]])
    for i, x in enumerate(numbers[1:], 1):
        before, after = ordered.add(x)
        if i % 500 == 0:
            known = sorted(numbers[: i + 1])
            at = known.index(x)
            assert (before, after) == (known[at - 1] if at else -1, known[at + 1] if at < i else -1)
    assert list(ordered) == sorted(numbers) and len(ordered) == 9000


def test_long_runs_of_one_word():
    words = np.zeros(20_001, np.int64)
    words[10_000] = 1
    assert periodic_runs.find_runs([words]) == [[(0, 10_000, 1), (10_001, 10_000, 1)]]


def digests_expected(rows):
    out = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_expected(words, 24, 3)
        dropped = {i for a, m, q in runs for i in range(a + q, a + m)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        out.append((doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_run_digests_of_odd_rows(documents, odd_rows):
    rows = [(i, None if t is None else t[:9000]) for i, t in odd_rows]
    rows += [(i, prose(i, i)) for i in range(100, 180)] + [(300, "a b c " * 9 + "d " * 30 + "e\x1cf " * 25)]
    got = periodic_runs.digests(documents(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == digests_expected(rows)
    assert any(r["n_runs"] for r in got if r["doc_id"] and 100 <= r["doc_id"] < 180)
    assert periodic_runs.digests(documents([])).collect() == []


@pytest.mark.skipif(not Path(SMOKE_DIR).exists(), reason="no test tables")
def test_run_query_agrees_with_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMOKE_DIR, "documents").select("doc_id", "text").collect()]
    short = {d for d, t in rows if len(t or "") < 4000}
    got = [tuple(r) for r in queries()["op13_periodic_runs"](spark, SMOKE_DIR).collect()]
    assert len(got) == len(rows)
    assert sorted((r for r in got if r[0] in short), key=str) == digests_expected([r for r in rows if r[0] in short])


def test_runs_and_collapsed_texts(documents):
    rows = [(1, "say  hello " * 20 + "end"), (2, "no  runs here"), (3, None)]
    docs = documents(rows)
    assert [tuple(r) for r in periodic_runs.runs(docs).collect()] == [(1, 0, 40, 2)]
    out = periodic_runs.collapse(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "say hello end", 2: "no  runs here", 3: None}
