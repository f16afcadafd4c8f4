"""Exact and near duplicates, repeated passages: against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from mapflow.llm import exact_dedup, near_dedup, repeats
from mapflow.llm.components import components
from tests.llm.texts import prose

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


def exact_expected(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(BLANK), []).append((len(text or ""), doc))
    out = []
    for doc, text in rows:
        same = groups[(text or "").translate(BLANK)]
        keep = min(same, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[1]
        digest = hashlib.sha256((text or "").translate(BLANK).encode()).hexdigest()
        out.append((doc, keep, len(same), doc == keep, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity", [1, 2, 65_536])
def test_exact_groups(documents, odd_rows, capacity):
    got = exact_dedup.groups(documents(odd_rows), capacity).collect()
    assert sorted((tuple(r) for r in got), key=str) == exact_expected(odd_rows)


def test_longer_original_wins_then_smaller_id(documents):
    rows = [(9, "a b"), (3, "a  b"), (7, "a\tb "), (5, "ab"), (1, "x")]
    kept = {r["doc_id"] for r in exact_dedup.groups(documents(rows)).where("kept").collect()}
    assert kept == {3, 1}
    assert exact_dedup.groups(documents([])).collect() == []


def test_directory_splits_only_full_buckets(spark):
    index = spark.range(1000).selectExpr("xxhash64(id) AS key")
    slots, bits = exact_dedup.directory(index, 50)
    slots = {r["slot"]: r for r in slots.collect()}
    keys = [r["key"] & (2**64 - 1) for r in index.collect()]
    filled = Counter(slots[k >> (64 - bits)]["bucket"] for k in keys)
    assert max(filled.values()) <= 50
    for r in slots.values():
        parent = {s for s in slots if s >> (bits - r["depth"] + 1) == r["slot"] >> (bits - r["depth"] + 1)}
        assert r["depth"] == 0 or sum(1 for k in keys if k >> (64 - bits) in parent) > 50


def test_exact_deduplicate_keeps_columns(documents, odd_rows):
    docs = documents(odd_rows)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    plain = [(t or "").translate(BLANK) for _, t in kept]
    assert len(plain) == len(set(plain)) == len({(t or "").translate(BLANK) for _, t in odd_rows})
    assert (4, odd_rows[3][1]) in kept


def near_expected(rows, words, percent):
    sets, parent = {}, {}
    for n, (doc, text) in enumerate(rows):
        found = (text or "").encode().lower().split()
        width = min(words, len(found))
        sets[n] = frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1)) if found else frozenset()
        if doc is not None:
            parent[doc] = doc

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    numbered = [(n, doc) for n, (doc, _) in enumerate(rows) if doc is not None]
    for i, a in numbered:
        for j, b in numbered:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    out = []
    for n, (doc, _) in enumerate(rows):
        component = None if doc is None else root(doc)
        out.append((doc, len(sets[n]), component, doc == component))
    return sorted(out, key=str)


def near_rows():
    """Chains of ever more changed texts, a large family, and short texts."""
    rng = random.Random(8)
    rows = []
    for family in range(6):
        words = prose(50 + family, 150).split()
        for _ in range(12):
            rows.append((len(rows) * 3 % 211, " ".join(words)))
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return rows + [(500, "two words"), (501, "Two  WORDS"), (502, "two words more"), (503, None)]


@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80)])
def test_near_groups(documents, odd_rows, words, percent):
    for rows in (odd_rows, near_rows()):
        got = near_dedup.near_groups(documents(rows), words, percent).collect()
        assert sorted((tuple(r) for r in got), key=str) == near_expected(rows, words, percent)


def test_near_groups_at_the_deeper_prefix(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "WIDE", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "TILE", 2)
    rows = near_rows()
    got = near_dedup.near_groups(documents(rows), 2, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows, 2, 80)


def test_neighbours_go_deeper_in_large_regions():
    key = np.array([1, 1, 2, 2, 2, 2, 2, 3])
    deep = np.array([[9, 9, 9, 9], [8, 8, 8, 8], [1, 1, 1, 1], [1, 1, 1, 1], [1, 1, 1, 2], [1, 2, 3, 4], [5, 5, 5, 5], [5, 5, 5, 5]], np.int64)
    deep = (deep << np.array([48, 32, 16, 0])).sum(1)
    assert near_dedup.order_neighbours(key, deep, 64).tolist() == [1, 3, 4, 5, 6]
    assert near_dedup.order_neighbours(key, deep, 4).tolist() == [1, 3, 4, 5]
    assert near_dedup.order_neighbours(key, deep, 2).tolist() == [1, 3]
    assert near_dedup.order_neighbours(key[:1], deep[:1], 2).tolist() == []


def test_pairs_in_wide_groups_are_all_found(documents, monkeypatch):
    """Pairs just above the threshold that share prefixes of four minima but none of eight, each among texts that are a little farther."""
    monkeypatch.setattr(near_dedup, "WIDE", 1)
    rows = []
    for seed in (102, 199, 255, 486):
        words = [f"shared{k}" for k in range(220)] + [f"own{seed}x{k}" for k in range(80)]

        def changed(rng, n, mark, words=words):
            other = list(words)
            for k in rng.sample(range(2, 298), n):
                other[k] = f"{mark}x{k}"
            return " ".join(other)

        rows += [(100 * len(rows) + n, changed(random.Random(1000 * seed + n), 25, f"far{seed}x{n}")) for n in range(40)]
        rows += [(10**6 + 2 * seed, " ".join(words)), (10**6 + 2 * seed + 1, changed(random.Random(seed), 16, f"new{seed}"))]
    got = near_dedup.near_groups(documents(rows), 2, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows, 2, 80)


def test_near_deduplicate(documents, odd_rows):
    docs = documents(odd_rows)
    out = near_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {None, 1, 2, 3, 4, 8, 9, 10, 11, 12}
    assert near_dedup.near_groups(documents([])).collect() == []


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (200, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 90), (90, 90), (95, 90)}


def repeats_expected(rows):
    data = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(b[i : i + 200] for _, b in data for i in range(len(b) - 199))
    out = []
    for doc, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    shared, rows = prose(70, 60), []
    for n in range(12):
        rows.append((n, f"{prose(80 + n, 40)} {shared[n : n + 230]} {prose(300 + n, 40)} {shared[: 180 + n * 3]}"))
    rows.append((20, "é" * 150 + prose(90, 10) + "é" * 150))
    rows.append((21, (prose(91, 20) + " ") * 3))
    return rows


@pytest.mark.parametrize("most", [repeats.MOST_BYTES, 1])
def test_repeated_passages(documents, odd_rows, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_BYTES", most)  # 1: every anchor counts as hot
    rows = [r for r in odd_rows if r[0] != 8] + passages()
    got = repeats.digests(documents(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == repeats_expected(rows)


def test_no_repeats_in_nothing(documents):
    assert repeats.digests(documents([])).collect() == []


def test_merged_shards_equal_counting():
    rng = random.Random(5)
    with np.errstate(over="ignore"):
        for _ in range(40):
            base = [bytes(rng.choices(b"abc d", k=rng.randint(1, 500))) for _ in range(4)]
            pieces = []
            while len(pieces) < 6:
                piece = b"".join(rng.choice(base)[rng.randint(0, 100) :] for _ in range(4)) + b"xyz" * rng.choice([0, 150])
                if len(piece) >= 200:
                    pieces.append(piece)
            seen = Counter(p[i : i + 200] for p in pieces for i in range(len(p) - 199))
            got = repeats.repeated_windows(pieces, shard_bytes=rng.choice([300, 1000, 10**6]))
            assert [m.tolist() for m in got] == [[seen[p[i : i + 200]] > 1 for i in range(len(p) - 199)] for p in pieces]
