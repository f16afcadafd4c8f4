"""Encoding, the token store and packing, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from mapflow.llm import bpe, encoding, packing, token_store
from mapflow.llm.bpe import ForcedBoundaryBPE
from mapflow.llm.common import tokenizer_path
from mapflow.session import scratch_path

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
TEXTS = [
    "",
    " ",
    "\n\n\n x\n\ty  z ",
    "don't I'll we've 's 'S 'T x's",
    "²½ ª º 12345 —–… _under_score__",
    "İ ΑΣ ΟΔΟΣ ß ẞ ſ ǅ K Å ﬁ é",
    "漢字 テスト \U0001f600 hi‍​ x",
    "a\x1cb\x85c\xa0d　e",
    "<|endoftext|>x <|startoftext|> y<|endoftext|>",
    "x" * 5000 + " " + "ab" * 2000,
    "zq qz xj 7jq! é",
]


def library(name: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.mark.parametrize("name", FILES)
def test_same_ids_and_texts_as_the_library(name):
    whole, own = library(name), ForcedBoundaryBPE(tokenizer_path(name), table_size=20)
    for text in TEXTS:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text
        assert own.decode(ids) == whole.decode(ids, skip_special_tokens=False)
    assert own.encode(None).tolist() == []
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode_many(TEXTS)] == [own.encode(t).tolist() for t in TEXTS]


@pytest.mark.parametrize("name", FILES)
def test_fragments_are_cut_where_no_token_can_be(name):
    own = ForcedBoundaryBPE(tokenizer_path(name))
    cut = 0
    for word in ["zqxjkv", "jqzx", "qqqzzzjjj", "ÃĤÃ", "hello"]:
        fragments = own.fragments(word)
        cut += len(fragments) - 1
        assert "".join(fragments) == word
        ids = [t.id for f in fragments[:-1] for t in own.inner.tokenize(f)] + [t.id for t in own.final.tokenize(fragments[-1])]
        assert ids == [t.id for t in own.final.tokenize(word)]
    assert cut > 0


@pytest.mark.parametrize("name", FILES)
def test_a_full_table_keeps_what_the_texts_need(name):
    own = ForcedBoundaryBPE(tokenizer_path(name), table_size=3)
    own.encode("one two three four five")
    held = dict(own.table)
    assert len(held) > own.table_size
    own._learn, learned = (lambda new: (learned.extend(new), type(own)._learn(own, new))), []
    assert own.encode("one two six").tolist() == library(name).encode("one two six", add_special_tokens=False).ids
    assert len(learned) == 1 and len(own.table) < len(held)


def plain_texts(seed: int, n: int) -> list[str]:
    """Short forms, runs of white space and signs, digits and letters of one to three bytes in any order."""
    rng = random.Random(seed)
    parts = ["'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'", "''", "'S", "'r", "'l", " ", "  ", "\n", "\r\n", "\t", "\xa0", ".", "_", "-–", "€", "é", "ß", "Œ", "a", "re", "Word", "7", "42", "‧"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(n)]


def test_pieces_of_plain_texts_are_those_of_the_pattern():
    texts = plain_texts(1, 5000)
    assert all(map(bpe.PLAIN.fullmatch, texts))
    for some in ([texts[0]], texts):
        joined = "\0".join(some) + "\0"
        starts = bpe.plain_starts(np.frombuffer(joined.encode("utf-16-le"), "<u2")).tolist()
        pieces = [joined[a:b] for a, b in zip(starts, [*starts[1:], len(joined)], strict=True)]
        assert pieces == [p for text in some for p in [*bpe.PLAIN_PIECE.findall(text), "\0"]]


def test_plain_texts_among_others_and_in_blocks(monkeypatch):
    own, whole = ForcedBoundaryBPE(tokenizer_path(FILES[1]), table_size=50), library(FILES[1])
    texts = [*plain_texts(2, 400), None, "", "漢字 and\0 <|endoftext|>\x1c", "<|endoftext|> plain", "x" * 90, " ".join(plain_texts(3, 60))]
    random.Random(4).shuffle(texts)
    expected = [whole.encode(text or "", add_special_tokens=False).ids for text in texts]
    for block in (bpe.BLOCK, 40):
        monkeypatch.setattr(bpe, "BLOCK", block)
        for _ in range(2):
            assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode_many(texts)] == expected


def test_classes_of_plain_characters_are_those_of_the_patterns():
    plain = {c for c in map(chr, range(0x3000)) if bpe.PLAIN.fullmatch(c)}
    for own, kind in ((bpe.LETTER, r"[^\W\d_]"), (bpe.DIGIT, r"\d"), (bpe.SIGN, r"[^\s\w]|_"), (bpe.BLANK, r"\s")):
        for c in plain | set("".join(plain).lower()):
            assert bool(re.fullmatch(own, c)) == bool(re.fullmatch(kind, c)), c


def test_digests_of_documents(documents, odd_rows):
    whole = library(FILES[0])
    expected = []
    for doc, text in odd_rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        decoded = whole.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in encoding.digests(documents(odd_rows), tokenizer_path(FILES[0])).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert encoding.digests(documents([]), tokenizer_path(FILES[0])).collect() == []


def test_encode_and_decode_columns(documents):
    path = tokenizer_path(FILES[1])
    out = encoding.decode(encoding.encode(documents([(1, "a  plain\ntext"), (2, None)]), path), path).collect()
    assert {(r["doc_id"], r["decoded"]) for r in out} == {(1, "a  plain\ntext"), (2, "")}


def test_token_store_round_trip(spark, documents, odd_rows):
    whole = library(FILES[1])
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, all_ids = [], []
    for doc, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc, len(all_ids), len(ids), zlib.crc32(np.array(ids, "<u4"))))
        all_ids += ids
    path = scratch_path(spark, "test-store")
    token_store.write_ids(documents(odd_rows), tokenizer_path(FILES[1]), path, segment_ids=500)
    got = sorted((tuple(r) for r in token_store.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected
    for start, length in [(0, 1), (3, 700), (len(all_ids) - 5, 50), (len(all_ids), 3)]:
        assert token_store.read_run(spark, path, start, length) == all_ids[start : start + length]
    empty = scratch_path(spark, "empty-store")
    token_store.write_ids(documents([]), tokenizer_path(FILES[1]), empty)
    assert token_store.read_documents(spark, empty).collect() == []


def test_codes_give_any_id():
    rng = np.random.default_rng(4)
    for ids in (np.array([], "u4"), np.array([0], "u4"), rng.integers(0, 2**rng.integers(1, 31, 5000), dtype=np.uint32)):
        codes = token_store.Codes(token_store.to_levels(ids))
        assert codes.run(0, len(ids)).tolist() == ids.tolist()
        for a in range(0, len(ids), 487):
            assert codes[a] == ids[a]
            assert codes.run(a, min(len(ids), a + 700)).tolist() == ids[a : a + 700].tolist()


def test_packing_places_every_id_once(documents, odd_rows):
    whole = library(FILES[0])
    got = packing.pack_documents(documents(odd_rows), tokenizer_path(FILES[0]), window=256).collect()
    expected = defaultdict(int)
    for doc, text in odd_rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 256):
            part = ids[at : at + 256]
            expected[doc, at, len(part), zlib.crc32(part), len(ids)] += 1
    found = defaultdict(int)
    for r in got:
        found[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    assert found == expected
    check_sequences(got, 256)
    assert packing.pack_documents(documents([]), tokenizer_path(FILES[0])).collect() == []


def check_sequences(rows, window: int) -> int:
    """Offsets without gaps, within the window; the number of sequences."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


def test_deal_balances_cost_and_wastes_little():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 2000, 4000))[::-1]
    sequence, offset = packing.deal(lengths, 4096)
    used = np.bincount(sequence, lengths)
    assert used.max() <= 4096
    assert lengths.sum() / (len(used) * 4096) > 0.97
    assert all(offset[sequence == s].min() == 0 for s in range(len(used)))
    cost = np.bincount(sequence, lengths + lengths.astype(float) ** 2 / packing.BALANCE)
    assert cost.std() / cost.mean() < 0.25
