"""BPE encoding with forced boundaries, and decoding, for tokenizer files of the `tokenizers` library.

A merge can only ever build a token of the vocabulary. So where two neighbouring
byte symbols stand side by side inside no token at all, no merge crosses, and the
text may be cut there: the fragments are encoded independently and their ids
concatenated. Three kinds of certain cuts are used, coarse to fine:

1. white space, which the pre-tokenizer never joins to what stands before it;
2. the pre-tokenizer's own pieces;
3. byte pairs that occur in no token (`ForcedBoundaryBPE.fragments`).

Since words repeat, every encoded piece (stretch, for texts that need the file's own
pre-tokenizer; bytes of plain texts' pieces, which are found by array operations over many texts) is remembered in a bounded table, and so are the fragments of those that hold
cuts. The tables outlive a batch; a full one is emptied, but for the pieces of the texts at hand:
results never depend on them.

Defined results: a null text counts as empty and has no ids; texts that contain the
name of an added token get that token's id, as in the library.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa

#: White space as Unicode's White_Space property, which the tokenizers' patterns mean by \s.
SPACE = "\t-\r \x85\xa0  -     　"
#: Texts of these characters are composed already, and lower-cased alike by Python and the library.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-‧€]*")
#: A stretch with the space before it, as byte-level patterns take them.
STRETCH = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PLAIN_STRETCH = re.compile(r" ?\S+|\s+(?!\S)|\s+")

def _plain_class(kind: str) -> str:
    """The characters of plain texts, lower-cased ones too, that `kind` matches, as one set of single characters.

    Python's expressions look a character up in such a set at once, where `[^\\W\\d_]` asks for its properties.
    """
    plain = {c for c in map(chr, range(0x2100)) if PLAIN.fullmatch(c)}
    return "[" + "".join(map(re.escape, sorted(c for c in plain | set("".join(plain).lower()) if re.fullmatch(kind, c)))) + "]"


#: The two pre-tokenizer patterns for such texts, in the terms of Python's own expressions. Short
#: forms only have to come before signs, as no letter or digit begins one.
SHORT_FORMS = "'s|'t|'re|'ve|'m|'ll|'d"
LETTER, DIGIT, SIGN, BLANK = map(_plain_class, (r"[^\W\d_]", r"\d", r"[^\s\w]|_", r"\s"))
WORDS = re.compile(f"{LETTER}+|{DIGIT}|{SHORT_FORMS}|{SIGN}+")
SPACED_WORDS = re.compile(f" ?{LETTER}+| ?{DIGIT}+|{SHORT_FORMS}| ?{SIGN}+|{BLANK}+")
#: Both with the white space between, as the second takes it, over whole texts.
PLAIN_PIECE = re.compile(SPACED_WORDS.pattern.removesuffix(f"|{BLANK}+") + r"|\s+(?!\S)|\s+")
#: What each 16-bit character of a plain text is to the second pattern, and how many bytes UTF-8 takes for it.
OTHER, BETWEEN, WHITE = 0, 1, 2
KINDS = np.zeros(1 << 16, np.uint8)
KINDS[0] = BETWEEN  # no plain text holds it, so it may stand between texts
for _number, _kind in enumerate((BLANK, LETTER, DIGIT, SIGN), WHITE):
    KINDS[[c for c in range(0x2100) if re.fullmatch(_kind, chr(c))]] = _number
WIDTHS = np.where(np.arange(1 << 16) < 0x80, 1, np.where(np.arange(1 << 16) < 0x800, 2, 3)).astype(np.uint8)
TABLE_SIZE = 500_000
FRAGMENTS = 100_000
BLOCK = 2_000_000  # characters of plain texts that are cut at once
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Above every byte symbol (256 bytes, of which fewer than 256 are shown as characters from 256 on).
SEPARATOR = 512


def plain_starts(data: np.ndarray) -> np.ndarray:
    """Where the second pattern's pieces begin in plain texts, each with a zero after it, given as 16-bit characters."""
    kind = KINDS[data]
    starts = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts[kind == BETWEEN] = True
    # The last blank before something else stands apart; a space belongs to what follows.
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] > WHITE))
    starts[last] = True
    starts[last[data[last] == ord(" ")] + 1] = False
    sign = np.flatnonzero(data[:-1] == ord("'"))
    sign = sign[starts[sign]]
    one, two = data[sign + 1], data[np.minimum(sign + 2, len(data) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(sign), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    form = sign[short | long]
    starts[form + 1] = False
    starts[form + np.where(long, 3, 2)[short | long]] = True
    return np.flatnonzero(starts)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Fragments(dict):
    """Ids of fragments by one of the file's models, the merges of each done once while it is remembered."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, fragment: str) -> list[int]:
        self[fragment] = ids = [t.id for t in self.tokenize(fragment)]
        return ids


class ForcedBoundaryBPE:
    """Encoder and decoder for one tokenizer file (BPE over byte symbols)."""

    def __init__(self, path: str, table_size: int = TABLE_SIZE):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        inner = models.BPE(model["vocab"], merges, cache_capacity=0)
        # Only the last fragment of a word ends with the word's suffix.
        self.inner = inner
        self.final = models.BPE(model["vocab"], merges, cache_capacity=0, end_of_word_suffix=self.suffix) if self.suffix else inner
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.tokens = [""] * (max([*model["vocab"].values(), *self.added.values()]) + 1)
        for token, number in [*model["vocab"].items(), *self.added.items()]:
            self.tokens[number] = token
        self.decoder = whole.decoder
        self.words = WORDS if self.normalizer is not None else SPACED_WORDS
        self.symbols = dict(enumerate(byte_symbols()))
        self.dtype = np.dtype("<u2" if len(self.tokens) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.inside, self.ending = self._pairs(model["vocab"])
        self.separator = chr(SEPARATOR)
        self.inside_table, self.ending_table = self._table(self.inside), self._table(self.ending)
        self.table_size = table_size
        self.table: dict[str | bytes | tuple[bytes], bytes] = {}
        self.joined_symbols = self.symbols | {0: self.separator}
        self.inner_ids = _Fragments(self.inner)
        self.final_ids = _Fragments(self.final) if self.suffix else self.inner_ids

    def _pairs(self, vocab: Iterable[str]) -> tuple[set[str], set[str]]:
        """Symbol pairs that stand inside some token; those before a word's end apart."""
        inside: set[str] = set()
        ending: set[str] = set()
        for token in vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            symbols = token[: -len(self.suffix)] if ends else token
            pairs = [symbols[i : i + 2] for i in range(len(symbols) - 1)]
            if ends and pairs:
                ending.add(pairs.pop())
            inside.update(pairs)
        return inside, ending if self.suffix else inside

    @staticmethod
    def _table(pairs: set[str]) -> np.ndarray:
        """Pairs of byte symbols by their characters; nothing is cut beside a separator."""
        table = np.zeros((SEPARATOR + 1, SEPARATOR + 1), bool)
        for pair in pairs:
            table[ord(pair[0]), ord(pair[1])] = True
        table[SEPARATOR], table[:, SEPARATOR] = True, True
        return table

    def fragments(self, word: str) -> list[str]:
        """A pre-tokenized word (byte symbols) cut at every pair that no token contains."""
        last = len(word) - 2
        cuts = [i + 1 for i in range(last) if word[i : i + 2] not in self.inside]
        if last >= 0 and word[last:] not in self.ending:
            cuts.append(last + 1)
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def _uncut(self, words: list[str]) -> np.ndarray:
        """For each word whether it holds no certain cut, looked up for all words at once."""
        data = np.frombuffer(self.separator.join(words).encode("utf-16-le"), "<u2")
        cut = ~self.inside_table[data[:-1], data[1:]]
        if self.suffix:
            before_end = np.flatnonzero(data[2:] == SEPARATOR)
            cut[before_end] = ~self.ending_table[data[before_end], data[before_end + 1]]
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        return np.add.reduceat(np.append(cut, False), starts) == 0

    def _words(self, stretch: str) -> list[str]:
        """The pre-tokenizer's pieces of a stretch, as byte symbols."""
        if stretch.isascii():
            if stretch.isalpha():
                return [stretch]
            if stretch[0] == " " and stretch[1:].isalpha():
                return [self.symbols[32] + stretch[1:]]
        if PLAIN.fullmatch(stretch):
            return [w.encode().decode("latin-1").translate(self.symbols) for w in self.words.findall(stretch)]
        return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(stretch)]

    def _learn(self, stretches: list[str] | list[bytes]) -> None:
        """Encode stretches that the table lacks."""
        if stretches and isinstance(stretches[0], bytes):
            return self._learn_plain(stretches)
        pieces = [self._words(s) for s in stretches]
        words = [w for piece in pieces for w in piece]
        uncut = iter(self._uncut(words).tolist() if words else ())
        inner, final, whole, code = self.inner_ids, self.final_ids, self.final.tokenize, self.code
        for stretch, piece in zip(stretches, pieces, strict=True):
            ids: list[int] = []
            for word in piece:
                if next(uncut):
                    ids += [t.id for t in whole(word)]
                    continue
                *before, end = self.fragments(word)
                for fragment in before:
                    ids += inner[fragment]
                ids += final[end]
            self.table[stretch] = array(code, ids).tobytes()

    def _stretches(self, text: str) -> list[str]:
        if self.normalizer is None:
            return (PLAIN_PIECE if PLAIN.fullmatch(text) else STRETCH).findall(text)
        if PLAIN.fullmatch(text):
            return WORDS.findall(text.lower())
        return [x for x in self.normalizer.normalize_str(text).split(" ") if x]

    def _parts(self, text: str) -> list[str | tuple[bytes]]:
        """Stretches of a text, and the ids of the added tokens between them, as tuples."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return self._stretches(text)
        out: list[str | tuple[bytes]] = []
        at = 0
        for found in self.added_pattern.finditer(text):
            out += [*self._stretches(text[at : found.start()]), (array(self.code, [self.added[found[0]]]).tobytes(),)]
            at = found.end()
        return [*out, *self._stretches(text[at:])]

    def _learn_plain(self, pieces: list[bytes]) -> None:
        """Encode pieces of plain texts that the table lacks, all at once up to the model's merges."""
        joined = b"\0".join(pieces).decode("latin-1").translate(self.joined_symbols)
        data = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        cuts = np.flatnonzero(~self.inside_table[data[:-1], data[1:]])
        each = np.cumsum(data == SEPARATOR)[cuts]
        n_fragments = (1 + np.bincount(each, minlength=len(pieces))).tolist()
        fragments = iter(np.insert(data, cuts + 1, SEPARATOR).tobytes().decode("utf-16-le").split(self.separator))
        whole, held, code = self.final.tokenize, self.final_ids, self.code
        for piece, n in zip(pieces, n_fragments, strict=True):
            if n == 1:
                ids = [t.id for t in whole(next(fragments))]
            else:
                ids = list(chain.from_iterable([held[f] for f in islice(fragments, n)]))
            self.table[piece] = array(code, ids).tobytes()

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts: pieces are cut, and equal ones found, for all texts at once; the table is asked once for each."""
        joined = "\0".join(texts) + "\0"
        data = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        starts = plain_starts(data)
        written = joined.encode()
        if len(written) > len(data):
            starts = (np.cumsum(WIDTHS[data], dtype=np.int32) - WIDTHS[data])[starts]
        edges = np.append(starts, len(written)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(written)]).dictionary_encode()
        pieces, each = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        between = pieces.index(b"\0")
        self._make_room(pieces)
        ids = list(map(self.table.get, pieces))
        ids[between] = b""
        holes = [i for i, known in enumerate(ids) if known is None]
        if holes:
            self._learn([pieces[i] for i in holes])
        for i in holes:
            ids[i] = self.table[pieces[i]]
        width = self.dtype.itemsize
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        flat = np.frombuffer(b"".join(ids), self.dtype)
        n = sizes[each]
        until = np.cumsum(n)
        # Piece after piece, where its ids stand among those of the distinct pieces.
        places = np.repeat((np.cumsum(sizes) - sizes)[each] - (until - n), n) + np.arange(until[-1])
        out = flat[places].tobytes()
        return [out[a:b] for a, b in pairwise([0, *(until[each == between] * width).tolist()])]

    def _encode_blocks(self, texts: list[str]) -> list[bytes]:
        """The same, about `BLOCK` characters at a time; longer texts are cut before a single space, where a piece begins."""
        out: list[list[bytes]] = [[] for _ in texts]
        block: list[tuple[int, str]] = []
        size = 0

        def encode() -> None:
            for (of, _), ids in zip(block, self._encode_plain([x for _, x in block]), strict=True):
                out[of].append(ids)

        for of, text in enumerate(texts):
            at = 0
            while at < len(text):
                cut = SINGLE_SPACE.search(text, at + BLOCK) if len(text) - at > BLOCK else None
                until = cut.start() if cut else len(text)
                block.append((of, text[at:until]))
                size, at = size + until - at, until
                if size >= BLOCK:
                    encode()
                    block, size = [], 0
        if block:
            encode()
        return [b"".join(x) for x in out]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of `dtype`."""
        if self.normalizer is not None or self.suffix:
            return self._encode_any(texts)
        named = self.added_pattern.search if self.added_pattern else lambda text: None
        plain = {i: text for i, text in enumerate(texts) if text and PLAIN.fullmatch(text) and not named(text)}
        out = self._encode_any([None if i in plain else text for i, text in enumerate(texts)])
        for i, ids in zip(plain, self._encode_blocks(list(plain.values())), strict=True):
            out[i] = ids
        return out

    def _make_room(self, pieces: Iterable[str | bytes | tuple[bytes]]) -> None:
        """Empty full tables, but for these pieces."""
        if len(self.table) > self.table_size:  # what is needed now, all frequent pieces among it, stays
            self.table = {s: self.table[s] for s in set(pieces).intersection(self.table)}
        for held in (self.inner_ids, self.final_ids):
            if len(held) > FRAGMENTS:
                held.clear()

    def _encode_any(self, texts: list[str | None]) -> list[bytes]:
        """The same, stretch by stretch."""
        parts = [self._parts(text) if text else [] for text in texts]
        pieces = list(chain.from_iterable(parts))
        if not pieces:
            return [b""] * len(texts)
        self._make_room(pieces)
        table = self.table
        coded = list(map(table.get, pieces))
        holes = [i for i, ids in enumerate(coded) if ids is None]
        missing = {pieces[i] for i in holes}
        table.update((s, s[0]) for s in missing if isinstance(s, tuple))
        self._learn([s for s in missing if isinstance(s, str)])
        for i in holes:
            coded[i] = table[pieces[i]]
        ends = list(accumulate(map(len, parts), initial=0))
        return [b"".join(coded[a:b]) for a, b in pairwise(ends)]

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_many([text])[0], self.dtype)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids, special tokens kept; without a decoder in the file, tokens joined by spaces."""
        if self.decoder is None:
            return " ".join(map(self.tokens.__getitem__, ids))
        return self.decoder.decode(list(map(self.tokens.__getitem__, ids)))


@cache
def _encoder(path: str, table_size: int) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path, table_size)


def encoder(path: str, table_size: int = TABLE_SIZE) -> ForcedBoundaryBPE:
    """One encoder for each file, size of table and Python worker."""
    return _encoder(path, table_size)


def encoded(path: str, texts: list[str | None], block: int = 256, table_size: int = TABLE_SIZE) -> Iterator[bytes]:
    """Ids of texts, a block of them at a time, by the worker's encoder."""
    bpe = encoder(path, table_size)
    for at in range(0, len(texts), block):
        yield from bpe.encode_many(texts[at : at + block])
