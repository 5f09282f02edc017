"""Encoding texts by a byte-pair tokenizer file, word by word.

A tokenizer never merges across the places where its own pattern splits. White
space (for word tokenizers) and a space before other text (for byte-level ones)
are such places, so a text's ids are those of its words. The distinct words of
some texts are learnt together: those of plain Latin letters, digits and ASCII
signs are split here and their distinct pieces merged by the tokenizer's own model;
any other word goes through the whole tokenizer. What is learnt is remembered, up to
a number of bytes: words for byte-level tokenizers; for word tokenizers the lower-case
pieces, which all words of some texts are split into at once, as arrays of bytes.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Iterator
from operator import attrgetter

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

# Bytes of one generation of remembered words, and characters learnt together.
MEMORY_BYTES = 64 << 20
PORTION = 2 << 20

LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
# Fixed value: the split pattern of byte-level tokenizers, for Latin text.
BYTE_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s0-9{LATIN}]+|\s+(?!\S)|\s+"
)
BYTE_SIMPLE = re.compile(rf"[\n\t !-~{LATIN}]*")
# A space before anything but white space: byte-level words begin there.
BREAK = re.compile(r" (?=\S)")
ODD_SPACE = re.compile(r" (?:\s|\Z)")
ASCII_SPACE = re.compile(r"[ \t\n\r]")

# Word tokenizers split Latin text into '(s|t|re|ve|m|ll|d), runs of letters, single
# digits and runs of signs. Kinds of the bytes of UTF-8 text for that: the second byte
# of a letter beyond ASCII is a letter too, and only C3 begins letters of LATIN.
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[0x21:0x7F] = SIGN
KINDS[[*b"\t\n\x0b\x0c\r "]] = SPACE
KINDS[[*b"0123456789"]] = DIGIT
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]] = LETTER
# White space beyond ASCII, of two and of three bytes.
WIDE_SPACES = [chr(c).encode() for c in range(0x80, 0x10000) if chr(c).isspace()]
PAIRS, TRIPLES = ([int.from_bytes(c) for c in WIDE_SPACES if len(c) == size] for size in (2, 3))
# The two characters between those of LATIN, multiplication and division.
BETWEEN = rb"\xc3[\x97\xb7]"
ID = attrgetter("id")


def byte_characters() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies use.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    characters from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Memory:
    """Bytes by word, of two generations: the older goes when the newer is full.

    Bounded by the characters and bytes it holds, so that long words count as such.
    """

    # What an entry takes besides its own characters and bytes.
    ENTRY_BYTES = 150

    def __init__(self, limit: int):
        self.limit, self.used = limit, 0
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> set[str]:
        """Words of neither generation; those of the older one move up."""
        words = words - self.now.keys()
        if self.old:
            found = words & self.old.keys()
            self.add({w: self.old[w] for w in found})
            words -= found
        return words

    def add(self, values: dict[str, bytes]) -> None:
        self.now.update(values)
        self.used += sum(map(len, values)) + sum(map(len, values.values()))
        self.used += self.ENTRY_BYTES * len(values)

    def turn(self) -> None:
        """Between batches: a full generation becomes the older one."""
        if self.used > self.limit:
            self.now, self.old, self.used = {}, self.now, 0


class WordEncoder:
    """Ids of whole texts by one tokenizer file."""

    def __init__(self, path: str, memory_bytes: int = MEMORY_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.model = self.tokenizer.model
        # Words are remembered here; the model's own memory would only be filled in vain.
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        special = [t["content"] for t in described.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.odd = re.compile(b"|".join([BETWEEN, *(re.escape(t.encode()) for t in special)]))
        normal, before = described.get("normalizer"), described.get("pre_tokenizer") or {}
        parts = [p["type"] for p in before.get("pretokenizers", [before])]
        steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if before.get("type") == "ByteLevel" and before.get("use_regex") and normal is None:
            self.kind = "byte" if not before.get("add_prefix_space") else "whole"
        elif parts == ["Split", "ByteLevel"] and steps == ["NFC", "Replace", "Lowercase"]:
            self.kind = "word"
        else:
            self.kind = "whole"
        self.shown = "".join(byte_characters())
        # First words of a text and words after a space; pieces if of the word kind.
        self.first = Memory(memory_bytes // 8)
        self.later = Memory(memory_bytes)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merge(self, pieces: bytes) -> list[bytes]:
        """Ids of each of the pieces, parted by zero bytes, by the tokenizer's own model."""
        shown = pieces.decode("latin-1").translate(self.shown).split(self.shown[0])
        merge = self.model.tokenize
        return [array("I", map(ID, merge(text))).tobytes() for text in shown]

    def _merged(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each distinct piece."""
        distinct = list(set(pieces))
        if not distinct:
            return {}
        return dict(zip(distinct, self._merge("\0".join(distinct).encode()), strict=True))

    def _learn(self, memory: Memory, words: set[str], before: str = "") -> None:
        """Encode the words that a memory lacks, all their pieces together."""
        missing = memory.missing(words)
        special = self.special.search if self.special else lambda _: None
        # Words without a space of their own can be split as one text.
        plain = [w for w in missing if w and " " not in w] if before else []
        if not self._is_plain(plain):
            plain = [w for w in plain if BYTE_SIMPLE.fullmatch(w) and not special(w)]
        found = self._together(plain) if plain else {}
        rest = missing.difference(plain)
        parts = {}
        for word in rest:
            if not BYTE_SIMPLE.fullmatch(word) or special(word):
                found[word] = self._whole(before + word)
            else:
                parts[word] = BYTE_SPLIT.findall(before + word)
        known = self._merged([p for pieces in parts.values() for p in pieces])
        for word, pieces in parts.items():
            found[word] = b"".join([known[p] for p in pieces])
        memory.add(found)

    def _is_plain(self, words: list[str]) -> bool:
        simple = BYTE_SIMPLE.fullmatch("".join(words))
        return bool(simple) and not (self.special and self.special.search(" ".join(words)))

    def _together(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words after a space, by one split of all of them."""
        pieces = BYTE_SPLIT.findall(" " + " ".join(words))
        known = self._merged(pieces)
        # A piece that begins with a space begins a word.
        starts = [n for n, piece in enumerate(pieces) if piece[0] == " "]
        ids = list(map(known.__getitem__, pieces))
        ends = [*starts[1:], len(pieces)]
        values = [ids[a] if b == a + 1 else b"".join(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
        return dict(zip(words, values, strict=True))

    def _words(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text by its words (byte-level kind)."""
        split = [BREAK.split(text) if ODD_SPACE.search(text) else text.split(" ") for text in texts]
        self._learn(self.first, {words[0] for words in split})
        self._learn(self.later, set().union(*[words[1:] for words in split]), " ")
        heads, later = self.first.now, self.later.now.__getitem__
        for words in split:
            yield heads[words[0]] + b"".join(map(later, words[1:]))

    def _split(self, texts: list[bytes]) -> tuple[np.ndarray, pa.BinaryArray]:
        """The number of pieces before each text and at the end, and all pieces.

        A word with other characters than ``LATIN`` and ASCII, or with a special token, is
        one piece, unchanged, after a space, which no other piece has.
        """
        data = b" ".join([b"", *texts, b"   "])
        raw = np.frombuffer(data, np.uint8)
        kinds = KINDS[raw]
        odd = np.flatnonzero(kinds == ODD)
        code = raw[odd].astype(np.int32) << 8 | raw[odd + 1]
        pairs, triples = np.isin(code, PAIRS), np.isin(code << 8 | raw[odd + 2], TRIPLES)
        for found, size in ((pairs, 2), (triples, 3)):
            kinds[odd[found][:, None] + np.arange(size)] = SPACE
        odd = odd[~(pairs | triples)]
        low = np.frombuffer(data.lower(), np.uint8).copy()
        lead = np.flatnonzero(low == 0xC3)
        low[lead[low[lead + 1] < 0x9F] + 1] += 0x20
        keep = kinds != SPACE
        start = kinds == DIGIT
        start[1:] |= kinds[1:] != kinds[:-1]
        start &= keep
        quotes = np.flatnonzero(start & (low == ord("'")))
        after, second = low[quotes + 1], low[quotes + 2]
        one = np.isin(after, [*b"stmd"])
        two = ((after == ord("r")) | (after == ord("v"))) & (second == ord("e"))
        two |= (after == ord("l")) & (second == ord("l"))
        start[quotes[one | two] + 1] = False
        for found, size in ((one, 2), (two, 3)):
            ends = quotes[found] + size
            start[ends] = keep[ends]
        odd = np.concatenate([odd, [m.start() for m in self.odd.finditer(data)]]).astype(np.int64)
        if len(odd):
            spaces = np.flatnonzero(~keep)
            # The spaces around each word that is one piece.
            words = np.unique(np.searchsorted(spaces, odd))
            begins, ends = spaces[words - 1], spaces[words]
            inside = np.zeros(len(data), np.int8)
            inside[begins] = 1
            inside[ends] -= 1
            inside = np.cumsum(inside, dtype=np.int8).astype(bool)
            low[inside] = raw[inside]
            low[begins] = ord(" ")
            keep |= inside
            start &= ~inside
            start[begins] = True
        places = np.flatnonzero(start)
        kept = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
        offsets = np.append(kept[places], kept[-1]).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(low[keep])]
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(places), buffers)
        # A text begins at the space before it.
        texts_at = np.cumsum([0, *(len(text) + 1 for text in texts)])
        return np.searchsorted(places, texts_at), pieces

    def _pieces(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text by its pieces (word kind)."""
        bounds, pieces = self._split([text.encode() for text in texts])
        coded = pieces.dictionary_encode()
        distinct, numbers = _listed(coded.dictionary), coded.indices.to_numpy()
        missing = self.later.missing(set(distinct))
        plain = [piece for piece in missing if piece[0] != ord(" ")]
        found = dict(zip(plain, self._merge(b"\0".join(plain)), strict=True)) if plain else {}
        for word in missing.difference(plain):
            found[word] = self._whole(word[1:].decode())
        self.later.add(found)
        values = list(map(self.later.now.__getitem__, distinct))
        ids = np.frombuffer(b"".join(values), np.uint32)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        firsts = np.cumsum(sizes) - sizes
        # Each piece's ids follow those of the pieces before it.
        counts = sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(firsts[numbers] - ends[:-1], counts)
        places += np.arange(len(places))
        data = ids[places].tobytes()
        cuts = (4 * ends[bounds]).tolist()
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield data[begin:end]

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Texts are learnt some at a time, so little waits in memory.
        """
        if self.kind == "whole":
            yield from map(self._whole, texts)
            return
        for some in _portions(texts):
            if self.kind == "byte":
                yield from self._words(some)
            elif len(some) == 1:
                yield b"".join(map(self._part, _parts(some[0])))
            else:
                yield from self._pieces(some)
            self.first.turn()
            self.later.turn()

    def _part(self, part: str) -> bytes:
        self.later.turn()
        return next(self._pieces([part]))

    def encode(self, text: str) -> bytes:
        return next(self.encode_batch([text]))


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of some ``PORTION`` characters; a longer text is one alone."""
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > PORTION:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def _listed(values: pa.BinaryArray) -> list[bytes]:
    """What ``to_pylist`` gives for an array without nulls, several times faster."""
    _, offsets, data = values.buffers()
    if not len(values):
        return []
    at = np.frombuffer(offsets, np.int32)[values.offset :][: len(values) + 1].tolist()
    data = data.to_pybytes()
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _parts(text: str) -> Iterator[str]:
    """A text cut at white space, every ``PORTION`` characters or soon after."""
    begin = 0
    while space := ASCII_SPACE.search(text, begin + PORTION):
        yield text[begin : space.start()]
        begin = space.start()
    yield text[begin:]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a file; made once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
        # Learning makes many short-lived lists and no cycles: look for cycles less often.
        gc.set_threshold(200_000, 20, 20)
    return _ENCODERS[path]
