"""Byte-pair encoding by a prefix-sharing trie of words.

The encoding of a prefix of a word has a definite last token, and the last token
of a longer prefix follows from those of the shorter ones: it is the token that
ends there and may follow the last token of what is left before it. Two tokens
may follow each other if merging their joined bytes gives them back. So a trie
of the distinct words of a batch is walked depth first, a node gets its last token
once, and the encodings of all words that share a prefix share that work.

Sorted words are the leaves of their trie in the order of that walk: a word keeps
what it shares with the one before, and its other prefixes are new nodes. The tokens
that end at a node are read off a trie of the vocabulary with links to the longest
suffix (Aho-Corasick); its steps and the pairs of tokens tried are remembered. A
node whose last token no longer prefix asks for goes without.

Words are the pieces that the tokenizer's own pattern makes. The tokenizer file
is only read for its vocabulary, merges, pattern kind and added tokens.

Defined results: a null text is empty and has no ids; repeated rows each get
theirs; very long texts are encoded whole; merges of equal rank go from the left, as
in the tokenizer; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from scorecard.llm.bpe import BREAK, BYTE_SIMPLE, BYTE_SPLIT, ODD_SPACE, byte_characters
from scorecard.llm.common import prepare, texts_of

# Distinct chunks, and words, of one of the two generations a worker remembers.
MEMORY_CHUNKS = 300_000
# Pairs of tokens, and steps in the vocabulary's trie, that a worker remembers.
MEMORY_PAIRS, MEMORY_STEPS = 1_000_000, 500_000


class Recent:
    """Results of two generations; between batches the older one may go."""

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}

    def start(self) -> dict:
        if len(self.now) > self.limit:
            self.now, self.old = {}, self.now
        return self.now

    def missing(self, keys: set) -> set:
        """Keys that neither generation has; those of the older one move up."""
        found = {k: self.old[k] for k in keys if k in self.old}
        self.now.update(found)
        return keys - found.keys()


class TrieEncoder:
    """Vocabulary and merges of a byte-level tokenizer file, and tries over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, before = described["model"], described.get("pre_tokenizer") or {}
        if (
            model["type"] != "BPE"
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or described.get("normalizer")
            or model.get("continuing_subword_prefix")
            or model.get("end_of_word_suffix")
        ):
            raise ValueError("a byte-level tokenizer without normalizer or prefix space is needed")
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        raw = lambda shown: bytes(byte_of[c] for c in shown)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.raw = raw
        self.ids = {raw(token): number for token, number in model["vocab"].items()}
        self.bytes = {number: token for token, number in self.ids.items()}
        # Rank of a merge by its two token ids.
        self.rank = {}
        for n, (a, b) in enumerate(model["merges"]):
            self.rank[self.ids[raw(a)], self.ids[raw(b)]] = n
        self.joined = {
            pair: self.ids[self.bytes[pair[0]] + self.bytes[pair[1]]] for pair in self.rank
        }
        self.added = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.bytes.update({n: content.encode() for content, n in self.added.items()})
        self.added_split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.chunks = Recent(MEMORY_CHUNKS)
        self.words = Recent(MEMORY_CHUNKS)
        # Bytes of every id in one array, for decoding without a loop over ids.
        self.top = top = max(self.bytes) + 1
        self.sizes = np.zeros(top, np.int64)
        for number, token in self.bytes.items():
            self.sizes[number] = len(token)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.all_bytes = np.frombuffer(
            b"".join(self.bytes.get(n, b"") for n in range(top)), np.uint8
        )
        # Every id as a 32-bit integer, and as a decimal with a comma behind it.
        four = np.arange(top, dtype="<u4").tobytes()
        self.listed = [(four[4 * n : 4 * n + 4], b"%d," % n) for n in range(top)]
        self.as_bytes, self.as_decimal = zip(*self.listed, strict=True)
        # The two tokens that each token was merged from first, and the rank of that;
        # single bytes were not merged. Pairs of tokens are one number here.
        self.rank_of = {left * top + right: n for (left, right), n in self.rank.items()}
        self.left, self.right, self.made = [0] * top, [0] * top, [-1] * top
        for pair, n in reversed(self.rank.items()):
            token = self.joined[pair]
            self.left[token], self.right[token], self.made[token] = *pair, n
        self.follows: dict[int, bool] = {}
        # The trie of the vocabulary: its nodes by number, known steps from a node by a
        # byte, and the tokens that end at each node and encode to themselves, longest first.
        self.prefixes = [b"", *{t[:n]: 0 for t in self.ids for n in range(1, len(t) + 1)}]
        self.nodes = {prefix: n for n, prefix in enumerate(self.prefixes)}
        self.steps: dict[int, int] = {}
        self.ends: list[tuple[int, ...] | None] = [None] * len(self.prefixes)
        self.own: dict[int, bool] = {}

    def merged(self, ids: list[int]) -> list[int]:
        """Plain merging, lowest rank first, leftmost of equals."""
        ids = list(ids)
        while len(ids) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(ids, ids[1:], strict=False)]
            best = min(ranks)
            if best == len(self.rank):
                break
            at = ranks.index(best)
            ids[at : at + 2] = [self.joined[ids[at], ids[at + 1]]]
        return ids

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, each its own encoding, encode to just them."""
        pair = left * self.top + right
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) > MEMORY_PAIRS:
                self.follows.clear()
            self.follows[pair] = known = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens.

        Merges are taken back from the last one on, the right token's first where ranks
        are equal. The tokens stay apart unless what then meets at their border would
        have been merged before what was just taken back.
        """
        rank, made, top = self.rank_of, self.made, self.top
        limit = len(self.rank)
        while True:
            if rank.get(left * top + right, limit) < limit:
                return False
            first, second = made[left], made[right]
            if first > second:
                left, limit = self.right[left], first
            elif second >= 0:
                right, limit = self.left[right], second + 1
            else:
                return True

    def _is_own(self, token: int) -> bool:
        """Whether a token's bytes encode to the token itself."""
        known = self.own.get(token)
        if known is None:
            data = self.bytes[token]
            known = self.merged([self.ids[bytes([b])] for b in data]) == [token]
            self.own[token] = known
        return known

    def _step(self, node: int, byte: int) -> int:
        """The node of the longest suffix, after one more byte, that begins a token."""
        data = self.prefixes[node] + bytes([byte])
        while data not in self.nodes:
            data = data[1:]
        if len(self.steps) > MEMORY_STEPS:
            self.steps.clear()
        self.steps[node << 8 | byte] = found = self.nodes[data]
        return found

    def _ends(self, node: int) -> tuple[int, ...]:
        data = self.prefixes[node]
        tokens = [self.ids.get(data[n:]) for n in range(len(data))]
        self.ends[node] = found = tuple(t for t in tokens if t is not None and self._is_own(t))
        return found

    def encode_words(self, words: set[bytes]) -> dict[bytes, list[int]]:
        """Encodings of distinct words, by a depth-first walk of their trie."""
        found: dict[bytes, list[int]] = {}
        follows, steps, ends, top = self.follows, self.steps, self.ends, self.top
        size = self.sizes.tolist()
        before = b""
        # By length of the prefix: its node in the vocabulary's trie, and its last token,
        # -1 if not known. Nothing is before the first token; ``top`` stands for it.
        nodes, last = [0], [top]
        for word in sorted(words):
            depth = 0
            for byte, other in zip(word, before, strict=False):
                if byte != other:
                    break
                depth += 1
            del nodes[depth + 1 :], last[depth + 1 :]
            node = nodes[depth]
            for byte in word[depth:]:
                key = node << 8 | byte
                node = steps.get(key)
                if node is None:
                    node = self._step(key >> 8, byte)
                nodes.append(node)
            last += [-1] * (len(word) - depth)
            # Prefixes whose last tokens are asked for, the shortest on top.
            asked = [len(word)]
            while asked:
                at = asked[-1]
                tokens = ends[nodes[at]]
                if tokens is None:
                    tokens = self._ends(nodes[at])
                # The token that ends here and may follow what is before it.
                for token in tokens:
                    left = last[at - size[token]]
                    if left < 0:
                        asked.append(at - size[token])
                        break
                    if left != top:
                        fits = follows.get(left * top + token)
                        if not (fits or fits is None and self.may_follow(left, token)):
                            continue
                    last[at] = token
                    asked.pop()
                    break
            out, at = [], len(word)
            while at:
                token = last[at]
                out.append(token)
                at -= size[token]
            out.reverse()
            found[word] = out
            before = word
        return found

    def _pieces(self, chunks: list[str]) -> dict[str, list[str]]:
        """The words of each chunk."""
        simple = BYTE_SIMPLE.fullmatch
        # Where a chunk's only space is its first character and no white space follows
        # it, the pattern splits chunks laid end to end as it splits each.
        alone, several = {}, []
        for chunk in chunks:
            if not simple(chunk):
                shown = self.splitter.pre_tokenize_str(chunk)
                alone[chunk] = [self.raw(part).decode() for part, _ in shown]
            elif chunk[0] == " " and not chunk.rfind(" ") and chunk[1:2] not in "\n\t":
                several.append(chunk)
            else:
                alone[chunk] = BYTE_SPLIT.findall(chunk)
        pieces = BYTE_SPLIT.findall("".join(several))
        starts = [n for n, piece in enumerate(pieces) if piece[0] == " "]
        starts.append(len(pieces))
        for chunk, start, end in zip(several, starts[:-1], starts[1:], strict=True):
            alone[chunk] = pieces[start:end]
        return alone

    def chunks_of(self, text: str) -> list:
        """Parts of a text that encode alone; an added token is its number."""
        parts = self.added_split.split(text) if self.added_split else [text]
        out: list = []
        for part in parts:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                if ODD_SPACE.search(part) or "\0" in part:
                    words = BREAK.split(part)
                    out.append(words[0])
                    out += [" " + w for w in words[1:]]
                else:
                    out += part.replace(" ", "\0 ").split("\0")
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [ids for ids, _ in self.encode_listed(texts)]

    def encode_listed(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        """Ids of each text, and the same as decimals joined by commas, which are put
        together once a chunk; new distinct words of the batch go into one trie."""
        split = [self.chunks_of(t) for t in texts]
        known, words = self.chunks.start(), self.words.start()
        fresh = self.chunks.missing(set().union(*split).difference(known))
        pieces = self._pieces([c for c in fresh if isinstance(c, str) and c])
        unknown = set().union(*pieces.values()).difference(words)
        new = {p.encode(): p for p in self.words.missing(unknown)}
        for word, numbers in self.encode_words(new.keys()).items():
            words[new[word]] = numbers
        for chunk in fresh:
            if isinstance(chunk, int):
                known[chunk] = self.listed[chunk]
                continue
            parts = pieces.get(chunk, ())
            numbers = words[parts[0]] if len(parts) == 1 else [n for p in parts for n in words[p]]
            known[chunk] = self.listed[numbers[0]] if len(numbers) == 1 else (
                b"".join([self.as_bytes[n] for n in numbers]),
                b"".join([self.as_decimal[n] for n in numbers]),
            )
        for chunks in split:
            ids, listed = zip(*[known[c] for c in chunks], strict=True) if chunks else ((), ())
            yield np.frombuffer(b"".join(ids), np.uint32), b"".join(listed)[:-1]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(self.starts[ids], sizes)
        return self.all_bytes[at].tobytes().decode("utf-8", "replace")


_ENCODERS: dict[str, TrieEncoder] = {}


def trie_encoder(path: str) -> TrieEncoder:
    """The encoder of a file; made once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
        # Encoding makes many short-lived lists and no cycles: look for cycles less often.
        gc.set_threshold(200_000, 20, 20)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    prepare(docs.sparkSession)

    def run(batches):
        tool = trie_encoder(tokenizer_path)
        for batch in batches:
            ids = tool.encode_batch(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists], names=["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""
    prepare(encoded.sparkSession)

    def run(batches):
        tool = trie_encoder(tokenizer_path)
        for batch in batches:
            texts = [tool.decode(np.asarray(i.values, np.int64)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, in one pass over the texts."""
    prepare(docs.sparkSession)

    def run(batches):
        tool = trie_encoder(tokenizer_path)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for ids, listed in tool.encode_listed(batch.column(1).to_pylist()):
                counts.append(len(ids))
                encoded.append(hashlib.sha256(listed).hexdigest())
                decoded.append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts_of(docs).mapInArrow(run, schema)
