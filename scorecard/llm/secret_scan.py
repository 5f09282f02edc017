"""Secret scans: fixed patterns, and strings that a tokenizer finds hard to write.

Patterns give the base spans. The token-efficiency test adds others: an unbroken
run of letters, digits or both that needs many tokens for its length under a public
vocabulary looks random. Base spans and known digests and identifiers (hexadecimal
digests, UUIDs, plain numbers, digests named as such) are cut out of a run first;
each rest that is long enough for a run is judged by itself.

Only words long enough to hold a secret are looked at, so a text costs one split.

Defined results: a null text is empty and has no spans; repeated rows each get
theirs; very long texts are searched whole; of spans of one start the kinds are in
the order listed, and a random run is what base spans and known digests leave of it;
an empty table gives no rows; other columns are ignored (``redact`` returns them unchanged, except ``n_chars`` where there is one).
"""

from __future__ import annotations

import base64
import hashlib
import re

import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import map_rows, prepare, texts_of

# Kinds in the order in which spans of one start are listed.
ASSIGN, ACCESS, HEX, RANDOM = "assign", "access", "hex", "random"
KINDS = (ASSIGN, ACCESS, HEX, RANDOM)

# The patterns and least lengths of the base kinds.
ASSIGN_PATTERN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS_PATTERN = re.compile(r"AKIA[A-Z0-9]+")
HEX_PATTERN = re.compile(r"[0-9a-f]+")
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

# The method's parameters.
RUN_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.1
RUN_PATTERN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN_CHARS)
DIGEST_CHARS = (32, 40, 48, 56, 64, 96, 128)
# Whole parts of a run: not those that go on with a letter or digit.
KNOWN = re.compile(
    r"(?<![A-Za-z0-9])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|%s)(?![A-Za-z0-9])"
    % "|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGEST_CHARS)
)
DIGEST_NAME = r"(?i:md5|sha-?[0-9]{1,3}|crc32|etag|digest|checksum|uuid|guid)"
NAMED_DIGEST = re.compile(DIGEST_NAME + r"\W{0,4}$")
# A name covers no more characters than the longest digest has.
NAMED_VALUE = r"[A-Za-z0-9+/_-]{1,%d}={0,2}" % DIGEST_CHARS[-1]
VALUE = re.compile(NAMED_VALUE)
STARTS_WITH_NAME = re.compile(DIGEST_NAME + "[-_=/+]" + NAMED_VALUE)
PLACEHOLDER = "[SECRET]"

_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(ranks_path: str) -> tiktoken.Encoding:
    """A tiktoken encoding from a rank file; loaded once per worker."""
    if ranks_path not in _ENCODINGS:
        from public_tokenizers import PATTERN

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[ranks_path] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[ranks_path]


def _long_words(text: str) -> list[tuple[int, str]]:
    """Start and text of every word that could hold a hexadecimal run or more."""
    found, at = [], 0
    for word in text.split():
        if len(word) >= HEX_CHARS:
            at = text.index(word, at)
            found.append((at, word))
            at += len(word)
    return found


def base_spans(text: str, words: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """Start, kind and end of the spans of the fixed patterns."""
    spans = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        for m in ASSIGN_PATTERN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE_CHARS:
                spans.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS_PATTERN.finditer(text):
            if len(m[0]) >= ACCESS_CHARS:
                spans.append((m.start(), 1, m.end()))
    for at, word in words:
        for m in HEX_PATTERN.finditer(word):
            if len(m[0]) >= HEX_CHARS:
                spans.append((at + m.start(), 2, at + m.end()))
    return sorted(spans)


def known_spans(run: str, before: str) -> list[tuple[int, int]]:
    """Digests and UUIDs inside a run: not secrets by this test."""
    named = VALUE.match(run) if NAMED_DIGEST.search(before) else STARTS_WITH_NAME.match(run)
    return [m.span() for m in KNOWN.finditer(run)] + ([named.span()] if named else [])


def rests(start: int, end: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the cuts leave of a span."""
    left = []
    for s, e in sorted(cuts):
        if s > start:
            left.append((start, min(s, end)))
        start = max(start, e)
    return [*left, (start, end)] if start < end else left


def random_spans(
    text: str, words: list[tuple[int, str]], taken: list[tuple[int, int, int]], tokens
) -> list[tuple[int, int, int]]:
    """Runs of few characters per token, without what is known or in a base span."""
    found = []
    for at, word in words:
        if len(word) < RUN_CHARS:
            continue
        for m in RUN_PATTERN.finditer(word):
            start, end = at + m.start(), at + m.end()
            cuts = [(s, e) for s, _, e in taken if s < end and start < e]
            known = known_spans(m[0], text[max(0, start - 16) : start])
            cuts += [(start + s, start + e) for s, e in known]
            for s, e in rests(start, end, cuts):
                run = text[s:e]
                if e - s < RUN_CHARS or not any(c.isalpha() for c in run):
                    continue
                if e - s <= MAX_CHARS_PER_TOKEN * len(tokens.encode_ordinary(run)):
                    found.append((s, 3, e))
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan_text(text: str, tokens) -> tuple[list, list]:
    words = _long_words(text)
    base = base_spans(text, words)
    return base, random_spans(text, words, base, tokens)


def scan(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Counts of the base kinds and all spans of every row."""
    prepare(docs.sparkSession)

    def rows(ids, texts):
        tokens = encoding(ranks_path)
        out = [ids, [], [], [], [], [], []]
        for text in texts:
            base, more = scan_text(text, tokens)
            for kind in (0, 1, 2):
                out[1 + kind].append(sum(s[1] == kind for s in base))
            out[4].append(hashlib.sha256(listed(base).encode()).hexdigest())
            out[5].append(listed(base + more))
            out[6].append(len(more))
        return out

    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string, n_random long"
    )
    return map_rows(texts_of(docs), rows, schema)


def redacted(text: str, tokens) -> str:
    """``text`` with every span, overlapping ones joined, replaced by a placeholder."""
    base, more = scan_text(text, tokens)
    parts, at = [], 0
    for start, _, end in sorted(base + more):
        if start >= at:
            parts += [text[at:start], PLACEHOLDER]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text


def redact(docs: DataFrame, ranks_path: str) -> DataFrame:
    """All rows and columns, with secrets out of ``text`` and ``n_chars`` brought up to date."""
    prepare(docs.sparkSession)
    schema = docs.schema
    place = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        tokens = encoding(ranks_path)
        for batch in batches:
            texts = [t if t is None else redacted(t, tokens) for t in batch.column(place).to_pylist()]
            yield batch.set_column(
                place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type)
            )

    cleaned = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        count = F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
        cleaned = cleaned.withColumn("n_chars", F.coalesce(count, F.col("n_chars")))
    return cleaned
