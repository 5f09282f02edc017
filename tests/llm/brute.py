"""Plain single-machine versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import xxhash

WHITE = "[\x20\x09-\x0d]"
EDGE_TEXTS = [None, "", " \n\t", "a", "a b", "ab", "a\tb", "A b", "é ü 字 #$|", "x " * 400, "long" * 30000]

SCHEMA = "doc_id long, text string, fp string, text_key string, kept string, n_words string"


def frame(spark, texts, ids=None):
    """Documents with ids and extra columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "fp", None, "kept", None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def exact(rows):
    """doc_id, keep_id, group_size, sha of every (doc_id, text)."""
    normal = lambda t: re.sub(WHITE, "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i or 0, i))
    return [
        (i, min(groups[normal(t)])[3], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
        for i, t in rows
    ]


def simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    k = min(3, len(w))
    total = Counter()
    n = len(w) - k + 1
    for a in range(n):
        h = xxhash.xxh64_intdigest(b" ".join(w[a : a + k]), 42)
        total.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * total[b] > n)


def groups_within(values, bits):
    """Smallest member of the component of each value."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(sorted(parent), 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def rule_counts(text):
    t, w = text or "", words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall("[#*$%&|<>]", t)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def without_repeats(rows, k):
    """doc_id, n_words, n_removed, kept text; rows ordered by doc_id (null last) and text."""
    seen, out = set(), []
    for i, t in rows:
        w, gone = words(t), set()
        for a in range(len(w) - k + 1):
            window = tuple(w[a : a + k])
            if window in seen:
                gone |= set(range(a, a + k))
            seen.add(window)
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def auc(labels, scores):
    rank = np.argsort(np.argsort(scores))
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))
