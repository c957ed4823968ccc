import hashlib
import random
from collections import Counter

import numpy as np

from foliant.llm import suffixes

from .helpers import docs


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for d, r in enumerate(raw):
        keep = bytearray(b"\1" * len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                keep[i : i + size] = bytes(size)
        spans = len([p for p in bytes(keep).split(b"\1") if p])
        out.append((d, len(r), keep.count(0), spans, bytes(x for x, k in zip(r, keep) if k)))
    return out


def corpus(rng, size):
    piece = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [piece(rng.choice([size - 2, size - 1, size, size + 1, size + 40, 4 * size])) for _ in range(5)]
    texts = [None, "", "x" * (size - 1), "y" * size, "z" * (size + 1), "ab" * (3 * size)]
    for _ in range(60):
        t = piece(rng.randrange(3 * size))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(t) + 1)
            t = t[:k] + rng.choice(shared) + t[k:]
        texts.append(t)
    return texts + texts[10:14]


def test_collection_against_brute_force():
    rng = np.random.default_rng(4)
    base = rng.integers(97, 99, 60, dtype=np.uint8)
    texts = []
    for _ in range(80):
        t = base.copy()
        for _ in range(rng.integers(0, 3)):
            t[rng.integers(0, 60)] = 99
        texts.append(t[rng.integers(0, 20) :])
    anchor = np.array([len(t) - 25 for t in texts])
    last = np.array([min(a, len(t) - 20) for a, t in zip(anchor, texts)])
    got = suffixes.repeated(texts, anchor, np.zeros(80, int), last, 20)
    columns = Counter((a - p, t[p : p + 20].tobytes()) for t, a, e in zip(texts, anchor, last) for p in range(e + 1))
    for t, a, e, flags in zip(texts, anchor, last, got):
        assert flags.tolist() == [columns[(a - p, t[p : p + 20].tobytes())] > 1 for p in range(e + 1)]


def test_against_brute_force(spark):
    for seed, size, gram, most in ((1, 400, 32, 2000), (2, 40, 8, 2000), (3, 40, 8, 3)):
        texts = corpus(random.Random(seed), size)
        frame = docs(spark, texts).selectExpr("*", "1 as uid", "'x' as kept")
        got = sorted(tuple(r) for r in suffixes.deduplicated(frame, window=size, gram=gram, most=most).collect())
        assert [(a, b, c, d, bytes(e)) for a, b, c, d, e in got] == brute(texts, size)


def test_repeated_rows_empty_table(spark):
    frame = docs(spark, ["x" * 500, "short"])
    twice = frame.union(frame)
    got = sorted(tuple(r) for r in suffixes.deduplicated(twice, digest=True).collect())
    none = hashlib.sha256(b"").hexdigest()
    assert got[:2] == [(0, 500, 500, 1, none)] * 2 and got[2][2] == 0
    assert suffixes.deduplicated(frame.where("doc_id > 5")).count() == 0
