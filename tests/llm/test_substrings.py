import hashlib
import random

from foliant.llm import substrings

from .helpers import docs, words


def brute(rows, size):
    """(doc, text) rows -> sorted (n_words, n_removed, kept) by row."""
    first = {}
    split = [(d, words(t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def passages(rng, size):
    """Texts with passages of about the window's length in many places, copies and edits."""
    word = lambda: f"w{rng.randrange(400)}"
    shared = [[word() for _ in range(rng.choice([size - 1, size, size + 1, size + 7, 3 * size]))] for _ in range(6)]
    texts = [None, "", " \n", "short text"]
    for _ in range(60):
        w = [word() for _ in range(rng.randrange(3 * size))]
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(w) + 1)
            w[k:k] = rng.choice(shared)
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    texts += texts[10:20] + [" ".join(["same"] * (4 * size))] * 3 + ["ab " * 200, "ab " * 170]
    for t in texts[20:30]:
        w = t.split()
        if w:
            w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    return texts


def test_against_brute_force(spark):
    for seed, size in ((1, 50), (2, 50), (3, 8)):
        texts = passages(random.Random(seed), size)
        random.Random(seed).shuffle(texts)
        frame = docs(spark, texts).selectExpr("*", "1 as uid", "'x' as kept")
        rows = list(enumerate(texts))
        got = sorted(tuple(r) for r in substrings.deduplicated(frame, window=size).collect())
        assert got == brute(rows, size)
    twice = frame.union(frame.where("doc_id < 5"))
    got = sorted(tuple(r) for r in substrings.deduplicated(twice, window=8, digest=True).collect())
    want = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows + rows[:5], 8))
    assert got == want


def test_empty_table_and_null_ids(spark):
    frame = docs(spark, ["x " * 60, "x " * 60])
    assert substrings.deduplicated(frame.where("doc_id > 5")).count() == 0
    rows = sorted((r["id"] is None, r["n_removed"]) for r in substrings.deduplicated(frame.selectExpr("nullif(doc_id, 0) doc_id", "text")).collect())
    assert rows == [(False, 0), (True, 60)]
