"""Words that any polynomial modulo 2**64 confuses must be told apart by every operator."""

import hashlib

import numpy as np

from foliant.llm import bpe, kernel, packing, perplexity, substrings, suffixes

from .helpers import docs
from .test_suffixes import brute


def thue_morse(n=2048):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def spans(words):
    raw = " ".join(words).encode()
    size = np.array([len(w.encode()) for w in words])
    ends = np.cumsum(size + 1) - 1
    return np.frombuffer(raw, np.uint8), ends - size, ends


def test_word_hashes_follow_the_bytes():
    words = ["", "a", "a\0", "abcdefgh", "abcdefghi", "b" * 63, "b" * 64, "b" * 65, "é" * 40, *thue_morse()] * 2
    buf, starts, ends = spans(words)
    h = kernel.word_hashes(buf, starts, ends).tolist()
    assert h[:11] == h[11:] and len(set(h)) == 11
    codes, first = kernel.distinct(buf, starts, ends)
    assert codes.tolist() == [*range(11)] * 2 and first.tolist() == [*range(11)]


def test_distinct_compares_bytes_where_hashes_meet(monkeypatch):
    words = ["x", "yy", "x", "c" * 70, "d" * 70, "abcdefgh1", "abcdefgh2", "yy"]
    buf, starts, ends = spans(words)
    monkeypatch.setattr(kernel, "word_hashes", lambda buf, a, b: (b - a).astype(np.uint64))
    codes, first = kernel.distinct(buf, starts, ends)
    assert [words[first[c]] for c in codes] == words and len(first) == 6


def test_base_counts():
    a, b = thue_morse()
    counts = lambda t: perplexity.base_counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
    assert counts(f"{a}\n{b}")["n_dup_lines"].tolist() == [0] and counts(f"{a}\n{a}")["n_dup_lines"].tolist() == [1]
    assert counts(f"{a} 1 2 3 4 {b} 1 2 3 4")["n_repeat_words"].tolist() == [0]


def test_substring_and_suffix_dedup(spark):
    a, b = thue_morse()
    rest = " ".join(f"w{i}" for i in range(49))
    texts = [f"{a} {rest}", f"{b} {rest}", f"{a} {rest}"]
    got = sorted(tuple(r)[:3] for r in substrings.deduplicated(docs(spark, texts)).collect())
    assert got == [(0, 50, 0), (1, 50, 0), (2, 50, 50)]
    texts = [a, b, a[:700] + "c", "c" + b[-900:], a + b, (a * 3)[5:]]
    got = sorted(tuple(r) for r in suffixes.deduplicated(docs(spark, texts)).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == brute(texts, 400)


def test_long_documents_block_by_block(spark, monkeypatch):
    from foliant.llm import repeats

    monkeypatch.setattr(repeats, "BLOCK", 97)
    rng = np.random.default_rng(5)
    shared = " ".join(f"s{i}" for i in rng.integers(0, 10**6, 300))
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 10**6, n)) for n in (40, 900, 2000)]
    texts = [texts[0], f"{texts[1]} {shared}", f"{shared} {texts[2]} {shared}"]
    got = sorted(tuple(r) for r in suffixes.deduplicated(docs(spark, texts)).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == brute(texts, 400)
    from .test_substrings import brute as by_words

    assert sorted(tuple(r) for r in substrings.deduplicated(docs(spark, texts)).collect()) == by_words(list(enumerate(texts)), 50)


def test_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    a, b = thue_morse()
    text = f"{a} {b}"
    path = public_tokenizers.path("word_bpe_49k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    row = bpe.digests(docs(spark, [text]), path).first()
    assert row["n_tokens"] == len(want) and row["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    pieces = sorted(packing.packed(docs(spark, [text]), path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [i for r in pieces for i in r["ids"]] == [*want, 0]
