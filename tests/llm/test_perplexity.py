import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from foliant.llm import perplexity as P

from .helpers import docs, words


def base(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def test_base_counts(spark):
    rng = random.Random(2)
    texts = [None, "", "\n", "a\n\na\n a\na ", "x y\nx y", "é é é é é é é é é é é", "one two three four five " * 2, "last line\n", "#*$%&|<> " * 12]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", "é", " ", "\n", "# ", "😀 ", "c d e f g\n"]) for _ in range(rng.randrange(80))))
    texts.append(" ".join(str(i % 997) for i in range(50_000)))
    frame = docs(spark, texts).selectExpr("*", "1 as id", "2 as model")
    rows = {r["id"]: r for r in P.judged(frame).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(t), repr(t)[:80]
        assert not (r["kept"] and r["base_failed"])


def plain_model(texts):
    """Modified Kneser-Ney by the book, over strings."""
    top = P.ORDER
    counts = [Counter() for _ in range(top + 1)]
    for t in texts:
        t = "\0" + t
        for n in range(1, top + 1):
            counts[n].update(t[i : i + n] for i in range(len(t) - n + 1))
    for n in range(1, top):
        counts[n] = Counter({g: len({h[0] for h in counts[n + 1] if h[1:] == g}) for g in counts[n]})
    steps = [None] + [P._discounts(np.array(list(c.values()))) for c in counts[1:]]
    total, left = [defaultdict(float) for _ in counts], [defaultdict(float) for _ in counts]
    for n in range(1, top + 1):
        for g, c in counts[n].items():
            total[n][g[:-1]] += c
            left[n][g[:-1]] += steps[n][min(c, 3)]

    def chance(g):
        n = len(g)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        below = chance(g[1:])
        if not total[n][g[:-1]]:
            return below
        c = counts[n][g]
        return max(c - steps[n][min(c, 3)], 0) / total[n][g[:-1]] + left[n][g[:-1]] / total[n][g[:-1]] * below

    return chance


def test_model_against_strings():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd ") for _ in range(200)) for _ in range(6)]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    found = P.grams(*P._points(buf, offs))
    rows = Counter()
    for n in range(1, P.ORDER + 1):
        context = P._contexts(found, n) if n > 1 else np.zeros(len(found[0]), np.int64)
        suffix = found[n - 2] if n > 1 else context
        rows.update((0, n, h, c, s) for h, c, s in zip(found[n - 1].tolist(), context.tolist(), suffix.tolist()) if h >= 0)
    table = pd.DataFrame([(*k, v) for k, v in rows.items()], columns=["model", "n", "h", "context", "suffix", "c"])
    assert not table.duplicated(["model", "n", "h"]).any()
    got, size = P.Model(table).scores(buf, offs, np.zeros(len(texts), np.int64))
    chance = plain_model(texts)
    for t, g, n in zip(texts, got, size):
        padded = "\0" + t
        want = [min(P.MOST_LOSS, -math.log(chance(padded[max(0, i - P.ORDER + 1) : i + 1]))) for i in range(1, len(padded))]
        assert n == len(t) and abs(g - sum(want) / n) < 1e-4


def test_every_language_has_its_own_model_and_band(spark):
    rng = random.Random(6)
    made = lambda alphabet: ["".join(rng.choice(alphabet) + (" " if k % 6 == 5 else "") for k in range(600)) for _ in range(60)]
    langs = [None, "", "de", "pl", "en", "ko", "es", "ja", "pt", "ar", "tr"] + [f"l{i}" for i in range(30)]
    names = docs(spark, langs).selectExpr("text").select(P.model_name(F.col("text")).alias("m")).distinct()
    assert names.count() == len(langs)
    rows = [(i, t, lang) for lang, alphabet in (("pl", "abcdefgh"), (None, "αβγδεζηθ")) for i, t in enumerate(made(alphabet), 0 if lang else 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    both = {r["id"]: (r["kept"], round(r["log_ppl"], 6)) for r in P.judged(frame).collect()}
    alone = {r["id"]: (r["kept"], round(r["log_ppl"], 6)) for lang in ("lang is null", "lang = 'pl'") for r in P.judged(frame.where(lang)).collect()}
    assert both == alone and all(kept for kept, _ in both.values())


def test_every_ngram_is_counted_apart(spark):
    rng = random.Random(5)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(1000)) for _ in range(120)]
    want = {n: len({g for t in texts for g in zip(*(("\0" + t)[k:] for k in range(n)))}) for n in range(1, P.ORDER + 1)}
    got = Counter(r["n"] for r in P.counted(docs(spark, texts).selectExpr("0L as model", "text")).collect())
    assert want[3] > 1 << 16 and dict(got) == want


def test_odd_text_is_rejected_and_clean_text_kept(spark):
    rng = random.Random(4)
    letters = ["the", "and", "of", "tion", "er", "in", "re", "on"]
    clean = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(40, 200))) for _ in range(400)]
    odd = ["".join(chr(rng.randrange(0x3B1, 0x3C9)) + (" " if k % 6 == 5 else "") for k in range(600)) for _ in range(3)]
    rows = {r["id"]: r["kept"] for r in P.judged(docs(spark, clean + odd).selectExpr("doc_id", "text", "'en' as lang")).collect()}
    assert all(rows[i] for i in range(400)) and not any(rows[400 + i] for i in range(3))


def test_empty_table(spark):
    assert P.judged(docs(spark, ["x"]).where("doc_id > 3")).count() == 0


def test_a_worker_counts_and_scores_in_small_slices():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefghij klmno") for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(6000)]
    batch = pa.RecordBatch.from_arrays([pa.array([7] * len(texts), pa.int64()), pa.array(texts), pa.array(range(len(texts)), pa.int64())], ["model", "text", "id"])
    assert batch.column(1).nbytes > 2 << 20
    counts = pa.Table.from_batches(list(P._counts([batch]))).to_pandas()
    model = P.Model(counts.groupby(["model", "n", "h"], as_index=False).agg({"context": "min", "suffix": "min", "c": "sum"}))
    for work in (lambda: P._counts([batch]), lambda: P._scores([batch], model)):
        tracemalloc.start()
        rows = sum(len(found) for found in work())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= len(texts) and peak < 45e6  # slices of a whole MB took 123 and 97 MB
