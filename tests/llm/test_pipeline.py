import random

import corpus_pipeline as pipeline

from .helpers import docs
from .test_substrings import brute


def test_stages_keep_their_promises(spark):
    rng = random.Random(6)
    syllables = ["the", "and", "tion", "er", "in", "re", "on", "st"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = text(80)
    texts = [text(rng.randint(60, 200)) for _ in range(80)]
    texts += [texts[0], texts[1], f"{texts[2]} {shared}", f"{texts[3]} {shared} {text(30)}"]
    texts += ["too short", None, "same words again here now " * 20]
    texts.append(text(40) + ' token = "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c" ' + text(30))
    frame = docs(spark, texts).selectExpr("*", "1 as kept", "2 as row")
    frame = frame.union(frame.where("doc_id = 5")).cache()

    good = pipeline.quality(spark, frame, "").cache()
    assert good.columns == pipeline.COLUMNS
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert set(range(80)) <= set(kept) and not {84, 85, 86} & set(kept) and good.count() == len(kept) + 1

    single = pipeline.deduplicated(spark, good, "").cache()
    ids = sorted(r["doc_id"] for r in single.collect())
    assert single.columns == pipeline.COLUMNS and ids == [i for i in sorted(kept) if i not in (80, 81)]

    cut = pipeline.substring_dedup(spark, single, "").cache()
    after = {r["doc_id"]: r["text"] for r in cut.collect()}
    want = {d: (kept[d] if not removed else left) for d, _, removed, left in brute([(i, kept[i]) for i in ids], 50)}
    assert cut.columns == pipeline.COLUMNS and after == want and shared not in after[83] and shared in after[82]

    clean = pipeline.secret_scan(spark, cut, "").cache()
    texts_after = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == pipeline.COLUMNS and "[SECRET]" in texts_after[87]
    assert {i: t for i, t in texts_after.items() if i != 87} == {i: t for i, t in after.items() if i != 87}
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())

    pieces = pipeline.packed(spark, clean, "").collect()
    assert {r["doc_id"] for r in pieces} == set(texts_after)
    whole = {}
    for r in pieces:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] >= r["length"]
    assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in pieces)


def test_empty_table(spark):
    frame = docs(spark, ["x"]).where("doc_id > 1")
    for _, stage in pipeline.STAGES[:-1]:
        frame = stage(spark, frame, "")
        assert frame.columns == pipeline.COLUMNS
    assert pipeline.packed(spark, frame, "").count() == 0
