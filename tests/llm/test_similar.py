import random
from itertools import combinations

import numpy as np

from foliant.llm import similar

from .helpers import docs, words


def shingles(text):
    w = words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(texts, gone):
    """Whoever goes is like one that stays before it; the share of those that should go and do."""
    s = [shingles(t) for t in texts]
    for i in gone:
        assert any(j not in gone and (texts[j] or "") == (texts[i] or "") or j not in gone and jaccard(s[i], s[j]) >= 0.8 for j in range(i)), i
    stay, want = [], []
    for i in range(len(texts)):
        if any((texts[i] or "") == (texts[j] or "") or jaccard(s[i], s[j]) >= 0.8 for j in stay):
            want.append(i)
        else:
            stay.append(i)
    return len(set(want) & gone) / max(1, len(want))


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "tion", "st"]) for _ in range(rng.randint(1, 4)))
    base = [[word() for _ in range(rng.randint(60, 400))] for _ in range(60)]
    texts = [None, "", "one two"] + [" ".join(b) for b in base]
    for b in base[:40]:
        for share in (0.004, 0.015, 0.02, 0.1):
            texts.append(" ".join(word() if rng.random() < share else w for w in b))
    texts += [texts[5], texts[5]]
    frame = docs(spark, texts).selectExpr("doc_id as id", "text")
    rows = [r["id"] for r in similar.repeats(frame).collect()]
    assert len(rows) == len(set(rows))
    assert check(texts, set(rows)) > 0.85


def test_large_component_by_rounds(spark, monkeypatch):
    for name, size in (("SMALL", 5), ("HEADS", 4), ("BLOCK", 6)):
        monkeypatch.setattr(similar, name, size)
    rng = random.Random(9)
    b = [f"w{rng.randrange(500)}" for _ in range(300)]
    texts = []
    for _ in range(40):
        c = list(b)
        for _ in range(rng.randint(0, 3)):
            c[rng.randrange(len(c))] = "edit"
        texts.append(" ".join(c))
    for _ in range(25):
        texts.append(" ".join("other" if rng.random() < 0.05 else w for w in b))
    gone = {r["id"] for r in similar.repeats(docs(spark, texts).selectExpr("doc_id as id", "text")).collect()}
    assert set(range(1, 40)) <= gone and check(texts, gone) > 0.95


def test_copies_with_a_block_added_or_cut_off_go(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "tion", "st"]) for _ in range(rng.randint(1, 4)))
    texts, copies = [], []
    for k in range(200):
        b = [word() for _ in range(rng.randint(80, 400))]
        n = int(len(b) * rng.uniform(0.15, 0.24))
        texts.append(" ".join(b))
        copies.append(" ".join(b + [word() for _ in range(n)] if k % 2 else b[: len(b) - n * 3 // 4]))
    assert all(jaccard(shingles(x), shingles(y)) >= 0.8 for x, y in zip(texts, copies))
    gone = {r["id"] for r in similar.repeats(docs(spark, texts + copies).selectExpr("doc_id as id", "text")).collect()}
    assert gone == set(range(200, 400))


def test_groups_are_closed_over_links(spark, monkeypatch):
    rng = random.Random(12)
    texts, want = [], set()
    for _ in range(12):
        b = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        copies = []
        for k in range(4):  # like the original, but not like each other
            copies.append(" ".join("edit" if i % 75 == 15 * k + 7 else w for i, w in enumerate(b)))
        s = [shingles(t) for t in [*copies, " ".join(b)]]
        assert all(jaccard(s[4], x) >= 0.8 for x in s[:4]) and jaccard(s[0], s[1]) < 0.8
        want |= set(range(len(texts) + 1, len(texts) + 5))
        texts += [*copies, " ".join(b)]
    frame = docs(spark, texts).selectExpr("doc_id as id", "text").cache()
    assert {r["id"] for r in similar.repeats(frame).collect()} == want
    for name, size in (("SMALL", 2), ("HEADS", 2), ("BLOCK", 2)):
        monkeypatch.setattr(similar, name, size)
    assert {r["id"] for r in similar.repeats(frame).collect()} == want


def passages(rng, count, length=200):
    """Texts of one passage of their own each, behind one that all share; every tenth is like the one before it."""
    word = lambda: f"w{rng.randrange(10**6)}"
    common, texts = [word() for _ in range(length)], []
    for k in range(count):
        own = texts[-1].split()[length:] if k % 10 == 9 else [word() for _ in range(length)]
        texts.append(" ".join([*common, *own[:-3], *(word() for _ in range(3))]))
    return texts


def test_rarest_shingles_need_no_join_and_hold_every_link(spark):
    texts = passages(random.Random(13), 60)
    frame = docs(spark, texts).selectExpr("doc_id as node", "text")
    found = similar.rarest(frame)
    assert "Join" not in found._jdf.queryExecution().toString() and "Exchange" not in found._jdf.queryExecution().toString()
    keys = {}
    for r in found.collect():
        keys.setdefault(r["node"], set()).add(r["key"])
    s = [shingles(t) for t in texts]
    assert all(keys[i] & keys[j] for i, j in combinations(range(60), 2) if jaccard(s[i], s[j]) >= 0.8)
    assert not keys.get(0, set()) & keys.get(1, set())  # the common passage is none of the rarest


def test_texts_of_pairs_that_cannot_be_alike_stay_where_they_are(spark, monkeypatch):
    texts = [*passages(random.Random(14), 30), None, "", "one two", "one two three"]
    s = [shingles(t) for t in texts]
    frame = docs(spark, texts).selectExpr("doc_id as id", "text")
    nodes = frame.selectExpr("id as node").distinct()
    rows, seen, keep = similar._texts(frame, nodes), {}, similar.written
    monkeypatch.setattr(similar, "written", lambda df, name: seen.setdefault(name + "+" * (name in seen), keep(df, name)))
    monkeypatch.setattr(similar, "removed", lambda *_: None)
    pairs = nodes.toDF("a").crossJoin(nodes.toDF("b")).where("a < b")
    links = {(r["a"], r["b"]) for r in similar.verified(pairs, rows).collect()}
    assert links == {(i, j) for i, j in combinations(range(len(texts)), 2) if jaccard(s[i], s[j]) >= 0.8}
    sent = {(r["a"], r["b"]) for r in seen["likely"].collect()}
    assert links <= sent and len(sent) < 20


def test_cells_never_refuse_alike_texts(spark):
    rng = random.Random(15)
    base = [str(rng.randrange(10**9)) for _ in range(40_000)]  # over 255 shingles in a cell
    texts = [" ".join(base), " ".join(base[:33_000]), " ".join(base[:30_000]), "", "a", "a b c d e", "a b c d e f"]
    rows = similar.celled(docs(spark, texts).selectExpr("doc_id as node", "text")).orderBy("node").select("cells").toArrow()
    cells, s = similar._cells(rows.column(0).combine_chunks()), [shingles(t) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        if jaccard(s[i], s[j]) >= 0.8:
            assert similar.possible(cells[[i]], cells[[j]]).all()
    assert not similar.possible(cells[[0]], cells[[2]]).any() and not similar.possible(cells[[0]], cells[[4]]).any()


def test_near_fingerprints_are_connected_whatever_bits_differ(spark):
    rng = random.Random(16)
    prints = []
    for k in range(90):
        f = rng.getrandbits(64)
        prints += [f, f ^ sum(1 << b for b in rng.sample(range(64), k % 6))]
    prints = list(dict.fromkeys(prints))
    far = [rng.getrandbits(64) for _ in prints]
    rows = [(i, *np.array([f, g, h], np.uint64).view(np.int64).tolist()) for i, (f, g, h) in enumerate(zip(prints, far, reversed(far)))]
    links = similar.near_prints(spark.createDataFrame(rows, "node long, f0 long, f1 long, f2 long"))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.index("explode(") < plan.index("Exchange ")  # the asking is told apart after the exchange
    label = list(range(len(prints)))
    for r in links.collect():
        x, y = label[r["a"]], label[r["b"]]
        label = [min(x, y) if v in (x, y) else v for v in label]
    for i, j in combinations(range(len(prints)), 2):
        near = any((a ^ b).bit_count() <= 5 for a, b in ((prints[i], prints[j]), (far[i], far[j])))
        assert not near or label[i] == label[j]


def test_empty(spark):
    assert similar.repeats(docs(spark, ["x"]).where("doc_id > 1").selectExpr("doc_id as id", "text")).count() == 0
