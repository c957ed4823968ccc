import random

import xxhash
from pyspark.sql import functions as F

from foliant.llm import near_dup
from foliant.llm.shared import written

from .helpers import docs, words


def fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(pairs):
    group = list(range(len(pairs)))
    for i, (_, x) in enumerate(pairs):
        for j in range(i):
            if (x ^ pairs[j][1]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(pairs, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return [least.get(g) for g in group]


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(60)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))) for _ in range(40)]
    texts = [None, "", " \n\t", "One", "one TWO", "x\xa0y z"] + base + base[:5]
    for text in base[:20]:
        w = text.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append("  ".join(w))
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(70_000)))
    frame = docs(spark, texts)
    frame = frame.union(frame.where("doc_id = 7")).selectExpr("*", "1 as fp", "2 as component")
    got = {(r["id"], r["fp"] % 2**64): r["component"] for r in near_dup.near_duplicates(frame).collect()}
    pairs = [(i, fingerprint(t)) for i, t in enumerate(texts)]
    assert got == dict(zip(pairs, brute(pairs)))
    assert near_dup.near_duplicates(frame).count() == len(texts) + 1


def test_null_ids_and_empty_table(spark):
    frame = docs(spark, ["a b c", "a b c", "d"]).selectExpr("nullif(doc_id, 0) as doc_id", "text")
    rows = sorted((r["id"] or -1, r["component"]) for r in near_dup.near_duplicates(frame).collect())
    assert rows == [(-1, 1), (1, 1), (2, 2)]
    assert near_dup.near_duplicates(frame.where("doc_id > 9")).count() == 0


def test_nothing_that_grows_is_broadcast(spark):
    frame = docs(spark, ["a b c", "a b c", "d", None])
    nodes = written(near_dup.fingerprints(frame).groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    for found in (near_dup.links(nodes), near_dup.near_duplicates(frame)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
