import random
import zlib
from collections import defaultdict

from foliant.llm import sharding

from .helpers import docs


def check(rows, texts, shards, slack):
    by = defaultdict(list)
    for r in rows:
        t = (texts[r["id"]] or "").encode()
        assert (r["size"], r["crc"]) == (len(t) + 1, zlib.crc32(t))
        by[r["shard"]].append(r)
    total = sum(r["size"] for r in rows)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= slack
    assert set(by) == set(range(shards))
    return by


def test_equal_bytes_slots_and_groups(spark):
    rng = random.Random(1)
    texts = [None, "", ""] + ["é" * rng.randint(0, 400) + str(i) for i in range(3000)] + ["copy " * 9] * 20
    frame = docs(spark, texts).selectExpr("*", "1 as shard", "2 as h")
    rows = sharding.sharded(frame, 8).collect()
    total = sum(r["size"] for r in rows)
    check(rows, texts, 8, 0.05 * total / 8)
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r["id"]] or ""].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    carried = sharding.sharded(frame, 8, carry=("text",)).collect()
    assert {(r["id"], r["shard"], r["slot"]) for r in carried} == {(r["id"], r["shard"], r["slot"]) for r in rows}
    assert all(r["k_text"] == texts[r["id"]] for r in carried)


def test_a_group_of_a_third_of_all_rows_is_cut(spark):
    texts = ["hot text " * 5] * 1000 + [f"other text {i} " * 3 for i in range(2000)]
    rows = sharding.sharded(docs(spark, texts), 8).collect()
    check(rows, texts, 8, 0.05 * sum(r["size"] for r in rows) / 8)


def test_few_rows_and_repeats(spark):
    frame = docs(spark, ["a", "b"])
    assert sharding.sharded(frame.where("doc_id > 3")).count() == 0
    rows = sharding.sharded(frame.union(frame).union(frame.selectExpr("null", "text", "lang", "source", "n_chars"))).collect()
    assert len(rows) == 6 and len({(r["shard"], r["slot"]) for r in rows}) == 6
