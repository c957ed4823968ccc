import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from foliant.llm import packing

from .helpers import docs
from .test_bpe import awkward

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_tokens_are_the_library_s():
    texts = awkward() + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    library = Tokenizer.from_file(PATH)
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, cut = packing.ByteBpe(PATH).texts(np.frombuffer(b"".join(raw), np.uint8), offs)
    for i, t in enumerate(texts):
        assert ids[cut[i] : cut[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_schedule_is_exact_on_large_totals():
    totals = [3 * 10**13 + 7, 5, 10**12 + 1, 6 * 10**13]
    plan = packing.Schedule(totals)
    rng = random.Random(1)
    for s, t in enumerate(totals):
        for _ in range(50):
            w = rng.randrange(sum(totals) // 1024 + 2)
            assert plan.served(s, np.array([w]))[0] == min(w * 1024, sum(totals)) * t // sum(totals)
            place = rng.randrange(t)
            w = plan.round_of(s, np.array([place]))
            assert plan.served(s, w)[0] <= place < plan.served(s, w + 1)[0]


def test_pieces_tile_documents_and_windows(spark):
    rng = random.Random(2)
    texts = [None, ""] + ["tiny"] * 3 + [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(1, 900))) for _ in range(60)] + ["long " * 9000]
    frame = docs(spark, texts).selectExpr("doc_id", "text", "case when doc_id < 4 then source when doc_id % 3 = 0 then 'hot' else concat('s', doc_id % 5) end source", "1 as part", "2 as ids")
    library = Tokenizer.from_file(PATH)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    rows = packing.packed(frame, PATH, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], np.uint32).tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] and r["doc_tokens"] == len(want[r["id"]])
        by_doc[r["id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert {d: [x for r in sorted(v, key=lambda r: r["start"]) for x in r["ids"]] for d, v in by_doc.items()} == want
    total = sum(map(len, want.values()))
    share = Counter()
    for r in rows:
        share[r["source"]] += r["length"]
    for s, v in by_sequence.items():
        at = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == min(1024, total - 1024 * s)
        if at == 1024:
            own = Counter()
            for r in v:
                own[r["source"]] += r["length"]
            for name, n in share.items():
                assert abs(own[name] - 1024 * n / total) <= 2 + len(share)
    assert sorted(by_sequence) == list(range(-(-total // 1024)))
    assert packing.packed(frame.where("doc_id < 0"), PATH).count() == 0


def simulated(totals, weights, window):
    """Tokens of each source in every window, by a plain deficit round-robin."""
    from fractions import Fraction

    rest, deficit, stream = list(totals), [Fraction(0)] * len(totals), []
    while any(rest):
        budget = Fraction(window)
        got = [0] * len(rest)
        while budget and any(rest[i] - got[i] for i in range(len(rest))):
            live = [i for i in range(len(rest)) if rest[i] - got[i]]
            own = {i: weights[i] for i in live} if any(weights[i] for i in live) else {i: totals[i] for i in live}
            every = sum(own.values())
            # until the first queue runs dry
            span = min([budget] + [(rest[i] - got[i] - deficit[i]) * every / Fraction(own[i]) for i in live if own[i]])
            span = max(span, Fraction(0))
            span = min(budget, Fraction(-(-span.numerator // span.denominator)))
            for i in live:
                deficit[i] += span * own[i] / every
                n = min(rest[i] - got[i], deficit[i].numerator // deficit[i].denominator)
                got[i] += n
                deficit[i] -= n
            budget -= span
            if any(rest[i] == got[i] for i in live):
                deficit = [Fraction(0)] * len(totals)
        for i, n in enumerate(got):
            stream += [i] * n
            rest[i] -= n
    return stream


def test_target_proportions_and_dry_queues():
    for totals, weights in (([500, 300, 700], [5, 3, 2]), ([40, 2000, 11], [1, 1, 0]), ([7, 9, 1000], [999, 1, 1]), ([100, 200, 300], None)):
        plan = packing.Schedule(totals, 64, weights)
        want = simulated(totals, weights or totals, 64)
        got = [None] * sum(totals)
        for s, t in enumerate(totals):
            n = np.array([t // 3, 1, t - t // 3 - 1])
            place = np.cumsum(n) - n
            for d, start, length, at in zip(*plan.pieces(s, place, n)):
                assert at // 64 == (at + length - 1) // 64
                for x in range(length):
                    assert got[at + x] is None
                    got[at + x] = s
        for w in range(-(-len(want) // 64)):
            assert Counter(got[64 * w : 64 * w + 64]) == Counter(want[64 * w : 64 * w + 64]), (totals, weights, w)


def test_many_sources_and_proportions(spark):
    frame = docs(spark, [f"word {i} " * 30 for i in range(300)]).selectExpr("doc_id", "text", "concat('s', doc_id) source")
    rows = packing.packed(frame.unionAll(frame.selectExpr("null", "text", "source").limit(3)), PATH).collect()
    assert {r["source"] for r in rows} == {f"s{i}" for i in range(300)} and sum(r["id"] is None for r in rows) > 0
    total = sum(r["length"] for r in rows)
    assert sorted({r["sequence_id"] for r in rows}) == list(range(-(-total // 1024)))
    two = frame.selectExpr("doc_id", "text", "if(doc_id % 3 = 0, 'a', 'b') source")
    share = Counter()
    for r in packing.packed(two, PATH, proportions={"a": 0.5, "b": 0.5}).where("sequence_id < 8").collect():
        share[r["source"]] += r["length"]
    assert abs(share["a"] - share["b"]) <= 2
