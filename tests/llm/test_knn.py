import math
import random

from foliant.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in sound}):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q and len(a) == len(b))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def vectors(rng, n):
    import struct

    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    rows = [(i, [single(rng.gauss(i % 3, 0.3)) for _ in range(6)]) for i in range(n)]
    rows += [(i, rows[7][1]) for i in range(n, n + 60)]
    rows += [(n + 100, None), (n + 101, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (n + 102, [float("nan")] * 6), (n + 150, [float("inf")] * 6), (n + 200, [])]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 3)
    rows = vectors(random.Random(1), 500)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 as cell", "2 as score")
    got = sorted(tuple(r) for r in knn.top_k(frame, 5, 10, pivots=8).collect())
    assert got == brute(rows, 5, 10)


def test_few_and_none(spark):
    rows = [(0, [0.5, -0.25]), (50, [1.0, 1.0]), (51, [1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(tuple(r) for r in knn.top_k(frame).collect()) == brute(rows, 5, 50)
    assert knn.top_k(frame.where("vec_id > 99")).count() == 0


def test_repeated_queries_null_ids_and_mixed_lengths(spark):
    rng = random.Random(4)
    rows = vectors(rng, 120)
    rows += [rows[0], rows[0], rows[3], (0, [9.0] * 6), (None, [1.0] * 6), (50, [2.0, 1.0]), (51, [1.0, 1.0]), (100, [3.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(tuple(r) for r in knn.top_k(frame, 5, 50).collect()) == brute(rows, 5, 50)
    few = [(0, [1.0, 0.5])] * 2 + [(i, [i / 8, 0.5]) for i in range(1, 9)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in few], SCHEMA)
    assert [r["vec_id"] for r in knn.top_k(frame).orderBy("rank").collect()] == [8, 7, 6, 5, 4]


def test_bounds_leave_out_what_lies_far(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(10)]
    rows = [(i, [x + rng.gauss(0, 0.02) for x in centres[i % 10]]) for i in range(2000)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    report = {}
    assert sorted(tuple(r) for r in knn.top_k(frame, report=report).collect()) == brute(rows, 5, 50)
    assert report["asked"] < 0.25 * report["pairs"]
