"""Traps of the operators, by hand-made rows."""

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators import chunks, enrich, intervals, quality, search, structure, summaries, validation
from foliant.plans import pipeline
from foliant.sources import datasets


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_text_functions(spark):
    assert one(spark, "Multiple    spaces\n\n\n\nand\n\n\nlines", T.normalize) == "Multiple spaces\n\nand\n\nlines"
    assert one(spark, "hy-\n  phen «q» a–b\u0000", T.normalize) == 'hyphen "q" a--b'
    assert one(spark, "", T.normalize) == "" and one(spark, None, T.normalize) is None
    assert one(spark, "ﬁne №", lambda c: T.normalize(c, unicode=True)) == "fine No"
    assert one(spark, "a Generated by  X\nb", T.strip_watermarks) == "aX\nb"
    assert one(spark, "1\nbody\n- 3 -\n[ 4 ]\n5 a", T.strip_page_numbers) == "body\n5 a"
    assert one(spark, "ёлка and the über", T.tokens) == ["лка", "ber"]
    assert one(spark, "well-known", T.has_formula) is True
    assert one(spark, "Каган Марти", T.sanitized) == "kagan_marti"
    assert one(spark, "Test®Book™", T.sanitized) == "test_book"
    assert len(one(spark, "x" * 200, T.sanitized)) == 50
    assert one(spark, "To <a.b@c.org>; <no>", T.emails) == "a.b@c.org"
    assert one(spark, "One. Two!  Three", T.sentences) == ["One.", "Two!", "Three"]


def test_sizes_round_halves_to_even_and_null_stays(spark):
    size = lambda n: spark.createDataFrame([(n,)], "x long").select(T.format_size(F.col("x")).alias("y")).first()["y"]
    assert [size(n) for n in (1152, 1408, 37504, 1044167709991895)] == ["1.12 KB", "1.38 KB", "36.62 KB", "949.66 TB"]
    assert [size(n) for n in (None, 0, 1023, 1024, 2**60)] == [None, "0.00 B", "1023.00 B", "1.00 KB", "1024.00 PB"]


def test_sentences_are_split_and_counted_once(spark):
    cards = spark.createDataFrame([(1, "A first sentence of plain words. A second one of plain words: 2."), (2, "short"), (3, None), (4, "")], "doc_id long, segment string")
    found = summaries.sentence_scores(cards)
    assert [(r["doc_id"], r["i"]) for r in found.orderBy("doc_id", "i").collect()] == [(1, 0), (1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("split(") == 1


def fold(text, size=512, overlap=128, least=100):
    """The chunk fold in plain Python."""
    tok = lambda s: len(s) // 4
    import re

    if len(text.strip()) < 10:
        return []
    cur, n, out = [], 0, []
    for s in [x.strip() for x in re.split(r"(?<=[.!?])\s+", text) if x.strip()]:
        if n + tok(s) > size and cur:
            if tok(" ".join(cur)) >= least:
                out.append(" ".join(cur))
            kept, total = [], 0
            for x in reversed(cur):
                if total + tok(x) > overlap:
                    break
                kept.insert(0, x)
                total += tok(x)
            cur, n = kept, total
        cur.append(s)
        n += tok(s)
    if cur and tok(" ".join(cur)) >= least:
        out.append(" ".join(cur))
    return out


def test_chunk_fold_against_plain_python(spark):
    import random

    rng = random.Random(1)
    texts = ["This is a test sentence. " * 100, "short", "x" * 5000 + ". " + "y. " * 300]
    texts += [" ".join("w" * rng.randint(1, 300) + rng.choice(".!?,") for _ in range(rng.randint(1, 80))) for _ in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in frame.select("i", chunks.folded(F.col("t")).alias("c")).collect():
        assert r["c"] == fold(texts[r["i"]]), r["i"]


def cards(spark, pages, book="b"):
    rows = [(i, book, p, f"{p:05d}", t, "b.pdf") for i, (p, t) in enumerate(pages)]
    return spark.createDataFrame(rows, "doc_id long, book string, page_num int, segment_id string, segment string, source_file string")


def test_chapters_keep_their_distance_and_sections_outlive_them(spark):
    c = cards(spark, [(1, "Chapter 1: First\n1.1 Alpha"), (2, "chapter II - too near"), (3, "Chapter 3: ab"), (4, "x"), (5, "Глава 4. Четвёртая"), (6, "x"), (9, "§ 2 Beta")])
    assert [(r["page_num"], r["num"]) for r in structure.chapters(c).orderBy("page_num").collect()] == [(1, "1"), (5, "4")]
    rows = {r["page_num"]: r for r in structure.filled(c).collect()}
    assert rows[6]["chapter_num"] == "4" and rows[6]["section_title"] == "Alpha" and rows[9]["section_title"] == "Beta"


def test_duplicates_and_continuity(spark):
    text = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    c = cards(spark, [(1, text), (2, "other words entirely different from the first page " * 2), (3, text.upper() + "  "), (4, "tiny"), (5, "tiny")])
    marked = {r["page_num"]: r for r in enrich.duplicates_marked(c).collect()}
    assert [p for p, r in marked.items() if r["is_duplicate"]] == [3] and marked[3]["duplicate_page"] == 1
    assert 3 not in {r["page_num"] for r in enrich.continuity(c).collect()}


def test_thresholds(spark):
    good = {"min_success_ratio": 0.98, "max_empty_ratio": 0.05, "min_avg_page_length": 1000.0, "max_error_ratio": 0.02}
    bad = {"min_success_ratio": 0.80, "max_empty_ratio": 0.20}
    rows = [(n, "structural", k, v) for n, own in (("good", good), ("bad", bad)) for k, v in own.items()]
    m = spark.createDataFrame(rows, "run string, stage string, metric string, value double")
    got = quality.checked(m, quality.limits(spark), literal=True).groupBy("run", "status").count().collect()
    n = {(r["run"], r["status"]): r["count"] for r in got}
    assert n == {("good", "ok"): 4, ("good", "missing"): 1, ("bad", "violation"): 2, ("bad", "missing"): 3}


def test_validation_rules(spark):
    rows = spark.createDataFrame([("1", "ok text here", 1), (None, "short", 0), ("3", "  \n   \n   x   ", None)], "segment_id string, segment string, page_num int")
    got = validation.violations(rows, validation.STAGES["structural"](), "segment_id").collect()
    assert sorted((r["segment_id"] or "", r["rule"]) for r in got) == [("", "Range"), ("", "RequiredField"), ("", "TextQuality"), ("3", "RequiredField"), ("3", "TextQuality")]
    typed = validation.violations(spark.createDataFrame([("x",), ("4",), (None,)], "n string"), [validation.typed("n", "int")], "n").collect()
    assert [r["n"] for r in typed] == ["x"]


def test_search_pieces(spark):
    assert search.expand("specific") == ["specific", "spe" + "continuous integration" + "fic", "spe" + "build automation" + "fic"]
    a = spark.createDataFrame([(1, 0.9), (2, 0.5)], "id long, score double")
    b = spark.createDataFrame([(2, 3.0), (3, 3.0)], "id long, score double")
    got = {r["id"]: (r["semantic"], r["keyword"], r["score"]) for r in search.hybrid(a, b).collect()}
    assert got == {1: (1.0, 0.0, 0.7), 2: (0.0, 1.0, 0.3), 3: (0.0, 1.0, 0.3)}
    hits = spark.createDataFrame([(0, 1, 0.2), (1, 1, 0.9), (1, 2, 0.4)], "query_no int, id long, score double")
    assert {r["id"]: r["score"] for r in search.merged(hits).collect()} == {1: 0.2, 2: 0.4}
    flags = spark.createDataFrame([(1, None), (2, True)], "id long, has_code boolean")
    assert [r["id"] for r in search.filtered(flags, has_code=False).collect()] == [1]


def test_ivf_finds_what_the_exact_index_finds(spark):
    from foliant.operators import ann

    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    index, centres = ann.indexed(e, 16)
    hit = total = 0
    for v in (0, 50, 100, 150):
        q = e.where(F.col("vec_id") == v).select(F.col("embedding").alias("q"))
        exact = {r["id"] for r in search.nearest(e, q, 10).collect()}
        hit += len(exact & {r["id"] for r in ann.probed(index, centres, q, 10, 12).collect()})
        total += len(exact)
    assert hit >= 0.9 * total


def test_intervals_drop_negative_spans(spark):
    log = spark.createDataFrame([("k", "open", "2024-01-01 00:00:00", 1), ("k", "done", "2024-01-03 12:00:00", 2)], "key string, status string, at string, id int").withColumn("at", F.col("at").cast("timestamp"))
    got = {r["status"]: r["days"] for r in intervals.status_intervals(log, "2024-01-02 00:00:00").collect()}
    assert got == {"open": 2.5}


def test_dataset_files_keep_odd_lines(spark, tmp_path):
    c = cards(spark, [(1, "a b"), (2, "===DATASET_END==="), (3, "line\nbreak")])
    datasets.written(c, f"file://{tmp_path}/d")
    got = datasets.read(spark, f"file://{tmp_path}/d")
    assert {r["segment"] for r in got.where("kind = 'card'").collect()} == {"a b", "===DATASET_END===", "line\nbreak"}
    assert {r["kind"] for r in got.collect()} == {"card", "header", "audit", "footer"}


def test_pipeline_runs_in_part_and_whole(spark):
    c = cards(spark, [(i, f"Chapter {i}: Title\n" + "A sentence of some words here. " * 30) for i in range(1, 9)])
    rows, status = pipeline.run(c)
    assert pipeline.overall(status) == "completed" and rows.count() == 8
    rows, status = pipeline.run(c, "structure", "summarize", write=False)
    assert set(status) == {"structure", "summarize"} and "l1_summary" in rows.columns
    with pytest.raises(Exception):
        pipeline.run(c.drop("segment"), "finalize", "finalize")


def test_numbers_above_the_width_stay_whole(spark):
    from foliant.functions.text import padded

    rows = spark.createDataFrame([(7,), (99999,), (100000,), (123456,)], "n long").select(padded(F.col("n"), 5).alias("p")).collect()
    assert [r["p"] for r in rows] == ["00007", "99999", "100000", "123456"]


def test_a_failed_stage_is_raised_unless_asked(spark):
    c = cards(spark, [(1, "Chapter 1: Title\nwords")])
    with pytest.raises(Exception):
        pipeline.run(c.drop("doc_id"), "summarize", "summarize")
    _, status = pipeline.run(c.drop("doc_id"), "summarize", "summarize", keep_going=True)
    assert status == {"summarize": "failed"}


def test_keyword_index_gives_what_raw_texts_give(spark, tmp_path):
    from foliant.operators import keyword_index, search

    texts = ["red apple tree", "red red rose", None, "", "blue sky over the apple tree", "apple apple apple pie"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = keyword_index.build(d, str(tmp_path / "index"))
    for words in (["apple", "tree", "apple"], ["red"], ["none"], []):
        asked = spark.createDataFrame([(w,) for w in words], "term string")
        want = [tuple(r) for r in search.bm25(d, asked, 4).collect()]
        assert [tuple(r) for r in keyword_index.search(spark, path, words, 4).collect()] == want
    plan = keyword_index.search(spark, path, ["apple"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,apple)]" in plan or "In(term" in plan


def test_changed_dataset_files_are_found(spark, tmp_path):
    c = spark.createDataFrame([(b, f"{i:05d}", i, f"page {i} ü", f"{b}.pdf") for b in ("a", "b") for i in range(1, 30)], "book string, segment_id string, page_num int, segment string, source_file string")
    datasets.written(c, f"file://{tmp_path}/d")
    assert {r["book"]: (r["lines"], r["intact"]) for r in datasets.checked(spark, f"file://{tmp_path}/d").collect()} == {"a": (31, True), "b": (31, True)}
    for part in (tmp_path / "d" / "book=a").iterdir():
        if part.name.startswith("."):
            part.unlink()  # the reader's own checksums, or it would refuse the file
    (part,) = (tmp_path / "d" / "book=a").iterdir()
    part.write_text(part.read_text().replace("page 7 ", "page 8 "))
    assert {r["book"]: r["intact"] for r in datasets.checked(spark, f"file://{tmp_path}/d").collect()} == {"a": False, "b": True}


def test_strict_validation_raises(spark):
    c = spark.createDataFrame([("a", "00001", 1, "long enough text", "a.pdf"), ("a", "00001", 2, "the same id again", "a.pdf"), ("a", "00003", 3, "         short", "a.pdf"), ("a", None, 4, "long enough text", "a.pdf")], "book string, segment_id string, page_num int, segment string, source_file string")
    assert sorted(r["page_num"] for r in validation.accepted(c).collect()) == [1, 2]
    with pytest.raises(ValueError):
        validation.accepted(c, strict=True)
