import numpy as np
import pyarrow.parquet as pq
import re

from foliant.llm import secrets

from .helpers import docs


def test_held_out_accuracy():
    forest = secrets.default_forest()
    rows = secrets.synthetic_findings(1500, seed=99)
    chance = forest.predict([secrets.features(t, a, b, p) for t, a, b, p, _ in rows])
    right = (chance >= secrets.SURE) == np.array([y for *_, y in rows], bool)
    assert right.mean() > 0.96


def test_finds_the_corpus_s_tokens_and_nothing_else():
    forest = secrets.default_forest()
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    planted = re.compile(r'(?i)token = "([0-9a-f]{40})"')
    for t in texts:
        spans, chance = secrets.scan_text(t, "src1", forest)
        got = [s for s, c in zip(spans, chance) if c >= secrets.SURE]
        assert got == [m.span(1) for m in planted.finditer(t)], t[:200]


def test_forest_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(secrets.FEATURES)))
    y = (x[:, 3] > 0.5) ^ (x[:, 7] > 0.6)
    forest = secrets.Forest(x[:400], y[:400])
    assert ((forest.predict(x[400:]) > 0.5) == y[400:]).mean() > 0.8


def test_rows(spark):
    value = "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c"
    texts = [None, "", "plain words only", f'then token = "{value}" and more', f'token = "{value}"', "x" * 100_000]
    frame = docs(spark, texts).selectExpr("*", "1 as id", "'p' as path")
    rows = {r["id"]: r for r in secrets.scanned(frame).collect()}
    assert rows[0]["masked"] is None and rows[1]["masked"] == "" and rows[2]["masked"] == texts[2]
    assert rows[3]["masked"] == 'then token = "[SECRET]" and more' and rows[4]["masked"] == 'token = "[SECRET]"'
    assert texts[3][rows[3]["findings"][0]["start"] : rows[3]["findings"][0]["end"]] == value
    assert rows[5]["masked"] == texts[5]
    assert secrets.scanned(frame.where("doc_id > 90")).count() == 0


def test_trained_from_a_table(spark):
    rows = secrets.synthetic_findings(400)
    table = spark.createDataFrame(rows, "text string, start int, end int, path string, label int")
    forest = secrets.trained(table)
    assert forest.predict([secrets.features(*r[:4]) for r in rows[:50]]).shape == (50,)
