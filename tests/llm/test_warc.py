import hashlib

from foliant.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        target = first.get(raw, i)
        again = target < i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", target if again else None))
    return sorted(out)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 8)
    monkeypatch.setattr(warc, "PAGE_BYTES", 300)
    monkeypatch.setattr(warc, "HELD_BYTES", 4000)
    odd = "<p>\r\n\r\nWARC/1.1\r\n\nfiledesc://x 1 2\n é😀</p>" * 5
    rows = [(0, None, None), (1, "http://a b\n/c", ""), (2, "u", odd), (3, "u", odd), (4, "v", "short"), (5, "v", "short"), (6, "w", "x" * 99), (7, "w", "x" * 99), (9, "w", "y" * 100), (8, "w", "y" * 100)]
    rows += [(10 + i, f"http://h/{i}", "copy " * 40 if i % 3 else f"page {i} " * 30) for i in range(60)]
    rows += [(100, "long", "z" * 3_000_000), (101, "long", "z" * 3_000_000), (102, "longer", "é" * 4_000_000)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as bytes", "'x' as digest").repartition(3)
    got = warc.converted(frame).collect()
    assert sorted(tuple(r)[:5] for r in got) == brute(rows)
    html = {i: h or "" for i, _, h in rows}
    assert all(r["payload"] == html[r["page_id"]] for r in got if r["record_type"] == "response")


def test_empty_null_ids_and_repeats(spark):
    frame = spark.createDataFrame([(None, "u", "z" * 200), (3, "u", "z" * 200), (3, "u", "z" * 200)], SCHEMA)
    rows = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in warc.converted(frame).collect())
    assert rows == [(-1, "revisit", 3), (3, "response", None), (3, "response", None)]
    assert warc.converted(frame.where("page_id = 4")).count() == 0


def test_arc_versions():
    doc = b"a\r\n\r\nb"
    one = b"u 1.2.3.4 20200102030405 text/html %d\n" % len(doc) + doc + b"\n"
    two = b"u 1.2.3.4 20200102030405 text/html 200 abc - 0 f.arc %d\n" % len(doc) + doc + b"\n"
    for version, raw in ((1, one), (2, two)):
        found = list(warc.arc_records(warc._head(version, "f.arc").encode() + b"\n" + raw + raw))
        assert [d for _, d in found] == [doc, doc] and found[0][0]["Archive-date"] == "20200102030405"
        assert [d for _, d in warc.arc_records(raw)] == [doc]
