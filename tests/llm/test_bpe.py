import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from foliant.llm import bpe

from .helpers import docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def awkward():
    rng = random.Random(3)
    alphabet = "abeinrstTHE'sdlmv  \n\t.,!?0123é́ßΣİ日本😀²½_-<|>\x00\x1c\x85 "
    texts = ["", " ", "'s", "it's don't WE'LL x''s 'd", "́ combining first", "a" * 3000, "x<|endoftext|>y <|startoftext|>'s", "ΟΔΟΣ İstanbul", "don\n't 's' ''t"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(1500)]
    return texts


def check(texts, found):
    library = Tokenizer.from_file(PATH)
    for t, (ids, decoded, n) in zip(texts, found):
        e = library.encode(t, add_special_tokens=False).ids
        assert (ids, n) == (" ".join(map(str, e)), len(e)), repr(t)
        assert decoded == library.decode(e, skip_special_tokens=False), repr(t)


def test_same_as_the_library_on_awkward_texts():
    texts = awkward()
    check(texts, bpe.Coder(PATH).texts(texts))


def test_same_as_the_library_on_the_corpus():
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    check(texts, bpe.Coder(PATH).texts(texts))


def test_query_rows(spark):
    frame = docs(spark, [None, "", "Hello THERE", "Hello THERE"]).selectExpr("*", "'x' as ids_sha256")
    rows = {r["id"]: r for r in bpe.digests(frame, PATH).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[0]["n_tokens"] == rows[1]["n_tokens"] == 0 and rows[0]["ids_sha256"] == empty == rows[1]["decoded_sha256"]
    assert rows[2][1:] == rows[3][1:] and rows[2]["n_tokens"] == 2
    full = {r["id"]: r for r in bpe.encoded(frame, PATH).collect()}
    assert full[2]["ids"] == Tokenizer.from_file(PATH).encode("Hello THERE", add_special_tokens=False).ids
    assert bpe.digests(frame.where("doc_id > 7"), PATH).count() == 0


def test_another_kind_of_file_is_refused(tmp_path):
    import json

    import pytest

    with open(PATH, encoding="utf-8") as f:
        data = json.load(f)
    for key, value in (("normalizer", None), ("decoder", {"type": "ByteLevel"})):
        path = tmp_path / "t.json"
        path.write_text(json.dumps(data | {key: value}))
        with pytest.raises(ValueError):
            bpe.Coder(str(path))
    with pytest.raises(ValueError):
        bpe.Coder(public_tokenizers.path("byte_bpe_50k.json"))


def test_very_long_text_through_the_query(spark):
    text = "long words and numbers 12345 " * 40_000
    e = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    row = bpe.digests(docs(spark, [text]), PATH).first()
    assert row["n_tokens"] == len(e) and row["ids_sha256"] == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
