"""BPE encoding and decoding of whole texts with the tokenization automaton.

A slice of texts is normalised, cut into words by character class, and its
distinct words are encoded by the automaton; a text's ids and labels are its
words' ids and labels in order.  The per-process word cache is cleared when it
takes ``CACHE_BYTES`` bytes, so memory is bounded and no word is left out.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .automaton import Automaton
from .presplit import bare_words

#: Bytes that a worker keeps for words, ids and labels, and what the interpreter takes for each such entry.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 320
# The word pattern, the normaliser and the pre-tokenizer of the tokenizer files that are coded here.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def checked(path: str) -> dict:
    """The tokenizer file, or an error if it asks for what is not coded here."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    model = data["model"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    steps = (data.get("normalizer") or {}).get("normalizers"), (data.get("pre_tokenizer") or {}).get("pretokenizers")
    added = all(not t[k] for t in data.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if model["type"] != "BPE" or not plain or not added or steps != (NORMALIZERS, PRETOKENIZERS) or data.get("decoder"):
        raise ValueError(f"{path}: only BPE with the normaliser {NORMALIZERS} and the pre-tokenizer {PRETOKENIZERS} is coded")
    return data


class Coder:
    """Encodes and decodes texts by one tokenizer file (a path is a parameter of the operator); another kind of file is refused."""

    def __init__(self, path: str):
        added = checked(path).get("added_tokens") or []
        self.automaton = Automaton.load(path)
        self.special = {t["content"]: t["id"] for t in added}
        self.automaton.labels.update({i: t for t, i in self.special.items()})
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.words: dict[bytes, tuple[str, str, int]] = {}
        self.held = 0

    @staticmethod
    def normalised(text: str) -> str:
        """NFC, then lower case letter by letter (a final sigma is an ordinary one)."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def word(self, raw: bytes) -> tuple[str, str, int]:
        """A word's ids and labels, space-joined, and their number."""
        found = self.words.get(raw)
        if found is None:
            if self.held > CACHE_BYTES:
                self.words.clear()
                self.held = 0
            ids = self.automaton.encode(raw)
            found = self.words[raw] = " ".join(map(str, ids)), self.automaton.decode(ids), len(ids)
            self.held += len(raw) + len(found[0]) + len(found[1]) + ENTRY_BYTES
        return found

    def mixed(self, text: str) -> tuple[list[str], list[str], int]:
        """The same for a text that holds special tokens."""
        ids, labels, n = [], [], 0
        for part in self.split.split(text):
            if part in self.special:
                found = [(str(self.special[part]), part, 1)]
            else:
                found = [self.word(w.encode()) for w in self.pattern.findall(self.normalised(part))]
            for i, t, k in found:
                ids.append(i)
                labels.append(t)
                n += k
        return ids, labels, n

    def texts(self, texts: list[str]):
        """Per text: ids joined by a space, decoded text, number of tokens."""
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if any(x in t for x in self.special):
                ids, labels, n = self.mixed(t)
                out[i] = " ".join(ids), " ".join(labels), n
            else:
                plain.append(i)
        norm = [self.normalised(texts[i]) for i in plain]
        sizes = np.array([len(t) + 1 for t in norm], np.int64)
        flat = "\n".join(norm) + "\n"
        points = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        raw = flat.encode()
        buf = np.frombuffer(raw, np.uint8)
        place = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
        start, end = bare_words(points)
        at, to = place[start], place[end]
        codes, first = K.distinct(buf, at, to)
        known = [self.word(raw[a:b]) for a, b in zip(at[first].tolist(), to[first].tolist())]
        ids = np.array([k[0] for k in known] + [""], object)[codes]
        labels = np.array([k[1] for k in known] + [""], object)[codes]
        count = np.concatenate([[0], np.cumsum(np.array([k[2] for k in known] + [0], np.int64)[codes])])
        cut = np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))
        for k, i in enumerate(plain):
            a, b = cut[k], cut[k + 1]
            out[i] = " ".join(ids[a:b].tolist()), " ".join(labels[a:b].tolist()), int(count[b] - count[a])
        return out


@lru_cache(2)
def coder(path: str) -> Coder:
    return Coder(path)


def texts_of(batch_column, ids):
    """(ids, texts) of bounded slices of a column; null: empty."""
    for a, b, buf, offs in K.slices(batch_column):
        raw = buf.tobytes()
        yield ids[a:b], [raw[x:y].decode() for x, y in zip(offs[:-1].tolist(), offs[1:].tolist())]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded, n_tokens) of every row; null and empty texts have no tokens."""

    def run(batches):
        code = coder(path)
        for batch in batches:
            for ids, texts in texts_of(batch.column(1), batch.column(0)):
                found = code.texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([[int(x) for x in f[0].split()] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.int64())],
                    ["id", "ids", "decoded", "n_tokens"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids array<int>, decoded string, n_tokens long")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the same coder, its outputs hashed where they arise."""

    def run(batches):
        code = coder(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for ids, texts in texts_of(batch.column(1), batch.column(0)):
                found = code.texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([f[2] for f in found], pa.int64()), pa.array([sha(f[0]) for f in found]), pa.array([sha(f[1]) for f in found])],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
