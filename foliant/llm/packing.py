"""Mixture-controlled packing of tokenised documents into fixed windows.

Source queues are served by deficit round-robin.  In each round a source may
serve its share of ``window`` tokens; what it could not serve for want of a whole
token is its deficit and is carried to the next round, so after w rounds source s
has served floor(w * window * T_s / T) tokens exactly (T_s: its weight, T: all).
The rounds follow each other in one stream that is cut every ``window`` tokens:
all sequences are full but the last, and each holds the target proportions to
within one token a source and round.

Target proportions other than the sources' own shares are served in the same way
until a queue runs dry; from then on the others share its part.

The served totals are closed forms of w between two such ends, so any document
finds its rounds from its place in its source's queue alone.  Places come from sums per (source, part
of the token table); no queue is ever gathered, and deficits cross windows and
partitions without a pass over either.

Documents wait in a queue in the order of the token table's parts.  Tokens are
written once to the shared folder and read once.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .presplit import spaced_words
from .automaton import byte_letters
from .shared import removed, written

WINDOW = 1024
END_ID = 0
#: Bytes that a worker keeps for words and their ids, and what the interpreter takes for each such entry.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 180
WIDTH = np.uint32


class ByteBpe:
    """Byte-level BPE of whole texts: distinct words are encoded once per slice and cached.

    The file's vocabulary is turned into merge ranks; texts that hold a special
    token are left to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if data["model"]["type"] != "BPE" or data.get("normalizer") or data.get("pre_tokenizer") != plain or data["model"].get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        back = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        ranks = {bytes(back[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.path = path
        self.core = tiktoken.Encoding("bpe", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.words: dict[bytes, bytes] = {}
        self.held = 0

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_padding()
        library.no_truncation()
        return library

    def word(self, raw: bytes) -> bytes:
        """A word's ids, as ``WIDTH`` values."""
        found = self.words.get(raw)
        if found is None:
            if self.held > CACHE_BYTES:
                self.words.clear()
                self.held = 0
            found = self.words[raw] = array("I", self.core._encode_single_piece(raw)).tobytes()
            self.held += len(raw) + len(found) + ENTRY_BYTES
        return found

    def texts(self, buf: np.ndarray, offs: np.ndarray):
        """(all ids, offsets per text), without a closing id."""
        n = len(offs) - 1
        raw = buf.tobytes()
        ids, cut = self._plain(raw, buf, offs)
        rare = [i for i in range(n) if any(s.encode() in raw[offs[i] : offs[i + 1]] for s in self.special)] if any(s.encode() in raw for s in self.special) else []
        if not rare:
            return ids, cut
        parts = [ids[cut[i] : cut[i + 1]] for i in range(n)]
        for i in rare:
            parts[i] = np.array(self.library.encode(raw[offs[i] : offs[i + 1]].decode(), add_special_tokens=False).ids, WIDTH)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _plain(self, raw: bytes, buf: np.ndarray, offs: np.ndarray):
        if not len(buf):
            return np.zeros(0, WIDTH), np.zeros(len(offs), np.int64)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
        first = np.zeros(len(points), bool)
        first[np.searchsorted(place, offs[:-1][np.diff(offs) > 0])] = True
        at = place[np.flatnonzero(spaced_words(points, first))]
        to = np.append(at[1:], len(buf))
        codes, one = K.distinct(buf, at, to)
        known = [self.word(raw[a:b]) for a, b in zip(at[one].tolist(), to[one].tolist())]
        size = np.array([len(k) for k in known], np.int64) // WIDTH().itemsize
        flat = np.frombuffer(b"".join(known), WIDTH)
        ids = flat[K.ragged((np.cumsum(size) - size)[codes], size[codes])]
        total = np.concatenate([[0], np.cumsum(size[codes])])
        return ids, total[np.searchsorted(at, offs)]


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, part, place, n, ids): ids little-endian 32 bit with the end id; place: tokens before it in its source and part."""

    def run(batches):
        code = byte_bpe(path)
        part = TaskContext.get().partitionId()
        served: dict[str, int] = {}
        end = np.array([END_ID], WIDTH)
        for batch in batches:
            sources = batch.column(1).to_pylist()
            for a, b, buf, offs in K.slices(batch.column(2)):
                ids, cut = code.texts(buf, offs)
                rows = [np.concatenate([ids[x:y], end]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                places = []
                for s, r in zip(sources[a:b], rows):
                    places.append(served.get(s, 0))
                    served[s] = places[-1] + len(r)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array([part] * (b - a), pa.int32()), pa.array(places, pa.int64()), pa.array([len(r) for r in rows], pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["id", "source", "part", "place", "n", "ids"],
                )

    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    frame = docs.select(F.col(id_col).cast("long").alias("id"), name.alias("source"), F.col(text_col).alias("text"))
    return frame.mapInArrow(run, "id long, source string, part int, place long, n long, ids binary")


class Schedule:
    """What deficit round-robin has served after any round, exactly.

    ``weights``: what the sources' shares of a round stand in proportion to, as
    integers; without them, their tokens.  When a queue runs dry, its share goes
    to the others in their proportions; sources of weight zero are served after
    all others, in proportion to their tokens.
    """

    def __init__(self, totals: list[int], window: int = WINDOW, weights: list[int] | None = None):
        self.totals, self.all, self.window = np.array(totals, np.int64), int(sum(totals)), window
        weights = list(weights or totals)
        rest, begin = list(map(int, totals)), 0
        phases = []  # the round-robin's clock at its begin, the sum of weights, and each source's weight, tokens served before and tokens left
        while any(rest):
            own = [w if n else 0 for w, n in zip(weights, rest)]
            own = own if any(own) else list(rest)
            every = sum(own)
            phases.append((begin, every, own, [t - n for t, n in zip(totals, rest)], list(rest)))
            span = min(-(-n * every // w) for n, w in zip(rest, own) if w)
            rest = [n - min(n, span * w // every) for n, w in zip(rest, own)]
            begin += span
        self.end = begin
        columns = list(zip(*phases)) if phases else [[], [], [], [], []]
        self.begin, self.every = np.array(columns[0], np.int64), np.array(columns[1], np.int64)
        self.own, self.before, self.left = (np.array(c, np.int64).reshape(len(phases), len(totals)) for c in columns[2:])

    def served(self, s: int, rounds: np.ndarray) -> np.ndarray:
        """Tokens of the source after so many rounds: a floor of a quotient, by a float guess and its exact remainder modulo 2**64."""
        m = np.minimum(rounds * self.window, self.end)
        k = np.searchsorted(self.begin, m, "right") - 1
        m = m - self.begin[k]
        w, every = self.own[k, s], self.every[k]
        guess = np.floor(m * (w / every)).astype(np.int64)
        with np.errstate(over="ignore"):
            rest = (m.astype(np.uint64) * w.astype(np.uint64) - guess.astype(np.uint64) * every.astype(np.uint64)).view(np.int64)
        return self.before[k, s] + np.minimum(self.left[k, s], guess + rest // every)

    def round_of(self, s: int, place: np.ndarray) -> np.ndarray:
        """The round that serves the source's token of that place, by bisection."""
        low, high = np.zeros(len(place), np.int64), np.full(len(place), -(-self.end // self.window))
        while (high - low > 1).any():
            middle = (low + high) // 2
            below = self.served(s, middle) <= place
            low, high = np.where(below, middle, low), np.where(below, high, middle)
        return low

    def stream(self, s: int, place: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Place in the stream of the source's token, given its round."""
        some, at = np.unique(rounds, return_inverse=True)
        before = np.zeros(len(some), np.int64)
        for j in range(len(self.totals)):
            before += self.served(j, some + 1) if j < s else self.served(j, some)
        return place - self.served(s, some)[at] + before[at]

    def pieces(self, s: int, place: np.ndarray, n: np.ndarray):
        """(document index, start, length, stream place) of the documents' pieces, cut at rounds and at windows."""
        first, last = self.round_of(s, place), self.round_of(s, place + n - 1)
        count = last - first + 1
        if count.sum() <= 2 * n.sum():
            doc = np.repeat(np.arange(len(place)), count)
            rounds = K.ragged(first, count)
            begin = np.maximum(self.served(s, rounds), place[doc])
            end = np.minimum(self.served(s, rounds + 1), (place + n)[doc])
            some = end > begin
            doc, rounds, begin, end = doc[some], rounds[some], begin[some], end[some]
        else:  # less than a token in most rounds: look at tokens, not rounds
            doc = np.repeat(np.arange(len(place)), n)
            begin = K.ragged(place, n)
            end = begin + 1
            rounds = self.round_of(s, begin)
        at = self.stream(s, begin, rounds)
        size = end - begin
        parts = (at + size - 1) // self.window - at // self.window + 1
        k = K.ragged(np.zeros_like(parts), parts)
        r = np.repeat(np.arange(len(parts)), parts)
        lo = np.maximum(at[r], (at[r] // self.window + k) * self.window)
        hi = np.minimum(at[r] + size[r], (at[r] // self.window + k + 1) * self.window)
        doc = doc[r]
        start = begin[r] + lo - at[r] - place[doc]
        length = hi - lo
        if len(start) > 1:  # neighbours in the stream are one piece
            joined = (lo[1:] == hi[:-1]) & (lo[1:] % self.window != 0) & (doc[1:] == doc[:-1])
            head = np.flatnonzero(np.append(True, ~joined))
            length = np.add.reduceat(length, head)
            doc, start, lo = doc[head], start[head], lo[head]
        return doc, start, length, lo


def _weights(names: list[str], proportions: dict[str, float] | None) -> list[int] | None:
    if not proportions:
        return None
    if min(proportions.values()) < 0:
        raise ValueError("a proportion is negative")
    most = max(proportions.values())
    return [round(proportions.get(s, 0) / most * 1_000_000) if most else 0 for s in names]


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", window: int = WINDOW, with_ids: bool = False, proportions: dict[str, float] | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source (and the piece's ids).

    ``proportions``: the target share of each source in every window, to a
    millionth of the largest, as long as all queues last; without it, the
    sources' own shares of all tokens.  Sources that it leaves out come last.

    Every row is packed, null ids and repeated rows too; a null text is empty
    and has the end id alone; a null source is the source ''.  The sources'
    totals, one number each, are held by the driver and sent to every task.  An empty table
    gives no piece.
    """
    spark = docs.sparkSession
    table = written(tokenised(docs, path, id_col, text_col, source_col), "tokens")
    sums = written(table.groupBy("source", "part").agg(F.sum("n").alias("tokens")), "token-sums")
    totals = {r["source"]: r["t"] for r in sums.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    names = sorted(totals)
    schedule = Schedule([totals[s] for s in names], window, _weights(names, proportions))
    index = {s: i for i, s in enumerate(names)}
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(sums.select("source", "part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")), "token-bases")
    removed(spark, sums)
    rows = table.join(base, ["source", "part"]).select("id", "source", (F.col("base") + F.col("place")).alias("place"), "n", "ids")
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        for batch in batches:
            sources, place, n = batch.column(1).to_pylist(), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            tokens = batch.column(4).cast(pa.large_binary())
            bytes_at = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens)]
            raw = memoryview(tokens.buffers()[2]) if len(tokens) else memoryview(b"")
            queue = np.array([index[s] for s in sources], np.int64)
            for q in np.unique(queue).tolist():
                own = np.flatnonzero(queue == q)
                doc, start, length, at = schedule.pieces(q, place[own], n[own])
                doc = own[doc]
                a = bytes_at[doc] + 4 * start
                spans = list(zip(a.tolist(), (a + 4 * length).tolist()))
                crc = np.fromiter((zlib.crc32(raw[x:y]) for x, y in spans), np.int64, len(spans))
                out = [batch.column(0).take(pa.array(doc)), *(pa.array(x) for x in (start, length, crc, n[doc], at // window, at % window)), pa.array([names[q]] * len(doc))]
                if with_ids:
                    out.append(pa.array([np.frombuffer(raw[x:y], WIDTH).tolist() for x, y in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"][: len(out)])

    return rows.mapInArrow(run, schema)
