"""Secret scans: candidate strings judged by a random forest.

Candidates are long unbroken strings with a digit or mixed case, and values that
are assigned to a telling name.  The forest removes false positives.  It looks at
a candidate's length, at its character transitions (changes of kind, and how
usual its letter pairs are in words), at how much of it a dictionary covers, at
the path around it, and at the words beside it.  It is trained from labelled
findings: a table of (text, start, end, path, label) of which at most
``MOST_LABELLED`` rows are used, or the seeded findings of ``synthetic_findings``.
"""

from __future__ import annotations

import random
import re
import string
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import kept_types

MOST_LABELLED = 6000
TREES, DEPTH, LEAF = 40, 10, 3
SURE = 0.5
MASK = "[SECRET]"
NEAR = 48
# Words that name a secret, words that name something else, and common words and parts of identifiers.
TELLING = ["token", "secret", "password", "passwd", "pwd", "key", "apikey", "credential", "auth", "bearer", "private"]
HARMLESS = ["example", "sample", "dummy", "test", "placeholder", "your", "changeme", "sha", "md5", "checksum", "digest", "commit", "uuid", "guid", "hash", "revision", "etag", "integrity", "version", "phone", "card", "order", "isbn"]
DICTIONARY = """able about access account action after again agent all also and any app apple application area array auth
back base bean before best block body book build button by call can case cat change char check class click client code
color com commit common config connection content context control copy core count create current data date day default
delete description design dev dir document done down draw drive each element end entry error event example factory
false field file filter find first float for form format from function get global good group hand handle hash head
header help here high home host html http icon image import in index info init input insert int internal is item java
join json key label last layout left level lib line link list load local lock log login long main make manager map
mark max message method min mode model module name nation native net network new next node not null number object of
off old on open option order org out output over page parent part pass password path people place plan point port
post print process product project public pull push query queue read record release remove report request reset
resource response result return right root route row rule run sample save scale scan screen script search secret
section select send server service session set shared show side sign simple site size slot small some sort source
space spec start state static status step stop store stream string style submit sum super system table tag task temp
template test text that the their then this thread time title to token tool top total trace true type under unit
update upload url use user util value vector version view wait was web what when where while window with word work
world write year your""".split()

_RUN = re.compile(r"(?<![A-Za-z0-9_+/=\-])[A-Za-z0-9_+/=\-]{16,}")
_VALUE = re.compile(r"(?i)(?:" + "|".join(TELLING) + r")[\"']?\s{0,3}[:=]{1,2}\s{0,3}[\"']?([^\s\"'<>,;]{8,})")
_KIND = np.zeros(128, np.int8)
for _k, _chars in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits)):
    _KIND[[ord(c) for c in _chars]] = _k + 1
_WORDS = re.compile("|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=len, reverse=True)))
_TELLING, _HARMLESS = re.compile("|".join(TELLING)), re.compile("|".join(HARMLESS))
_PAIRS: dict[str, float] = {}


def _pairs() -> dict[str, float]:
    """How usual each letter pair is in the dictionary, as a log share."""
    if not _PAIRS:
        counts: dict[str, int] = {}
        for w in DICTIONARY:
            for i in range(len(w) - 1):
                counts[w[i : i + 2]] = counts.get(w[i : i + 2], 0) + 1
        total = sum(counts.values()) + 26 * 26
        _PAIRS.update({a + b: float(np.log((counts.get(a + b, 0) + 1) / total)) for a in string.ascii_lowercase for b in string.ascii_lowercase})
    return _PAIRS


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of a text that may be secrets, in order and disjoint."""
    found = []
    for m in _RUN.finditer(text):
        s = m.group()
        a, b = m.span()
        if any(c.isdigit() for c in s) or (not s.islower() and not s.isupper() and not s.istitle()):
            found.append((a, b))
    for m in _VALUE.finditer(text):
        found.append(m.span(1))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


FEATURES = ["length", "digits", "upper", "symbols", "distinct", "entropy", "transitions", "pairs", "dictionary", "slashes", "dots", "separators", "hex", "path", "telling", "harmless", "assigned", "quoted", "word_before"]


def features(text: str, start: int, end: int, path: str = "") -> list[float]:
    s = text[start:end]
    n = len(s)
    low = s.lower()
    kinds = _KIND[np.minimum(np.frombuffer(s.encode("utf-32-le"), np.uint32), 127)]
    count = np.bincount(kinds, minlength=4)
    _, each = np.unique(list(s), return_counts=True)
    share = each / n
    pairs = _pairs()
    usual = [pairs[low[i : i + 2]] for i in range(n - 1) if low[i : i + 2] in pairs]
    before, after = text[max(0, start - NEAR) : start].lower(), text[end : end + NEAR // 2].lower()
    tail = before.rstrip("\"' ")
    return [
        n,
        count[3] / n,
        count[2] / n,
        count[0] / n,
        len(each) / n,
        float(-(share * np.log2(share)).sum()),
        float((kinds[1:] != kinds[:-1]).sum()) / n,
        float(np.mean(usual)) if usual else -7.0,
        sum(len(w) for w in _WORDS.findall(low)) / n,
        s.count("/") / n,
        s.count(".") / n,
        (s.count("-") + s.count("_")) / n,
        float(all(c in "0123456789abcdef" for c in low)),
        float(bool(re.search(r"(://|www\.|/|\\|\.(?:html?|js|py|css|png|jpg|java|json|txt)\b)", before[-16:] + s + after[:6])) or "test" in path.lower() or "example" in path.lower()),
        float(bool(_TELLING.search(before[-24:]))),
        float(bool(_HARMLESS.search(before)) or bool(_HARMLESS.search(low))),
        float(tail.endswith(("=", ":"))),
        float(start > 0 and text[start - 1] in "\"'" and text[end : end + 1] in ("\"", "'")),
        float(bool(re.search(r"[a-zà-ÿ]{2,}\s$", before))),
    ]


# ---------------------------------------------------------------- the forest
@dataclass
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while (inner := self.feature[at] >= 0).any():
            f = np.maximum(self.feature[at], 0)
            to = np.where(x[np.arange(len(x)), f] <= self.cut[at], self.below[at], self.above[at])
            at = np.where(inner, to, at)
        return self.value[at]


def _grown(x, y, rng, depth) -> Tree:
    nodes: list[list] = []

    def grow(rows, level) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if level == depth or len(rows) < 2 * LEAF or y[rows].min() == y[rows].max():
            return me
        best = (np.inf, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1]))), replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, t = x[order, f], np.cumsum(y[order])
            k = np.arange(1, len(order))
            ok = (v[1:] > v[:-1]) & (k >= LEAF) & (len(order) - k >= LEAF)
            if not ok.any():
                continue
            p, q = t[:-1] / k, (t[-1] - t[:-1]) / (len(order) - k)
            impurity = np.where(ok, k * p * (1 - p) + (len(order) - k) * q * (1 - q), np.inf)
            i = int(impurity.argmin())
            if impurity[i] < best[0]:
                best = (impurity[i], int(f), float(v[i]))
        if best[1] < 0:
            return me
        side = x[rows, best[1]] <= best[2]
        nodes[me][0], nodes[me][1] = best[1], best[2]
        nodes[me][2] = grow(rows[side], level + 1)
        nodes[me][3] = grow(rows[~side], level + 1)
        return me

    grow(rng.integers(0, len(y), len(y)), 0)
    cols = list(zip(*nodes))
    return Tree(np.array(cols[0], np.int64), np.array(cols[1]), np.array(cols[2], np.int64), np.array(cols[3], np.int64), np.array(cols[4]))


class Forest:
    """A random forest of seeded bootstrap trees."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees = [_grown(np.asarray(x, float), np.asarray(y, float), rng, depth) for _ in range(trees)]

    def predict(self, x) -> np.ndarray:
        x = np.asarray(x, float).reshape(-1, len(FEATURES))
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


def synthetic_findings(n: int, seed: int = 11) -> list[tuple[str, int, int, str, int]]:
    """Labelled findings (text, start, end, path, label) by rule: keys in telling places, and what is mistaken for them."""
    rng = random.Random(seed)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    b64 = string.ascii_letters + string.digits + "+/"
    words = lambda k: [rng.choice(DICTIONARY) for _ in range(k)]
    filler = lambda: " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "é", "sch", "que"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 6)))
    out = []
    while len(out) < n:
        if len(out) % 2:
            value = rng.choice([lambda: pick("0123456789abcdef", rng.choice([32, 40, 48, 64])), lambda: pick(b64, rng.choice([24, 32, 40, 64])), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + pick(string.ascii_letters + string.digits, 36), lambda: pick(string.ascii_letters + string.digits + "!@#%^*", rng.randint(10, 20))])()
            name = rng.choice([*TELLING, "api_key", "access_token", "client_secret", "db_password"])
            name = rng.choice([str.lower, str.upper, str.title])(name)
            before, after = rng.choice([(f'{name} = "', '"'), (f"{name}: ", ""), (f"{name}='", "'"), (f'"{name}": "', '"'), (f"{name}=", "\n")])
            value = value.upper() if name.isupper() and rng.random() < 0.3 else value
            path, label = rng.choice(["src/app.py", "config.yml", ""]), 1
        else:
            kind = rng.randrange(9)
            before, after, label, path = "", "", 0, rng.choice(["src/app.py", "docs/readme.md", "tests/test_a.py", ""])
            if kind == 0:
                value, before = str(uuid.UUID(int=rng.getrandbits(128))), rng.choice(["id ", "uuid: ", "request ", "guid="])
            elif kind == 1:
                value, before = pick("0123456789abcdef", rng.choice([32, 40, 64])), rng.choice(["commit ", "sha256:", "md5 = ", "checksum: ", "digest ", "revision "])
            elif kind == 2:
                value, before = "/".join(words(rng.randint(3, 6))) + rng.choice(["", "/v2", "/index1"]), rng.choice(["http://example.com/", "see ", "path ", "/"])
            elif kind == 3:
                value = "".join(w.title() for w in words(rng.randint(3, 6))) + rng.choice(["", "2", "Impl"])
            elif kind == 4:
                value, before = rng.choice(["your_api_key_here1", "xxxxxxxxxxxxxxxx1234", "changeme12345678", "example-token-value-1", "INSERT_TOKEN_HERE_1"]), rng.choice(["token = ", "key: ", "api_key='"])
            elif kind == 5:
                value, before = pick("0123456789", rng.randint(16, 20)), rng.choice(["phone ", "card ", "", "order number "])
            elif kind == 6:
                value, before = "_".join(words(rng.randint(3, 6))) + rng.choice(["", "_1", "_v2"]), rng.choice(["def ", "key = ", "", "token: "])
            elif kind == 7:
                value = rng.choice(["=" * 30 + "1", "-" * 24 + "2024", "------------------1", "2024-01-02-10-11-12-0001"])
            else:
                value, before, after = rng.choice(words(4)) + rng.choice(words(4)) + rng.choice(["", "s"]), rng.choice(["password: ", "key = ", "token: ", "auth="]), " "
        lead = filler() + rng.choice([" ", "\n"])
        text = lead + before + value + after + rng.choice([" ", "\n"]) + filler()
        start = len(lead) + len(before)
        out.append((text, start, start + len(value), path, label))
    return out


def trained(findings: DataFrame | None = None) -> Forest:
    """A forest from labelled findings; beyond ``MOST_LABELLED`` rows, those with the least hashes."""
    if findings is None:
        rows = synthetic_findings(MOST_LABELLED)
    else:
        columns = ["text", "start", "end", "path", "label"]
        rows = [tuple(r) for r in findings.select(*columns).orderBy(F.xxhash64(*columns)).limit(MOST_LABELLED).collect()]
    return Forest([features(t, a, b, p or "") for t, a, b, p, _ in rows], [y for *_, y in rows])


@lru_cache(1)
def default_forest() -> Forest:
    return trained()


# ---------------------------------------------------------------- the operator
def scan_text(text: str, path: str, forest: Forest):
    """(spans, chance that each is a secret) of a text's candidates."""
    spans = candidates(text)
    return spans, forest.predict([features(text, a, b, path) for a, b in spans]) if spans else np.zeros(0)


def masked(text: str, spans) -> str:
    out, at = [], 0
    for a, b in spans:
        out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


def scanned(docs: DataFrame, forest: Forest | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_candidates, findings (start, end, chance), masked) of every row, and the columns named in ``carry``, as k_<name>.

    ``masked`` is the text with each confirmed secret replaced; a null text stays
    null and has no candidates; null paths are empty; repeated rows come back as
    often as they came.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(forest or default_forest())

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in K.slices(batch.column(2)):
                raw = buf.tobytes()
                null = batch.column(2).slice(a, b - a).is_null().to_pylist()
                found, count, out = [], [], []
                for x, y, path, gone in zip(offs[:-1].tolist(), offs[1:].tolist(), batch.column(1)[a:b].to_pylist(), null):
                    text = raw[x:y].decode()
                    spans, chance = scan_text(text, path or "", model.value)
                    sure = [(s, float(c)) for s, c in zip(spans, chance) if c >= SURE]
                    count.append(len(spans))
                    found.append([{"start": s[0], "end": s[1], "chance": c} for s, c in sure])
                    out.append(None if gone else masked(text, [s for s, _ in sure]))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(count, pa.int64()), pa.array(found, kind), pa.array(out, pa.string()), *(c[a:b] for c in batch.columns[3:])], ["id", "n_candidates", "findings", "masked", *batch.schema.names[3:]])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"k_{c}") for c in carry])
    return rows.mapInArrow(run, "id long, n_candidates long, findings array<struct<start: int, end: int, chance: double>>, masked string" + kept_types(rows, 3))

