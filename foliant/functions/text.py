"""Text functions as Column -> Column expressions; all run in the JVM but ``nfkc``."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import constants as C

WHITE = r"[ \t\n\r\x0B\f]"


def literal(text: str) -> Column:
    return F.lit(text)


def any_of(flags: list[Column]) -> Column:
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark lacks."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalize(c: Column, unicode: bool = False) -> Column:
    """Character replacements, words joined over line ends, spaces and empty lines reduced."""
    c = nfkc(c) if unicode else c
    c = F.translate(c, C.REMOVED, "")
    for old, new in C.REPLACED.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, r"([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])", "$1$2")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, r"[ \t\r\f]+\n", "\n")
    return strip(c)


def normalize_light(c: Column) -> Column:
    return F.translate(c, "\u0000\ufeff", "")


def strip_page_numbers(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n", -1), lambda x: ~any_of([x.rlike(p) for p in C.PAGE_NUMBERS])), "\n")


def strip_watermarks(c: Column) -> Column:
    for p in C.WATERMARKS:
        c = F.regexp_replace(c, p, "")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def truncate_text(c: Column, n: int, suffix: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - len(suffix)), F.lit(suffix))).otherwise(c)


def format_size(c: Column) -> Column:
    """Bytes as B, KB, … with two digits, exact halves to the even one (``format_string`` rounds up and writes null as text)."""
    text = lambda k, unit: F.concat(F.call_function("format_number", c / F.lit(float(1024**k)), F.lit("0.00")), F.lit(f" {unit}"))
    out = F.when(c < 1024, text(0, "B"))
    for k, unit in enumerate(["KB", "MB", "GB", "TB"], 1):
        out = out.when(c < 1024 ** (k + 1), text(k, unit))
    return out.otherwise(text(5, "PB"))


def is_stop_word(w: Column) -> Column:
    return w.isin(*C.STOP_WORDS)


def padded(c: Column, width: int) -> Column:
    """The number with zeros before it up to the width; longer numbers stay whole."""
    digits = c.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def tokens(c: Column) -> Column:
    """Lower-cased words of Latin, Cyrillic and digits without stop words."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit("[A-Za-zА-Яа-я0-9]{2,}"), 0), lambda w: ~is_stop_word(w))


def keyword_tokens(c: Column) -> Column:
    """Lower-cased words of more than two characters."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), 0), lambda w: F.length(w) > 2)


def text_hash(c: Column) -> Column:
    return F.md5(strip(F.regexp_replace(F.lower(c), f"{WHITE}+", " ")))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"(?<=[.!?])\s+", -1), strip), lambda s: s != "")


def summary_sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"(?<=[.!?])\s+|\n{2,}", -1), strip), lambda s: F.length(s) > 20)


def token_count(c: Column) -> Column:
    return F.floor(F.length(c) / 4).cast("int")


def has_code(c: Column) -> Column:
    return any_of([c.contains(m) for m in C.CODE_MARKS])


def has_formula(c: Column) -> Column:
    return any_of([c.contains(m) for m in C.FORMULA_MARKS]) | c.rlike(C.FORMULA)


def has_diagram(c: Column) -> Column:
    return any_of([c.contains(m) for m in C.DIAGRAM_MARKS])


def has_list(c: Column) -> Column:
    return (F.regexp_count(c, F.lit("[•*–]")) > 2) | (F.regexp_count(c, F.lit(r"(?m)^\s*\d+\.")) > 2)


def has_citations(c: Column) -> Column:
    return any_of([c.rlike(p) for p in C.CITATIONS])


def emails(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit(r"<([^<>\s]+@[^<>\s]+\.[^<>\s]+)>"), 1), "; ")


def parse_time(c: Column) -> Column:
    """ISO times with Z, +0300 or +03:00; null where none fits."""
    shapes = ["yyyy-MM-dd'T'HH:mm:ss[.SSS]X", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XX", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX"]
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(s)) for s in shapes])


def sanitized(stem: Column, limit: int = 50) -> Column:
    """A short lower-case name of letters, digits and underscores."""
    c = F.lower(stem)
    for old, new in C.LATIN.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, r"[^\p{L}\p{N}]", "_")
    c = F.regexp_replace(c, "_+", "_")
    c = F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 7), F.lit("_"), F.substring(F.md5(stem), 1, 6))).otherwise(c)
    return F.regexp_replace(c, "^_+|_+$", "")


def safe_name(stem: Column, ext: str, limit: int = 100) -> Column:
    c = stem
    for old, new in C.UNSAFE.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.replace(F.regexp_replace(c, " {2,}", " "), F.lit(" "), F.lit("_"))
    c = F.regexp_replace(c, "^_+|_+$", "")
    cut = F.concat(F.substring(c, 1, limit - len(ext) - 7), F.lit("_"), F.substring(F.md5(stem), 1, 6))
    return F.concat(F.when(F.length(c) > limit - len(ext), cut).otherwise(c), F.lit(ext))


def name_issues(name: Column, stem: Column, limit: int = 100) -> Column:
    unsafe = any_of([name.contains(u) for u in C.UNSAFE])
    return F.array_compact(
        F.array(
            F.when(F.length(name) > limit, F.lit("LONG_FILENAME")),
            F.when(unsafe, F.lit("UNSAFE_CHARS")),
            F.when(name.contains("  "), F.lit("MULTIPLE_SPACES")),
            F.when(stem != strip(stem), F.lit("WHITESPACE")),
        )
    )


def salvaged(c: Column) -> Column:
    """The first part in braces (one level may nest) of a model's answer that is JSON, else the whole answer if it is JSON, else null."""
    found = F.filter(F.regexp_extract_all(c, F.lit(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"), 0), lambda m: F.try_parse_json(m).isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.when(F.try_parse_json(c).isNotNull(), c))
