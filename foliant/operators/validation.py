"""Rules over records: violations by rule and severity, cleaning, field coverage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass
class Rule:
    """A named test: ``message`` is null where a record passes."""

    name: str
    severity: str
    message: Column


def required(fields: list[str]) -> Rule:
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    return Rule("RequiredField", "ERROR", F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", "))))


def typed(field: str, kind: str) -> Rule:
    """The field's text can be read as the type."""
    bad = F.col(field).isNotNull() & F.expr(f"try_cast({field} AS {kind})").isNull()
    return Rule("Type", "ERROR", F.when(bad, F.lit(f"{field} is no {kind}")))


def in_range(field: str, low: float | None = None, high: float | None = None) -> Rule:
    c, out = F.col(field), F.lit(None).cast("string")
    if high is not None:
        out = F.when(c > high, F.lit(f"{field} above {high}")).otherwise(out)
    if low is not None:
        out = F.when(c < low, F.lit(f"{field} below {low}")).otherwise(out)
    return Rule("Range", "ERROR", out)


def text_quality(field: str, shortest: int = 10, longest: int | None = None) -> Rule:
    """The first failure of: too short, too long, a null character, mostly blank."""
    c, n = F.col(field), F.length(F.col(field))
    out = F.when(n < shortest, F.lit("too short"))
    if longest is not None:
        out = out.when(n > longest, F.lit("too long"))
    blank = n - F.length(F.translate(c, " \n", ""))
    return Rule("TextQuality", "WARNING", out.when(c.contains("\u0000"), F.lit("null character")).when((n > 0) & (blank / n > 0.5), F.lit("mostly blank")))


def shaped(field: str, keys: list[str]) -> Rule:
    """A struct or map column holds the keys."""
    missing = F.array_compact(F.array(*[F.when(F.col(field)[k].isNull(), F.lit(k)) for k in keys]))
    return Rule("ExtendedFields", "WARNING", F.when(F.size(missing) > 0, F.concat(F.lit("Missing: "), F.array_join(missing, ", "))))


#: Rules of each stage's records; ``summarized`` too.
STAGES = {
    "structural": lambda: [required(["segment_id", "segment", "page_num"]), text_quality("segment", 10, 50_000), in_range("page_num", 1)],
    "structured": lambda: [required(["segment_id", "segment", "page_num", "chapter_title", "section_title"]), text_quality("segment", 10)],
    "summarized": lambda: [required(["segment_id", "segment", "page_num", "l1_summary", "l2_summary"])],
    "extended": lambda: [required(["segment_id", "segment", "page_num", "prev_page", "next_page"])],
    "final": lambda: [required(["segment_id", "segment", "page_num"]), text_quality("segment", 10)],
    "chunks": lambda: [required(["chunk_id", "text", "tokens"]), text_quality("text", 50, 2000), in_range("tokens", 10, 1000)],
}


def violations(records: DataFrame, rules: list[Rule], *keys: str) -> DataFrame:
    """One row for each rule that a record breaks: keys, rule, severity, message."""
    found = F.array(*[F.when(r.message.isNotNull(), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), r.message.alias("message"))) for r in rules])
    return records.select(*keys, F.inline(F.array_compact(found)))


def summary(records: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """Per dataset: records, errors, warnings, and whether it is valid (no error)."""
    found = F.array_compact(F.array(*[F.when(r.message.isNotNull(), F.lit(r.severity)) for r in rules]))
    n = lambda kind: F.sum(F.size(F.filter("found", lambda x: x == kind))).alias(kind.lower() + "s")
    out = records.select(key, found.alias("found")).groupBy(key).agg(F.count("*").alias("records"), n("ERROR"), n("WARNING"))
    return out.withColumn("valid", F.col("errors") == 0)


def by_rule(records: DataFrame, rules: list[Rule], *keys: str) -> DataFrame:
    return violations(records, rules, *keys).groupBy("rule", "severity").agg(F.count("*").alias("n"))


def stage_of(path: Column) -> Column:
    out = None
    for mark, stage in (("structured", "structured"), ("structural", "structural"), ("summarized", "summarized"), ("extended", "extended"), ("final", "final"), ("chunks", "chunks")):
        out = F.when(path.contains(mark), stage) if out is None else out.when(path.contains(mark), stage)
    return out


def finalized(cards: DataFrame) -> DataFrame:
    """Per card, what is wrong: empty required fields, short text, an id that is used twice."""
    twice = cards.groupBy("book", "segment_id").agg(F.count("*").alias("same")).where("same > 1")
    j = cards.join(twice, ["book", "segment_id"], "left")
    gone = F.array_compact(F.array(*[F.when(F.coalesce(F.col(f).cast("string"), F.lit("")).isin("", "0"), F.lit("missing " + f)) for f in ("segment_id", "segment", "page_num", "source_file")]))
    more = F.array_compact(F.array(F.when(F.length(T.strip(F.col("segment"))) < 10, F.lit("short segment")), F.when(F.col("same").isNotNull(), F.lit("repeated segment_id"))))
    return j.withColumn("problems", F.concat(gone, more)).drop("same")


def accepted(cards: DataFrame, strict: bool = False) -> DataFrame:
    """The cards without a problem of their own (a repeated id is one of the dataset); ``strict`` raises if there are others."""
    own = finalized(cards).withColumn("problems", F.array_remove("problems", "repeated segment_id"))
    if strict and (n := own.where(F.size("problems") > 0).count()):
        raise ValueError(f"{n} invalid cards")
    return own.where(F.size("problems") == 0).drop("problems")


def cleaned(cards: DataFrame, keep: tuple[str, ...] = ("segment", "l1_summary", "l2_summary")) -> DataFrame:
    """Empty strings become null but in text fields; page numbers become numbers where they can."""
    out = {c: F.nullif(F.col(c), F.lit("")) for c, kind in cards.dtypes if kind == "string" and c not in keep}
    out["page_num"] = F.expr("try_cast(page_num AS int)")
    return cards.withColumns({k: v for k, v in out.items() if k in cards.columns})


def coverage(cards: DataFrame, fields: list[str]) -> DataFrame:
    """(book, field, filled, ratio) of each field."""
    truthy = lambda c: ~F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0", "false")
    sums = cards.groupBy("book").agg(F.count("*").alias("n"), *[F.sum(truthy(f).cast("int")).alias(f) for f in fields])
    long = sums.unpivot(["book", "n"], fields, "field", "filled")
    return long.select("book", "field", "filled", F.round(F.col("filled") / F.col("n"), 6).alias("ratio"))
