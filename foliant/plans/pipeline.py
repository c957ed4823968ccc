"""Stages from cards to chunks, composed; each is lazy, and Parquet may be written between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chunks, enrich, structure, summaries, validation
from ..sources.shared import fresh

STAGES = ["structure", "summarize", "extended", "finalize", "chunk"]
#: A failure in these always ends the run.
CRITICAL = {"finalize"}


def _summarize(cards: DataFrame) -> DataFrame:
    for level in summaries.LEVELS:
        s = summaries.summaries(cards, level).withColumnRenamed("summary", f"{level}_summary")
        cards = cards.join(s, "doc_id", "left")
    return cards


def _finalize(cards: DataFrame) -> DataFrame:
    return validation.finalized(validation.cleaned(cards.drop("prev_page", "next_page")))


STEPS = {
    "structure": structure.filled,
    "summarize": _summarize,
    "extended": lambda c: enrich.linked(enrich.duplicates_marked(c)),
    "finalize": _finalize,
    "chunk": chunks.chunked,
}


def run(cards: DataFrame, start: str = "structure", end: str = "chunk", write: bool = True, keep_going: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """The last stage's rows, and each stage's status: completed or failed.

    A failure is raised; with ``keep_going`` one outside ``CRITICAL`` leaves the rows as the stage before gave them, and the status says so.
    With ``write`` each stage but the last is a Parquet table, so that no stage is computed again for a later one.
    """
    status = {}
    for stage in STAGES[STAGES.index(start) : STAGES.index(end) + 1]:
        try:
            rows = STEPS[stage](cards)
            if write and stage != end:
                path = fresh(cards.sparkSession, f"stage-{stage}")
                rows.write.parquet(path)
                rows = cards.sparkSession.read.schema(rows.schema).parquet(path)
            cards, status[stage] = rows, "completed"
        except Exception:
            if stage in CRITICAL or not keep_going:
                raise
            status[stage] = "failed"
    return cards, status


def overall(status: dict[str, str]) -> str:
    done = [s == "completed" for s in status.values()]
    return "completed" if all(done) else "partial" if any(done) else "failed"
