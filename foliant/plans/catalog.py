"""All queries of the engine and the SQL that must give the same rows."""

from __future__ import annotations

from . import card_queries, record_queries, run_queries, text_queries

QUERIES, ORACLES = {}, {}
for _part in (text_queries, card_queries, record_queries, run_queries):
    QUERIES.update(_part.QUERIES)
    ORACLES.update(_part.ORACLES)
