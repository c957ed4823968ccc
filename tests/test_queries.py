"""Every query of the engine that has SQL, against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from foliant.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 8) + 0.0
        return round(float(v), 8) if type(v).__name__ == "Decimal" else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    found = duck.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(found.columns)
    a, b = plain([tuple(r) for r in frame.collect()], frame.columns), plain(found.fetchall(), found.columns)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(v == pytest.approx(w) if isinstance(v, float) else v == w for v, w in zip(x, y)), (x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_no_python_in_queries_with_sql(spark):
    for name in ("chunk_pages", "bm25_search", "dup_mark"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
