"""Every query of the subpackage runs on the smallest tables; those with SQL agree with DuckDB."""

import glob
import os

import duckdb
import pytest

from foliant.llm import queries

FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(str(v) for v in r) for r in rows))


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = plain(got.select(*columns).collect())
    assert rows
    if name not in queries.ORACLES:
        return
    with duckdb.connect() as db:
        for path in glob.glob(f"{FOLDER}/*.parquet"):
            db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        asked = db.execute(queries.ORACLES[name])
        order = sorted(range(len(columns)), key=lambda i: asked.description[i][0])
        assert [asked.description[i][0] for i in order] == columns
        assert rows == plain(tuple(r[i] for i in order) for r in asked.fetchall())
