"""The operators' queries against their SQL on DuckDB."""

import hashlib
import math

import duckdb
import pytest

from kiln.llm import queries

FOLDER = "/root/testdata/sf0.001"


def digest(columns, rows):
    def text(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else repr(round(v, 6)) if isinstance(v, float) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return hashlib.md5("\n".join(sorted("\x1f".join(text(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    found = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    df = queries.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert queries.queries()[name](spark, FOLDER).count() > 0
