"""The subpackage's queries against their SQL on the smallest tables."""

import duckdb
import pytest

from chunkloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duck.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    rows = lambda names, rows: sorted(tuple(str(r[names.index(n)]) for n in sorted(names)) for r in rows)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())
