"""Each query against its SQL on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pytest

from chunkloom import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ENTRIES = plans.load()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, float) or hasattr(value, "as_tuple"):
        return "nan" if math.isnan(value) else f"{round(float(value), 5) + 0.0}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if sql])
def test_query(spark, duck, name):
    f, sql = ENTRIES[name]
    df, want = f(spark, SF), duck.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_ivf_queries(spark, duck):
    """Every twentieth vector asks; recall against brute force."""
    ids, vectors = zip(*duck.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall())
    x = np.array(vectors, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = ENTRIES["ivf_topk"][0](spark, SF).collect()
    asked = [k for k, i in enumerate(ids) if i % 20 == 0]
    assert {r.query_id for r in rows} == {ids[k] for k in asked}
    best = {(ids[k], ids[j]) for k in asked for j in np.lexsort((ids, -np.round(x @ x[k], 6)))[:10]}
    recall = len(best & {(r.query_id, r.id) for r in rows}) / len(best)
    assert recall >= 0.9, recall


def test_a_fold_again_and_again(spark):
    """Arrow folds over lambdas, whatever ran in the session before and however the rows are taken."""
    want = None
    for take in (lambda df: df.count(), lambda df: len(df.collect()), lambda df: len(df.toPandas())):
        got = take(ENTRIES["sentence_chunks"][0](spark, SF)), take(ENTRIES["sentence_spans"][0](spark, SF))
        assert want in (None, got)
        want = got
    ENTRIES["sentence_chunks"][0](spark, SF).write.format("noop").mode("overwrite").save()


def test_every_cap_of_the_walk_binds():
    """Without any one of the caps the walk's SQL, which the query equals, gives other rows."""
    from chunkloom.plans.retrievals import _walk_sql

    duck = duckdb.connect()  # the smallest tables have too few customers
    for t in ("customer", "supplier", "orders", "lineitem"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/../sf0.01/{t}.parquet'")
    caps = {"hops": 3, "per_node": 2, "beam": 3, "per_seed": 6, "total": 20}
    walk = lambda **c: set(map(str, duck.sql(_walk_sql(**(caps | c))).fetchall()))
    want = walk()
    assert want and all(walk(**{c: 1_000_000}) != want for c in caps if c != "hops") and walk(hops=2) < want
