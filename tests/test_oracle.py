"""Every registered query of the library against its SQL on DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

from quillwork.plans import domain_queries, event_queries, graph_queries, io_queries, queue_queries, registry, review_queries, sequence_queries, text_queries, voice_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)

    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "NULL"
        return str(v) if isinstance(v, (bool, str)) else repr(round(float(v), 4) + 0.0)

    return Counter(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.SQL:
        assert sum(got.values()) > 0
        return
    want = duck.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == rows(want.columns, want.fetchall())
