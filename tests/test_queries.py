"""The driver contract: every query of the library that has SQL equals it on the smallest tables."""

import duckdb
import pytest

from corpusloom.plans import extended
from corpusloom.plans import queries as library

SQL = library.oracle_sql() | extended.oracle_sql()
QUERIES = library.queries() | extended.queries()

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if x is None or x != x else float(x) if isinstance(x, float) else str(x) for x in r) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf, name):
    ours, theirs = QUERIES[name](spark, sf).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    import __spark_entry__ as E

    assert E.entry(spark).count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
