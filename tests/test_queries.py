"""Every query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings wearers sessions segments speaker_map helio_battito helio_notti speakers_db mix_targets".split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(round(float(v), 5) + 0.0) if isinstance(v, float) or hasattr(v, "as_tuple") else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, D)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
