"""Every query against its SQL on DuckDB, over the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return repr(round(float(v), 7) + 0.0)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:10] if not isinstance(v, datetime.datetime) or v.time() == datetime.time() else str(v)
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[k]) for k in order) for r in data)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# The subpackage's own queries have their tests with it.
OWN = [k for k in entry.oracle_sql() if not k.startswith("op") and k != "pipeline"]


@pytest.mark.parametrize("name", OWN)
def test_oracle(spark, duck, sf_dir, name):
    out = entry.queries()[name](spark, sf_dir)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(out.columns) == sorted(want.columns)
    assert rows(out.columns, [tuple(r) for r in out.collect()]) == rows(list(want.columns), want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
