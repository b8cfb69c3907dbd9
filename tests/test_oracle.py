"""Every registered query against its DuckDB oracle on the smallest data set: same
columns, same row count, same multiset of (rounded) values."""

import datetime as dt
import math

import pytest

import __spark_entry__ as E
from marketweave.plans import load_all
from tests.conftest import SMALL

QUERIES = load_all().REGISTRY
ORACLE = load_all().ORACLE
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(rows):
    return sorted(repr(tuple(_norm(x) for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    want = [tuple(r[dcols.index(c)] for c in cols) for r in cur.fetchall()]
    assert len(got) == len(want)
    assert _bag(got) == _bag(want)


def test_every_query_has_an_oracle():
    assert not ROWS_ONLY


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "correlation" in df.columns
