"""Every registered query against its SQL, on the smallest scale factor."""

from __future__ import annotations

import datetime
import math

import pytest

import __spark_entry__ as entry_points
from rankframe import checks

QUERIES = checks.queries()
ORACLES = checks.oracle_sql()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    found = rows(result.columns, result.collect())
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    expected = rows(columns, answer.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert found
    assert found == expected


def test_all_are_registered():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_entry_runs(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[-2:] == ["target_is_native_order", "ubi_hash"]
    assert frame.count() > 0
