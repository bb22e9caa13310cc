"""Every registered query against its SQL on the supplied tables."""

import pytest

import __spark_entry__ as entry_points
from sigweave.plans.checks import CHECKS
from sigweave.plans.queries import QUERIES


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    expected = duck.execute(CHECKS[name])
    columns = [c[0] for c in expected.description]
    ours = _sorted([tuple(r) for r in found.collect()], found.columns)
    assert ours == _sorted(expected.fetchall(), columns)
    assert ours[1]


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["key", "value", "topic"]
