import pytest

import __spark_entry__ as entry_point
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    ours, theirs = compare(spark, sf_dir, entry_point.queries()[name], entry_point.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    different = [pair for pair in zip(ours[1], theirs[1]) if pair[0] != pair[1]]
    assert not different[:3]
    assert ours[1], "a check on no rows proves nothing"


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_of_the_catalog_has_its_sql():
    assert set(entry_point.QUERIES) == set(entry_point.ORACLES)
