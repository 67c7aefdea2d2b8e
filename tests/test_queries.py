"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare
from conftest import SF_DIR

import __spark_entry__ as entry_points
from rimstone.gallery.registry import REGISTRY


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    query, sql = REGISTRY[name]
    n_rows, faults = compare(duck, query(spark, SF_DIR), sql)
    assert not faults, "\n".join(map(str, faults))
    assert n_rows > 0


def test_entry_points(spark):
    assert entry_points.entry(spark).columns[:2] == ["season_sk", "season_id"]
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
