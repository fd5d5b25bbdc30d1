"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import SMOKE_DIR, entry
from check_queries import compare
from sentaria.plans.oracles import ORACLES
from sentaria.plans.registered import QUERIES

needs_tables = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no benchmark tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    status, rows, _, note = compare(spark, SMOKE_DIR, name, QUERIES[name], ORACLES[name])
    assert status == "match", note
    assert rows > 0


@needs_tables
def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["sentence_id"] and df.count() > 0
