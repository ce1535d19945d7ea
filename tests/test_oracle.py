"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from harness import compare, type_diffs
from roadlens.plans.queries import ORACLE, QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert "error" not in res, res
    assert res["ok"], res


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, name):
    assert type_diffs(spark, SF_SMALL, name) == {}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "congestion_level" in df.columns
