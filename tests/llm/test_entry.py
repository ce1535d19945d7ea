"""Every operator is registered once, and SQL oracles agree where SQL can express the query."""

import re

import pytest
from conftest import SF_SMALL
from harness import compare, type_diffs

import __spark_entry__ as entry
from roadlens.llm.queries import ORACLE, QUERIES


def test_names():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    result = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert result.get("ok"), result
    assert type_diffs(spark, SF_SMALL, name) == {}
