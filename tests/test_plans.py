"""Plan shape of every registered batch query (scale guards, no execution).

* no cartesian product and no broadcast nested-loop join (the only
  non-equi condition, the schedule interval, must ride on an equi join);
* the ``events`` scan reads only the four columns the fixture uses
  (column pruning reached the Parquet reader).
"""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from roadlens.plans.queries import QUERIES

# queries that write and read files (or run a stream) while being built
RUN_AT_BUILD = {"stream_ingest", "stream_dead_letters", "stream_verdicts", "stream_dedupe",
                "stream_sessions", "stream_keep_first", "lake_roundtrip", "env_union",
                "lake_incremental", "lake_write_metrics", "verdict_from_store", "warehouse_load",
                "verdict_load_idempotent", "retention_store", "stream_load", "stream_verdicts_sliding",
                "vehicle_pings", "light_pings", "stream_audit", "table_load", "latest_verdicts", "latest_per_light", "inefficient_lights", "by_time_window"}
NAMES = sorted(set(QUERIES) - RUN_AT_BUILD)
FIXTURE_COLS = {"event_id", "ts", "user_id", "value"}


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    schemas = re.findall(r"events\.parquet\].*?ReadSchema: struct<([^>]*)>", plan)
    assert schemas, name  # every registered query reads the events table
    for schema in schemas:
        cols = {c.split(":")[0] for c in schema.split(",")}
        assert cols <= FIXTURE_COLS, (name, cols)
