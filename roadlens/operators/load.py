"""Warehouse loading: insert-or-ignore, retention and load metrics.

Plain Parquet has no transactions, so insert-or-ignore assumes one writer per
table: new rows = batch (first copy per key) anti-joined with the stored keys.
The anti-join shuffles both sides on the key; AQE's skew-join handling splits
a hot key's partition on the big side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.joins import keep_first


def insert_or_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``: the first copy per key by ``order``."""
    return keep_first(batch, list(keys), list(order)).join(target.select(*keys), list(keys), "left_anti")


def metrics_table(pairs: Sequence[tuple[str, Column]], source: DataFrame) -> DataFrame:
    """One aggregate pass over ``source`` producing ``(metric, value)`` rows."""
    agg = source.agg(*[c.alias(f"m{i}") for i, (_, c) in enumerate(pairs)])
    body = ", ".join(f"'{name}', CAST(m{i} AS BIGINT)" for i, (name, _) in enumerate(pairs))
    return agg.select(F.expr(f"stack({len(pairs)}, {body}) AS (metric, value)"))
