"""Join helpers: size-checked broadcast and the keep-first aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Same bound as Spark's autoBroadcastJoinThreshold default: file-based estimates are
# compressed sizes, so the bound stays conservative.
BROADCAST_MAX_BYTES = 10 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (exact for inline tables and ranges, the file size for scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when the plan proves that it is at most ``max_bytes``.

    Beyond the bound the DataFrame is returned as is and Spark plans a shuffle
    join (AQE may still broadcast it once its true size is known). No job is
    started to find out.
    """
    return F.broadcast(df) if plan_size_bytes(df) <= max_bytes else df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], nulls_last: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (ascending).

    Expressed as ``min(named_struct(order…, payload…))`` per key, which Spark
    aggregates partially on the map side: a key holding a large share of all
    rows (many copies of one ping) is reduced inside every input task before
    the shuffle, never gathered whole in one task as a ``row_number`` window
    would. ``order`` terms are column names or SQL expression text; use a
    negated term (``"-n"``) for descending order. With ``nulls_last`` each
    term is preceded by its null flag, giving SQL ``NULLS LAST``.

    The struct is what crosses the shuffle, so nothing is in it twice: a column
    that is an order term is not payload as well, and one that cannot be null has no flag.
    """
    payload = [c for c in df.columns if c not in keys]
    null = {f.name: f.nullable for f in df.schema.fields}
    fields, place = [], {c: c for c in payload}
    for i, o in enumerate(order):
        if nulls_last and null.get(o, True):
            fields.append(f"'__n{i}', ({o}) IS NULL")
        fields.append(f"'__o{i}', ({o})")
        if place.get(o) == o:
            place[o] = f"__o{i}"
    fields += [f"'{c}', `{c}`" for c in payload if place[c] == c]
    return (df.groupBy(*keys)
              .agg(F.expr(f"min(named_struct({', '.join(fields)})) AS __first"))
              .selectExpr(*[f"`{k}`" for k in keys], *[f"__first.`{place[c]}` AS `{c}`" for c in payload]))
