"""Data-quality reports: NOT NULL, uniqueness, CHECK and reference checks.

A table's :class:`Rules` are applied in one pass: every row gets flags of the rules that
it breaks by itself (references by a left join with the key table, broadcast when it is small).
:func:`report` counts them per rule, with the table's key in the same aggregation: rows are grouped by
the key once, with partial sums, and groups of several rows are counted. :func:`violations` returns the broken rows with the array of their rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.joins import small_side


@dataclass
class Rules:
    """What a table's rows must keep to; ``ranges`` are (column, low, high), ``references`` (column, DataFrame, its column)."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    ranges: Sequence[tuple[str, float, float]] = ()
    references: Sequence[tuple[str, DataFrame, str]] = ()

    def names(self) -> list[str]:
        return [*(f"not_null:{c}" for c in self.not_null), *(f"check:{c} in [{lo:g},{hi:g}]" for c, lo, hi in self.ranges),
                *(f"references:{c}" for c, _, _ in self.references)]


def _flagged(df: DataFrame, rules: Rules) -> tuple[DataFrame, list[str]]:
    """``df`` with one boolean column ``__b<k>`` per rule that a row can break by itself; NULL passes checks and references, as in SQL."""
    exprs = [f"`{c}` IS NULL" for c in rules.not_null]
    exprs += [f"coalesce(NOT `{c}` BETWEEN {lo} AND {hi}, false)" for c, lo, hi in rules.ranges]
    for k, (c, ref, ref_col) in enumerate(rules.references):
        keys = ref.filter(F.col(ref_col).isNotNull()).select(F.col(ref_col).alias(f"__r{k}")).distinct()
        df = df.join(small_side(keys), df[c] == F.col(f"__r{k}"), "left")
        exprs.append(f"`{c}` IS NOT NULL AND __r{k} IS NULL")
    flagged = df.selectExpr("*", *[f"{e} AS __b{k}" for k, e in enumerate(exprs)])
    return flagged.drop(*[f"__r{k}" for k in range(len(rules.references))]), rules.names()


def report(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """``(table_name, check_name, violations)``, one scan and, with a key, one shuffle; a repeated key counts once."""
    flagged, names = _flagged(df, rules)
    sums = [f"coalesce(sum(CAST(__b{k} AS BIGINT)), 0L) AS s{k}" for k in range(len(names))]
    if rules.unique:
        per_key = flagged.groupBy(*rules.unique).agg(F.expr("count(1) AS __n"), *map(F.expr, sums))
        one = per_key.agg(*[F.expr(f"coalesce(sum(s{k}), 0L) AS s{k}") for k in range(len(names))], F.expr(f"count_if(__n > 1) AS s{len(names)}"))
        names = [*names, "unique:" + ",".join(rules.unique)]
    else:
        one = flagged.agg(*map(F.expr, sums))
    body = ", ".join(f"'{name}', s{k}" for k, name in enumerate(names))
    return one.select(F.lit(table).alias("table_name"), F.expr(f"stack({len(names)}, {body}) AS (check_name, violations)"))


def violations(df: DataFrame, table: str, row_key: str, rules: Rules) -> DataFrame:
    """``(table_name, row_key, rules)``: the rows that break a rule, named by the SQL text ``row_key``, with all rules that they break.

    Rows of a repeated key all break it. Counts are reduced before the shuffle and only repeated keys are joined back.
    """
    names = rules.names()
    wanted = df.withColumn("__row", F.expr(row_key))
    flagged, _ = _flagged(wanted, rules)
    if rules.unique:
        keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(rules.unique)]
        repeated = df.select(*keys).groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
        same = " AND ".join(f"`{c}` <=> __k{i}" for i, c in enumerate(rules.unique))
        flagged = flagged.join(repeated, F.expr(same), "left").withColumn(f"__b{len(names)}", F.col("__n").isNotNull())
        names = [*names, "unique:" + ",".join(rules.unique)]
    broken = ", ".join(f"CASE WHEN __b{k} THEN '{name}' END" for k, name in enumerate(names))
    return (flagged.select(F.lit(table).alias("table_name"), F.col("__row").alias("row_key"), F.expr(f"array_compact(array({broken})) AS rules"))
            .filter(F.size("rules") > 0))
