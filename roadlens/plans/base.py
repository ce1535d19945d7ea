"""Shared stages used by the registered queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators.clean import clean, valid
from roadlens.operators.enrich import quarantine_unknown_lights, to_warehouse
from roadlens.sources import dimensions
from roadlens.sources.fixtures import gps_raw

# Analysis instant of the snapshot queries (inside the fixture's Friday).
AS_OF = "2026-01-09 08:30:00"


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps_raw(spark, sf_dir)


def clean_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_pings(spark, sf_dir))


def warehouse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched, instant-deduplicated pings including unknown lights (one shuffle)."""
    return to_warehouse(valid(raw_pings(spark, sf_dir)))


def warehouse_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse rows after quarantining pings of lights not in the dimension."""
    known, _ = quarantine_unknown_lights(warehouse_all(spark, sf_dir),
                                         dimensions.traffic_lights(spark))
    return known


def unknown_light_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, unknown = quarantine_unknown_lights(warehouse_all(spark, sf_dir),
                                           dimensions.traffic_lights(spark))
    return unknown


def pipeline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, warehouse incl. unknown lights, warehouse) built once as one chain.

    Reports that check several stages derive them from the same DataFrames,
    so the plan is built once and the shared exchanges are identical (AQE
    reuses them instead of recomputing the pipeline per branch).
    """
    raw = raw_pings(spark, sf_dir)
    wh_all = to_warehouse(valid(raw))
    wh, _ = quarantine_unknown_lights(wh_all, dimensions.traffic_lights(spark))
    return raw, wh_all, wh
