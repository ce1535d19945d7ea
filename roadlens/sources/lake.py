"""Parquet ping lake: ``<root>/env=<env>/year=YYYY/month=MM/day=DD/*.parquet``.

Writing: rows carry an ``env`` (``prod`` / ``mock``) and the date of the
partition (processing time by default, another instant optionally); month and
day are zero-padded text as in the lake layout. A value that cannot be cast to
its column's type becomes NULL, which validation reports; it does not end the
job. Writes rebalance on the partition columns first: AQE then makes one task
of many small partitions and several of a large day, so files have the advisory
size; ``maxRecordsPerFile`` caps them.

Reading: an explicit schema (never inference), partition values typed, and
the file name plus the row position kept as the ``src_file`` / ``src_row``
order of the keep-first dedupe. Filters on env/year/month/day prune
directories (visible as ``PartitionFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.session import exists

LAKE_SCHEMA = T.StructType([
    T.StructField("gps_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("traffic_light_id", T.StringType()),
    T.StructField("day_type", T.StringType()),
    T.StructField("time_window", T.StringType()),
    T.StructField("received_at", T.StringType()),
])
PARTITIONS = ["env", "year", "month", "day"]
READ_SCHEMA = T.StructType(LAKE_SCHEMA.fields + [
    T.StructField("env", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])


def _aligned(columns) -> list[Column]:
    cols = set(columns)
    return [(F.col(f.name) if f.name in cols else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in LAKE_SCHEMA.fields]


def align(df: DataFrame) -> DataFrame:
    """Lake layout: missing columns as NULL, extras dropped, fixed order and types."""
    return df.select(*_aligned(df.columns))


def with_partitions(df: DataFrame, env: Column | str, at: Column | None = None) -> DataFrame:
    """Aligned rows plus env/year/month/day; ``at`` defaults to processing time (now, UTC).

    ``env`` and ``at`` are evaluated on the input row, so they may use columns
    that alignment drops.
    """
    t = at if at is not None else F.current_timestamp()
    e = F.lit(env) if isinstance(env, str) else env
    return df.select(*_aligned(df.columns), e.alias("env"),
                     F.date_format(t, "yyyy").alias("year"),
                     F.date_format(t, "MM").alias("month"),
                     F.date_format(t, "dd").alias("day"))


def write(df: DataFrame, root: str, max_records_per_file: int = 5_000_000,
          mode: str = "append", observe: tuple | None = None) -> None:
    """Append to the lake.

    The ``rebalance`` hint deals rows by the partition columns; AQE sizes the
    tasks by their bytes (small days together, a large day split), without a
    sampling pass over the input. ``observe`` = (Observation, expressions)
    attaches load metrics after that exchange, so they count each row once.
    """
    out = df.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "timestamp", "gps_id")
    if observe:
        out = out.observe(observe[0], *observe[1])
    (out.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(root))


# Load metrics gathered by ``observe`` in the same pass as the write.
WRITE_METRICS = {
    "rows_written": "count(1)",
    "rows_without_light": "count_if(traffic_light_id IS NULL OR traffic_light_id = 'unknown')",
    "rows_peak_hour": "count_if(time_window = 'peak_hour')",
}


def write_observed(df: DataFrame, root: str, metrics: dict[str, str] | None = None, **kw) -> dict:
    """Append to the lake and return load metrics counted while writing.

    The metrics are ``DataFrame.observe`` aggregates evaluated inside the
    write's own tasks (partial per task, merged on the driver as a few
    numbers), so counting costs no second pass over the data.
    """
    from pyspark.sql import Observation
    obs = Observation("lake_write")
    m = metrics or WRITE_METRICS
    write(df, root, observe=(obs, [F.expr(f"CAST({e} AS BIGINT) AS {n}") for n, e in m.items()]), **kw)
    return dict(obs.get)


FILES = "path string, size bigint, modified timestamp"


def files(spark: SparkSession, root: str, env: str | None = None, since=None) -> DataFrame:
    """``(path, size, modified)`` of the lake's files, from the listing; none is opened.

    ``since`` (a UTC ``datetime``) narrows the listing to files modified after it, chosen early enough to cover the longest write.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if since:
        r = r.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S.%f"))
    listed = r.load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return listed.filter(F.col("path").contains(f"/env={env}/")) if env else listed


def discover(spark: SparkSession, root: str, manifests: str, env: str | None = None, since=None) -> DataFrame:
    """The files that no run has recorded below ``manifests``: exact, however late a file was committed."""
    listed = files(spark, root, env, since)
    if not exists(spark, manifests):
        return listed
    return listed.join(spark.read.schema(FILES).parquet(manifests).select("path"), "path", "left_anti")


def record(found: DataFrame, manifests: str, run: str) -> DataFrame:
    """Write a run's files to its own manifest, and read that back: what the run covers is fixed from here on.

    A repeated run overwrites its manifest. Write it to a folder that :func:`discover` does not look at,
    and record it there once the rows are stored, if a failed run's files shall be found again.
    """
    path = f"{manifests}/run={run}"
    found.select("path", "size", "modified").write.mode("overwrite").parquet(path)
    return found.sparkSession.read.schema(FILES).parquet(path)


def read_files(spark: SparkSession, root: str, found: DataFrame) -> DataFrame:
    """The rows of the ``found`` files alone; their paths pass through the driver, as those of any scan do."""
    paths = sorted(r["path"] for r in found.select("path").collect())
    if not paths:
        return spark.createDataFrame([], READ_SCHEMA).selectExpr("*", "'' AS src_file", "0L AS src_row")
    df = spark.read.schema(READ_SCHEMA).option("basePath", root).parquet(*paths)
    return df.select("*", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.row_index").alias("src_row"))


def read(spark: SparkSession, root: str, env: str | None = None,
         modified_after: str | None = None, with_order: bool = True) -> DataFrame:
    """Read the lake; ``modified_after`` gives incremental file discovery."""
    r = spark.read.schema(READ_SCHEMA)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    df = r.parquet(root)
    if with_order:
        df = df.select("*", F.col("_metadata.file_path").alias("src_file"),
                       F.col("_metadata.row_index").alias("src_row"))
    if env:
        df = df.filter(F.col("env") == env)
    return df
