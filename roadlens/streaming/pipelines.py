"""Structured Streaming jobs: ingest (JSON → lake) and verdicts (lake → results).

The batch operators are reused through ``DataFrame.transform`` style calls;
only stream-specific pieces live here:

* ingest: a text/JSON (or Kafka, when its connector is on the classpath)
  stream of request bodies → :func:`roadlens.sources.decode.decode_requests`
  → accepted rows appended to the partitioned lake, rejected rows to a
  dead-letter folder. Checkpointed offsets give at-least-once delivery; the
  warehouse key absorbs replays.
* verdicts: lake/warehouse files → watermark → event-time windows per light
  → ``foreachBatch`` applying the schedule join, indicators and per-light
  collapse (batch operators on each micro-batch), written idempotently per
  batch id.

Exact distinct vehicles: two chained aggregations. The first keeps a sum and a
count per window, group and vehicle, the second counts those rows, so state is
one short row per vehicle of an open window, spread by vehicle, and a busy
light is never one growing set. Sliding windows would make that a row per vehicle
and each window that covers it: their state is one row per vehicle and pane, from which the closed
windows are computed (:func:`sliding_batch_writer`).

A stream in append mode emits what its watermark has closed, and drops what
comes later than that. :func:`catch_up` completes the stored result from the
stored pings, insert-or-ignore, once a stream has been drained.

Window edge: the warehouse job's frame is ``(as_of - 5 min, ∞)``; event-time
windows are ``[start, end)``. For exact parity at one instant use
:func:`roadlens.operators.congestion.snapshot`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from roadlens.operators import congestion
from roadlens.operators.joins import keep_first
from roadlens.session import file_system
from roadlens.sources import decode, lake

WATERMARK = "10 minutes"


def read_stream(spark: SparkSession, source: str, options: dict, max_files: int | None = None, max_bytes: str | None = None,
                max_offsets: int | None = None) -> DataFrame:
    """Request bodies (column ``value``) of any streaming source: ``source`` is its format, ``options`` are its own.

    The limits bound a micro-batch: files or bytes of a file source, offsets of a queue. They hold within an
    ``availableNow`` run as well, which then takes several batches.
    """
    r = spark.readStream.format(source).options(**options)
    for name, limit in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes), ("maxOffsetsPerTrigger", max_offsets)):
        if limit:
            r = r.option(name, limit)
    return r.load().select(F.col("value").cast("string").alias("value"))


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return read_stream(spark, "text", {"path": path}, max_files=max_files_per_trigger)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Queue source (needs the Kafka connector on the classpath)."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return read_stream(spark, "kafka", options, max_offsets=max_offsets_per_trigger)


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Queue sink keyed by gps_id (needs the Kafka connector)."""
    return (decode.encode_message(df).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


# Counted in the same pass as a micro-batch is written.
INGEST_METRICS = {
    "rows_in": "count(1)",
    "rows_accepted": "count_if(reject_reason IS NULL)",
    "rows_malformed": "count_if(reject_reason IN ('malformed', 'empty'))",
    "rows_invalid": "count_if(reject_reason NOT IN ('malformed', 'empty'))",
}
AUDIT = "run string, batch_id bigint, metric string, value bigint"


class StreamAudit(StreamingQueryListener):
    """Appends the observed metrics of every micro-batch to an audit table below ``path``, one folder per run and batch.

    A batch that is replayed after a failure overwrites its folder, so it counts once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        rows = [(str(p.id), p.batchId, name, int(row[name])) for row in p.observedMetrics.values() for name in row.asDict()]
        if rows:
            self.spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={p.id}/batch={p.batchId}")


def ingest(requests: DataFrame, lake_root: str, dead_letter: str, checkpoint: str, env: str = "prod",
           received_at=None, available_now: bool = True, processing_time: str | None = None):
    """Start the ingest query: accepted rows to the lake, rejected ones to the dead letters, in one pass.

    Each micro-batch is decoded once and persisted, with the bodies of its rejected rows only, while both sinks are written; the
    lake write rebalances, so a trigger leaves files by size and not one per task. Both sinks write a folder per
    batch id, overwritten if the batch is replayed.
    """
    decoded = decode.decode_requests(requests, received_at=received_at).observe(
        "ingest", *[F.expr(f"{e} AS {n}") for n, e in INGEST_METRICS.items()])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.selectExpr("CASE WHEN reject_reason IS NOT NULL THEN value END AS value", "reject_reason", *decode.MESSAGE_COLS).persist()
        lake.write(lake.with_partitions(decode.accepted(batch), env), f"{lake_root}/batch_id={batch_id}", mode="overwrite")
        decode.rejected(batch).write.mode("overwrite").parquet(f"{dead_letter}/batch_id={batch_id}")
        batch.unpersist()

    w = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def window_stats(pings: DataFrame, minutes: int = 5, slide: int | None = None,
                 watermark: str = WATERMARK, vehicle_col: str = "gps_id") -> DataFrame:
    """Per (window end, light, time_window, day_type): mean speed and distinct vehicles."""
    w = F.window("recorded_at", f"{minutes} minutes", f"{slide} minutes" if slide else None)
    per_vehicle = (pings.withWatermark("recorded_at", watermark)
                   .filter(F.col("traffic_light_id").isNotNull())
                   .groupBy(w.alias("__w"), *congestion.GROUP, vehicle_col)
                   .agg(F.expr(f"sum({congestion.SPEED_DEC}) AS __sum"), F.expr("count(speed_kmh) AS __n")))
    # windows that end at one instant are one group: the step that holds the last microsecond before it
    end = F.window(F.window_time("__w"), f"{slide or minutes} minutes")
    return (per_vehicle.groupBy(end.alias("__e"), *congestion.GROUP)
            .agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("veh_count"))
            .selectExpr(*congestion.GROUP, "__e.end AS analysis_ts", "CAST(__sum AS DOUBLE) / __n AS avg_speed", "veh_count"))


def verdict_batch_writer(schedule: DataFrame, out_path: str, mode: str = "strict"):
    """``foreachBatch`` body: verdicts of the windows closed in this batch.

    In append mode every group of a window is emitted in the same micro-batch
    (eviction depends on the window end only), so the per-light collapse is
    exact per batch. Output goes to ``batch_id=<n>``, overwritten on replay,
    which makes the sink idempotent.
    """
    def run(stats: DataFrame, batch_id: int) -> None:
        v = congestion.verdicts(stats, schedule, "analysis_ts", mode)
        v.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    return run


def sliding_batch_writer(schedule: DataFrame, out_path: str, state: str, minutes: int, slide: int, watermark: str = WATERMARK,
                         mode: str = "strict", vehicle_col: str = "gps_id"):
    """``foreachBatch`` body: verdicts of the sliding windows that the watermark closes with this batch of pings.

    The state is a folder per batch below ``state``: one short row per vehicle, group and pane, of the batch and of the panes
    before it that an open window still needs. A batch reads the folder of the one before and writes its own,
    overwritten on replay; older ones are removed. The watermark is the last ping so far less the delay. A late ping counts in
    the windows that are open, and in none that has been written. A window's groups are all written with the batch that closes it.
    """
    us = slide * 60_000_000
    write = verdict_batch_writer(schedule, out_path, mode)
    last = f"unix_micros(timestamp_micros(max(__last)) - CAST('{watermark}' AS INTERVAL))"

    def closed(panes: DataFrame) -> int | None:
        """Number of the last closed window's last pane, if there is a ping."""
        at = panes.selectExpr(f"{last} AS at").first()["at"]
        return None if at is None else at // us - 1

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{state}/batch_id={batch_id}"
        rows = congestion.pane_rows(batch, slide, vehicle_col).selectExpr(
            "__p", *congestion.GROUP, f"`{vehicle_col}`", "CAST(__speed AS DECIMAL(28,6)) AS __sum", "CAST(nvl2(__speed, 1, 0) AS BIGINT) AS __n", "__at AS __last")
        before = None
        if batch_id:
            kept = spark.read.schema(rows.schema).parquet(f"{state}/batch_id={batch_id - 1}")
            before = closed(kept)
            rows = rows.unionByName(kept)
        if before is not None:
            rows = rows.filter(f"__p > {before - minutes // slide + 1}")
        (rows.groupBy("__p", *congestion.GROUP, vehicle_col)
         .agg(F.expr("CAST(sum(__sum) AS DECIMAL(28,6)) AS __sum"), F.expr("sum(__n) AS __n"), F.expr("max(__last) AS __last"))
         .write.mode("overwrite").parquet(folder))
        panes = spark.read.schema(rows.schema).parquet(folder)
        now = closed(panes)
        stats = congestion.slide_panes(panes.filter(f"__p <= {now}" if now is not None else "false"), minutes, slide, vehicle_col)
        ends = [f"unix_micros(analysis_ts) div {us} - 1 {o} {e}" for o, e in ((">", before), ("<=", now)) if e is not None]
        write(stats.filter(" AND ".join(ends) or "true"), batch_id)
        fs, old = file_system(spark, f"{state}/batch_id={batch_id - 2}")
        fs.delete(old, True)
    return run


def verdicts(pings: DataFrame, schedule: DataFrame, out_path: str, checkpoint: str,
             minutes: int = 5, slide: int | None = None, watermark: str = WATERMARK,
             mode: str = "strict", available_now: bool = True,
             processing_time: str | None = "60 seconds"):
    """Start the streaming verdict query (append mode, idempotent per batch).

    Sliding windows of whole panes keep their panes below the checkpoint (:func:`sliding_batch_writer`), others are stateful
    aggregations (:func:`window_stats`).
    """
    if slide and minutes % slide == 0:
        out = pings.writeStream.foreachBatch(sliding_batch_writer(schedule, out_path, checkpoint + "/panes", minutes, slide, watermark, mode))
    else:
        out = window_stats(pings, minutes, slide, watermark).writeStream.foreachBatch(verdict_batch_writer(schedule, out_path, mode))
    w = out.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def catch_up(stored: DataFrame, complete: DataFrame, keys: list[str]) -> DataFrame:
    """The stored rows plus those of ``complete`` (the batch result) whose key is not stored."""
    return stored.unionByName(complete.join(stored.select(*keys), keys, "left_anti").select(*stored.columns))


def dedupe(pings: DataFrame, watermark: str = WATERMARK, keys=("gps_id", "recorded_at")) -> DataFrame:
    """Drop repeated keys within the watermark (state bounded by the watermark)."""
    return pings.withWatermark("recorded_at", watermark).dropDuplicatesWithinWatermark(list(keys))


def keep_first_stream(pings: DataFrame, order=("src_file", "src_row"), watermark: str = WATERMARK,
                      keys=("gps_id", "recorded_at")) -> DataFrame:
    """Keep-first per key on a stream, skew-safe (append-mode aggregation).

    :func:`dedupe` emits a key's first arrival at once, but its operator has
    no map-side step: every copy of a key crosses the shuffle into one task,
    so a key copied a third of the time loads one task with a third of each
    micro-batch. Here the same ``min(named_struct(order…, payload…))`` as the
    batch :func:`roadlens.operators.joins.keep_first` runs as a streaming
    aggregation, which Spark pre-aggregates inside every input task before the
    shuffle, and the kept row is the first by ``order`` (not by arrival).
    The price is latency: a key is emitted once the watermark passes its
    ``recorded_at``; state is bounded by the watermark as well.
    """
    return keep_first(pings.withWatermark("recorded_at", watermark), list(keys), list(order))


def sessions(pings: DataFrame, gap_seconds: int = 30, watermark: str = WATERMARK,
             vehicle_col: str = "gps_id") -> DataFrame:
    """Closed gap sessions per vehicle (emitted once the watermark passes the session end)."""
    sw = F.session_window("recorded_at", f"{int(gap_seconds)} seconds")
    return (pings.withWatermark("recorded_at", watermark)
                 .groupBy(vehicle_col, sw.alias("__s"))
                 .agg(F.count(F.lit(1)).alias("n_points"),
                      F.min("recorded_at").alias("first_ping"),
                      F.max("recorded_at").alias("last_ping")))
