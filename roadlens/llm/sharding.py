"""Sharding by a two-pass external shuffle.

Pass 1 scatters whole records uniformly into memory-sized buckets by a seeded
hash. Pass 2 shuffles each bucket in memory by Fisher-Yates, with a generator
seeded by the run's seed and the bucket, and writes it. The concatenation of
the buckets is then a uniform random permutation; the record at place ``p`` of
it goes to shard ``p mod n`` as slot ``p div n``, so shard sizes differ by at
most one row (the ``rows`` law) and slots have no gaps.

The places of a bucket's records need the sizes of the buckets before it. These
offsets are a two-level prefix sum: inside spans of ``SPAN`` buckets by a
window per span, and over the spans' totals (one number per ``SPAN`` buckets,
4 GB of texts at least for each number) on the driver.

Defined results: a null text has size 1 and CRC-32 0; rows with null or
repeated ids are rows like any other (the row's place in the input joins the
hash, so even a table of equal rows scatters evenly); an empty table gives no
rows; further columns are written with the record. Reruns over the same files
agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, shuffle_partitions, staged, text_or_empty

SHARDS = 16
SEED = 20_240_607
BUCKET_BYTES = 16 << 20  # text of a bucket; a task holds one or a few of them
SPAN = 256


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of ``0 .. n-1`` (numpy's in-place Fisher-Yates)."""
    order = np.arange(n)
    np.random.default_rng([seed, bucket]).shuffle(order)
    return order


def scatter(docs: DataFrame, text: str, seed: int, bucket_bytes: int, names: dict) -> tuple[DataFrame, int]:
    """Pass 1: records with their size, CRC and bucket, dealt to one partition per bucket."""
    value = text_or_empty(text)
    sized = docs.withColumn(names["size"], (F.octet_length(value) + 1).cast("bigint"))
    total = sized.agg(F.sum(names["size"])).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), shuffle_partitions(docs.sparkSession))
    key = F.xxhash64(F.lit(seed), F.col(names["row"]))
    dealt = (sized.withColumn(names["crc"], F.crc32(F.encode(value, "utf-8")).cast("bigint"))
             .withColumn(names["row"], F.monotonically_increasing_id())
             .withColumn(names["key"], key)
             .withColumn(names["bucket"], F.pmod(names["key"], F.lit(buckets)).cast("int"))
             .repartition(buckets, names["bucket"]))
    return dealt, buckets


def _shuffle_bucket(names: dict, seed: int):
    def run(records: pa.Table) -> pa.Table:
        bucket = records.column(names["bucket"])[0].as_py()
        # the order of arrival depends on the cluster, so the records are first put in the order of their keys
        first = pa.compute.sort_indices(records, [(names["key"], "ascending"), (names["row"], "ascending")])
        records = records.take(first).take(pa.array(fisher_yates(len(records), seed, bucket)))
        return records.append_column(names["place"], pa.array(np.arange(len(records)), pa.int64())).drop_columns(
            [names["key"], names["row"]])

    return run


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, dict]:
    """The written records with their shard and slot.

    Returns the frame (all columns of ``docs`` and the added ones) and the
    names of the added columns: ``size``, ``crc``, ``shard``, ``slot``.
    """
    wanted = ["size", "crc", "row", "key", "bucket", "place", "shard", "slot", "offset"]
    names = dict(zip(wanted, fresh(docs, *wanted), strict=True))
    dealt, _ = scatter(docs, text, seed, bucket_bytes, names)
    kept = [f for f in dealt.schema.fields if f.name not in (names["key"], names["row"])]
    schema = T.StructType([*kept, T.StructField(names["place"], T.LongType())])
    written = staged(dealt.groupBy(names["bucket"]).applyInArrow(_shuffle_bucket(names, seed), schema), "buckets")

    counts = written.groupBy(F.col(names["bucket"]).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    spans = counts.withColumn("span", (F.col("b") / SPAN).cast("int"))
    before, base = 0, []
    for s, n in spans.groupBy("span").agg(F.sum("n")).orderBy("span").collect():
        base.append((s, before))
        before += n
    starts = docs.sparkSession.createDataFrame(base, "span int, base bigint")
    offsets = (spans.join(starts, "span")
               .selectExpr("b", f"base + sum(n) over (partition by span order by b) - n as {names['offset']}"))
    place = F.col(names["offset"]) + F.col(names["place"])
    placed = (written.join(offsets, written[names["bucket"]] == offsets.b)
              .withColumn(names["shard"], F.pmod(place, F.lit(shards)).cast("int"))
              .withColumn(names["slot"], F.floor(place / shards).cast("bigint"))
              .drop("b", names["offset"], names["bucket"], names["place"]))
    return placed, {k: names[k] for k in ("size", "crc", "shard", "slot")}
