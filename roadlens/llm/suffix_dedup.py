"""Removing long repeated passages by interval expansion on a Burrows-Wheeler transform.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere
else, in the same text or another. Strings are judged on the input.

1. Every window of ``LENGTH`` bytes chooses an anchor, the smallest (by hash) of
   its strings of ``ANCHOR`` bytes, so equal windows choose equal anchors. The
   windows of one text that share an anchor, with the text they cover, are a
   *context*. Anchors that occur once are done with.
2. Equal contexts are counted. One that was counted more than once goes as a
   whole; an anchor is searched only if it has a context that was counted once.
3. The distinct contexts of such an anchor come together in one task, many anchors to
   a block of about ``BLOCK_BYTES``. The block's suffixes are sorted, and breadth-first
   backward extension on the Burrows-Wheeler transform (:mod:`.bwt`) finds
   the places that share ``LENGTH`` bytes with another place.
4. An anchor with more than ``LIMIT`` distinct contexts would outgrow a block.
   Its contexts choose anchors again, longer ones, which splits them into many smaller
   contexts of many anchors, and steps 2 to 4 are repeated with these. The
   length of an anchor approaches ``LENGTH``, where equal windows are one context.
5. What was found is joined back to the texts that have the context, and cut.

Windows between anchors belong to exactly one context, so no pair of windows is
missed or compared twice. Texts travel compressed; they are shuffled twice.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose
nothing; a text that occurs twice and is long enough goes as a whole, in every
copy; cuts are made between bytes, so what is kept may not be valid UTF-8 and
is returned as bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeats
from .common import pack_last, shuffle_partitions, staged, text_or_empty
from .shingles import BASE, BYTE_CODES, INVERSE, _powers, mix

LENGTH = 400
ANCHOR = 160
LIMIT = 512
BLOCK_BYTES = 1 << 20
PLACE_BITS = 32


_PIECES = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("copies", pa.int64()), ("hot", pa.bool_()), ("bytes", pa.binary())])
_PLACE = "anchor bigint, context bigint, first int, windows int"
_FOUND = "anchor bigint, context bigint, low array<int>, high array<int>"


def anchors(text: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each context of one text."""
    n = len(text)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _powers(BASE, n), _powers(INVERSE, n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[text] * up, dtype=np.uint64)))
    hashes = mix((sums[size:] - sums[:-size]) * down[:n - size + 1])
    # the upper bits order the candidates, the place (lower bits) breaks ties in favour of the first one
    best = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    width, reached = length - size + 1, 1
    while reached < width:
        step = min(reached, width - reached)
        best = np.minimum(best[:-step], best[step:])
        reached += step
    place = (best & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return hashes[place[first]], first, np.diff(np.append(first, len(place)))


def _contexts(length: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for text in batch.column(2).to_pylist():
                raw = text.encode("utf-8", "replace")
                h, first, windows = anchors(np.frombuffer(raw, np.uint8), length, size)
                out[0].append(h.view(np.int64))
                out[1].append(np.array([xxhash.xxh3_64_intdigest(raw[a:a + w + length - 1]) for a, w in zip(first.tolist(), windows.tolist(), strict=True)], np.uint64).view(np.int64))
                out[2].append(first.astype(np.int32))
                out[3].append(windows.astype(np.int32))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in out[0]]))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["k1", "k2", "anchor", "context", "first", "windows"])

    return run


def _extract(length: int, unpack):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for packed, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = unpack(packed.as_py())
                rows += [{"anchor": w["anchor"], "context": w["context"], "copies": w["copies"], "hot": w["hot"],
                          "bytes": raw[w["first"]:w["first"] + w["windows"] + length - 1]} for w in wanted]
            yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)

    return run


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2].tolist(), edges[1::2].tolist()


def _search(length: int, block_bytes: int):
    """Rows (anchor, context, copies, bytes) in order of their anchors to the runs of repeated windows of contexts counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[tuple[int, int], tuple[int, bytes]] = {}
        size, last = 0, None

        def search() -> pa.RecordBatch:
            rows = []
            for (key, (copies, _)), flags in zip(block.items(), repeats([raw for _, raw in block.values()], length), strict=True):
                if copies == 1 and flags.any():
                    low, high = _runs(flags)
                    rows.append({"anchor": key[0], "context": key[1], "low": low, "high": high})
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))]))

        for batch in batches:
            for anchor, context, copies, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if size >= block_bytes and anchor != last:
                    yield search()
                    block, size = {}, 0
                if (anchor, context) not in block:
                    block[anchor, context] = copies, raw
                    size += len(raw)
                last = anchor
        if block:
            yield search()

    return run


def _again(length: int, size: int):
    """Rows (anchor, context, copies, bytes) of hot anchors to their contexts under longer anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[], [], [], [], [], [], []]
            for anchor, context, copies, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                h, first, windows = anchors(np.frombuffer(raw, np.uint8), length, size)
                digests = [xxhash.xxh3_64_intdigest(raw[a:a + w + length - 1]) for a, w in zip(first.tolist(), windows.tolist(), strict=True)]
                for column, values in zip(columns, (np.full(len(h), anchor), np.full(len(h), context), np.full(len(h), min(copies, 2)), h.view(np.int64),
                                                    np.array(digests, np.uint64).view(np.int64), first.astype(np.int32), windows.astype(np.int32)), strict=True):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns],
                                                 names=["k1", "k2", "weight", "anchor", "context", "first", "windows"])

    return run


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    value = text_or_empty(text)
    return docs.select("*", F.xxhash64(value).alias("k1"), F.xxhash64(F.lit("second"), value).alias("k2"), value.alias("the text"))


def _repeated(places: DataFrame, held: DataFrame, unpack, length: int, anchor: int, limit: int, block_bytes: int) -> DataFrame:
    """``(anchor, context, low, high)``: the runs of windows that occur again, of every context that has some.

    ``places`` (k1, k2, weight, anchor, context, first, windows) says which contexts a string has and how often the string
    occurs; ``held`` (k1, k2, packed) has the strings, which ``unpack`` turns into bytes.
    """
    contexts = staged(places.groupBy("anchor", "context").agg(
        F.sum("weight").alias("copies"), F.min(F.struct("k1", "k2", "first", "windows")).alias("seen")), "bwt-distinct")
    zero = F.lit(0).cast("int")
    whole = contexts.filter("copies > 1").select("anchor", "context", F.array(zero).alias("low"), F.array("seen.windows").alias("high"))
    kinds = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("fewest"))
    kinds = kinds.filter("fewest = 1 and n > 1").select("anchor", (F.col("n") > limit).alias("hot"))
    wanted = contexts.join(kinds, "anchor").groupBy(F.col("seen.k1").alias("k1"), F.col("seen.k2").alias("k2")).agg(
        F.collect_list(F.struct("anchor", "context", F.col("seen.first").alias("first"), F.col("seen.windows").alias("windows"), "copies", "hot")).alias("wanted"))
    pieces = staged(held.join(wanted, ["k1", "k2"]).select("packed", "wanted").mapInArrow(
        _extract(length, unpack), "anchor bigint, context bigint, copies bigint, hot boolean, bytes binary"), "bwt-pieces")
    parts = shuffle_partitions(places.sparkSession)
    ordered = (pieces.filter("not hot").select("anchor", "context", "copies", "bytes")
               .repartition(parts, "anchor").sortWithinPartitions("anchor"))
    found = whole.unionByName(ordered.mapInArrow(_search(length, block_bytes), _FOUND))
    hot = pieces.filter("hot")
    if hot.isEmpty():
        return staged(found, "bwt-repeated")
    longer = length - (length - anchor) // 4
    hot = hot.select(F.col("anchor").alias("k1"), F.col("context").alias("k2"), "copies", F.col("bytes").alias("packed"))
    subs = staged(hot.mapInArrow(_again(length, longer), "k1 bigint, k2 bigint, weight bigint, " + _PLACE), "bwt-again")
    deeper = _repeated(subs, hot.select("k1", "k2", "packed"), bytes, length, longer, limit, block_bytes)
    shift = lambda ends: F.transform(ends, lambda x: x + F.col("first"))
    # the windows of a context are dealt once, so its runs are disjoint, and where one ends as the next one starts they are one
    runs = subs.filter("weight = 1").join(deeper, ["anchor", "context"]).groupBy("k1", "k2").agg(
        F.flatten(F.collect_list(shift("low"))).alias("low"), F.flatten(F.collect_list(shift("high"))).alias("high"))
    runs = runs.select(F.col("k1").alias("anchor"), F.col("k2").alias("context"), F.sort_array(F.array_except("low", "high")).alias("low"),
                       F.sort_array(F.array_except("high", "low")).alias("high"))
    return staged(found.unionByName(runs), "bwt-repeated")


def spans(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, limit: int = LIMIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(k1, k2, spans)``: for each text that loses bytes (known by two hashes), the covered ranges, not yet merged."""
    long_texts = _keyed(docs.select(text), text).select("k1", "k2", "the text").filter(F.octet_length("the text") >= length)
    found = staged(long_texts.mapInArrow(
        _contexts(length, anchor), "k1 bigint, k2 bigint, anchor array<bigint>, context array<bigint>, first array<int>, windows array<int>"), "bwt-contexts")
    each = found.select("k1", "k2", F.explode(F.arrays_zip("anchor", "context", "first", "windows")).alias("x")).select("k1", "k2", "x.*")
    again = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    places = staged(each.join(again, "anchor").withColumn("weight", F.lit(1).cast("bigint")), "bwt-places")
    packed = long_texts.mapInArrow(pack_last, "k1 bigint, k2 bigint, packed binary").dropDuplicates(["k1", "k2"])
    repeated = _repeated(places, packed, zstandard.decompress, length, anchor, limit, block_bytes)
    # copies of a text have the same places; one of each is enough
    per_text = places.dropDuplicates(["k1", "k2", "first"]).join(repeated, ["anchor", "context"])
    return per_text.select("k1", "k2", F.explode(F.arrays_zip("low", "high")).alias("x"), "first").groupBy("k1", "k2").agg(
        F.collect_list(F.struct((F.col("first") + F.col("x.low")).alias("low"),
                                (F.col("first") + F.col("x.high") + (length - 1)).alias("high"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        removed, merged, kept = [], [], []
        for packed, ranges in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            raw, out, at, runs = unpack(packed.as_py()), [], 0, 0
            end = -1
            for r in sorted((r["low"], r["high"]) for r in ranges):
                if r[0] > end:  # a new run; ranges that touch are one
                    runs += 1
                    out.append(raw[at:r[0]])
                end = at = max(end, r[1])
            out.append(raw[at:])
            kept.append(b"".join(out))
            removed.append(len(raw) - len(kept[-1]))
            merged.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(merged, pa.int64()), pa.array(kept, pa.binary())],
                                         names=["row", "n_removed", "n_spans", "kept"])


def cut_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> tuple[DataFrame, DataFrame]:
    """The rows that lose bytes, ``(id, n_bytes, n_removed, n_spans, kept)``, and the rows that lose none, with their text."""
    found = staged(spans(docs, text, **options), "bwt-spans")
    keyed = _keyed(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text")
    packed = keyed.select(F.struct("id", F.octet_length("the text").alias("n")).alias("row"), "k1", "k2", "the text").filter(
        F.octet_length("the text") >= options.get("length", LENGTH))
    row = packed.schema["row"].dataType.simpleString()
    packed = packed.mapInArrow(pack_last, f"row {row}, k1 bigint, k2 bigint, packed binary")
    cut = packed.join(found, ["k1", "k2"]).select("row", "packed", "spans").mapInArrow(
        _cut, f"row {row}, n_removed bigint, n_spans bigint, kept binary")
    cut = cut.select(F.col("row.id").alias("id"), F.col("row.n").cast("bigint").alias("n_bytes"), "n_removed", "n_spans", "kept")
    whole = keyed.select("id", F.octet_length("the text").cast("bigint").alias("n_bytes"), F.sha2("the text", 256).alias("sha256"), "k1", "k2")
    return cut, whole.join(found.select("k1", "k2"), ["k1", "k2"], "left_anti").select("id", "n_bytes", "sha256")
