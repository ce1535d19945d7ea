"""Fill-in-middle transformation by a Fenwick tree over fixed blocks of a text.

A text is a sequence of units (a run of ASCII letters, or one other code
point). It is cut after two numbers of units, drawn from a keyed hash of its
id, into prefix, middle and suffix, which are written in the order prefix,
suffix, middle (``psm``) or suffix, prefix, middle (``spm``) behind one marker each.

Two Fenwick trees over blocks of ``BLOCK`` bytes hold how many units and how
many code points start in each block. For a cut the trees are descended by
binary lifting (halving steps, a step is taken while the units before it do not
exceed the cut): that gives the block of the cut and the code points before the
block, and only this block is looked at again to find the byte. All texts
of a batch are counted, and their trees built and descended, together; the masks
of a long text are made ``PIECE`` bytes at a time.

Defined results: a null text is an empty one; empty texts, texts that contain a
marker, and those that the hash leaves out stay as they are (``plain``, without
counts of prefix and middle); a null id is hashed as an empty one; rows with equal ids draw
equally; an empty table gives no rows; further columns pass through, and the new ones take names that clash with none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 512  # bytes of a block
PIECE = 1 << 22  # bytes whose masks are made at a time
GROUP = 1 << 22  # bytes of texts that are handled together
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def starts(raw: np.ndarray, before: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where units and code points start, in bytes that follow a letter (``before``) or none."""
    letter, lead = LETTER[raw], (raw & 0xC0) != 0x80
    after = np.empty_like(letter)
    after[:1], after[1:] = before, letter[:-1]
    return lead & ~(letter & after), lead


class Trees:
    """The Fenwick trees of several texts: ``raw[offsets[k]:offsets[k + 1]]`` is text ``k``."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        size = np.diff(offsets)
        self.blocks = -(-size // BLOCK)
        self.base = np.concatenate(([0], np.cumsum(self.blocks)))
        owner = np.repeat(np.arange(len(size)), self.blocks)
        place = np.arange(len(owner)) - self.base[owner] + 1  # from 1 within its text
        first = offsets[:-1][owner] + (place - 1) * BLOCK
        units, points = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        # a text's first byte starts a unit whatever the text before it ends with
        step = PIECE // BLOCK
        for a in range(0, len(owner), step):
            begin = first[a]
            end = first[a + step] if a + step < len(owner) else offsets[-1]
            unit, lead = starts(raw[begin:end], begin > 0 and LETTER[raw[begin - 1]])
            opening = first[a:a + step][place[a:a + step] == 1] - begin
            unit[opening] = True
            where = first[a:a + step] - begin
            units[a:a + step] = np.add.reduceat(unit, where, dtype=np.int64)
            points[a:a + step] = np.add.reduceat(lead, where, dtype=np.int64)
        text = np.repeat(np.arange(len(size)), self.blocks)
        self.n = np.bincount(text, units, len(size)).astype(np.int64)
        low, limit, at = place & -place, self.blocks[owner], np.arange(len(owner))
        level = 1
        while level <= (int(self.blocks.max()) if len(size) else 0):
            on = at[(low == level) & (place + level <= limit)]
            units[on + level] += units[on]
            points[on + level] += points[on]
            level *= 2
        self.units, self.points = units, points

    def find(self, text: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and code points of each ``text`` before its unit number ``cut`` (all, if it has no more units)."""
        base, limit = self.base[text], self.blocks[text]
        block, left, points = np.zeros(len(text), np.int64), cut.astype(np.int64), np.zeros(len(text), np.int64)
        step = 1 << int(limit.max()).bit_length() if len(text) else 0
        while step:
            node = np.where(block + step <= limit, base + block + step - 1, -1)
            go = (node >= 0) & (self.units[node] <= left)
            left, points = left - np.where(go, self.units[node], 0), points + np.where(go, self.points[node], 0)
            block += go * step
            step //= 2
        byte = np.diff(self.offsets)[text]
        for k in np.flatnonzero(block < limit).tolist():
            begin, end = self.offsets[text[k]], self.offsets[text[k] + 1]
            at = begin + int(block[k]) * BLOCK
            unit, lead = starts(self.raw[at:min(at + BLOCK, end)], at > begin and LETTER[self.raw[at - 1]])
            here = int(np.flatnonzero(unit)[left[k]])
            byte[k] = at - begin + here
            points[k] += int(lead[:here].sum())
        return byte, points


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the offsets of its texts."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def rearrange(column: pa.Array, draws: np.ndarray, rate: int, spm: int) -> tuple[list[bytes], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Texts, forms, numbers of units, and code points of prefix and middle (-1: plain) of a column without nulls; ``draws`` has four numbers a text."""
    raw, offsets = _raw(column)
    trees, cuts = Trees(raw, offsets), offsets.tolist()
    whole = raw.tobytes()
    texts = [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    open_ = draws[:, 2] % 100 < rate
    open_ &= np.fromiter((bool(t) and not any(x in t for x in marks) for t in texts), bool, len(texts))
    turned = draws[:, 3] % 100 < spm
    some = np.flatnonzero(open_)
    one, two = (draws[some, k] % (trees.n[some] + 1) for k in (0, 1))
    first, chars = trees.find(some, np.minimum(one, two))
    second, chars2 = trees.find(some, np.maximum(one, two))
    prefix, middle = np.full(len(texts), -1), np.full(len(texts), -1)
    prefix[some], middle[some] = chars, chars2 - chars
    forms = np.where(open_, np.where(turned, "spm", "psm"), "plain").tolist()
    for k, a, b in zip(some.tolist(), first.tolist(), second.tolist(), strict=True):
        t = texts[k]
        texts[k] = b"".join((s, t[b:], p, t[:a], m, t[a:b]) if turned[k] else (p, t[:a], s, t[b:], m, t[a:b]))
    return texts, forms, trees.n, prefix, middle


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + GROUP, "right")))
        yield start, end
        start = end


def transform(docs: DataFrame, text: str = "text", id_col: str = "doc_id", seed: str = "1", rate: int = 90,
              spm: int = 20) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the rearranged text and what was done, and the names of the new columns.

    Of 100 texts about ``rate`` are rearranged, and of 100 of these about ``spm`` in the order suffix, prefix, middle.
    """
    wanted = ("output", "form", "units", "prefix_chars", "middle_chars")
    *helpers, clean = fresh(docs, "draw1", "draw2", "draw3", "draw4", "whole")
    c = dict(zip(wanted, fresh(docs, *wanted), strict=True))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    drawn = docs.select("*", text_or_empty(text).alias(clean), *[
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(h) for k, h in enumerate(helpers)])
    kinds = (T.StringType(), T.StringType(), T.LongType(), T.LongType(), T.LongType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c[w], kind) for w, kind in zip(wanted, kinds, strict=True))])
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in _groups(batch.column(width)):
                part = batch.slice(start, end - start)
                draws = np.stack([part.column(width + 1 + k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
                texts, forms, n, prefix, middle = rearrange(part.column(width), draws, rate, spm)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(forms), pa.array(n),
                     *(pa.array(x, mask=x < 0) for x in (prefix, middle))], names=schema.names)

    return drawn.mapInArrow(run, schema), c


def restore(output: Column, form: Column) -> Column:
    """The text that was rearranged: each marker occurs once, as such texts contain none."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
