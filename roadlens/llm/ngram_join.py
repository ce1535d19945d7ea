"""N-gram Jaccard self-join by a token-group matrix.

Texts are sets of word shingles (64-bit hashes, so sizes and overlaps are those
of the hashes). Two sets link when 100 * |A and B| >= t * |A or B|.

1. Texts with equal sets are one class from the start.
2. Partition similar sets into groups. Each band of min-hashes has a head: the set that meets
   most sets in its own bands, as the least altered one of many near copies does. A set is compared
   exactly with the head of its bands whose sketch agrees most; what links is one family, so a family of any
   size takes one comparison a set. Further rounds, with other bands and heads, compare sets with heads of other families,
   as long as they still add a share of the links. Sets of like size, of one family, else near one, else of one band,
   form groups of about ``GROUP_SETS``.
3. Of its n tokens, in one order for all (widely used tokens last, by their use), a set shows the
   first n - ceil(t n) + l(n), the longer prefix. Linked sets of sizes n and m share at least the
   smaller of l(n) and l(m) tokens of these. So a set has no link outside its family
   unless that many of its longer prefix are shown by sets of other families as well; only such sets go on.
   They are merged once more, by rounds: each token of a shorter prefix (l = 1) has a head, too, and a set is compared with
   the one of these heads that it differs least from. So sets that link with many of a family, but not with its
   head, take one comparison a round, not one for each link.
4. The matrix holds each group's token union, restricted to the first n - ceil(t n) + 1
   tokens (l = 1). A set's overlap with any member of a group is at most the number of its
   prefix tokens in the group's union plus what lies beyond the prefixes.
   Groups of its own family alone are passed over, as nothing can be added there.
5. Groups whose bound reaches the overlap that a link needs are opened. Their
   members are held to the same bound one by one, and to another: every set has ``PARITY`` words of
   bits, and each of its tokens flips one; where two sets' bits differ, so do the sets, so these
   are at most as many as the tokens that one of the two lacks. What is left is compared exactly.

The bound is one-sided, so no link between families is lost: the sketches and
the list of widely used tokens decide how much is compared, never what links.
Links inside a family need not all be listed, as their ends are connected.
Matrix, pairs and sets are joined, never gathered; tokens in many sets come
last in the order, so they seldom reach a prefix.

Defined results: texts without words have an empty set and link with nothing;
null texts are empty; equal sets link, so copies and rows with repeated ids do;
a component's name is its smallest id (null where none of its rows has an id);
an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, most_frequent, named, pack_last, staged, text_or_empty
from .components import components, extended
from .shingles import Shingler, blocks, mix

SKETCH = 16  # min-hashes of a set
BAND = 2  # min-hashes of a band
ALIKE = 9  # equal min-hashes of 16 from which two sets of a band are compared
ROUNDS = 4  # of comparisons with the heads of bands, at most
ADDED = 0.02  # of the links so far: where a round adds fewer, it is the last one
GROUP_SETS = 64
COMMON_TOKENS = 1 << 17  # entries of the list of widely used tokens
COMMON_LOCAL = 4  # sets of a run that a token must be in to be counted for it
RUN_TOKENS = 2_000_000  # tokens of a run
PARITY = 16  # words of 64 bits that tell how many tokens two sets differ in, at least
BITMAP_WORDS = 1 << 20  # words of 64 bits of the broadcast bitmap


def least_overlap(n: np.ndarray, t: int) -> np.ndarray:
    """Tokens that a set of ``n`` shares with any set that it links with, at least."""
    return -(-t * n // 100)


def more_shared(n: np.ndarray, t: int) -> np.ndarray:
    """``l(n)``: the tokens of the longer prefixes that two linked sets of ``n`` tokens share, at least; it grows with ``n``."""
    o = least_overlap(n, t)
    return np.minimum(n - o + 1, o)


def _describe(size: int, t: int):
    """Per text: set size, digest and sketch; and the tokens that many sets of a run have."""
    seeds = [int(x) for x in np.random.default_rng(31).integers(1, 2 ** 63, SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        pending: dict[bytes, np.ndarray] = {}
        waiting = 0

        def frequent() -> pa.RecordBatch:
            tokens, uses = np.unique(np.concatenate(list(pending.values())), return_counts=True)
            on = uses >= COMMON_LOCAL
            k = int(on.sum())
            empty = lambda kind: pa.nulls(k, kind)
            return pa.RecordBatch.from_arrays(
                [*(empty(pa.int64()) for _ in range(6)), empty(pa.list_(pa.int64())),
                 pa.array(tokens[on].view(np.int64)), pa.array(uses[on])], names=["id", "k1", "k2", "n", "high", "low", "sketch", "token", "uses"])

        for batch in batches:
            texts, ids = batch.column(3).to_pylist(), batch.columns[:3]
            for start, end in blocks(texts):
                offsets, tokens = shingler.sets(texts[start:end])
                n = np.diff(offsets)
                cut = offsets.tolist()
                raw = tokens.view(np.uint8)
                digests = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) for a, b in zip(cut, cut[1:], strict=False)]
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                sketch = np.zeros((len(n), SKETCH), np.int64)
                full = np.flatnonzero(n)
                for k, seed in enumerate(seeds):
                    if len(full):
                        sketch[full, k] = np.minimum.reduceat(mix(tokens, seed), offsets[:-1][full]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, end - start) for c in ids), pa.array(n), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, SKETCH * len(n) + 1, SKETCH, dtype=np.int32)), pa.array(sketch.ravel())),
                     pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())],
                    names=["id", "k1", "k2", "n", "high", "low", "sketch", "token", "uses"])
                for d, a, b in zip(digests, cut, cut[1:], strict=False):
                    if b > a and d not in pending:
                        pending[d] = tokens[a:b].copy()
                        waiting += b - a
                if waiting >= RUN_TOKENS:
                    yield frequent()
                    pending, waiting = {}, 0
        if pending:
            yield frequent()

    return run


def _prefixes(size: int, t: int, common, least: int):
    """Per text with at least ``least`` tokens: digest, size, longer prefix, and how many of it a link needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        hot, use = common.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, end in blocks(texts):
                offsets, tokens = shingler.sets(texts[start:end])
                n = np.diff(offsets)
                where = np.minimum(np.searchsorted(hot, tokens), max(len(hot) - 1, 0))
                late = np.where(hot[where] == tokens, use[where], 0).astype(np.uint8) if len(hot) else np.zeros(len(tokens), np.uint8)
                out, lengths, digests, sizes, parity = [], [], [], [], []
                bit = (mix(tokens, 4099) % np.uint64(64 * PARITY)).astype(np.int64)
                take = n - least_overlap(n, t) + more_shared(n, t)
                raw, cut = tokens.view(np.uint8), offsets.tolist()
                for k in np.flatnonzero(n >= least).tolist():
                    a, b = cut[k], cut[k + 1]
                    own, last = tokens[a:b], late[a:b]
                    part = own[np.argsort(last, kind="stable")[:take[k]]]
                    out.append(part)
                    lengths.append(len(part))
                    sizes.append(b - a)
                    digests.append(xxhash.xxh3_128_digest(raw[8 * a:8 * b]))
                    parity.append(np.packbits(np.bincount(bit[a:b], minlength=64 * PARITY).astype(np.uint8) & 1).tobytes())
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                flat = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(np.array(sizes, np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(flat)),
                     pa.array(more_shared(least_overlap(np.array(sizes, np.int64), t), t)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, PARITY * len(sizes) + 1, PARITY, dtype=np.int32)),
                                              pa.array(np.frombuffer(b"".join(parity), np.int64)))],
                    names=["high", "low", "n", "prefix", "needed", "parity"])

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [unpack(x).decode() for x in batch.column(0).to_pylist()]
            for start, end in blocks(texts):
                offsets, tokens = shingler.sets(texts[start:end])
                raw, cut = tokens.view(np.uint8), offsets.tolist()
                sets = [raw[8 * a:8 * b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, sets)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sets, pa.binary())],
                                                 names=["high", "low", "tokens"])

    return run


def _compare(t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                links.append(100 * both >= t * (len(a) + len(b) - both))
            on = pa.array(links, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(on), batch.column(1).filter(on)], names=["a", "b"])

    return run


def _sieved(rows: DataFrame, several: DataFrame) -> DataFrame:
    """``rows`` without most of those whose token is none of ``several``.

    A bitmap of the tokens' hashes, of ``BITMAP_WORDS`` words at most, drops them before any shuffle; it lets through too many, never too few.
    """
    word, bit = F.expr(f"pmod(xxhash64(token), {BITMAP_WORDS})").alias("word"), "cast(pmod(xxhash64(token, 1), 64) as int)"
    bitmap = several.groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits"))
    return rows.select("*", word).join(F.broadcast(bitmap), "word").filter(f"shiftright(bits, {bit}) & 1L = 1L").drop("word", "bits")


class _Join:
    def __init__(self, docs: DataFrame, size: int, t: int, text: str, id_col: str):
        self.size, self.t = size, t
        value = text_or_empty(text)
        self.texts = docs.select(F.xxhash64(value).alias("k1"), F.xxhash64(F.lit("second"), value).alias("k2"), value.alias("text"))
        self.spark = docs.sparkSession
        described = staged(docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(value).alias("k1"), F.xxhash64(F.lit("second"), value).alias("k2"), value.alias("text")).mapInArrow(
            _describe(size, t), "id bigint, k1 bigint, k2 bigint, n bigint, high bigint, low bigint, sketch array<bigint>, token bigint, uses bigint"), "join-sets")
        self.rows = described.filter("n is not null").select("id", "n", "high", "low")
        # of a fixed number of entries
        top = most_frequent(staged(described.filter("token is not null").groupBy("token").agg(F.sum("uses").alias("uses")), "join-common"),
                            "token", "uses", COMMON_TOKENS).collect()
        hot = np.array([r["token"] for r in top], np.int64).view(np.uint64)
        # their places in the order: steps of the logarithm of their use, 1 and up
        use = np.minimum(1 + np.floor(4 * np.log2(np.array([r["uses"] for r in top], np.float64))), 255).astype(np.uint8)
        by_token = np.argsort(hot)
        self.common = self.spark.sparkContext.broadcast((hot[by_token], use[by_token]))
        self.classes = staged(described.filter("n > 0").groupBy("high", "low").agg(
            F.min("id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("k1", "k2")).alias("text"))
            .withColumn("cid", F.monotonically_increasing_id()), "join-classes")
        # the smallest set that can link with an unequal one: it lacks one token of the other
        self.least = next((n for n in range(1, 101) if 100 * n >= t * (n + 1)), 1 << 62)

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of classes that link, compared on their whole sets."""
        pairs = staged(pairs, "join-pairs")
        wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        wanted = staged(self.classes.join(wanted, "cid", "left_semi").select("cid", "high", "low", "text.k1", "text.k2"), "join-wanted")
        # sets are made again, from one text of each wanted class; texts travel compressed, copies are dropped before
        texts = _sieved(self.texts.select(F.col("k1").alias("token"), "k1", "k2", "text"), wanted.select(F.col("k1").alias("token")))
        packed = texts.select("k1", "k2", "text").mapInArrow(pack_last, "k1 bigint, k2 bigint, packed binary").groupBy("k1", "k2").agg(F.first("packed").alias("packed"))
        found = packed.join(wanted.select("k1", "k2"), ["k1", "k2"], "left_semi").select("packed").mapInArrow(
            _full_sets(self.size), "high bigint, low bigint, tokens binary")
        sets = staged(found.join(wanted, ["high", "low"]).select("cid", "tokens"), "join-tokens")
        a, b = sets.toDF("a", "x"), sets.toDF("b", "y")
        return staged(pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(_compare(self.t), "a bigint, b bigint"), "join-links")

    def near(self) -> tuple[DataFrame, DataFrame]:
        """Families ``(node, component)`` by links of classes with heads of their bands, by rounds, until one adds few; and the first round's pairs of class and head."""
        keys = F.transform(F.sequence(F.lit(0), F.lit(SKETCH // BAND - 1)), lambda k: F.xxhash64(k, F.slice("sketch", k * BAND + 1, F.lit(BAND))))
        bands = self.classes.filter(F.col("n") >= self.least).select("cid", F.explode(keys).alias("key"))
        bands = bands.join(bands.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "key")
        bands = staged(bands, "join-bands")
        sets = staged(self.classes.select("cid", "n", "sketch").join(bands.groupBy("cid").agg(F.sum("met").alias("weight")), "cid"), "join-sketches")
        # the set that meets most others, in later rounds any one
        rows = bands.select("cid", "key").join(sets.select("cid", "n", F.col("weight").alias("rank"), F.col("cid").alias("family")), "cid")
        nearest = staged(self.heads(rows, sets), "join-nearest")
        links = self.verify(self.ordered(nearest))
        families = components(links)
        rng, total = np.random.default_rng(43), links.count()
        for number in range(1, ROUNDS):
            # bands of more and more min-hashes, drawn anew
            drawn = [sorted(int(k) for k in rng.choice(SKETCH, min(2 + 2 * number, SKETCH // 2), replace=False)) for _ in range(SKETCH // BAND)]
            keys = F.array(*[F.xxhash64(F.lit(k), *[F.col("sketch")[i] for i in some]) for k, some in enumerate(drawn)])
            rows = self.of_family(sets, families).select("cid", "n", F.xxhash64("cid", F.lit(number)).alias("rank"), "family", F.explode(keys).alias("key"))
            more = self.verify(self.ordered(self.heads(rows, sets)))
            families, added = extended(families, more), more.count()
            total += added
            if added <= ADDED * total:
                break
        return families, nearest

    @staticmethod
    def of_family(sets: DataFrame, families: DataFrame) -> DataFrame:
        """``sets`` with the ``family`` of each, itself where it has no link."""
        return sets.join(families.toDF("cid", "family"), "cid", "left").withColumn("family", F.coalesce("family", "cid"))

    @staticmethod
    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b")).distinct()

    def heads(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """``(cid, a)``: each class and the head of its bands, of another family and a size that can link, whose sketch agrees most, if it does."""
        head = rows.groupBy("key").agg(F.max(F.struct("rank", "cid", "n", "family")).alias("head"), F.min("family").alias("f0"), F.max("family").alias("f1"))
        met = (rows.join(head.filter("f0 != f1").select("key", "head"), "key")
               .filter(f"family != head.family AND 100 * least(n, head.n) >= {self.t} * greatest(n, head.n)")
               .select("cid", F.col("head.cid").alias("a")).distinct())
        both = met.join(sets.select("cid", "sketch"), "cid").join(sets.select(F.col("cid").alias("a"), F.col("sketch").alias("other")), "a")
        alike = F.size(F.filter(F.arrays_zip("sketch", "other"), lambda z: z["sketch"] == z["other"]))
        best = both.select("cid", "a", alike.alias("alike")).filter(f"alike >= {ALIKE}").groupBy("cid").agg(F.max(F.struct("alike", "a")).alias("m"))
        return best.select("cid", "m.a")

    def ruled(self, asking: DataFrame, others: DataFrame, on: str) -> DataFrame:
        """Pairs ``(cid, other)`` of sets of different families that meet ``on`` and that no bound rules out, and how many tokens they ``differ`` in, at least."""
        t = self.t
        members = others.select(*([on] if on != "other" else []), F.col("cid").alias("other"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"),
                                F.col("family").alias("family_b"), F.col("prefix").alias("prefix_b"), F.col("parity").alias("parity_b"))
        reach = f"size(array_intersect(prefix, prefix_b)) + greatest(rest, rest_b) >= ceil({t} * (n + n_b) / {100 + t})"
        differ = " + ".join(f"bit_count(parity[{k}] ^ parity_b[{k}])" for k in range(PARITY))
        near = f"({differ}) <= (n + n_b) * {100 - t} div {100 + t}"
        return (asking.join(members, on).filter(f"family != family_b AND 100 * least(n, n_b) >= {t} * greatest(n, n_b) AND {near} AND {reach}")
                .select("cid", "other", F.expr(differ).alias("differ")))

    def merged(self, sets: DataFrame, families: DataFrame) -> DataFrame:
        """``families`` after rounds of comparisons with heads of prefix tokens, until one adds few.

        A token's first head is the set whose tokens are shown most, as the least altered one of near copies does; then it is any one.
        """
        total = 0
        for number in range(ROUNDS):
            named = self.of_family(sets, families)
            shown = named.select("cid", "family", (F.xxhash64("cid", F.lit(number)) if number else F.col("weight")).alias("rank"), F.explode("prefix").alias("token"))
            head = shown.groupBy("token").agg(F.max(F.struct("rank", "cid", "family")).alias("head"), F.min("family").alias("f0"), F.max("family").alias("f1"))
            met = (shown.join(head.filter("f0 != f1").select("token", "head"), "token").filter("family != head.family")
                   .select("cid", F.col("head.cid").alias("other")).distinct())
            best = (self.ruled(met.join(named, "cid"), named, "other").groupBy("cid")
                    .agg(F.min(F.struct("differ", "other")).alias("m")).select("cid", F.col("m.other").alias("a")))
            more = self.verify(self.ordered(best))
            added = more.count()
            if added:
                families = extended(families, more)
            total += added
            if added <= ADDED * total:
                break
        return families

    def opened(self, families: DataFrame, nearest: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Families after further merging, and the pairs of classes of different ones that the matrix does not rule out."""
        t = self.t
        made = self.texts.select("text").mapInArrow(
            _prefixes(self.size, t, self.common, self.least), "high bigint, low bigint, n bigint, prefix array<bigint>, needed bigint, parity array<bigint>")
        made = made.groupBy("high", "low").agg(F.first("prefix").alias("prefix"), F.first("needed").alias("needed"), F.first("parity").alias("parity"))
        band = F.xxhash64(F.slice("sketch", 1, BAND)).alias("band")
        shown = staged(self.of_family(made.join(self.classes.select("high", "low", "cid", "n", band), ["high", "low"]), families).drop("high", "low"), "join-shown")
        # only tokens of several families tell sets of different families apart
        tokens = shown.select("cid", "family", F.explode("prefix").alias("token"))
        several = staged(tokens.groupBy("token").agg(F.min("family").alias("f0"), F.max("family").alias("f1"), F.count(F.lit(1)).alias("sets"))
                         .filter("f0 != f1").select("token", "sets"), "join-several")
        shared = (_sieved(tokens.select("cid", "token"), several).join(several, "token")
                  .groupBy("cid").agg(F.count(F.lit(1)).alias("shared"), F.sum("sets").alias("weight")))
        sets = (shown.join(shared, "cid").filter("shared >= needed").withColumn("prefix", F.expr(f"slice(prefix, 1, cast(n - ({t} * n + 99) div 100 + 1 as int))"))
                .withColumn("rest", F.col("n") - F.size("prefix")).drop("shared", "needed", "family"))
        # groups: sets of one family, else of heads of one, else of one band, whose sizes differ by a twentieth at most, about GROUP_SETS of them
        sets = staged(sets.withColumn("step", F.floor(F.log("n") / float(np.log(1.05)))), "join-prefixes")
        families = self.merged(sets, families)
        sets = self.of_family(sets, families)
        several_sets = sets.groupBy("family").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("family", F.lit(1).alias("home"))
        beside = nearest.join(families.select(F.col("node").alias("a"), "component"), "a", "left").select("cid", F.coalesce("component", "a").alias("beside"))
        sets = sets.join(several_sets, "family", "left").join(beside, "cid", "left").withColumn("home", F.when(
            F.col("home") == 1, F.xxhash64(F.lit("family"), "family")).when(F.col("beside").isNotNull(), F.xxhash64(F.lit("beside"), "beside")).otherwise(F.col("band")))
        parts = sets.groupBy("home", "step").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).alias("parts")).filter("parts > 1")
        grouped = staged(sets.join(parts, ["home", "step"], "left").withColumn(
            "gid", F.xxhash64("home", "step", F.pmod(F.xxhash64("cid"), F.coalesce("parts", F.lit(1))))).drop("band", "home", "beside", "step", "parts", "weight"), "join-groups")
        bounds = grouped.groupBy("gid").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max("rest").alias("rest_max"),
                                            F.min("family").alias("f_min"), F.max("family").alias("f_max"))
        matrix = grouped.select("gid", F.explode("prefix").alias("token")).distinct()
        asked = grouped.select("cid", "n", "rest", "family", F.explode("prefix").alias("token"))
        matrix = matrix.join(several, "token", "left_semi").join(bounds, "gid")
        met = (asked.join(several, "token", "left_semi").join(matrix, "token")
               .filter(f"NOT (family = f_min AND family = f_max) AND 100 * n_max >= {t} * n AND 100 * n >= {t} * n_min")
               .groupBy("cid", "gid").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n"), F.first("rest").alias("rest"),
                                          F.first("n_min").alias("n_min"), F.first("rest_max").alias("rest_max")))
        # |A and B| >= t (|A| + |B|) / (100 + t), with the smallest |B| that can link
        needed = F.ceil(F.lit(t) * (F.col("n") + F.greatest(F.col("n_min"), F.ceil(F.col("n") * t / 100))) / (100 + t))
        open_groups = staged(met.filter(F.col("shared") + F.greatest("rest", "rest_max") >= needed).select("cid", "gid"), "join-open")
        # the same bound for each member, from the prefixes that the two share
        asking = open_groups.join(grouped.select("cid", "n", "rest", "family", "prefix", "parity"), "cid")
        return families, self.ordered(self.ruled(asking, grouped, "gid").select("cid", F.col("other").alias("a")))


def join(docs: DataFrame, size: int = 5, t: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs``."""
    j = _Join(docs, size, t, text, id_col)
    families, pairs = j.opened(*j.near())
    names = extended(families, j.verify(pairs)).withColumnRenamed("node", "cid")
    whole = j.classes.select("cid", "high", "low", "least").join(names, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = whole.join(smallest, "component").select("high", "low", "component_id")
    out = j.rows.filter("n > 0").join(named, ["high", "low"], "left").select("id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(j.rows.filter("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, t: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of linked rows: that with the smallest id (null last), then any one; rows without words all stay."""
    row, name = fresh(docs, "row", "the row")
    kept = named(docs, row, "join-docs")
    groups = join(kept, size, t, text, row).select(F.col("id").alias(name), "component_id")
    best = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row)).alias("s")).alias("best")
    stay = (kept.select(id_col, row).join(groups, F.col(row) == F.col(name)).groupBy("component_id").agg(best)
            .select(F.col(f"best.{row}").alias(name)))
    return kept.join(stay, F.col(row) == F.col(name), "left_semi").select(*docs.columns)
