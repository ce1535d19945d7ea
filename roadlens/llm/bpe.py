"""Byte-level BPE encoding by speculation and verification, and decoding.

A text is split by the vocabulary's word pattern (its special tokens first).
Each distinct word is proposed a segmentation by greedy longest match over the
vocabulary. BPE produces a segmentation exactly if BPE leaves every adjacent
pair of its tokens as it is, so the proposals are verified by a vectorised
test over all distinct adjacent pairs of a batch: the merges that formed two
neighbours are undone step by step along their common edge, and a pair fails
when a merge across the edge would have come first. Only words with a failing
pair go through exact merging, by rank with a heap (n log n, so very long
words are no trouble).

Words repeat, so each task keeps the ids of the words it has met, up to
``CACHE_WORDS`` of them; then those that are not in use go. The vocabulary (a file of some
50,000 entries, at ``path``) is read once on the driver and broadcast; its size
does not depend on the data.

Defined results: a null text is encoded as an empty one, to no ids, and
decodes to an empty text; decoding replaces bytes that are not UTF-8 by U+FFFD;
ids outside the vocabulary are an error; further columns pass through,
but for those named like the two new ones, which are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE_WORDS = 200_000
BATCH_CHARS = 1_000_000  # characters handled at a time
SHORT = 64  # bytes up to which failing words of one length are merged together

# The word pattern of byte-level BPE, and the byte alphabet's printable bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file, to the byte."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def latin_pattern() -> str:
    """``PATTERN`` with its classes written out for texts of code points below 256, which the standard library splits faster."""
    chars = [chr(c) for c in range(256)]
    letter, number, space = ("".join(f"\\x{ord(c):02x}" for c in chars if regex.match(p, c)) for p in (r"\p{L}", r"\p{N}", r"\s"))
    return f"'(?:[stmd]|re|ve|ll)| ?[{letter}]++| ?[{number}]++| ?[^{space}{letter}{number}]++|[{space}]+(?![^{space}])|[{space}]+"


class Vocabulary:
    """Tokens as bytes, merge ranks and the pair test's tables; independent of any Spark object."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = raw(token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.size = size
        # rank of the merge that forms a token, -1 for single bytes; its two halves (itself for bytes)
        self.rank = np.full(size, -1, np.int64)
        self.first, self.second = np.arange(size), np.arange(size)
        for table, value in ((self.rank, np.arange(len(merges))), (self.first, left), (self.second, right)):
            table[made[::-1]] = value[::-1]  # the earliest merge counts
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.made = keys[order], order, made
        self.merges = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, made, strict=True))}
        self.by_bytes = {b: i for i, b in enumerate(self.token_bytes) if b and i not in self.special.values()}
        self.byte_ids = [self.by_bytes[bytes([b])] for b in range(256)]
        # the vocabulary as a trie: child of (node, byte) by binary search, and the token that ends at a node
        nodes: dict[bytes, int] = {b"": 0}
        for token in self.by_bytes:
            for end in range(1, len(token) + 1):
                nodes.setdefault(token[:end], len(nodes))
        edges = np.array([nodes[t[:-1]] * 256 + t[-1] for t in nodes if t], np.int64)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], order + 1
        self.ends = np.array([self.by_bytes.get(t, -1) for t in nodes], np.int64)

    def across(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or a rank beyond all where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.pair_keys))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the neighbours ``a[i]``, ``b[i]`` as they are.

        Going back in time: of the two tokens at the edge, the one formed last is
        undone first. At each state, a merge across the edge that ranks before the
        step that ends the state would have been taken instead. Equal ranks
        (the same token twice) go to the left one, which merges first.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        until = np.full(len(a), len(self.pair_keys), np.int64)  # rank of the step that ends this state
        strict = np.ones(len(a), bool)  # whether a merge across of that same rank comes later
        while len(live):
            r = self.across(x, y)
            bad = (r < until) | ((r == until) & ~strict & (r < len(self.pair_keys)))
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_x, done = rx > ry, (rx < 0) & (ry < 0)
            until = np.where(undo_x, rx, ry)
            # the left token is formed before a merge across of equal rank, the right one after
            strict = undo_x
            x, y = np.where(undo_x, self.second[x], x), np.where(undo_x, y, self.first[y])
            on = ~(bad | done)
            live, x, y, until, strict = live[on], x[on], y[on], until[on], strict[on]
        return good

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest vocabulary entry first, from the left, all words in step: token ids and the word each belongs to."""
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        word = np.flatnonzero(np.diff(stop, prepend=0))
        stop = stop[word]
        at = np.concatenate(([0], stop[:-1])) if len(stop) else stop
        node, best, best_end = np.zeros_like(at), np.full_like(at, -1), at.copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            keys = node * 256 + text[at]
            edge = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            on = (self.edges[edge] == keys) & (at < stop)
            node = np.where(on, self.children[edge], 0)
            at = at + on
            ends = np.where(on, self.ends[node], -1)
            best, best_end = np.where(ends >= 0, ends, best), np.where(ends >= 0, at, best_end)
            off = ~on
            if off.any():
                found.append((word[off], best[off]))
                at = np.where(off, best_end, at)
                best = np.where(off, -1, best)
                going = on | (at < stop)
                word, stop, at, node, best, best_end = (x[going] for x in (word, stop, at, node, best, best_end))
        owner, ids = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE: the lowest rank first, the leftmost of equal ones."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
        heap = [(r, i, m, p) for r, m, i, p in heap]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, m, p = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or (ids[i], ids[j]) != p:
                continue  # one of the two has been merged meanwhile
            ids[i], alive[j], after[i] = m, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for s, e in ((before[i], i), (i, after[i])):
                if s >= 0 and e < n and (q := (ids[s], ids[e])) in self.merges:
                    heapq.heappush(heap, (self.merges[q][0], s, self.merges[q][1], q))
        return [x for x, on in zip(ids, alive, strict=True) if on]

    def merge_equal(self, words: list[bytes]) -> list[list[int]]:
        """Exact BPE of words of equal length at once: each round merges the best pair of every word that has one."""
        none = len(self.made)
        out: list[list[int]] = [[]] * len(words)
        row = np.arange(len(words))
        ids = np.array(self.byte_ids)[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), -1)
        ranks = self.across(ids[:, :-1], ids[:, 1:])
        while True:
            n = ids.shape[1]
            best = ranks.argmin(1) if n > 1 else np.zeros(len(row), np.int64)  # the leftmost of equal ones
            rank = ranks[np.arange(len(row)), best] if n > 1 else np.full(len(row), none)
            for k in np.flatnonzero(rank == none).tolist():
                out[row[k]] = ids[k].tolist()
            on = rank < none
            if not on.any():
                return out
            row, ids, ranks, best, rank = row[on], ids[on], ranks[on], best[on, None], rank[on]
            at = np.arange(len(row))
            np.put_along_axis(ids, best, self.made[rank][:, None], 1)
            places = np.arange(n - 1)
            ids = np.take_along_axis(ids, places + (places > best), 1)
            ranks = np.take_along_axis(ranks, places[:-1] + (places[:-1] >= best), 1)
            best = best[:, 0]
            for p, ok in ((best - 1, best > 0), (best, best < n - 2)):
                ranks[at[ok], p[ok]] = self.across(ids[at[ok], p[ok]], ids[at[ok], p[ok] + 1])

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words needed exact merging."""
        flat, owner = self.greedy(words)
        cuts = np.searchsorted(owner, np.arange(len(words) + 1))
        values = flat.tolist()
        ids = [values[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        inner = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.zeros(0, np.int64)
        pairs, where = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.unique(owner[inner[~good[where]]])
        by_length: dict[int, list[int]] = {}
        for k in failing.tolist():
            by_length.setdefault(len(words[k]), []).append(k)
        for n, group in by_length.items():
            exact = self.merge_equal([words[k] for k in group]) if n <= SHORT else map(self.merge, (words[k] for k in group))
            for k, found in zip(group, exact, strict=True):
                ids[k] = found
        return ids, len(failing)


class Encoder:
    """Encodes texts with a bounded memory of words already met."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.v, self.cache, self.cache_words = vocabulary, {}, cache_words
        self.any_words, self.latin_words = regex.compile(PATTERN).findall, re.compile(latin_pattern()).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")").split if vocabulary.special else None
        self.met = self.exact = 0

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_words(text)
        return self.latin_words(text)

    def _pieces(self, text: str) -> list[str]:
        if self.split is None or not any(s in text for s in self.v.special):
            return self.words(text)
        out = []
        for k, part in enumerate(self.split(text)):
            out += ["\0special" + part] if k % 2 else self.words(part)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        pieces = [self._pieces(t) for t in texts]
        wanted = set().union(*pieces)
        if len(self.cache) > self.cache_words:  # only words that are in use stay
            self.cache = {w: self.cache[w] for w in wanted if w in self.cache}
        new = sorted(wanted.difference(self.cache))
        special = [w for w in new if w.startswith("\0special")]
        new = [w for w in new if not w.startswith("\0special")]
        ids, exact = self.v.encode_words([w.encode("utf-8", "surrogatepass") for w in new])
        self.met, self.exact = self.met + len(new), self.exact + exact
        self.cache.update(zip(new, ids, strict=True))
        self.cache.update((w, [self.v.special[w.removeprefix("\0special")]]) for w in special)
        get = self.cache.__getitem__
        return [list(chain.from_iterable(map(get, p))) for p in pieces]

    def decode(self, ids: list[list[int]]) -> list[str]:
        get = self.v.token_bytes.__getitem__
        return [b"".join(map(get, row)).decode("utf-8", "replace") for row in ids]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, shared) -> Encoder:
    """The worker's encoder; words met in one task serve the next one."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(shared.value)
    return _ENCODERS[path]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for k, t in enumerate(texts):
        chars += len(t)
        if chars >= BATCH_CHARS:
            yield start, k + 1
            start, chars = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the token ids of ``text`` and the text that these ids decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    schema = T.StructType([*[f for f in docs.schema.fields if f.name.lower() not in (ids_col.lower(), decoded_col.lower())],
                           T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared)
        for batch in batches:
            batch = batch.select([f.name for f in schema.fields[:-2]])
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            for start, end in _blocks(texts):
                ids = encoder.encode(texts[start:end])
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns, column, pa.array(encoder.decode(ids), pa.string())],
                                                 names=[*part.schema.names, ids_col, decoded_col])

    return docs.mapInArrow(run, schema)
