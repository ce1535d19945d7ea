"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies by a score-ordered agenda.

A text is a sequence of symbols, one a character at first (spaces are the
vocabulary's space symbol, and one is put before the text). The agenda holds all
adjacent pairs of symbols whose union is a piece; the pair with the highest score, the leftmost
of equal ones, is merged, and the pairs with its neighbours enter the agenda,
until it is empty. Characters without a piece become their bytes.

Merges never cross the places where no piece can reach: if no piece has a
space after another character, a text falls apart before each run of spaces,
and also at the ASCII characters that no piece contains. The parts (words, with the
spaces before them) are merged alone. Each distinct one is merged once: the
agendas of all new words of one length are kept as rows of a table and advance
together, a merge each a round; long words have a heap each (n log n).

The words that a worker meets for the first time in an Arrow batch are also
encoded by the sentencepiece library. Its ids are taken where the two differ, and the number of
such words is counted per text (none is known). Words repeat, so a worker keeps the ids of those it has met, up to
``CACHE_WORDS``; then those not in use go. The vocabulary is read on the driver and broadcast; its size does not depend on the data.

Defined results: a null text is encoded as an empty one, to no ids, and decodes
to an empty text; the space symbol itself in a text decodes to a space, as in the library; bytes that are not UTF-8
decode to U+FFFD each; ids outside the vocabulary are an error; further columns pass
through, but for those named like the new ones, which are replaced. Vocabularies with
another model type, normalisation rules, user-defined pieces or without byte pieces are refused.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE_WORDS = 200_000
BATCH_CHARS = 1_000_000  # characters handled at a time
SHORT = 48  # characters up to which words of one length are merged together

SPACE = "▁"  # the vocabulary's space symbol
# Fixed values of the model file: kinds of pieces, the number of the merge model type, the text of an unknown id.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_MODEL = 2
UNKNOWN_TEXT = " ⁇ "
NO_RANK = np.int32(2 ** 31 - 1)

codecs.register_error("one byte a time", lambda e: ("�", e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a message's fields (protocol buffer wire format)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 2: None, 5: 4}[key & 7]
        n = varint() if n is None else n
        yield key >> 3, data[at:at + n]
        at += n


class Vocabulary:
    """Pieces, the table of pairs that merge, and where texts fall apart; independent of any Spark object."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = f.read()
        self.pieces, scores, kinds = [], [], []
        trainer: dict = {}
        rules: dict = {}
        for number, value in _fields(self.model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if trainer.get(3, 1) != MERGE_MODEL or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("not a merge-type vocabulary with byte pieces and spaces before words")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("vocabularies with normalisation rules or user-defined pieces are not supported")
        self.lead = " " if rules.get(3, 1) else ""
        self.kinds = np.array(kinds)
        normal = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes: list[bytes] = []
        for i, (p, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
            self.bytes.append({NORMAL: p.replace(SPACE, " ").encode(), UNKNOWN: UNKNOWN_TEXT.encode(), CONTROL: b"",
                               BYTE: bytes([int(p[3:5], 16)]) if kind == BYTE else b""}[kind])
        # symbols: the pieces, then characters of pieces that are none themselves
        loose = sorted({ch for p in normal for ch in p}.difference(normal))
        symbols = normal | {ch: len(self.pieces) + k for k, ch in enumerate(loose)}
        self.loose, self.size = loose, len(self.pieces) + len(loose)
        self.symbol_of = -2 - np.arange(0x110000, dtype=np.int32)  # a character without a symbol keeps its code point
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        # pieces of equal score have one rank; index -1 (no piece) has the last one
        order = np.unique(-np.array(scores, np.float32), return_inverse=True)[1]
        self.rank_of = np.append(order.astype(np.int32), NO_RANK)
        pairs = {symbols[p[:k]] * self.size + symbols[p[k:]]: i
                 for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        self._fill(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.pair = pairs
        together = any(a != SPACE and b == SPACE for p in normal for a, b in zip(p, p[1:], strict=False))
        used = {ch for p in normal for ch in p}
        alone = "".join(f"\\x{c:02x}" for c in range(128) if chr(c) not in used and c != 32)
        self.words = (lambda t: [t] if t else []) if together else re.compile(f" *[^ {alone}]+| +|[{alone}]" if alone else " *[^ ]+| +").findall

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open hash table of the pairs."""
        self.bits = int(4 * len(keys) + 16).bit_length()
        self.slot_keys, self.slot_values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_keys[at] < 0)
            free = free[np.unique(at[free], return_index=True)[1]]
            self.slot_keys[at[free]], self.slot_values[at[free]] = keys[free], values[free]
            on = np.ones(len(keys), bool)
            on[free] = False
            keys, values, at = keys[on], values[on], (at[on] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def union(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols forms, -1 where there is none."""
        keys = np.where((a < 0) | (b < 0), -2, a.astype(np.int64) * self.size + b).reshape(-1)
        at = self._slot(keys)
        held = self.slot_keys[at]
        flat = np.where(held == keys, self.slot_values[at], np.int32(-1))
        on = np.flatnonzero((held != keys) & (held >= 0) & (keys >= 0))
        at = at[on]
        while len(on):
            at = (at + 1) & ((1 << self.bits) - 1)
            held = self.slot_keys[at]
            hit = held == keys[on]
            flat[on[hit]] = self.slot_values[at[hit]]
            go = ~hit & (held >= 0)
            on, at = on[go], at[go]
        return flat.reshape(a.shape)

    def finish(self, symbols: list[int]) -> list[int]:
        """Ids of symbols: those without a piece become the bytes of their character."""
        if min(symbols) >= 0 and max(symbols) < len(self.pieces):
            return symbols
        out: list[int] = []
        for x in symbols:
            if 0 <= x < len(self.pieces):
                out.append(x)
            else:
                out += self.byte_ids[list((chr(-2 - x) if x < 0 else self.loose[x - len(self.pieces)]).encode())].tolist()
        return out

    def merge_equal(self, symbols: np.ndarray) -> list[bytes]:
        """Ids (as 32-bit numbers in a row) of words of equal length, their agendas a row each."""
        out = [b""] * len(symbols)
        row = np.arange(len(symbols))
        rank = self.rank_of[self.union(symbols[:, :-1], symbols[:, 1:])]
        while True:
            n = symbols.shape[1]
            at = np.arange(len(row))
            if n > 1:
                best = rank.argmin(1)  # the leftmost of equal ones
                on = rank[at, best] < NO_RANK
            else:
                on = np.zeros(len(row), bool)
            if not on.all():
                done = symbols[~on]
                plain = ((done >= 0) & (done < len(self.pieces))).all(1)
                raw, size = done.tobytes(), 4 * n
                for i, (k, ok) in enumerate(zip(row[~on].tolist(), plain.tolist(), strict=True)):
                    out[k] = raw[i * size:(i + 1) * size] if ok else np.array(self.finish(done[i].tolist()), np.int32).tobytes()
                if not on.any():
                    return out
                row, symbols, rank, best = row[on], symbols[on], rank[on], best[on]
                at = np.arange(len(row))
            # the right one of the two goes, with the pair that it was the left one of
            symbols[at, best] = self.union(symbols[at, best], symbols[at, best + 1])
            stay = np.ones(symbols.shape, bool)
            stay[at, best + 1] = False
            symbols = symbols[stay].reshape(len(row), n - 1)
            stay = stay[:, 1:]
            rank = rank[stay].reshape(len(row), n - 2)
            for p, ok in ((best - 1, best > 0), (best, best < n - 2)):
                r, p = at[ok], p[ok]
                rank[r, p] = self.rank_of[self.union(symbols[r, p], symbols[r, p + 1])]

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of one word, its agenda a heap."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def enter(i: int, j: int) -> None:
            piece = self.pair.get(symbols[i] * self.size + symbols[j]) if symbols[i] >= 0 and symbols[j] >= 0 else None
            if piece is not None:
                heapq.heappush(agenda, (int(self.rank_of[piece]), i, symbols[i], symbols[j], piece))

        for i in range(n - 1):
            enter(i, i + 1)
        alive = [True] * n
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], alive[j], after[i] = piece, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                enter(i, after[i])
            if before[i] >= 0:
                enter(before[i], i)
        return self.finish([x for x, on in zip(symbols, alive, strict=True) if on])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (as 32-bit numbers in a row)."""
        out = [b""] * len(words)
        if not words:
            return out
        flat = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")
        lengths, first = np.unique(size[order], return_index=True)
        for n, group in zip(lengths.tolist(), np.split(order, first[1:]), strict=True):
            if 0 < n <= SHORT:
                found = self.merge_equal(flat[begin[group][:, None] + np.arange(n)])
            else:
                found = [np.array(self.merge(flat[b:b + n].tolist()) if n else [], np.int32).tobytes() for b in begin[group].tolist()]
            for k, ids in zip(group.tolist(), found, strict=True):
                out[k] = ids
        return out


class Encoder:
    """Encodes texts with a bounded memory of words already met."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS, check: bool = True):
        self.v, self.cache_words = vocabulary, cache_words
        self.cache: dict[str, bytes] = {}
        self.differing: set[str] = set()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model) if check else None

    def _checked(self, words: list[str], found: list[bytes]) -> list[bytes]:
        """The ids of new words held against the library's, which puts a space before each (so one goes first)."""
        asked = [k for k, w in enumerate(words) if w[:1] == " " and len(w) > 1]
        theirs = self.library.encode([words[k][1:] for k in asked], num_threads=1)
        for k, ids in zip(asked, theirs, strict=True):
            ids = np.array(ids, np.int32).tobytes()
            if ids != found[k]:
                found[k] = ids
                self.differing.add(words[k])
        return found

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """Per text its ids (as 32-bit numbers in a row), and how many of its words the library segments in another way."""
        parts = [self.v.words((self.v.lead + t).replace(SPACE, " ")) if t else [] for t in texts]
        wanted = set().union(*parts)
        if len(self.cache) > self.cache_words:  # only words that are in use stay
            self.cache = {w: self.cache[w] for w in wanted if w in self.cache}
            self.differing &= set(self.cache)
        new = list(wanted.difference(self.cache))
        found = self.v.encode_words(new)
        self.cache.update(zip(new, self._checked(new, found) if self.library and self.v.lead else found, strict=True))
        get = self.cache.__getitem__
        differ = [sum(w in self.differing for w in p) for p in parts] if self.differing else [0] * len(texts)
        return [b"".join(map(get, p)) for p in parts], differ

    def decode(self, ids: list[int]) -> str:
        """The text of token ids; the space put before a text goes."""
        data = b"".join(map(self.v.bytes.__getitem__, ids))
        first = next((i for i in ids if self.v.kinds[i] != CONTROL), None)
        if self.v.lead and first is not None and self.v.kinds[first] == NORMAL and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "one byte a time")


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, check: bool, shared) -> Encoder:
    """The worker's encoder; words met in one task serve the next one."""
    if (path, check) not in _ENCODERS:
        _ENCODERS[path, check] = Encoder(shared.value, check=check)
    return _ENCODERS[path, check]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for k, t in enumerate(texts):
        chars += len(t)
        if chars >= BATCH_CHARS:
            yield start, k + 1
            start, chars = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids_col: str = "ids", decoded_col: str = "decoded",
                  differing_col: str = "differing", check: bool = True) -> DataFrame:
    """``docs`` with the token ids of ``text``, the text that they decode to, and the words that the library segments in another way."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType()), T.StructField(differing_col, T.IntegerType())]
    taken = {f.name.lower() for f in new}
    schema = T.StructType([*[f for f in docs.schema.fields if f.name.lower() not in taken], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, check, shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            batch = batch.select([f.name for f in schema.fields[:-3]])
            for start, end in _blocks(texts):
                rows, differ = encoder.encode(texts[start:end])
                offsets = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
                flat = np.frombuffer(b"".join(rows), np.int32)
                every, cut = flat.tolist(), offsets.tolist()
                decoded = [encoder.decode(every[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, end - start).columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(decoded, pa.string()), pa.array(differ, pa.int32())], names=schema.names)

    return docs.mapInArrow(run, schema)
