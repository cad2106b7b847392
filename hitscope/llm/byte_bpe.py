"""Byte-level BPE encoding and decoding (operator 2).

Pre-tokenisation uses no regular expression. Each code point gets a symbol (letter, number,
space, ... from a class table and a look at the next one or two code points); a symbol is a
function from the state before it to the state after it. These functions form a small monoid,
so a table-driven prefix scan (blocks scanned side by side, then the block totals) gives the
state before every code point of a whole slice at once, and with it every boundary.

The slices between the boundaries are merged once per distinct slice: the ones a worker has
not seen lately go through a vectorised pair merge, many slices per step. ``encode`` keeps the
byte offset at which each id starts, so a range of ids can be mapped back to its text.

Defined results: null text counts as empty; empty text gives no ids; rows are independent, so
repeated rows and ties need no rule; an empty table gives an empty table; a text of any length is encoded
whole, in memory in proportion to the longest text of a slice; other input columns
are dropped unless named in ``keep``, so clashing names cannot arise.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from hitscope.llm.textio import binary_array, slices, string_bytes

# Code points that the pattern's \s stands for.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Contraction endings that form a slice of their own after an apostrophe.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")
# Letters and numbers of Unicode 16 that Python 3.13's tables (15.1) lack, as first and last code points.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

OTHER, LETTER, NUMBER, SPACE, BLANK, APOSTROPHE = range(6)
# Symbols: what a code point does to the state.
RESET, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_BLANK, S_MORE, S_SHORT, S_LONG = range(9)
# States: what the code points so far have left open.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_TO_GO, TWO_TO_GO = range(8)
SEPARATOR = "\ud800"  # never part of a valid text
CACHED_SLICES = 200_000
#: Bytes of text that a worker encodes at once.
SLICE_BYTES = 1 << 20
VECTOR_BYTES = 64


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a slice starts at this symbol."""
    if symbol == RESET:
        return FRESH, True
    if symbol in (S_LETTER, S_NUMBER, S_OTHER):
        if state == TWO_TO_GO:
            return ONE_TO_GO, False
        if state == ONE_TO_GO:
            return FRESH, False
        own = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}[symbol]
        return own, state not in (own, AFTER_SPACE)
    if symbol in (S_SHORT, S_LONG):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return (ONE_TO_GO if symbol == S_SHORT else TWO_TO_GO), True
    if symbol == S_MORE:
        return IN_BLANKS, state != IN_BLANKS
    return (AFTER_SPACE if symbol == S_SPACE else FRESH), True


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Element of each symbol, composition table, image of each state, starts by (state, symbol), identity."""
    base = [tuple(_step(s, c)[0] for s in range(8)) for c in range(9)]
    elements = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    for f in queue:
        for g in base:
            h = tuple(g[s] for s in f)
            if h not in elements:
                elements[h] = len(elements)
                queue.append(h)
    n = len(queue)
    if n > 255:
        raise AssertionError("the monoid must fit a byte")
    images = np.array(queue, np.uint8)
    compose = np.array([[elements[tuple(g[s] for s in f)] for g in queue] for f in queue], np.uint8)
    starts = np.array([[_step(s, c)[1] for c in range(9)] for s in range(8)], bool)
    return np.array([elements[g] for g in base], np.uint8), compose, images, starts, 0


def _compose(compose: np.ndarray, f: np.ndarray, g: np.ndarray) -> np.ndarray:
    return compose.ravel().take(f.astype(np.int32) * len(compose) + g)


def _states_before(elements: np.ndarray, width: int = 64) -> np.ndarray:
    """State before each position when the first state is FRESH: an exclusive prefix scan."""
    _, compose, images, _, identity = _monoid()
    n = len(elements)
    if n <= width:
        out, state = np.empty(n, np.uint8), FRESH
        for i in range(n):
            out[i] = state
            state = images[elements[i], state]
        return out
    rows = -(-n // width)
    grid = np.full(rows * width, identity, np.uint8)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = _compose(compose, grid[j - 1], grid[j])
    entry = _states_before(grid[-1], width)
    out = np.empty((width, rows), np.uint8)
    out[0] = entry
    for j in range(1, width):
        out[j] = images.ravel().take(grid[j - 1].astype(np.int32) * 8 + entry)
    return np.ascontiguousarray(out.T).ravel()[:n]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    for ranges, kind in ((NEWER_LETTERS, LETTER), (NEWER_NUMBERS, NUMBER)):
        for low, high in ranges:
            table[low : high + 1] = kind
    table[WHITE_SPACE] = BLANK
    table[0x20] = SPACE
    table[0x27] = APOSTROPHE
    return table


def slice_starts(points: np.ndarray) -> np.ndarray:
    """Whether a slice of the pattern starts at each code point; texts are set apart by SEPARATOR."""
    n = len(points)
    end = ord(SEPARATOR)
    classes = _classes()[points]
    follow = np.full(n + 2, end, points.dtype)
    follow[:n] = points
    symbol = np.array([S_OTHER, S_LETTER, S_NUMBER, S_SPACE, S_BLANK, S_OTHER], np.uint8)[classes]
    blank = (classes == SPACE) | (classes == BLANK)
    at_end = np.ones(n, bool)
    at_end[:-1] = blank[1:] | (points[1:] == end)
    symbol[blank & at_end] = S_MORE
    for i in np.flatnonzero(classes == APOSTROPHE) if n else ():
        one, two = chr(follow[i + 1]), chr(follow[i + 2])
        if one in SHORT_ENDINGS:
            symbol[i] = S_SHORT
        elif one + two in LONG_ENDINGS:
            symbol[i] = S_LONG
    symbol[points == end] = RESET
    elements, _, _, starts, _ = _monoid()
    before = _states_before(elements[symbol])
    return starts.ravel().take(before.astype(np.int32) * 9 + symbol)


class Vocabulary:
    """Ranks of a tiktoken file with what vectorised merging and decoding need."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = size
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    merged.append(rank)
        self._index_pairs(np.array(keys, np.int64), np.array(merged, np.int32))
        left, right = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_pairs = self.pair(left, right).reshape(256, 256)
        self._forget()

    def _index_pairs(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """An open-addressing table of the pairs: key and merged id by slot."""
        self.slot_bits = max(8, int(len(keys)).bit_length() + 2)
        self.slot_keys = np.full(1 << self.slot_bits, -1, np.int64)
        self.slot_ids = np.full(1 << self.slot_bits, self.size, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.slot_keys[slot] < 0
            self.slot_keys[slot[free]] = keys[free]  # of several for one slot the last stays
            put = self.slot_keys[slot] == keys
            self.slot_ids[slot[put]] = ids[put]
            keys, ids, slot = keys[~put], ids[~put], (slot[~put] + 1) & (len(self.slot_keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def _forget(self) -> None:
        """Start the cache anew with the slices that are tokens themselves."""
        self.cache: dict[bytes, int] = dict(self.ranks)
        self.known_ids = np.arange(self.size, dtype=np.int32)
        self.known_sizes = np.ones(self.size, np.int32)
        self.known_begin = np.arange(self.size, dtype=np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, ``size`` where the two do not merge."""
        key = left.astype(np.int64) * self.size + right
        slot = self._slot(key)
        out = np.full(len(key), self.size, np.int32)
        rest = np.arange(len(key))
        while len(rest):
            there = self.slot_keys[slot]
            hit = there == key
            out[rest[hit]] = self.slot_ids[slot[hit]]
            go = ~hit & (there >= 0)
            rest, key, slot = rest[go], key[go], (slot[go] + 1) & (len(self.slot_keys) - 1)
        return out

    def _merge_many(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number per slice. Lowest rank first, leftmost on ties: one merge per slice and step."""
        count, width = len(parts), max(map(len, parts))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(count, width)
        ids = self.byte_ids[raw]
        left = np.fromiter(map(len, parts), np.int32, count)
        column = np.arange(width, dtype=np.int32)
        ranks = self.byte_pairs[raw[:, :-1], raw[:, 1:]]
        ranks[column[None, :-1] >= left[:, None] - 1] = self.size
        out = ids.copy()
        rows = np.arange(count)
        while len(rows) and ranks.shape[1]:
            best = ranks.argmin(1)
            lowest = ranks[np.arange(len(rows)), best]
            live = lowest < self.size
            if not live.all():
                out[rows[~live], : ids.shape[1]] = ids[~live]
                rows, ids, ranks, best, lowest = rows[live], ids[live], ranks[live], best[live], lowest[live]
            if not len(rows):
                break
            k = np.arange(len(rows))
            after = column[None, : ranks.shape[1]] > best[:, None]
            now = left[rows] - 1
            left[rows] = now
            keep = max(int(now.max()), 1)
            merged = np.where(after, ids[:, 1:], ids[:, :-1])
            merged[k, best] = lowest
            moved = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ids, ranks = merged[:, :keep], moved[:, : keep - 1]
            for spot in (best - 1, best):
                use = np.flatnonzero((spot >= 0) & (spot < now - 1))
                at = spot[use]
                ranks[use, at] = self.pair(ids[use, at], ids[use, at + 1])
            past = np.flatnonzero((best >= now - 1) & (best < ranks.shape[1]))
            ranks[past, best[past]] = self.size
        out[rows, : ids.shape[1]] = ids
        return out[column[None, :] < left[:, None]], left

    def _merge_long(self, part: bytes) -> np.ndarray:
        """One long slice with a heap of pairs: n log n steps."""
        ids = [self.ranks[bytes([b])] for b in part]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, size = [True] * n, self.size
        known = self._known_pairs()
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := known.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = rank, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for p in (before[i], i):
                if p >= 0 and after[p] < n and (r := known.get(ids[p] * size + ids[after[p]])) is not None:
                    heapq.heappush(heap, (r, p, ids[p], ids[after[p]]))
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], np.int32)

    def _known_pairs(self) -> dict[int, int]:
        if not hasattr(self, "_pairs"):
            used = self.slot_keys >= 0
            self._pairs = dict(zip(self.slot_keys[used].tolist(), self.slot_ids[used].tolist(), strict=True))
        return self._pairs

    def merged(self, parts: list[bytes]) -> np.ndarray:
        """Place of each distinct slice in the ``known_`` arrays, which the cache extends with the new ones."""
        if len(self.known_sizes) + len(parts) > CACHED_SLICES + self.size:
            self._forget()
        get = self.cache.get
        found = [get(p, -1) for p in parts]
        places = np.array(found, np.int64)
        new = np.flatnonzero(places < 0).tolist()
        groups: dict[int, list[int]] = {}
        for i in new:
            groups.setdefault(min(-(-len(parts[i]) // 3), VECTOR_BYTES), []).append(i)
        flats, sizes, order = [self.known_ids], [self.known_sizes], []
        for width, members in groups.items():
            if width * 3 > VECTOR_BYTES:
                long = [self._merge_long(parts[i]) for i in members]
                flat, size = np.concatenate(long), np.array([len(x) for x in long], np.int32)
            else:
                flat, size = self._merge_many([parts[i] for i in members])
            flats.append(flat)
            sizes.append(size)
            order += members
        if order:
            at = len(self.known_sizes)
            places[order] = np.arange(at, at + len(order))
            self.known_ids, self.known_sizes = np.concatenate(flats), np.concatenate(sizes)
            self.known_begin = np.cumsum(self.known_sizes, dtype=np.int64) - self.known_sizes
            self.cache.update((parts[i], at + k) for k, i in enumerate(order) if len(parts[i]) <= VECTOR_BYTES)
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, byte offset of each in its text, and the offsets of the texts in these."""
        strings = [t or "" for t in texts.to_pylist()]
        points = np.frombuffer(SEPARATOR.join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        data, byte_at = string_bytes(texts)
        if not len(points):
            return np.empty(0, np.int32), np.empty(0, np.int32), np.zeros(len(strings) + 1, np.int64)
        apart = points == ord(SEPARATOR)
        starts = np.flatnonzero(slice_starts(points))
        width = np.ones(len(points), np.int8)
        for low in (0x80, 0x800, 0x10000):
            width += points >= low
        width[apart] = 0
        at = np.cumsum(width, dtype=np.int64)
        at -= width
        starts = starts[~apart[starts]]
        cuts = np.append(at[starts], len(data))
        pieces = binary_array(data, cuts).dictionary_encode()
        codes = pieces.indices.to_numpy()
        places = self.merged(pieces.dictionary.to_pylist())[codes]
        count = self.known_sizes[places]
        upto = np.cumsum(count, dtype=np.int32)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.known_ids[np.arange(total, dtype=np.int32) + np.repeat(self.known_begin[places] - (upto - count), count)]
        ends = np.cumsum(self.lengths[ids])
        begins = ends - self.lengths[ids]
        first = np.searchsorted(begins, byte_at[:-1], "left")
        first = np.append(first, len(ids)).astype(np.int64)
        own = begins - np.repeat(byte_at[:-1], np.diff(first))
        return ids, own.astype(np.int32), first

    def decode(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """Bytes of each list of ids."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        return binary_array(self.blob[source], np.append(0, ends)[first])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


def encode(documents: DataFrame, path: str, text: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` and ``starts`` (the byte at which each id begins) of every row."""
    keep = [k for k in keep if k not in ("ids", "starts")]
    lists = ArrayType(IntegerType(), False)
    schema = StructType([documents.schema[k] for k in keep] + [StructField("ids", lists), StructField("starts", lists)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in slices(batches, "__text", SLICE_BYTES):
            ids, starts, first = words.encode(part.column("__text"))
            at = pa.array(first.astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (ids, starts)]
            yield pa.RecordBatch.from_arrays([part.column(k) for k in keep] + lists, [*keep, "ids", "starts"])

    return documents.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def _lists(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
    counts = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return flat, np.append(0, np.cumsum(counts))


def decoded(ids: Column | str, path: str) -> Column:
    """The bytes that a list of ids stands for; null gives no bytes."""

    @F.arrow_udf(BinaryType())
    def run(lists: pa.Array) -> pa.Array:
        return vocabulary(path).decode(*_lists(lists))

    return run(ids)


def tokenise(documents: DataFrame, path: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded, then decoded from the ids.

    ``with_ids`` adds the ids themselves, packed as little-endian unsigned 32-bit integers.

    Both directions run in one Python worker per task, so it holds the vocabulary once.
    """
    schema = StructType([documents.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in slices(batches, "__text", SLICE_BYTES):
            ids, _, first = words.encode(part.column("__text"))
            columns = [part.column("doc_id"), pa.array(np.diff(first)), binary_array(ids.astype("<u4"), first * 4), words.decode(ids, first)]
            yield pa.RecordBatch.from_arrays([c.cast(pa.binary()) if pa.types.is_large_binary(c.type) else c for c in columns], schema.names)

    out = documents.select("doc_id", F.col(text).alias("__text")).mapInArrow(run, schema)
    digests = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return out.select("doc_id", "n_tokens", *digests, *(["ids"] if with_ids else []))
