"""Vectorised words and word-sequence hashes over Arrow text columns.

Everything works on the UTF-8 bytes of a whole batch at once (numpy), because a word here is a
run of bytes outside ``[\\x20\\x09-\\x0D]`` and that never cuts a multi-byte character.
Callers feed slices of bounded size (``slices``), so the memory of a task does not follow the
size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 512 << 10
#: Words of at most so many bytes are hashed together; longer ones by xxh3, one by one.
VECTOR_BYTES = 64

_U = np.uint64
_random = np.random.Generator(np.random.PCG64(20240229))
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_CHECK_PLACE = np.random.Generator(np.random.PCG64(97)).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
# A random number for each byte at each place of a word. Sums of these have no algebraic structure, as powers
# of a base modulo 2^64 have, where words of equal hash can be constructed.
_AT_PLACE = _random.integers(0, 1 << 64, VECTOR_BYTES * 256, dtype=np.uint64).reshape(VECTOR_BYTES, 256)
# What stays of eight bytes of which so many belong to a word, and what marks their number: bytes that UTF-8 does not have.
_OWN_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_NUMBER = np.array([*((0xF8 + k) << 56 for k in range(8)), 0], np.uint64)


@cache
def _numbers(breaks: bytes, lower: bool) -> np.ndarray:
    """The numbers by place and byte, 0 for bytes between words; with ``lower`` A-Z have those of a-z."""
    table = _AT_PLACE[:, _LOWER] if lower else _AT_PLACE.copy()
    table[:, np.frombuffer(breaks, bool)] = 0
    return table.ravel()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts in them; null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = string_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of a slice: byte ranges, and the n + 1 offsets of the documents' words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    breaks: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64 bits per word; with ``lower`` A-Z count as a-z."""
        out = np.empty(len(self.start), np.uint64)
        length = self.end - self.start
        numbers = _numbers(self.breaks.tobytes(), lower)
        at = 0
        while at < len(self.start):
            begin = self.start[at]
            upto = max(at + 1, int(np.searchsorted(self.end, begin + SLICE_BYTES, "right")))
            span = int(self.end[upto - 1] - begin)
            if span <= SLICE_BYTES:  # else one very long word
                here = self.data[begin : begin + span]
                rel = self.start[at:upto] - begin
                steps = np.diff(rel, append=span)
                code = np.arange(span) - np.repeat(rel, steps)  # the place in a word
                if int(steps.max()) > VECTOR_BYTES:
                    np.minimum(code, VECTOR_BYTES - 1, out=code)
                code <<= 8
                code |= here
                out[at:upto] = np.add.reduceat(numbers[code], rel)
            at = upto
        for i in np.flatnonzero(length > VECTOR_BYTES).tolist():
            word = self.data[self.start[i] : self.end[i]].tobytes()
            out[i] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
        return mix(out)

    def keys(self, lower: bool = False) -> np.ndarray:
        """64 bits per word as ``hashes``, but others, from blocks of eight bytes; words of up to eight bytes never collide with each other."""
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:-8] = self.data | ((self.data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)) if lower else self.data
        eight = np.ndarray(len(self.data) + 1, "<u8", data, strides=(1,))  # from each byte on
        length = self.end - self.start
        own = np.minimum(length, 8)
        out = mix(eight[self.start] & _OWN_BYTES[own] | _NUMBER[own])
        more, at = np.flatnonzero((length > 8) & (length <= VECTOR_BYTES)), 8
        while len(more):
            left = length[more] - at
            own = np.minimum(left, 8)
            out[more] = mix(out[more] ^ mix((eight[self.start[more] + at] & _OWN_BYTES[own] | _NUMBER[own]) + _PLACE[at]))
            more, at = more[left > 8], at + 8
        for i in np.flatnonzero(length > VECTOR_BYTES).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[self.start[i] : self.end[i]].tobytes())
        return out


def words(texts: pa.Array, breaks: np.ndarray | None = None) -> Words:
    """Words of each text. ``breaks`` marks further bytes that separate words."""
    data, at = string_bytes(texts)
    # arithmetic instead of a lookup, for the usual breaks
    gap = (data == 0x20) | (data - np.uint8(0x09) < 5) if breaks is None else breaks[data]
    breaks = _SPACES if breaks is None else breaks
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    solid = ~gap
    head = solid.copy()
    head[1:] &= gap[:-1] | edge[1:-1]
    tail = solid.copy()
    tail[:-1] &= gap[1:] | edge[1:-1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return Words(data, start, end, np.searchsorted(start, at).astype(np.int64), breaks)


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and first word of every ``size`` consecutive words inside one document."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(doc)) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    # summed at every word, whatever its document: neighbours in memory are faster than looking up each start
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * _PLACE[k]
    return mix(total[start] + _U(size)), doc, start


def sequence_checks(hashes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """32 further bits of the ``size`` words from each ``start``, independent of ``sequence_hashes``."""
    total = np.zeros(len(start), np.uint64)
    for k in range(size):
        total += hashes[start + k] * _CHECK_PLACE[k]
    return (mix(total + _U(size)) >> _U(32)).astype(np.uint32)


def short_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each document that has words but fewer than ``size``: its whole sequence."""
    counts = np.diff(first)
    doc = np.flatnonzero((counts > 0) & (counts < size))
    total = np.zeros(len(doc), np.uint64)
    for k in range(size - 1):
        has = counts[doc] > k
        total[has] += hashes[first[doc[has]] + k] * _PLACE[k]
    return mix(total + counts[doc].astype(np.uint64)), doc


def distinct_in_groups(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value of a group once, by group and value. Sorted by one number of both; where that cannot tell two values apart, by both."""
    if len(group) and int(group.max()) < 1 << 20:
        key = (group.astype(np.uint64) << _U(44)) | (values >> _U(20))
        by = np.argsort(key)
        key, values_by = key[by], values[by]
        if np.any((key[1:] == key[:-1]) & (values_by[1:] != values_by[:-1])):
            by = np.lexsort((values, group))
    else:
        by = np.lexsort((values, group))
    values, group = values[by], group[by]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
    return values[new], group[new]


def binary_array(data: np.ndarray | bytes, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary column over one buffer."""
    raw = data if isinstance(data, bytes) else np.ascontiguousarray(data).view(np.uint8)
    if offsets[-1] >= 1 << 31:
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
