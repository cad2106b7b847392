"""A count-min table over the hashes of a corpus: a general helper of the operators.

Each task sends, for every line of the table, the cells that it hits and those that it hits more
than once; sketches are merged by ranges of cells into one bit a cell: hit at least twice. It can
only overestimate: a hash that occurs twice is always reported. The table has a fixed size
(``lines * 2 ** CELL_BITS`` bits), so what is collected and broadcast does not grow with the data. It is
stored and comes to the driver in ``TABLE_PARTS`` parts, ranges with few cells as the gaps between them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hitscope.llm.textio import mix, slices
from hitscope.session import scratch_path

LINES = 2
CELL_BITS = 28
CHUNK_BITS = 18
#: Hashes that a task holds before it sends their cells.
SKETCH_HASHES = 2_000_000
#: A hash counts towards heavy ones where one slice has it this often; so many are kept, each with this many rows at least.
HEAVY_IN_SLICE = 32
HEAVY = 1000
HEAVY_FROM = 1000
HEAVY_CHUNK = 64
#: Parts in which the merged table comes to the driver, one after the other.
TABLE_PARTS = 16
_SALT = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)]
HashOf = Callable[[pa.RecordBatch], np.ndarray]


def gaps_packed(rising: np.ndarray) -> bytes:
    """Rising integers as bytes: the gap to the one before, 255 standing for 255 and more to come."""
    if not len(rising):
        return b""
    gap = np.diff(rising.astype(np.int64), prepend=0)
    more = gap // 255
    at = np.cumsum(more + 1) - 1
    out = np.full(at[-1] + 1, 255, np.uint8)
    out[at] = gap - more * 255
    return out.tobytes()


def gaps_unpacked(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def cells_packed(two: np.ndarray) -> bytes:
    """The cells of a chunk that are set: the gaps between them, or one bit a cell where that is not longer."""
    gaps = gaps_packed(np.flatnonzero(two))
    return gaps if len(gaps) < len(two) >> 3 else np.packbits(two, bitorder="little").tobytes()


def cells_unpacked(raw: bytes) -> np.ndarray:
    """One bit a cell of a chunk."""
    if len(raw) == 1 << (CHUNK_BITS - 3):
        return np.frombuffer(raw, np.uint8)
    two = np.zeros(1 << CHUNK_BITS, bool)
    two[gaps_unpacked(raw)] = True
    return np.packbits(two, bitorder="little")


def cells(hashes: np.ndarray, line: int) -> np.ndarray:
    return (mix(hashes ^ _SALT[line]) >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


_SKETCH = "line int, chunk int, hit binary, again binary"
_FOLDED = "line int, chunk int, bits binary"


def _sketches(hash_of: HashOf, lines: int, heavy_in_slice: int, sliced: bool = True):
    """Cells hit by this task, and hashes that are frequent in one of its slices (line -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: list[np.ndarray] = []
        twice: list[np.ndarray] = []
        often: dict[int, int] = defaultdict(int)
        held = total = 0

        def flush() -> Iterator[tuple]:
            nonlocal held
            hashes = np.concatenate(once) if once else np.empty(0, np.uint64)
            known = np.concatenate(twice) if twice else hashes[:0]
            for line in range(lines):
                hit, count = np.unique(cells(hashes, line), return_counts=True)
                again = np.union1d(hit[count > 1], cells(known, line))
                for part, values in (("hit", hit), ("again", again)):
                    chunk = values >> CHUNK_BITS
                    edges = np.flatnonzero(np.diff(chunk, prepend=-1))
                    for a, b in zip(edges, np.append(edges[1:], len(values)), strict=False):
                        packed = gaps_packed(values[a:b] & ((1 << CHUNK_BITS) - 1))
                        yield (line, int(chunk[a]), packed if part == "hit" else b"", packed if part == "again" else b"")
            once.clear()
            twice.clear()
            held = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["line", "chunk", "hit", "again"])

        for rows in slices(batches, "text") if sliced else batches:
            hashes = hash_of(rows)
            values, count = np.unique(hashes, return_counts=True)
            once.append(values)
            twice.append(values[count > 1])
            for h, n in zip(values[count >= heavy_in_slice].tolist(), count[count >= heavy_in_slice].tolist(), strict=True):
                often[h] += n
            held += len(values)
            total += len(hashes)
            if held >= SKETCH_HASHES or len(often) > 100_000:
                yield batch([*flush(), *_often(often)])
                often.clear()
        yield batch([*flush(), *_often(often), (-2, 0, total.to_bytes(8, "little"), b"")])

    return run


def _often(often: dict[int, int]) -> Iterator[tuple]:
    table = np.array(list(often.items()), np.uint64).reshape(-1, 2)
    chunk = (table[:, 0] % np.uint64(HEAVY_CHUNK)).astype(int)
    for c in np.unique(chunk).tolist():
        yield (-1, c, table[chunk == c].tobytes(), b"")


def _folded(heavy_from: int):
    """One row per (line, chunk): the cells hit twice, packed; for line -1 the most frequent hashes; for -2 the number of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        for (line, chunk), group in groupby(rows, key=lambda r: r[:2]):
            if line == -2:
                bits = sum(int.from_bytes(r[2], "little") for r in group).to_bytes(8, "little")
            elif line == -1:
                counts: dict[int, int] = defaultdict(int)
                for r in group:
                    for h, n in np.frombuffer(r[2], np.uint64).reshape(-1, 2).tolist():
                        counts[h] += n
                most = sorted(((n, h) for h, n in counts.items() if n >= heavy_from), reverse=True)[:HEAVY]
                bits = np.array([(h, n) for n, h in most], np.uint64).tobytes()
            else:
                one, two = np.zeros(1 << CHUNK_BITS, bool), np.zeros(1 << CHUNK_BITS, bool)
                for _, _, hit, again in group:
                    at = gaps_unpacked(hit)
                    two[at[one[at]]] = True
                    one[at] = True
                    two[gaps_unpacked(again)] = True
                bits = cells_packed(two)
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([chunk], pa.int32()), pa.array([bits], pa.binary())], ["line", "chunk", "bits"])

    return run


class Sketch:
    """The merged table, and the hashes that occur very often."""

    def __init__(self, rows: Iterable, lines: int):
        self.lines = np.zeros((lines, 1 << (CELL_BITS - 3)), np.uint8)
        self.total, heavy, size = 0, [], 1 << (CHUNK_BITS - 3)
        for line, chunk, bits in rows:
            if line >= 0:
                if bits:  # cells of a chunk without any stay untouched
                    self.lines[line, chunk * size : (chunk + 1) * size] = cells_unpacked(bits)
            elif line == -1:
                heavy += np.frombuffer(bits, np.uint64).reshape(-1, 2).tolist()
            else:
                self.total += int.from_bytes(bits, "little")
        self.heavy = np.array(sorted(h for h, _ in sorted(heavy, key=lambda x: (-x[1], x[0]))[:HEAVY]), np.uint64)

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for line, bits in enumerate(self.lines):
            at = cells(hashes, line)
            out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return out


def sketch(source: DataFrame, hash_of: HashOf, lines: int = LINES, heavy_in_slice: int = HEAVY_IN_SLICE, heavy_from: int = HEAVY_FROM, columns: tuple[str, ...] = ("text",)) -> Sketch:
    """The merged table of what ``hash_of`` gives for slices of column ``text`` (whole batches if it is not among ``columns``)."""
    rows = source.select(*columns).mapInArrow(_sketches(hash_of, lines, heavy_in_slice, "text" in columns), _SKETCH).repartition("line", "chunk").sortWithinPartitions("line", "chunk")
    path = scratch_path(source.sparkSession, "count_min")
    rows.mapInArrow(_folded(heavy_from), _FOLDED).write.option("compression", "zstd").parquet(path)
    # one part at a time is in the driver's JVM and on its way to Python, where the table itself is all there is
    parts = source.sparkSession.read.schema(_FOLDED).parquet(path).repartition(TABLE_PARTS, "chunk")
    return Sketch(parts.toLocalIterator(), lines)
