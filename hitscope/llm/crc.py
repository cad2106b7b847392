"""CRC-32 of many byte ranges at once (numpy)."""

from __future__ import annotations

import zlib

import numpy as np

#: The reversed CRC-32 polynomial that zlib uses.
POLYNOMIAL = 0xEDB88320
#: Longer ranges go to zlib one by one.
VECTOR_BYTES = 64


def _table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), value >> np.uint32(1))
    return value.astype(np.uint32)


_STEP = _table()


def crc32_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray | None = None) -> np.ndarray:
    """``zlib.crc32(data[start:end], seed)`` of every range; ``seed`` is the CRC of what stands before it."""
    length = end - start
    out = np.zeros(len(start), np.uint32) if seed is None else seed.astype(np.uint32)
    short = np.flatnonzero(length <= VECTOR_BYTES)
    order = short[np.argsort(-length[short], kind="stable")]
    state, first = out[order] ^ np.uint32(0xFFFFFFFF), start[order]
    falling = -length[order]
    for k in range(int(length[order[0]]) if len(order) else 0):
        upto = int(np.searchsorted(falling, -k, "left"))  # the ranges longer than k
        low = (state[:upto] ^ data[first[:upto] + k]) & np.uint32(255)
        state[:upto] = _STEP[low] ^ (state[:upto] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > VECTOR_BYTES).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(out[i]))
    return out


#: DuckDB text of the table that ``crc_sql`` needs; it takes WITH RECURSIVE before it.
CRC_TABLE = """
steps(b, i, v) AS (SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, i + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE i < 8),
crc_table AS (SELECT list(v ORDER BY b) AS crc_steps FROM steps WHERE i = 8)"""


def crc_sql(word: str) -> str:
    """DuckDB text of the unsigned CRC-32 of a column's UTF-8 bytes; the query must read crc_table (column crc_steps)."""
    octets = f"list_transform(range(1, octet_length(encode({word})) + 1), lambda i: CAST('0x' || substr(hex(encode({word})), 2 * i - 1, 2) AS BIGINT))"
    step = "xor(crc_steps[(xor(c, b) & 255) + 1], c // 256)"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"
