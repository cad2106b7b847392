"""Geo ranges and the IP range join.

The reference joins every log row against every range (a theta join, so Spark plans a
nested loop: rows x ranges comparisons). Here the join gets an equality: IPs and ranges
are cut into bins of ``2**(32 - bin_bits)`` addresses; a range is exploded over the bins
it touches, a log row has one bin, and the original inclusive predicate stays as a
residual. Each matching (row, range) pair meets in exactly one bin, so overlapping
ranges still multiply rows, and a row matching nothing still comes out once.

The binned range table is bounded by the IPv4 space, not by the logs: at most
``2**bin_bits + #ranges`` rows for non-overlapping blocks. Its size is measured before
it is broadcast; past the limit the join is a shuffled equi join on (bin, salt), which needs
no adaptive execution (streams run without it): the ranges are copied to every salt, the log
rows of a bin are spread over the salts by a hash of the row, and rows without an IP get
bins of their own, below zero, by the same hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.functions.ip import cidr_end, cidr_start, ip_to_long, is_ip_address
from hitscope.schemas import GEO_COLUMNS

UNKNOWN = "Unknown"
DEFAULT_BIN_BITS = "auto"
# Bin sizes tried by "auto", coarse to fine, and the most ranges one bin may hold: a log
# row is compared with every range of its bin, so this bounds the per-row probe work.
BIN_BITS_CANDIDATES = (16, 18, 20)
MAX_RANGES_PER_BIN = 64
# Broadcast limit for the binned range table (measured, not estimated from files).
DEFAULT_BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
# Shares into which the shuffled join deals the log rows of one bin, and negative bins for
# rows without an IP.
SALTS = 32
NON_IP_BINS = 1 << 20
# Bytes per binned row besides its string bytes: an UnsafeRow of 7 fields (null bits +
# 7 words) plus hash-map entry overhead in the broadcast relation.
_ROW_OVERHEAD = 96


def build_geo_ranges(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """CIDR blocks -> ``ip_start, ip_end`` + location names (inner join on id).

    Blocks that are not IPv4 CIDR, or whose ``geoname_id`` is NULL/unknown, drop out.
    """
    ranges = (
        blocks.select(
            cidr_start("network").alias("ip_start"),
            cidr_end("network").alias("ip_end"),
            F.col("geoname_id"),
        )
        .where((F.col("ip_start") >= 0) & (F.col("ip_end") >= 0))
    )
    names = locations.select("geoname_id", *GEO_COLUMNS)
    return ranges.join(names, "geoname_id", "inner").drop("geoname_id")


def add_ip_columns(logs: DataFrame, host_col: str = "host") -> DataFrame:
    """``is_ip_host`` and ``ip_long`` (-1 for non-IP hosts)."""
    is_ip = is_ip_address(host_col)
    return logs.withColumns({
        "is_ip_host": is_ip,
        "ip_long": F.when(is_ip, ip_to_long(host_col)).otherwise(F.lit(-1).cast("long")),
    })


def bin_ranges(ranges: DataFrame, bin_bits: int = 16, columns: Sequence[str] = GEO_COLUMNS) -> DataFrame:
    """Explode each range over the address bins it covers (``range_bin``)."""
    shift = 32 - bin_bits
    return ranges.select(
        F.explode(F.sequence(F.shiftright("ip_start", shift), F.shiftright("ip_end", shift))).alias("range_bin"),
        "ip_start", "ip_end", *columns,
    )


@dataclass(frozen=True)
class RangeIndex:
    """A binned range table plus the measured decision on how to join it."""

    binned: DataFrame
    bin_bits: int
    rows: int
    approx_bytes: int
    broadcast: bool
    max_per_bin: int = -1
    columns: tuple[str, ...] = tuple(GEO_COLUMNS)


def _measure(binned: DataFrame, columns: Sequence[str]) -> tuple[int, int, int]:
    """(rows, approximate broadcast bytes, most ranges in one bin): one small job."""
    width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns)
    per_bin = binned.groupBy("range_bin").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("chars"))
    stats = per_bin.agg(F.sum("n").alias("rows"), F.max("n").alias("top"), F.sum("chars").alias("chars")).first()
    rows = int(stats["rows"] or 0)
    return rows, rows * _ROW_OVERHEAD + int(stats["chars"] or 0), int(stats["top"] or 0)


def index_ranges(ranges: DataFrame, bin_bits: int | str = DEFAULT_BIN_BITS,
                 broadcast_limit_bytes: int = DEFAULT_BROADCAST_LIMIT_BYTES,
                 strategy: str = "auto", persist: bool = False, columns: Sequence[str] = GEO_COLUMNS) -> RangeIndex:
    """Bin the ranges and measure them (small jobs over the dimension table only).

    ``bin_bits="auto"`` takes the coarsest of ``BIN_BITS_CANDIDATES`` whose fullest bin
    holds at most ``MAX_RANGES_PER_BIN`` ranges and that fits the broadcast limit (else
    the least crowded one that fits, else the least crowded with a shuffled join).
    ``strategy="broadcast"`` above the limit is an error. ``persist`` keeps
    the binned table in executor storage (memory, then disk) for reuse by several joins;
    lost blocks are rebuilt from the geo files."""
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    candidates = BIN_BITS_CANDIDATES if bin_bits == "auto" else (int(bin_bits),)
    ranges = ranges.persist()  # measured once per candidate
    try:
        measured = []
        for bits in candidates:
            rows, approx, top = _measure(bin_ranges(ranges, bits, columns), columns)
            measured.append((bits, rows, approx, top))
            if top <= MAX_RANGES_PER_BIN and approx <= broadcast_limit_bytes:
                break
    finally:
        ranges.unpersist()
    fitting = [m for m in measured if m[2] <= broadcast_limit_bytes]
    if strategy == "broadcast" and not fitting:
        raise ValueError(f"the binned ranges take {measured[0][2]} bytes, over the broadcast limit of {broadcast_limit_bytes}")
    uncrowded = [m for m in fitting if m[3] <= MAX_RANGES_PER_BIN]
    if strategy == "shuffle":
        chosen = min(measured, key=lambda m: m[3])
    elif uncrowded:
        chosen = uncrowded[0]  # coarsest
    else:
        chosen = min(fitting or measured, key=lambda m: m[3])
    bits, rows, approx, top = chosen
    binned = bin_ranges(ranges, bits, columns)
    if persist:
        binned = binned.persist()
    go_broadcast = strategy != "shuffle" and approx <= broadcast_limit_bytes
    return RangeIndex(binned, bits, rows, approx, go_broadcast, top, tuple(columns))


def _finish(joined: DataFrame) -> DataFrame:
    """G6c/G6e: every geo column NULL (non-IP, no match, or NULL in the file) -> Unknown."""
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in GEO_COLUMNS})


def geolocate(logs: DataFrame, ranges: DataFrame | RangeIndex, *,
              strategy: str = "auto", bin_bits: int | str = DEFAULT_BIN_BITS,
              broadcast_limit_bytes: int = DEFAULT_BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Left range join of logs with geo ranges, as a binned equi join.

    ``strategy``: ``auto`` (broadcast when the measured binned table fits the limit,
    else shuffle on the bin), ``broadcast``, ``shuffle``, or ``naive`` (the reference's
    plain theta join, kept for comparison; it plans a nested loop).
    Works on bounded and streaming ``logs`` (stream-static left join).
    """
    with_ip = add_ip_columns(logs)
    if strategy == "naive":
        if isinstance(ranges, RangeIndex):
            raise ValueError("the naive join takes the plain ranges, not a RangeIndex")
        cond = (with_ip["ip_long"] >= ranges["ip_start"]) & (with_ip["ip_long"] <= ranges["ip_end"])
        joined = with_ip.join(ranges, cond, "left").drop("ip_start", "ip_end")
        return _finish(joined)

    index = ranges if isinstance(ranges, RangeIndex) else index_ranges(
        ranges, bin_bits, broadcast_limit_bytes, strategy)
    return _finish(join_ranges(with_ip, index))


def join_ranges(with_ip: DataFrame, index: RangeIndex) -> DataFrame:
    """Rows with ``ip_long`` and the columns of each range that holds it, or NULL: a left equi join on the bin."""
    shift = 32 - index.bin_bits
    bin_of = F.shiftright("ip_long", shift)
    in_range = (F.col("ip_long") >= F.col("ip_start")) & (F.col("ip_long") <= F.col("ip_end"))
    if index.broadcast:
        # ip_long = -1 (not an IP) gets a NULL bin and can only come out unmatched.
        probe = with_ip.withColumn("ip_bin", F.when(F.col("ip_long") >= 0, bin_of))
        cond = (F.col("ip_bin") == F.col("range_bin")) & in_range
        joined = probe.join(F.broadcast(index.binned), cond, "left")
    else:
        spread = F.xxhash64("host", "time", "url")
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("range_salt")
        probe = with_ip.withColumns({
            "ip_bin": F.when(F.col("ip_long") >= 0, bin_of).otherwise(-1 - F.pmod(spread, F.lit(NON_IP_BINS))),
            "ip_salt": F.pmod(spread, F.lit(SALTS)).cast("int"),
        })
        cond = (F.col("ip_bin") == F.col("range_bin")) & (F.col("ip_salt") == F.col("range_salt")) & in_range
        joined = probe.join(index.binned.select("*", salts).hint("merge"), cond, "left").drop("ip_salt", "range_salt")
    return joined.drop("ip_bin", "range_bin", "ip_start", "ip_end")
