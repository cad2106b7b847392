"""Sessions of hosts: stretches of requests with no pause longer than a gap.

Bounded rows take two levels, so that no task has all requests of a hot host: sessions inside chunks of time
first, then sessions of a host that touch across chunks. The second level has at most one row for each
gap of the time covered and host, however many requests there are. Streams use Spark's
session windows, whose state merges sessions as they grow; a session is emitted once, when the watermark has
passed its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.operators.windows import EVENT_TIME, WATERMARK_DELAY

GAP_SECONDS = 30 * 60
CHUNK_SECONDS = 24 * 3600
COLUMNS = ("session_start", "session_end", "host", "requests", "total_bytes")


def _numbered(rows: DataFrame, keys: list[str], start: str, end: str, gap: int) -> DataFrame:
    """``rows`` with the number of their session: a new one begins where the pause since all before it is longer than the gap."""
    order = Window.partitionBy(*keys).orderBy(start)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col(start) > before + gap).cast("int"), F.lit(1))
    return rows.withColumn("fresh", fresh).withColumn("session", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def host_sessions(logs: DataFrame, gap: int = GAP_SECONDS, chunk: int = CHUNK_SECONDS, event_time: str = EVENT_TIME) -> DataFrame:
    """session_start, session_end (last request and the gap), host, requests, total_bytes; rows without a time are in no session."""
    # requests of one second are one row before any ordering
    second = F.unix_seconds(event_time)
    rows = logs.where(F.col(event_time).isNotNull()).groupBy("host", second.alias("first")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes"))
    rows = rows.withColumns({"last": F.col("first"), "chunk": F.floor(F.col("first") / chunk)})
    sums: list[Column] = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("requests").alias("requests"), F.sum("total_bytes").alias("total_bytes")]
    inside = _numbered(rows, ["host", "chunk"], "first", "last", gap).groupBy("host", "chunk", "session").agg(*sums)
    whole = _numbered(inside.drop("session"), ["host"], "first", "last", gap).groupBy("host", "session").agg(*sums)
    return whole.select(F.timestamp_seconds("first").alias("session_start"), F.timestamp_seconds(F.col("last") + gap).alias("session_end"), "host", "requests", "total_bytes")


def session_stream(logs: DataFrame, gap: int = GAP_SECONDS, watermark: str = WATERMARK_DELAY, event_time: str = EVENT_TIME) -> DataFrame:
    """The same over a stream (output mode append)."""
    grouped = logs.withWatermark(event_time, watermark).groupBy(F.session_window(event_time, f"{gap} seconds").alias("s"), "host")
    return grouped.agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes")).select(
        F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "host", "requests", "total_bytes")
