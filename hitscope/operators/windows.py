"""Five-minute tumbling event-time windows with a ten-minute watermark.

The same functions run on a streaming frame (state kept per window and key, evicted
once the watermark passes) and on a bounded frame, where the watermark is ignored and
the result is the final value of every window. Rows with a NULL event time fall in no
window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tumbling window length and watermark delay, as in the reference.
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "10 minutes"
WINDOW_SECONDS = 300  # WINDOW_DURATION in seconds
EVENT_TIME = "timestamp"
UNKNOWN = "Unknown"


def windowed(df: DataFrame, keys: list[str], aggs: list[Column], *,
             where: Column | None = None, window: str = WINDOW_DURATION,
             watermark: str | None = WATERMARK_DELAY, event_time: str = EVENT_TIME) -> DataFrame:
    """W5 + W6: watermark, optional filter, tumbling window, flattened window struct."""
    if watermark:
        df = df.withWatermark(event_time, watermark)
    if where is not None:
        df = df.where(where)
    out = df.groupBy(F.window(event_time, window).alias("window"), *keys).agg(*aggs)
    names = [a for a in out.columns if a not in ("window", *keys)]
    return out.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys, *names,
    )


def _megabytes() -> Column:
    return F.round(F.sum("bytes") / 1024.0 / 1024.0, 2)


def requests_by_country(df: DataFrame, **kw) -> DataFrame:
    """Requests and bytes per window and country (known countries only)."""
    return windowed(df, ["country_name"],
                    [F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes")],
                    where=F.col("country_name") != UNKNOWN, **kw)


def requests_by_url_category(df: DataFrame, **kw) -> DataFrame:
    """Requests, bytes and mean bytes per window and URL category."""
    return windowed(df, ["url_category"],
                    [F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes"),
                     F.round(F.avg("bytes"), 2).alias("avg_bytes")], **kw)


def error_rate(df: DataFrame, **kw) -> DataFrame:
    """Requests, requests with status >= 400, and their percentage per window."""
    errors = F.sum(F.when(F.col("response") >= 400, 1).otherwise(0))
    rate = F.round(errors.cast("double") / F.count(F.lit(1)).cast("double") * 100, 2)
    return windowed(df, [], [F.count(F.lit(1)).alias("total_requests"),
                             errors.alias("error_requests"), rate.alias("error_rate_pct")], **kw)


def traffic_volume(df: DataFrame, *, with_unique_hosts: bool = True, **kw) -> DataFrame:
    """Requests, bytes, megabytes and approximate distinct hosts per window.

    Exact distinct counts are not supported on streams, so ``unique_hosts`` is an
    HyperLogLog++ estimate (default relative error)."""
    aggs = [F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes"),
            _megabytes().alias("total_mb")]
    if with_unique_hosts:
        aggs.append(F.approx_count_distinct("host").alias("unique_hosts"))
    return windowed(df, [], aggs, **kw)


# Stream table name -> (function, key columns besides the window).
WINDOWED: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "stream_requests_by_country": (requests_by_country, ["country_name"]),
    "stream_requests_by_url_category": (requests_by_url_category, ["url_category"]),
    "stream_error_rate": (error_rate, []),
    "stream_traffic_volume": (traffic_volume, []),
}


def four_tables(df: DataFrame, *, window: str = WINDOW_DURATION, watermark: str | None = WATERMARK_DELAY,
                event_time: str = EVENT_TIME) -> DataFrame:
    """W1-W4 from one read and in one state: a row counts for its window, its country and its URL category.

    Each row becomes up to three small ones (table, key) before the only shuffle, and these are partially
    aggregated there, so the records are decoded and geolocated once and one state store holds all four results.
    ``split_tables`` takes them apart."""
    if watermark:
        df = df.withWatermark(event_time, watermark)
    one = lambda table, key: F.struct(F.lit(table).alias("table"), key.cast("string").alias("key"))
    counted = F.array(one("window", F.lit(None)), one("url_category", F.col("url_category")), one("country", F.col("country_name")))
    rows = df.select(event_time, "bytes", "response", "host", F.explode(counted).alias("of"))
    rows = rows.where((F.col("of.table") != "country") | (F.col("of.key") != UNKNOWN))
    grouped = rows.groupBy(F.window(event_time, window).alias("window"), F.col("of.table").alias("table"), F.col("of.key").alias("key")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes"),
        F.sum(F.when(F.col("response") >= 400, 1).otherwise(0)).alias("error_requests"),
        F.approx_count_distinct(F.when(F.col("of.table") == "window", F.col("host"))).alias("unique_hosts"))
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          "table", "key", "requests", "total_bytes", "error_requests", "unique_hosts")


def split_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The four stream tables with the columns that their own queries give (and the version columns, if there are any)."""
    bounds = ["window_start", "window_end"]
    version = [c for c in ("run", "batch_id") if c in rows.columns]
    of = lambda table: rows.where(F.col("table") == table)
    errors = F.col("error_requests")
    rate = F.round(errors.cast("double") / F.col("requests").cast("double") * 100, 2)
    return {
        "stream_requests_by_country": of("country").select(*bounds, F.col("key").alias("country_name"), "requests", "total_bytes", *version),
        "stream_requests_by_url_category": of("url_category").select(
            *bounds, F.col("key").alias("url_category"), "requests", "total_bytes", F.round(F.col("total_bytes") / F.col("requests"), 2).alias("avg_bytes"), *version),
        "stream_error_rate": of("window").select(*bounds, F.col("requests").alias("total_requests"), errors, rate.alias("error_rate_pct"), *version),
        "stream_traffic_volume": of("window").select(
            *bounds, "requests", "total_bytes", F.round(F.col("total_bytes") / 1024.0 / 1024.0, 2).alias("total_mb"), "unique_hosts", *version),
    }
