"""Dashboard measures and slicers over the report tables.

All inputs are report tables (one row per hour, day, code, category or window). A
table-wide value comes from a window when the table has a fixed small domain (24 hours),
else from a global aggregate used as a scalar subquery; nothing is pulled to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def client_error_rate(error_analysis: DataFrame, category: str = "Client Error") -> DataFrame:
    """M1: share (%) of requests in ``category`` over all requests of A4."""
    hit = F.sum(F.when(F.col("response_category") == category, F.col("requests")).otherwise(0))
    return error_analysis.agg(
        (F.try_divide(hit.cast("double"), F.sum("requests").cast("double")) * 100)
        .alias("client_error_rate_pct"))


def total_megabytes(daily_bandwidth: DataFrame) -> DataFrame:
    """M2: sum of the (rounded) daily megabytes of A14, rounded to cents."""
    return daily_bandwidth.agg(F.round(F.sum("total_mb"), 2).alias("total_mb"))


def peak_hour(hourly_traffic: DataFrame) -> DataFrame:
    """M3: the hour(s) with the most requests; ties are all kept.

    A5 has at most 25 rows (hours and NULL), so the maximum is a window over them; a
    scalar subquery would re-run the aggregation over the logs."""
    top = F.max("requests").over(Window.partitionBy())
    return (hourly_traffic.withColumn("_top", top).where(F.col("requests") == F.col("_top"))
            .select("hour_of_day", "requests"))


def latest_error_rate(error_rate_latest: DataFrame) -> DataFrame:
    """M4: newest window (with a rate) of the latest-version W3 table: one pass, one row per task to the last step."""
    row = F.max_by(F.struct("window_start", "window_end", "error_rate_pct"), "window_start")
    newest = error_rate_latest.where(F.col("error_rate_pct").isNotNull()).agg(row.alias("_w"))
    return newest.where(F.col("_w").isNotNull()).select("_w.window_start", "_w.window_end", "_w.error_rate_pct")


def daily_traffic_between(daily_traffic: DataFrame, start: str | _dt.date,
                          end: str | _dt.date) -> DataFrame:
    """days of A6 inside [start, end]."""
    return daily_traffic.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def country_slice(traffic_by_country: DataFrame, countries: list[str]) -> DataFrame:
    """rows of A1 for the chosen countries."""
    return traffic_by_country.where(F.col("country_name").isin(list(countries)))


def category_slice(url_category_distribution: DataFrame, categories: list[str]) -> DataFrame:
    """rows of A10 for the chosen URL categories."""
    return url_category_distribution.where(F.col("url_category").isin(list(categories)))


def hour_slice(hourly_traffic: DataFrame, first: int, last: int) -> DataFrame:
    """rows of A5 with hour_of_day in [first, last]."""
    return hourly_traffic.where(F.col("hour_of_day").between(first, last))


def heatmap_matrix(country_hour_heatmap: DataFrame) -> DataFrame:
    """H1: A12 as one row per country and one column per hour (``h00``..``h23``).

    The 24 pivot values are given, so no distinct-values job runs first."""
    wide = country_hour_heatmap.groupBy("country_name").pivot("hour_of_day", list(range(24))).agg(
        F.sum("requests"))
    return wide.select("country_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])
