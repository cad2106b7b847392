"""Distinct hosts from stored sketches: written once per day and country, merged for any longer period.

Exact distinct counts cannot be added up, so each period would read the logs again. An HLL sketch can: the
table holds one row of counts and one sketch for each (date, country), ``2 ** lg_k`` registers at most, and a month, a year or
all countries is a union of sketches. A rerun of a day replaces its rows only.

The relative standard error of an estimate is at most 1.04 / sqrt(2 ** lg_k); ``ERRORS`` of these is the bound
that results are checked against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.sinks.files import write_parquet

LG_K = 12
ERRORS = 4
UNKNOWN = "Unknown"
_SCHEMA = "country_name string, requests long, total_bytes long, hosts binary, date date"


def relative_error(lg_k: int = LG_K) -> float:
    return ERRORS * 1.04 / 2 ** (lg_k / 2)


def daily_sketches(enriched: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """date, country_name, requests, total_bytes and the sketch of the hosts; rows without a time have no day."""
    return enriched.where(F.col("date").isNotNull()).groupBy("date", "country_name").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("total_bytes"), F.hll_sketch_agg("host", lg_k).alias("hosts"))


def write_sketches(enriched: DataFrame, path: str, lg_k: int = LG_K) -> None:
    """Write the sketches of the days that ``enriched`` has; other days of the table stay."""
    write_parquet(daily_sketches(enriched, lg_k), path, partition_by=["date"], replace="folders")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def _counts() -> list[Column]:
    return [F.sum("requests").alias("requests"), F.sum("total_bytes").alias("total_bytes"),
            F.hll_sketch_estimate(F.hll_union_agg("hosts", True)).cast("long").alias("hosts")]


def hosts_by_period(sketches: DataFrame) -> DataFrame:
    """level (day, month, all), period, country_name (NULL: all countries), requests, total_bytes and the estimate of
    distinct hosts, in one aggregation of the sketch rows; no logs are read."""
    rows = sketches.withColumns({"day": F.date_format("date", "yyyy-MM-dd"), "month": F.date_format("date", "yyyy-MM")})
    day, month, country = F.col("day"), F.col("month"), F.col("country_name")
    sets = [[day, country], [day], [month, country], [month], [country], []]
    merged = rows.groupingSets(sets, day, month, country).agg(F.grouping("day").alias("no_day"), F.grouping("month").alias("no_month"), *_counts())
    level = F.when(F.col("no_day") == 0, "day").when(F.col("no_month") == 0, "month").otherwise("all")
    return merged.where("requests IS NOT NULL").select(level.alias("level"), F.coalesce("day", "month", F.lit("all")).alias("period"), "country_name", "requests", "total_bytes", "hosts")


def exact_hosts(enriched: DataFrame) -> DataFrame:
    """The same rows with exact distinct hosts, from the logs: what the estimates are checked against."""
    rows = enriched.where(F.col("date").isNotNull()).withColumns({"day": F.date_format("date", "yyyy-MM-dd"), "month": F.date_format("date", "yyyy-MM")})
    day, month, country = F.col("day"), F.col("month"), F.col("country_name")
    sets = [[day, country], [day], [month, country], [month], [country], []]
    counted = rows.groupingSets(sets, day, month, country).agg(F.grouping("day").alias("no_day"), F.grouping("month").alias("no_month"), F.count_distinct("host").alias("exact_hosts"))
    level = F.when(F.col("no_day") == 0, "day").when(F.col("no_month") == 0, "month").otherwise("all")
    return counted.select(level.alias("level"), F.coalesce("day", "month", F.lit("all")).alias("period"), "country_name", "exact_hosts")


def checked_hosts(sketches: DataFrame, enriched: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``hosts_by_period`` with the exact hosts instead of the estimate, and whether the estimate is within its bound (or off by one)."""
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("level", "period", "country_name")]
    near = F.abs(F.col("hosts") - F.col("exact_hosts")) <= F.greatest(F.lit(1.0), relative_error(lg_k) * F.col("exact_hosts"))
    joined = hosts_by_period(sketches).alias("s").join(exact_hosts(enriched).alias("e"), same[0] & same[1] & same[2])
    return joined.select("s.level", "s.period", "s.country_name", "requests", "total_bytes", "exact_hosts", near.alias("estimate_ok"))
