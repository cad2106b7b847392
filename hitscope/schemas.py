"""Explicit schemas: no inference pass, and the same types in every file."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Access log as CSV: a leading index column (any name) then six text fields.
RAW_LOG = StructType([
    StructField("idx", StringType()),
    StructField("host", StringType()),
    StructField("time", StringType()),
    StructField("method", StringType()),
    StructField("url", StringType()),
    StructField("response", StringType()),
    StructField("bytes", StringType()),
])

# One stream record (JSON value of a Kafka message or a line of a text file).
LOG_JSON = StructType([
    StructField("host", StringType()),
    StructField("time", LongType()),
    StructField("method", StringType()),
    StructField("url", StringType()),
    StructField("response", IntegerType()),
    StructField("bytes", LongType()),
])

GEO_BLOCKS = StructType([
    StructField("network", StringType()),
    StructField("geoname_id", LongType()),
])

GEO_LOCATIONS = StructType([
    StructField("geoname_id", LongType()),
    StructField("country_name", StringType()),
    StructField("continent_name", StringType()),
    StructField("country_iso_code", StringType()),
    StructField("continent_code", StringType()),
])

GEO_COLUMNS = ["country_name", "continent_name", "country_iso_code", "continent_code"]

CLEAN_COLUMNS = ["host", "time", "method", "url", "response", "bytes"]

ENRICHED_COLUMNS = CLEAN_COLUMNS + ["is_ip_host", "ip_long"] + GEO_COLUMNS + [
    "timestamp", "hour_of_day", "day_of_week", "date",
    "url_category", "response_category", "bytes_kb",
]
