"""Time attributes, URL/response categories and kilobytes, one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.functions.categories import (
    RESPONSE_CLASSES,
    URL_RULES,
    response_category,
    url_category,
)

# Epoch seconds that map to years 0001..9999; outside this a timestamp is NULL
# (the reference's string round trip gives NULL there too, and timestamp_seconds
# would overflow).
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799


def enrich(df: DataFrame, url_rules=URL_RULES, response_classes=RESPONSE_CLASSES) -> DataFrame:
    """Add ``timestamp, hour_of_day, day_of_week, date, url_category, response_category,
    bytes_kb``. Hour, day and date follow the session time zone (pinned to UTC by
    ``hitscope.session.configure``)."""
    t = F.col("time")
    ts = F.when(t.between(MIN_EPOCH, MAX_EPOCH), F.timestamp_seconds(t))
    with_ts = df.withColumn("timestamp", ts)
    return with_ts.withColumns({
        "hour_of_day": F.hour("timestamp"),
        "day_of_week": F.date_format("timestamp", "EEEE"),
        "date": F.to_date("timestamp"),
        "url_category": url_category("url", url_rules),
        "response_category": response_category("response", response_classes),
        "bytes_kb": F.round(F.col("bytes") / 1024.0, 2),
    })
