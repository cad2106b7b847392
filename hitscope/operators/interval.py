"""Interval join: rows of two tables with equal keys, the second at most so much later than the first.

Bounded tables are cut into buckets of the interval's length: a row of the second table can only match rows of its
own bucket and of the one before, so it is copied to both and the join is an equi join on (keys, bucket); a key with a
third of all rows is as many buckets as the time covered has. Streams use Spark's stream-stream join on the same
buckets, so a row meets only the state of its key and bucket, never all that its key has; the condition on both event
times lets each side's state go once the other's watermark has passed it. There the first side is copied (to its own
bucket and the next): its rows, here the errors, are usually the fewer, and each copy is a row of state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.operators.windows import EVENT_TIME, WATERMARK_DELAY

WITHIN_SECONDS = 600


def interval_join(first: DataFrame, second: DataFrame, keys: Sequence[str], first_time: str, second_time: str, within: int = WITHIN_SECONDS) -> DataFrame:
    """All pairs with equal ``keys`` and ``first_time <= second_time <= first_time + within`` seconds: the columns of
    ``first`` and those of ``second`` but its keys (names must differ). Rows with a NULL key or time are in no pair."""
    bucket = lambda c: _bucket(F.col(c), within)
    a = first.withColumn("__bucket", bucket(first_time))
    b = second.withColumn("__bucket", F.explode(F.array(bucket(second_time), bucket(second_time) - 1)))
    return a.join(b, [*keys, "__bucket"]).where(_inside(F.col(first_time), F.col(second_time), within)).drop("__bucket")


def _bucket(time: Column, within: int) -> Column:
    return F.floor(F.unix_micros(time) / (within * 1_000_000))


def _inside(first: Column, second: Column, within: int) -> Column:
    return (second >= first) & (second <= first + F.expr(f"INTERVAL {within} SECONDS"))


def interval_join_streams(first: DataFrame, second: DataFrame, keys: Sequence[str], first_time: str, second_time: str,
                          within: int = WITHIN_SECONDS, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """The same over two streams (output mode append)."""
    at = _bucket(F.col(first_time), within)
    a = first.withWatermark(first_time, watermark).withColumn("__bucket", F.explode(F.array(at, at + 1))).alias("a")
    b = second.withWatermark(second_time, watermark).withColumn("__bucket", _bucket(F.col(second_time), within)).alias("b")
    same = _inside(F.col(f"a.{first_time}"), F.col(f"b.{second_time}"), within)
    for k in [*keys, "__bucket"]:
        same &= F.col(f"a.{k}") == F.col(f"b.{k}")
    return a.join(b, same).select(*[F.col(f"a.{c}") for c in first.columns], *[F.col(f"b.{c}") for c in second.columns if c not in keys])


def errors(logs: DataFrame, event_time: str = EVENT_TIME) -> DataFrame:
    return logs.where(F.col("response") >= 400).select("host", F.col(event_time).alias("error_time"), F.col("url").alias("error_url"), F.col("response").alias("error_response"))


def successes(logs: DataFrame, event_time: str = EVENT_TIME) -> DataFrame:
    return logs.where(F.col("response").between(200, 299)).select("host", F.col(event_time).alias("success_time"), F.col("url").alias("success_url"))
