"""Late rows to a table of their own, instead of nowhere.

A windowed query drops rows whose window the watermark has passed. Here a stateless query in front of it
splits each micro-batch at the watermark: rows that are still in time go to ``kept``, late ones to ``late``,
each batch in a folder of its own that a retry overwrites, so every row is in exactly one of the two,
once. The watermark is the one that the windowed query would have: the newest event time of the batches before
less the delay. It is kept beside the data (``marks``, one row a batch, written after both), not in
memory, so a restarted query goes on from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitscope.operators.windows import EVENT_TIME, WATERMARK_DELAY, WINDOW_SECONDS
from hitscope.streaming.sink import LOCAL_RUN, start_query


def is_late(event_time: Column, newest: Column, delay: str = WATERMARK_DELAY, window_seconds: int = WINDOW_SECONDS) -> Column:
    """Whether the window of ``event_time`` ends at or before the watermark; rows without a time are in no window and never late."""
    watermark = newest - F.expr(f"INTERVAL {delay}")
    # not by F.window, which takes rows without a time out of the frame
    second = F.unix_seconds(event_time)
    end = F.timestamp_seconds(second - F.pmod(second, F.lit(window_seconds)) + window_seconds)
    return F.coalesce(end <= watermark, F.lit(False))


@dataclass(frozen=True)
class LateSplit:
    """Target of the splitting query: ``path/kept``, ``path/late`` and ``path/marks``, a folder a batch in each."""

    path: str
    event_time: str = EVENT_TIME
    delay: str = WATERMARK_DELAY
    window_seconds: int = WINDOW_SECONDS

    def folder(self, name: str, run: str, batch_id: int) -> str:
        return f"{self.path}/{name}/run={run}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int, run: str = LOCAL_RUN) -> None:
        spark, rows = df.sparkSession, df.drop("run", "batch_id")
        before = None
        if batch_id > 0:  # every batch leaves a mark, empty ones too
            before = spark.read.schema("newest timestamp").parquet(self.folder("marks", run, batch_id - 1)).first()["newest"]
        mark = F.lit(before).cast("timestamp")
        late = is_late(F.col(self.event_time), mark, self.delay, self.window_seconds)
        for name, part in (("kept", rows.where(~late)), ("late", rows.where(late))):
            part.hint("rebalance").write.mode("overwrite").parquet(self.folder(name, run, batch_id))
        newest = rows.agg(F.greatest(F.max(self.event_time), mark).alias("newest"))
        newest.write.mode("overwrite").parquet(self.folder("marks", run, batch_id))


def start_late_split(rows: DataFrame, path: str, checkpoint: str, *, name: str = "late_split", trigger: dict | None = None, **options) -> StreamingQuery:
    """Split a stream of rows (not aggregated) at the watermark into ``path/kept`` and ``path/late``."""
    return start_query(rows, name, LateSplit(path, **options), checkpoint, output_mode="append", trigger=trigger, skip_empty=False)


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of ``kept`` or ``late`` of all runs and batches."""
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}").drop("run", "batch_id")
