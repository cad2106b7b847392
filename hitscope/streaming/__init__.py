"""Structured Streaming: the batch operators on ``readStream`` frames, a versioned
``foreachBatch`` sink, and the reader that keeps the newest version of each window."""

from hitscope.streaming.pipeline import enriched_stream
from hitscope.streaming.sink import (
    ParquetBatchTarget,
    JdbcBatchTarget,
    start_windowed_queries,
    start_query,
    versioned_batch_writer,
)
from hitscope.streaming.staging import read_enriched_table, start_enriched_table
from hitscope.streaming.versions import latest_versions

__all__ = [
    "JdbcBatchTarget",
    "ParquetBatchTarget",
    "enriched_stream",
    "latest_versions",
    "read_enriched_table",
    "start_enriched_table",
    "start_query",
    "start_windowed_queries",
    "versioned_batch_writer",
]
