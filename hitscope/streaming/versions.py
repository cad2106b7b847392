"""W8 reader: the newest version of each window from an append-only versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


VERSION = ("run", "batch_id")


def latest_versions(versions: DataFrame, keys: list[str], keep_version: bool = False) -> DataFrame:
    """Keep, per ``window_start, window_end`` + ``keys``, the row of the newest run and, in it, the highest batch id.

    ``max_by`` is an ordinary aggregate (partial on the map side), so a window with many
    versions never gathers its rows in one place; equal versions (a retried append) collapse.
    With ``keep_version`` the result says which version it is.
    """
    group = ["window_start", "window_end", *keys]
    values = [c for c in versions.columns if c not in group and (keep_version or c not in VERSION)]
    order = F.struct(*[F.col(c) for c in VERSION if c in versions.columns])
    packed = F.struct(*[F.col(c) for c in values])
    newest = versions.groupBy(*group).agg(F.max_by(packed, order).alias("_v"))
    return newest.select(*group, *[F.col(f"_v.{c}").alias(c) for c in values])


def read_versions(spark, path: str) -> DataFrame:
    """Read a ``ParquetBatchTarget`` directory (``run`` and ``batch_id`` come from the folder names)."""
    return spark.read.option("basePath", path).parquet(path)
