"""One projection and one filter, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIRST = object()


def typed(df: DataFrame, index_col=_FIRST) -> DataFrame:
    """Drop the index column, trim text, type numbers, default bytes.

    * C3: by default the first column whatever its name (batch CSV) is dropped;
      ``index_col=None`` keeps all columns (stream records).
    * C4: trim ``host``, ``method``, ``url`` (spaces only).
    * C5: ``time``/``bytes`` -> long, ``response`` -> int; a bad value becomes NULL
      (``try_cast``, so ANSI mode cannot fail the job).
    * C8: NULL ``bytes`` -> 0. ``method`` and ``time`` may stay NULL.
    """
    if index_col is _FIRST:
        df = df.drop(df.columns[0])
    elif index_col is not None:
        df = df.drop(index_col)
    return df.withColumns({
        "host": F.trim(F.col("host")),
        "method": F.trim(F.col("method")),
        "url": F.trim(F.col("url")),
        "time": F.col("time").try_cast("long"),
        "response": F.col("response").try_cast("int"),
        "bytes": F.coalesce(F.col("bytes").try_cast("long"), F.lit(0).cast("long")),
    })


def kept() -> Column:
    """C6/C7 on typed rows: a ``response``, and a non-empty ``host`` and ``url``."""
    return (
        F.col("response").isNotNull()
        & F.col("host").isNotNull() & (F.col("host") != "")
        & F.col("url").isNotNull() & (F.col("url") != "")
    )


def clean(df: DataFrame, index_col=_FIRST) -> DataFrame:
    """Type and filter raw log rows (C1 batch; ``index_col=None`` is C2, streams)."""
    return typed(df, index_col).where(kept())
