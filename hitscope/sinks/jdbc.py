"""JDBC tables. Connection settings are always passed in, never defaulted."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None, *,
                 batchsize: int | None = None, num_partitions: int | None = None) -> dict[str, str]:
    """Writer options. ``num_partitions`` caps concurrent connections (Spark coalesces
    to it), ``batchsize`` sets rows per insert round trip (K2 uses 10,000 and 8)."""
    if not url or not table:
        raise ValueError("url and table are required")
    opts = {"url": url, "dbtable": table, **{k: str(v) for k, v in (properties or {}).items()}}
    if batchsize is not None:
        opts["batchsize"] = str(int(batchsize))
    if num_partitions is not None:
        opts["numPartitions"] = str(int(num_partitions))
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *,
               mode: str = "overwrite", batchsize: int | None = None,
               num_partitions: int | None = None, on_error: str = "raise") -> bool:
    """Write ``df`` to ``table``. Returns False when ``on_error="skip"`` swallowed a failure."""
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")
    opts = jdbc_options(url, table, properties, batchsize=batchsize, num_partitions=num_partitions)
    try:
        df.write.format("jdbc").options(**opts).mode(mode).save()
        return True
    except Exception:  # noqa: BLE001
        if on_error == "raise":
            raise
        log.warning("JDBC write to %s failed; skipped", table, exc_info=True)
        return False
