"""K3/K4/K7: report files and the enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hitscope.sinks.jdbc import write_jdbc


def export_csv(df: DataFrame, path: str, *, single_file: bool = True) -> None:
    """K3: CSV with a header, overwrite. One file for (small) reports only: never use it
    for a table that grows with the logs."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None, replace: str = "all") -> None:
    """K4: Parquet, overwrite, optionally partitioned (``date`` for the enriched table).

    ``replace="folders"`` overwrites only the folders that the rows fall into (a job run again for some days
    leaves the other days as they are); ``"all"`` replaces the table.

    Partitioned rows are rebalanced by the folder columns first: without that every task writes a file
    into every folder. Spark splits a large folder by size, so a hot day is not one task's work."""
    if replace not in ("all", "folders"):
        raise ValueError(f"unknown replace {replace!r}")
    if replace == "folders" and not partition_by:
        raise ValueError('replace="folders" needs partition_by')
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    else:
        writer = df.write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic" if replace == "folders" else "static").parquet(path)


def export_reports(reports: dict[str, DataFrame], csv_dir: str | None = None, *,
                   jdbc: dict | None = None, on_error: str = "raise") -> dict[str, bool]:
    """K7: every report to ``csv_dir/<name>`` and/or a JDBC table of the same name.

    A report is computed once: it is cached (it is small, one row per group) for the
    two writes, then released. ``jdbc`` holds ``url`` and ``properties``."""
    written = {}
    for name, df in reports.items():
        cached = df.persist() if (csv_dir and jdbc) else df
        try:
            if csv_dir:
                export_csv(cached, f"{csv_dir.rstrip('/')}/{name}")
            ok = True
            if jdbc:
                ok = write_jdbc(cached, jdbc["url"], name, jdbc.get("properties"),
                                mode="overwrite", on_error=on_error)
            written[name] = ok
        finally:
            if cached is not df:
                cached.unpersist()
    return written
