"""The batch pipeline: raw rows -> clean -> geolocate -> enrich -> reports -> sinks.

At scale the enriched table is not cached (it is as large as the logs): ``run_batch``
writes it once as Parquet partitioned by date, one scan of that table makes the lattice that all
reports are rolled up from, and every report reads its own folder of the stored lattice. The written
tables also cut the lineage, so a lost executor re-runs a report from Parquet, not from the raw logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.operators.cleaning import _FIRST, clean, kept, typed
from hitscope.operators.enrich import enrich
from hitscope.operators.geo import RangeIndex, build_geo_ranges, geolocate, index_ranges
from hitscope.operators.overlaps import Multiplicity, multiplicity, repeat_by_ranges
from hitscope.operators.reports import lattice, reports_from_lattice
from hitscope.sinks.files import export_reports, write_parquet
from hitscope.sinks.jdbc import write_jdbc
from hitscope.sources.files import read_access_log, read_geo_blocks, read_geo_locations


def enriched_logs(raw: DataFrame, ranges: DataFrame | RangeIndex | Multiplicity, *, strategy: str = "auto",
                  index_col=_FIRST) -> DataFrame:
    """Clean, geolocate and enrich raw log rows (19 columns); with a ``Multiplicity`` the same rows without geo columns."""
    if isinstance(ranges, Multiplicity):
        return enrich(repeat_by_ranges(clean(raw, index_col=index_col), ranges))
    return enrich(geolocate(clean(raw, index_col=index_col), ranges, strategy=strategy))


def pipeline_counts(raw: DataFrame, blocks: DataFrame, locations: DataFrame, *,
                    strategy: str = "auto") -> DataFrame:
    """K9: row count of each stage as one ``(stage, rows)`` frame (one job).

    Raw and cleaned rows are counted in the same pass (``count_if`` of the cleaning
    predicate). Enriched rows are as many unless ranges overlap; only then are the logs
    read again, with the overlaps and without the geo columns."""
    ranges = build_geo_ranges(blocks, locations)
    many = multiplicity(ranges)

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")

    counts = [F.count(F.lit(1)).alias("raw"), F.count_if(kept()).alias("cleaned")]
    if many.index is None:
        counts.append(F.count_if(kept()).alias("enriched"))
    stages = ["raw", "cleaned", "enriched"][: len(counts)]
    raw_and_clean = typed(raw).agg(*counts).unpivot([], stages, "stage", "rows")
    parts = [
        raw_and_clean,
        count(blocks, "geo_blocks"),
        count(locations, "geo_locations"),
        count(ranges, "geo_ranges"),
    ]
    if many.index is not None:
        parts.append(count(enriched_logs(raw, many), "enriched"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def previews(reports: dict[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    """K8: the first ``n`` rows of each report as DataFrames (display is the caller's)."""
    return {name: df.limit(n) for name, df in reports.items()}


def run_batch(spark: SparkSession, raw: DataFrame, blocks: DataFrame, locations: DataFrame,
              out_dir: str, *, jdbc: dict | None = None, report_names: list[str] | None = None,
              strategy: str = "auto", on_error: str = "raise",
              jdbc_enriched: bool = True, replace: str = "all") -> dict[str, DataFrame]:
    """Run the whole batch job and write its outputs under ``out_dir``.

    * ``enriched_logs_parquet/`` (partitioned by ``date``), also to JDBC ``cleaned_logs``
      with 10,000-row batches over at most 8 connections when ``jdbc`` is given (unless
      ``jdbc_enriched=False``: at scale 8 connections cannot take the whole table);
      ``replace="folders"`` replaces only the days that the input has, and the reports are over all days;
    * ``report_base/``: the lattice of the reports (one scan of the enriched table), partitioned by level;
    * one CSV folder per report, and a JDBC table per report when ``jdbc`` is given.

    Returns the reports as DataFrames over the written base.
    """
    out_dir = out_dir.rstrip("/")
    index = index_ranges(build_geo_ranges(blocks, locations), strategy=strategy, persist=True)
    table_path, base_path = f"{out_dir}/enriched_logs_parquet", f"{out_dir}/report_base"
    enriched = enriched_logs(raw, index)
    try:
        write_parquet(enriched, table_path, partition_by=["date"], replace=replace)
    finally:
        index.binned.unpersist()
    # read back with the known schema: an empty input writes no data files to infer from
    stored = spark.read.schema(enriched.schema).parquet(table_path)
    base = lattice(stored, report_names)
    base.write.mode("overwrite").partitionBy("level").parquet(base_path)
    reports = reports_from_lattice(spark.read.schema(base.schema).parquet(base_path), report_names)
    if jdbc and jdbc_enriched:
        write_jdbc(stored, jdbc["url"], "cleaned_logs", jdbc.get("properties"),
                   batchsize=10000, num_partitions=8, on_error=on_error)
    export_reports(reports, f"{out_dir}/reports", jdbc=jdbc, on_error=on_error)
    return reports


def write_corrupt_records(spark: SparkSession, logs: str | list[str], path: str) -> None:
    """The log records whose number of fields does not fit their file's header, as Parquet (idx, record)."""
    marked = read_access_log(spark, logs, corrupt="record")
    marked.where(F.col("record").isNotNull()).select("idx", "record").write.mode("overwrite").parquet(path)


def run_file_job(spark: SparkSession, logs: str | list[str], blocks: str | list[str], locations: str | list[str],
                 out_dir: str, *, corrupt_dir: str | None = None, **options) -> dict[str, DataFrame]:
    """The batch job from CSV files to files (S1-S3 -> K3, K4, K7).

    With ``corrupt_dir`` the log records whose number of fields does not fit their file's header are also
    written there (idx, record) as Parquet; they go through the job as far as their fields can be read, as without it."""
    if corrupt_dir:
        write_corrupt_records(spark, logs, corrupt_dir)
    return run_batch(spark, read_access_log(spark, logs), read_geo_blocks(spark, blocks), read_geo_locations(spark, locations),
                     out_dir, **options)
