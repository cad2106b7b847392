"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame`` over the test tables.

Each reads the whole tables (through the log-shaped adapter) and returns a lazy
DataFrame; the stream queries run their stream to the end of the input first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.functions.sql import register_sql_functions
from hitscope.operators import host_sketches, measures, reports
from hitscope.operators.asof import asof_join
from hitscope.operators.cleaning import clean
from hitscope.operators.difference import run_difference
from hitscope.operators.interval import errors, interval_join, successes
from hitscope.operators.sessions import host_sessions
from hitscope.operators.windows import WINDOWED, requests_by_url_category, windowed
from hitscope.operators.geo import GEO_COLUMNS, RangeIndex, build_geo_ranges, geolocate, index_ranges
from hitscope.operators.overlaps import Multiplicity, multiplicity, overlaps
from hitscope.plans.batch import enriched_logs, pipeline_counts, previews, run_file_job
from hitscope.plans.streams import (
    replay_four_tables,
    replay_in_two_parts,
    replay_late_split,
    replay_manifest,
    replay_recovered_errors,
    replay_late_rows,
    replay_sessions,
    replay_staged,
    replay_windowed,
    replay_with_two_checkpoints,
    write_record_input,
)
from hitscope.session import configure, scratch_path
from hitscope.sinks.records import encode_records
from hitscope.sources import testdata
from hitscope.sources.stream import decode_records

Query = Callable[[SparkSession, str], DataFrame]

# Fixed slicer parameters of the registered dashboard queries.
DATE_RANGE = ("2024-01-05", "2024-01-20")
COUNTRIES = ["NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_21"]
CATEGORIES = ["Shuttle", "Images", "Homepage", "CGI"]
HOURS = (8, 17)


_RAW: dict[tuple[str, str], DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-shaped input (a lazy plan, resolved once per session and folder)."""
    configure(spark)
    key = _key(spark, sf_dir)
    if key not in _RAW:
        _RAW[key] = testdata.raw_logs(spark, sf_dir)
    return _RAW[key]


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return build_geo_ranges(testdata.geo_blocks(spark, sf_dir), testdata.geo_locations(spark, sf_dir))


_INDEXES: dict[tuple[str, str], RangeIndex] = {}


def _index(spark: SparkSession, sf_dir: str) -> RangeIndex:
    """One measured, persisted range index per session and input folder (the geo
    table is a small dimension: built once, reused by every query)."""
    key = _key(spark, sf_dir)
    if key not in _INDEXES:
        _INDEXES[key] = index_ranges(_ranges(spark, sf_dir), persist=True)
    return _INDEXES[key]


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_logs(_raw(spark, sf_dir), _index(spark, sf_dir))


def _report(name: str) -> Query:
    """A report over its own scan; one without a geo key reads the same rows without geo columns (no lookup of addresses
    unless ranges overlap)."""
    geo = any(key in GEO_COLUMNS for key in reports.REPORT_KEYS[name])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        logs = _enriched(spark, sf_dir) if geo else enriched_logs(_raw(spark, sf_dir), _many(spark, sf_dir))
        return reports.REPORTS[name](logs, None)

    return run


def ip_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G3 through the registered SQL functions, on every raw host."""
    register_sql_functions(spark)
    return _raw(spark, sf_dir).select(
        "host",
        F.expr("is_ip_address(host)").alias("is_ip_address"),
        F.expr("ip_to_long(host)").alias("ip_to_long"),
    )


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K11 -> S5 round trip, then the stream cleaner."""
    records = encode_records(_raw(spark, sf_dir))
    return clean(decode_records(records, keep=["key"]), index_col=None)


_RECORD_INPUTS: dict[tuple[str, str], str] = {}


def _records(spark: SparkSession, sf_dir: str) -> str:
    """The log rows encoded as stream records once per session and input folder."""
    key = _key(spark, sf_dir)
    if key not in _RECORD_INPUTS:
        _RECORD_INPUTS[key] = write_record_input(spark, _raw(spark, sf_dir))
    return _RECORD_INPUTS[key]


_MANY: dict[tuple[str, str], Multiplicity] = {}


def _many(spark: SparkSession, sf_dir: str) -> Multiplicity:
    """The overlaps of the geo ranges, swept once per session and input folder."""
    key = _key(spark, sf_dir)
    if key not in _MANY:
        _MANY[key] = multiplicity(_ranges(spark, sf_dir), persist=True)
    return _MANY[key]


def _stream(name: str, *, geo: bool = True, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return replay_windowed(spark, None, (_index if geo else _many)(spark, sf_dir), name,
                               input_dir=_records(spark, sf_dir), **kw)
    return run


def _wide_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return build_geo_ranges(testdata.geo_blocks_wide(spark, sf_dir), testdata.geo_locations_wide(spark, sf_dir))


def _wide_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return testdata.raw_logs_wide(spark, sf_dir)


def geo_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of addresses that two and more ranges hold, by the distributed sweep."""
    return overlaps(_wide_ranges(spark, sf_dir))


def url_categories_with_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 over overlapping ranges without geo columns: rows count as often as ranges hold their address."""
    logs = enriched_logs(_wide_logs(spark, sf_dir), multiplicity(_wide_ranges(spark, sf_dir)))
    return requests_by_url_category(logs, watermark=None)


def pipeline_counts_with_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 where enriched rows are more than cleaned ones."""
    return pipeline_counts(_wide_logs(spark, sf_dir), testdata.geo_blocks_wide(spark, sf_dir), testdata.geo_locations_wide(spark, sf_dir))


def all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A15 from one scan of the logs, as one long table."""
    path = scratch_path(spark, "report_base")
    base = reports.lattice(_enriched(spark, sf_dir))
    base.write.partitionBy("level").parquet(path)
    return reports.long_table(reports.reports_from_lattice(spark.read.schema(base.schema).parquet(path)))


def _file_job(spark: SparkSession, sf_dir: str) -> str:
    """The job from CSV files to files: log files of two layouts in one folder, some with records too short or long."""
    root = scratch_path(spark, "file_job")
    raw = _wide_logs(spark, sf_dir)
    first = F.col("idx").cast("long") % 2 == 0
    write = lambda df, name: df.write.option("header", True).option("quote", '"').option("escape", '"').mode("append").csv(f"{root}/{name}")
    write(raw.where(first), "logs")
    write(raw.where(~first).select(F.col("idx").alias("n"), "bytes", "response", F.lit("a,\"b\"").alias("agent"), "url", "method", "time", "host"), "logs")
    write(testdata.geo_blocks_wide(spark, sf_dir), "blocks")
    write(testdata.geo_locations_wide(spark, sf_dir).select("continent_code", "country_iso_code", "geoname_id", "continent_name", "country_name"), "locations")
    run_file_job(spark, f"{root}/logs", f"{root}/blocks", f"{root}/locations", f"{root}/out")
    return f"{root}/out"


def file_job_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table that the file job wrote."""
    return spark.read.parquet(f"{_file_job(spark, sf_dir)}/enriched_logs_parquet")


def file_job_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K7: the CSV files of all reports that the file job wrote, read back as one long table."""
    out = _file_job(spark, sf_dir)
    text = {name: spark.read.option("header", True).csv(f"{out}/reports/{name}") for name in reports.REPORT_KEYS}
    return reports.long_table(text)


def previews_of_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the first five rows of each report, as one long table."""
    return reports.long_table(previews({name: _report(name)(spark, sf_dir) for name in reports.REPORTS}, 5))


def stream_requests_by_country_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 through the staged layout (records enriched once into a table, then windowed)."""
    return replay_staged(spark, _records(spark, sf_dir), _index(spark, sf_dir), "stream_requests_by_country")


#: Largest error of the distinct-host estimate: three times its documented standard error of 5 %.
HOST_ERROR = 0.15


def stream_traffic_volume_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 in full: each window with its exact hosts, and whether the stream's estimate is near them."""
    found = replay_windowed(spark, None, _many(spark, sf_dir), "stream_traffic_volume", input_dir=_records(spark, sf_dir))
    exact = windowed(_enriched(spark, sf_dir), [], [F.count_distinct("host").alias("exact_hosts")], watermark=None)
    near = F.abs(F.col("unique_hosts") - F.col("exact_hosts")) <= F.greatest(F.lit(1.0), HOST_ERROR * F.col("exact_hosts"))
    return found.join(exact, ["window_start", "window_end"]).withColumn("estimate_ok", near).drop("unique_hosts")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row arrives after the others; what the watermark has passed by then is dropped."""
    late = F.col("idx").cast("long") % 3 == 0
    return replay_late_rows(spark, _raw(spark, sf_dir), _many(spark, sf_dir), "stream_error_rate", late)


def latest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error-rate windows from two runs over one checkpoint; the newest version of each window."""
    return replay_in_two_parts(spark, _raw(spark, sf_dir), _many(spark, sf_dir), "stream_error_rate")[1]


def latest_windows_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 after a change that needs a new checkpoint: the newest run's windows are read."""
    return replay_with_two_checkpoints(spark, _raw(spark, sf_dir), _many(spark, sf_dir), "stream_error_rate")[1]


def stream_four_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 as one query: the four tables from one read of the records, as one long table."""
    metrics = {"requests": "long", "total_bytes": "long", "avg_bytes": "double", "error_requests": "long", "error_rate_pct": "double", "total_mb": "double"}
    parts = []
    for name, df in replay_four_tables(spark, _records(spark, sf_dir), _index(spark, sf_dir)).items():
        key = F.col(WINDOWED[name][1][0]) if WINDOWED[name][1] else F.lit(None).cast("string")
        df = df.withColumnRenamed("total_requests", "requests")
        values = [(F.col(m) if m in df.columns else F.lit(None)).cast(t).alias(m) for m, t in metrics.items()]
        parts.append(df.select(F.lit(name).alias("table_name"), "window_start", "window_end", key.alias("key"), *values))
    return reduce(DataFrame.unionByName, parts)


def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row arrives after the others: each row once, and whether it went to the late table."""
    kept, late = replay_late_split(spark, _raw(spark, sf_dir), F.col("idx").cast("long") % 3 == 0)
    columns = ["host", "time", "method", "url", "response", "bytes"]
    return kept.select(*columns, F.lit(False).alias("late")).unionByName(late.select(*columns, F.lit(True).alias("late")))


def hosts_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hosts by day, month and in all, with and without the country, merged from stored daily sketches."""
    path = scratch_path(spark, "host_sketches")
    enriched = _enriched(spark, sf_dir)
    host_sketches.write_sketches(enriched, path)
    return host_sketches.checked_hosts(host_sketches.read_sketches(spark, path), enriched)


def requests_with_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request with the error rate of its host's last 5-minute window that had ended by then."""
    logs = _enriched_without_geo(spark, sf_dir).select("host", "url", "response", "bytes", "timestamp")
    rate = F.round(F.count_if(F.col("response") >= 400) / F.count(F.lit(1)) * 100, 2).alias("error_rate_pct")
    rates = windowed(logs, ["host"], [rate], watermark=None)
    return asof_join(logs, rates, "host", "timestamp", "window_end", ["window_end", "error_rate_pct"])


def _enriched_without_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_logs(_raw(spark, sf_dir), Multiplicity(None))


#: Seconds within which a success after an error counts (the test rows are too thin for the default).
RECOVERED_WITHIN = 3600


def recovered_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and the successes of the same host within an hour after them."""
    logs = _enriched_without_geo(spark, sf_dir)
    return interval_join(errors(logs), successes(logs), ["host"], "error_time", "success_time", RECOVERED_WITHIN)


def latest_windows_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 through a table with snapshots: the newest windows after compaction."""
    return replay_manifest(spark, _records(spark, sf_dir), _many(spark, sf_dir), "stream_error_rate").latest(spark)


def run_difference_of_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs over the two fixtures have in common and not, by columns in which rows repeat."""
    return run_difference(clean(_raw(spark, sf_dir)), clean(_wide_logs(spark, sf_dir)), ["host", "method", "response", "bytes"])


def _measure(fn, source: Query, *args) -> Query:
    return lambda spark, sf_dir: fn(source(spark, sf_dir), *args)


QUERIES: dict[str, Query] = {
    "clean_logs": lambda spark, sf_dir: clean(_raw(spark, sf_dir)),
    "ip_functions": ip_functions,
    "geo_ranges": _ranges,
    "geolocate_logs": lambda spark, sf_dir: geolocate(clean(_raw(spark, sf_dir)), _index(spark, sf_dir)),
    "geolocate_logs_shuffled": lambda spark, sf_dir: geolocate(
        clean(_raw(spark, sf_dir)), _ranges(spark, sf_dir), strategy="shuffle"),
    "enrich_logs": _enriched,
    **{name: _report(name) for name in reports.REPORTS},
    "stream_requests_by_country": _stream("stream_requests_by_country"),
    "stream_requests_by_url_category": _stream("stream_requests_by_url_category", geo=False),
    "stream_error_rate": _stream("stream_error_rate", geo=False),
    "stream_traffic_volume": _stream("stream_traffic_volume", geo=False, with_unique_hosts=False),
    "stream_traffic_volume_hosts": stream_traffic_volume_hosts,
    "stream_late_rows": stream_late_rows,
    "stream_requests_by_country_staged": stream_requests_by_country_staged,
    "latest_windows": latest_windows,
    "latest_windows_two_checkpoints": latest_windows_two_checkpoints,
    "json_records": json_records,
    "pipeline_counts": lambda spark, sf_dir: pipeline_counts(
        _raw(spark, sf_dir), testdata.geo_blocks(spark, sf_dir), testdata.geo_locations(spark, sf_dir)),
    "client_error_rate": _measure(measures.client_error_rate, _report("error_analysis")),
    "total_megabytes": _measure(measures.total_megabytes, _report("daily_bandwidth")),
    "peak_hour": _measure(measures.peak_hour, _report("hourly_traffic")),
    "latest_error_rate": _measure(measures.latest_error_rate, latest_windows),
    "daily_traffic_between": _measure(measures.daily_traffic_between, _report("daily_traffic"), *DATE_RANGE),
    "country_slice": _measure(measures.country_slice, _report("traffic_by_country"), COUNTRIES),
    "category_slice": _measure(measures.category_slice, _report("url_category_distribution"), CATEGORIES),
    "hour_slice": _measure(measures.hour_slice, _report("hourly_traffic"), *HOURS),
    "hosts_by_period": hosts_by_period,
    "host_sessions": lambda spark, sf_dir: host_sessions(_enriched_without_geo(spark, sf_dir)),
    "stream_host_sessions": lambda spark, sf_dir: replay_sessions(spark, _records(spark, sf_dir)),
    "requests_with_error_rate": requests_with_error_rate,
    "run_difference": run_difference_of_logs,
    "recovered_errors": recovered_errors,
    "stream_recovered_errors": lambda spark, sf_dir: replay_recovered_errors(spark, _records(spark, sf_dir), RECOVERED_WITHIN),
    "latest_windows_manifest": latest_windows_manifest,
    "stream_four_tables": stream_four_tables,
    "stream_late_split": stream_late_split,
    "clean_logs_wide": lambda spark, sf_dir: clean(_wide_logs(spark, sf_dir)),
    "geo_ranges_wide": _wide_ranges,
    "geolocate_logs_wide": lambda spark, sf_dir: geolocate(clean(_wide_logs(spark, sf_dir)), _wide_ranges(spark, sf_dir)),
    "geo_overlaps": geo_overlaps,
    "url_categories_with_overlaps": url_categories_with_overlaps,
    "pipeline_counts_with_overlaps": pipeline_counts_with_overlaps,
    "all_reports": all_reports,
    "file_job_enriched": file_job_enriched,
    "file_job_reports": file_job_reports,
    "previews_of_reports": previews_of_reports,
    "heatmap_matrix": _measure(measures.heatmap_matrix, _report("country_hour_heatmap")),
}

# Registered without a SQL oracle.
ROWS_ONLY: set[str] = set()
