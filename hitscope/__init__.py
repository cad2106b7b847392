"""hitscope: web access-log analytics on PySpark, batch and streaming.

The same DataFrame functions serve bounded and unbounded inputs:

    raw rows -> clean -> geolocate (binned range join) -> enrich -> reports / windows

Everything is expressed with ``pyspark.sql.functions``; there are no Python UDFs.
"""

from hitscope.operators.cleaning import clean
from hitscope.operators.enrich import enrich
from hitscope.operators.geo import build_geo_ranges, geolocate, index_ranges
from hitscope.operators.reports import REPORTS, run_reports
from hitscope.operators.windows import WINDOWED
from hitscope.plans.batch import enriched_logs, pipeline_counts, run_batch
from hitscope.session import configure
from hitscope.streaming.pipeline import enriched_stream
from hitscope.streaming.versions import latest_versions

__all__ = [
    "REPORTS",
    "WINDOWED",
    "build_geo_ranges",
    "clean",
    "configure",
    "enrich",
    "enriched_logs",
    "enriched_stream",
    "geolocate",
    "index_ranges",
    "latest_versions",
    "pipeline_counts",
    "run_batch",
    "run_reports",
]
