"""Plan guards for every registered batch query (the shapes that matter at scale)."""

import re

import pytest

from paths import SF_SMALL
from hitscope.plans.catalog import QUERIES

BATCH = [n for n in sorted(QUERIES) if not n.startswith("stream_")
         and n not in ("latest_windows", "latest_windows_two_checkpoints", "latest_error_rate")]
# the groups of a share, of the lattice and of the file job are written once and read; what is planned last reads no log
STORED = {"error_analysis", "url_category_distribution", "method_distribution", "client_error_rate", "category_slice", "all_reports",
          "file_job_enriched", "file_job_reports", "geo_ranges", "geo_ranges_wide", "geo_overlaps", "requests_with_error_rate", "latest_windows_manifest"}
# one scan a report, but those whose groups are stored; with overlaps K9 reads the logs for the rows that they add
SEVERAL_SCANS = {"previews_of_reports": 12, "pipeline_counts_with_overlaps": 2, "run_difference": 2, "recovered_errors": 2}


def _final_plan(df):
    """The executed adaptive plan, without its (top-level) initial-plan copy."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "AdaptiveSparkPlan" not in plan:  # nothing is shuffled
        return plan
    assert "isFinalPlan=true" in plan.splitlines()[0]
    return plan.split("\n+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", BATCH)
def test_plan_shape(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in plan, (name, bad)
    assert "NestedLoopJoin" not in plan, name
    # nothing is shuffled between the scan and the first operator that needs it
    assert "REPARTITION_BY" not in plan, name
    scans = len(re.findall(r"FileScan parquet [^\n]*events\.parquet", plan))
    assert scans == (0 if name in STORED else SEVERAL_SCANS.get(name, 1)), (name, scans)


def _scans(df):
    return len(re.findall(r"FileScan parquet [^\n]*events\.parquet", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]))


@pytest.mark.parametrize("name", ["error_analysis", "url_category_distribution", "method_distribution", "client_error_rate", "category_slice", "all_reports", "pipeline_counts"])
def test_one_scan_of_the_logs_in_all(spark, monkeypatch, name):
    """The whole query, with what it stores on the way, reads the logs once."""
    from pyspark.sql.readwriter import DataFrameWriter

    written = []
    store = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **kw: (written.append(_scans(self._df)), store(self, *args, **kw))[1])
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    assert sum(written) + _scans(df) == 1


def test_reports_read_the_enriched_table_once(spark, scratch):
    from hitscope.operators import reports
    from hitscope.plans.batch import run_batch
    from hitscope.sources import testdata

    out = f"{scratch}/one_pass"
    made = run_batch(spark, testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL), testdata.geo_locations(spark, SF_SMALL), out)
    stored = spark.read.parquet(f"{out}/enriched_logs_parquet")
    for name, df in made.items():
        plan = _final_plan(df)
        assert "enriched_logs_parquet" not in plan and re.search(r"PartitionFilters: \[[^\]]*level", plan), name
        alone = reports.REPORTS[name](stored)
        assert df.columns == alone.columns
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, alone.collect()), key=str), name
    plan = _final_plan(reports.lattice(stored))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_date_slicer_prunes_partitions(spark, scratch):
    """F1 over the stored enriched table (partitioned by date) reads only the chosen days."""
    from hitscope.operators import measures, reports
    from hitscope.plans.batch import run_batch
    from hitscope.sources import testdata

    out = f"{scratch}/pruning"
    run_batch(spark, testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL),
              testdata.geo_locations(spark, SF_SMALL), out, report_names=["hourly_traffic"])
    stored = spark.read.parquet(f"{out}/enriched_logs_parquet")
    sliced = measures.daily_traffic_between(reports.daily_traffic(stored), "2024-01-05", "2024-01-06")
    plan = _final_plan(sliced)
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan), plan
    assert len(sliced.collect()) == 2
    # and a report reads only the columns it needs
    assert re.search(r"ReadSchema: struct<host:string>", _final_plan(reports.daily_traffic(stored)))


@pytest.mark.parametrize("name", ["stream_requests_by_country", "stream_traffic_volume"])
def test_stream_plan_shape(spark, scratch, capsys, name):
    """Streaming plans: JSON parsed once, broadcast geo join, partial aggregate before the
    stateful shuffle, no Python evaluation."""
    from hitscope.operators.windows import WINDOWED
    from hitscope.plans import catalog
    from hitscope.sources.stream import read_record_stream
    from hitscope.streaming.pipeline import enriched_stream

    path = f"{scratch}/plan-input-{name}"
    spark.createDataFrame([], "value string").write.text(path)
    fn, _keys = WINDOWED[name]
    fn(enriched_stream(read_record_stream(spark, "text", path=path), catalog._index(spark, SF_SMALL))).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1, plan
    assert "BroadcastHashJoin" in plan and "StateStoreSave" in plan
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoopJoin", "CartesianProduct"):
        assert bad not in plan
