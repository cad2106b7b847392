"""The split at the watermark and the four tables from one query."""

import datetime as dt

from pyspark.sql import functions as F

from hitscope.operators.overlaps import Multiplicity
from hitscope.operators.windows import WINDOWED, four_tables, split_tables
from hitscope.plans import catalog
from hitscope.sources.stream import read_record_stream
from hitscope.streaming.late import LateSplit, read_split
from hitscope.streaming.pipeline import enriched_stream

from paths import SF_SMALL

T = dt.datetime(2024, 1, 1, 12)


def batch(spark, *minutes):
    return spark.createDataFrame([(f"h{m}", None if m is None else T + dt.timedelta(minutes=m)) for m in minutes], "host string, timestamp timestamp")


def hosts(spark, path, name):
    return sorted(r.host for r in read_split(spark, path, name).collect())


def test_rows_behind_the_watermark_go_to_the_late_table(spark, scratch):
    split = LateSplit(f"{scratch}/late")
    split.write(batch(spark, 0, 60, None), 0)
    # the watermark is 12:50; the window 12:45 to 12:50 has ended there, the one after has not
    split.write(batch(spark, 47, 50, 10, 61, None), 1)
    assert hosts(spark, split.path, "late") == ["h10", "h47"]
    assert hosts(spark, split.path, "kept") == ["h0", "h50", "h60", "h61", "hNone", "hNone"]
    split.write(batch(spark), 2)
    split.write(batch(spark, 49, 55), 3)
    assert "h49" in hosts(spark, split.path, "late") and "h55" in hosts(spark, split.path, "kept")


def test_a_batch_run_again_is_there_once(spark, scratch):
    split = LateSplit(f"{scratch}/late-again")
    split.write(batch(spark, 60), 0)
    for _ in range(2):
        split.write(batch(spark, 10, 70), 1)
    assert hosts(spark, split.path, "late") == ["h10"] and hosts(spark, split.path, "kept") == ["h60", "h70"]
    marks = spark.read.parquet(f"{split.path}/marks/run=local/batch_id=1").collect()
    assert [r.newest for r in marks] == [T + dt.timedelta(minutes=70)]


def test_four_tables_equal_the_four_queries(spark):
    logs = catalog._enriched(spark, SF_SMALL)
    got = split_tables(four_tables(logs, watermark=None))
    for name, (fn, _keys) in WINDOWED.items():
        want = fn(logs, watermark=None)
        assert got[name].columns == want.columns
        assert sorted(map(tuple, got[name].collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name


def test_four_tables_read_the_records_once(spark, scratch, capsys):
    path = f"{scratch}/four-input"
    spark.createDataFrame([], "value string").write.text(path)
    logs = enriched_stream(read_record_stream(spark, "text", path=path), Multiplicity(None)).withColumn("country_name", F.lit("A"))
    four_tables(logs).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1 and plan.count("StateStoreSave") == 1
    assert "partial_" in plan
