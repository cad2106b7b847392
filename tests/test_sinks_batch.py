"""K1-K4, K7, K9, K10 and the whole batch run, written to a fresh scratch folder.

No database is started: JDBC is checked through its options and through the
skip-on-error path with a URL no driver accepts (no connection is attempted).
"""

import os

import pytest

from hitscope.plans.batch import pipeline_counts, run_batch
from hitscope.sinks.files import export_csv, write_parquet
from hitscope.sinks.jdbc import jdbc_options, write_jdbc
from hitscope.sources import testdata
from hitscope.sources.files import read_access_log, read_geo_blocks, read_geo_locations

from paths import SF_SMALL


def test_jdbc_options_and_skip(spark):
    opts = jdbc_options("jdbc:postgresql://db/x", "t", {"user": "u"}, batchsize=10000, num_partitions=8)
    assert opts == {"url": "jdbc:postgresql://db/x", "dbtable": "t", "user": "u",
                    "batchsize": "10000", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc_options("", "t")
    df = spark.createDataFrame([(1,)], "a int")
    assert write_jdbc(df, "jdbc:hitscope-no-such-driver:x", "t", on_error="skip") is False
    with pytest.raises(Exception):
        write_jdbc(df, "jdbc:hitscope-no-such-driver:x", "t")


def test_csv_and_parquet(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    export_csv(df, f"{scratch}/csv_out")
    parts = [f for f in os.listdir(f"{scratch}/csv_out") if f.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.option("header", True).csv(f"{scratch}/csv_out")
    assert sorted(tuple(r) for r in back.collect()) == [("a", "1"), ("b", "2")]
    write_parquet(df, f"{scratch}/pq_out", partition_by=["k"])
    assert {"k=a", "k=b"} <= set(os.listdir(f"{scratch}/pq_out"))


def test_csv_sources(spark, scratch):
    path = f"{scratch}/raw_csv"
    os.makedirs(path)
    with open(f"{path}/log.csv", "w") as fh:
        fh.write('"",host,time,method,url,response,bytes\n'
                 '0,"a.b",804571201,GET,"/x,""y""",200,\n')
    with open(f"{scratch}/blocks.csv", "w") as fh:
        fh.write("network,geoname_id,registered_country_geoname_id\n10.0.0.0/8,7,7\n")
    with open(f"{scratch}/locations.csv", "w") as fh:
        fh.write("geoname_id,locale_code,continent_code,continent_name,country_iso_code,country_name\n"
                 "7,en,EU,Europe,FR,France\n")
    row = read_access_log(spark, path).first()
    assert (row.host, row.url, row.bytes) == ("a.b", '/x,"y"', None)
    assert [tuple(r) for r in read_geo_blocks(spark, f"{scratch}/blocks.csv").collect()] == [("10.0.0.0/8", 7)]
    assert [tuple(r) for r in read_geo_locations(spark, f"{scratch}/locations.csv").collect()] == [
        (7, "France", "Europe", "FR", "EU")]


def test_pipeline_counts(spark):
    counts = {r.stage: r.rows for r in pipeline_counts(
        testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL),
        testdata.geo_locations(spark, SF_SMALL)).collect()}
    assert counts["raw"] == 1000 and counts["geo_blocks"] == 33 and counts["geo_locations"] == 25
    assert counts["geo_ranges"] == 33 and counts["enriched"] == counts["cleaned"] > 900


def test_run_batch(spark, scratch):
    out = f"{scratch}/batch_run"
    reports = run_batch(spark, testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL),
                        testdata.geo_locations(spark, SF_SMALL), out)
    assert len(reports) == 15
    assert os.path.isdir(f"{out}/enriched_logs_parquet") and any(
        d.startswith("date=") for d in os.listdir(f"{out}/enriched_logs_parquet"))
    for name in reports:
        files = [f for f in os.listdir(f"{out}/reports/{name}") if f.endswith(".csv")]
        assert len(files) == 1, name
    pct = reports["error_analysis"].agg({"percentage": "sum"}).first()[0]
    assert abs(pct - 100.0) < 0.1


def test_previews(spark):
    from hitscope.plans.batch import previews

    reports = {"a": spark.range(100), "b": spark.range(3)}
    got = {k: v.count() for k, v in previews(reports, 5).items()}
    assert got == {"a": 5, "b": 3}


def test_run_batch_survives_database_down(spark, scratch):
    out = f"{scratch}/batch_run_nodb"
    jdbc = {"url": "jdbc:hitscope-no-such-driver:x", "properties": {"user": "u"}}
    reports = run_batch(spark, testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL),
                        testdata.geo_locations(spark, SF_SMALL), out, jdbc=jdbc,
                        report_names=["hourly_traffic", "top_hosts"], on_error="skip")
    assert set(reports) == {"hourly_traffic", "top_hosts"}
    assert os.path.isdir(f"{out}/reports/top_hosts")


def test_shared_bases_equal_separate_reports(spark):
    from hitscope.operators.reports import run_reports
    from hitscope.plans import catalog

    enriched = catalog._enriched(spark, SF_SMALL)
    separate, none_shared = run_reports(enriched)
    shared, bases = run_reports(enriched, share=True)
    assert none_shared == [] and len(bases) == 3
    try:
        for name in separate:
            assert shared[name].columns == separate[name].columns, name
            assert sorted(map(tuple, shared[name].collect())) == sorted(map(tuple, separate[name].collect())), name
    finally:
        for b in bases:
            b.unpersist()


def test_access_log_by_header_names(spark, scratch):
    path = f"{scratch}/raw_csv_reordered"
    os.makedirs(path)
    with open(f"{path}/log.csv", "w") as fh:
        fh.write("n,url,host,bytes,time,response,method\n7,/a,h,12,804571201,200,GET\n")
    row = read_access_log(spark, path).first()
    assert tuple(row) == ("7", "h", "804571201", "GET", "/a", "200", "12")


def test_run_batch_on_empty_input(spark, scratch):
    from hitscope.schemas import RAW_LOG

    empty = spark.createDataFrame([], RAW_LOG)
    reports = run_batch(spark, empty, testdata.geo_blocks(spark, SF_SMALL), testdata.geo_locations(spark, SF_SMALL),
                        f"{scratch}/batch_empty")
    assert all(df.count() == 0 for df in reports.values())


def test_access_log_from_parquet(spark, scratch):
    raw = testdata.raw_logs(spark, SF_SMALL)
    raw.write.parquet(f"{scratch}/raw_parquet")
    back = read_access_log(spark, f"{scratch}/raw_parquet", fmt="parquet")
    assert back.columns == raw.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))


def test_run_batch_reports_only_to_jdbc(spark, scratch, monkeypatch):
    import hitscope.plans.batch as batch

    tables = []
    monkeypatch.setattr(batch, "write_jdbc", lambda df, url, table, *a, **k: tables.append(table))
    import hitscope.sinks.files as files
    monkeypatch.setattr(files, "write_jdbc", lambda df, url, table, *a, **k: tables.append(table) or True)
    run_batch(spark, testdata.raw_logs(spark, SF_SMALL), testdata.geo_blocks(spark, SF_SMALL),
              testdata.geo_locations(spark, SF_SMALL), f"{scratch}/batch_reports_only",
              jdbc={"url": "jdbc:x:y"}, report_names=["hourly_traffic"], jdbc_enriched=False)
    assert tables == ["hourly_traffic"]


def test_a_differing_geo_header_fails(spark, scratch):
    import os

    from hitscope.sources.files import read_geo_blocks

    folder = f"{scratch}/headers"
    os.makedirs(folder)
    for name, header, row in (("a", "network,geoname_id", "10.0.0.0/8,1"), ("b", "geoname_id,network", "2,11.0.0.0/8")):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(f"{header}\n{row}\n")
    with pytest.raises(Exception, match="header"):
        read_geo_blocks(spark, folder).collect()
    assert [r.geoname_id for r in read_geo_blocks(spark, f"{folder}/a.csv").collect()] == [1]


def test_partitioned_output_has_few_files_per_date(spark, scratch):
    import glob

    from pyspark.sql import functions as F

    from hitscope.sinks.files import write_parquet

    rows = spark.range(2000).select("id", (F.col("id") % 5).alias("date")).repartition(8)
    write_parquet(rows, f"{scratch}/few", partition_by=["date"])
    assert len(glob.glob(f"{scratch}/few/date=*/*.parquet")) <= 10
    assert spark.read.parquet(f"{scratch}/few").count() == 2000
