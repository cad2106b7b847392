"""The command line jobs on CSV / record files derived from the test tables."""

import os

from hitscope.__main__ import main
from hitscope.sinks.records import write_records
from hitscope.sources import testdata
from hitscope.streaming.versions import latest_versions, read_versions

from paths import SF_SMALL


def _write_inputs(spark, root):
    testdata.raw_logs(spark, SF_SMALL).write.option("header", True).csv(f"{root}/logs")
    testdata.geo_blocks(spark, SF_SMALL).write.option("header", True).csv(f"{root}/blocks")
    testdata.geo_locations(spark, SF_SMALL).write.option("header", True).csv(f"{root}/locations")


def test_batch_command(spark, scratch, capsys):
    root = f"{scratch}/cli_batch"
    _write_inputs(spark, root)
    main(["batch", "--logs", f"{root}/logs", "--blocks", f"{root}/blocks",
          "--locations", f"{root}/locations", "--out", f"{root}/out", "--show", "3"])
    printed = capsys.readouterr().out
    assert "--- top_hosts ---" in printed and "enriched" in printed and "|-- url_category" in printed
    assert len(os.listdir(f"{root}/out/reports")) == 15
    from hitscope.plans import catalog
    expected = sorted(tuple(r) for r in catalog.QUERIES["traffic_by_country"](spark, SF_SMALL).collect())
    got = spark.read.option("header", True).option("inferSchema", True).csv(
        f"{root}/out/reports/traffic_by_country")
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_stream_command_once(spark, scratch):
    root = f"{scratch}/cli_stream"
    _write_inputs(spark, root)
    write_records(testdata.raw_logs(spark, SF_SMALL), f"{root}/records")
    main(["stream", "--records", f"{root}/records", "--blocks", f"{root}/blocks",
          "--locations", f"{root}/locations", "--out", f"{root}/out", "--checkpoint", f"{root}/ckpt", "--once",
          "--show", "2"])
    from hitscope.plans import catalog
    expected = sorted(tuple(r) for r in catalog.QUERIES["stream_error_rate"](spark, SF_SMALL).collect())
    got = latest_versions(read_versions(spark, f"{root}/out/stream_error_rate"), [])
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_stream_command_staged(spark, scratch):
    root = f"{scratch}/cli_stream_staged"
    _write_inputs(spark, root)
    write_records(testdata.raw_logs(spark, SF_SMALL), f"{root}/records")
    main(["stream", "--records", f"{root}/records", "--blocks", f"{root}/blocks",
          "--locations", f"{root}/locations", "--out", f"{root}/out", "--checkpoint", f"{root}/ckpt", "--once",
          "--stage-enriched", f"{root}/enriched"])
    from hitscope.plans import catalog
    expected = sorted(tuple(r) for r in catalog.QUERIES["stream_requests_by_country"](spark, SF_SMALL).collect())
    got = latest_versions(read_versions(spark, f"{root}/out/stream_requests_by_country"), ["country_name"])
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_batch_command_for_days_and_corrupt_records(spark, scratch):
    root = f"{scratch}/cli_days"
    _write_inputs(spark, root)
    with open(f"{root}/day.csv", "w") as out:
        out.write("n,bytes,response,url,method,time,host\n1,5,200,/x,GET,86400,h\n2,5\n")
    common = ["--blocks", f"{root}/blocks", "--locations", f"{root}/locations", "--out", f"{root}/out"]
    main(["batch", "--logs", f"{root}/logs", *common])
    days = spark.read.parquet(f"{root}/out/enriched_logs_parquet").select("date").distinct().count()
    main(["batch", "--logs", f"{root}/day.csv", *common, "--replace-days", "--corrupt-dir", f"{root}/bad"])
    assert spark.read.parquet(f"{root}/out/enriched_logs_parquet").select("date").distinct().count() == days + 1
    assert [tuple(r) for r in spark.read.parquet(f"{root}/bad").collect()] == [("2", "2,5")]


def test_stream_command_as_one_query(spark, scratch):
    root = f"{scratch}/cli_one"
    _write_inputs(spark, root)
    write_records(testdata.raw_logs(spark, SF_SMALL), f"{root}/records")
    main(["stream", "--records", f"{root}/records", "--blocks", f"{root}/blocks", "--locations", f"{root}/locations",
          "--out", f"{root}/out", "--checkpoint", f"{root}/ckpt", "--once", "--one-query"])
    from hitscope.plans import catalog
    for name, keys in (("stream_error_rate", []), ("stream_requests_by_country", ["country_name"])):
        expected = sorted(tuple(r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect())
        got = latest_versions(read_versions(spark, f"{root}/out/{name}"), keys)
        assert sorted(tuple(r) for r in got.collect()) == expected
