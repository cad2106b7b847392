"""The file job: headers of their own, records that do not fit, days replaced one by one."""

import datetime
import gzip
import os

import pytest
from paths import SF_SMALL

from hitscope.plans.batch import run_batch, run_file_job
from hitscope.sinks.files import write_parquet
from hitscope.sources import testdata
from hitscope.sources.files import headers, read_access_log


def write(folder, name, text, opener=open):
    os.makedirs(folder, exist_ok=True)
    with opener(f"{folder}/{name}", "wt", encoding="utf-8") as out:
        out.write(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_files_of_several_layouts_in_one_folder(spark, scratch):
    folder = f"{scratch}/layouts"
    write(folder, "a.csv", "i,host,time,method,url,response,bytes\n1,h1,10,GET,/a,200,5\n")
    write(folder, "b.csv", ",bytes,response,url,method,time,host\n2,6,404,/b,POST,20,h2\n")
    write(folder, "c.csv.gz", 'i,agent,host,time,method,url,response,bytes,agent\n3,"x, ""y""",h3,30,GET,"/c,d",304,7,z\n', gzip.open)
    write(folder, "d.csv", "")
    write(folder, "e.csv", "﻿i,host,time,method,url,response,bytes\n")
    got = read_access_log(spark, folder)
    assert got.columns == ["idx", "host", "time", "method", "url", "response", "bytes"]
    assert rows(got) == [("1", "h1", "10", "GET", "/a", "200", "5"), ("2", "h2", "20", "POST", "/b", "404", "6"), ("3", "h3", "30", "GET", "/c,d", "304", "7")]
    assert {len(names) for names in headers(spark, folder).values()} == {1, 2}


@pytest.mark.parametrize("header", ["i,host,time,method,url,response", "host,time,method,url,response,bytes", ""])
def test_a_file_without_a_field_is_named(spark, scratch, header):
    folder = f"{scratch}/missing-{len(header)}"
    write(folder, "good.csv", "i,host,time,method,url,response,bytes\n1,h1,10,GET,/a,200,5\n")
    write(folder, "strange.csv", f"{header}\n")
    with pytest.raises(ValueError, match="strange.csv"):
        read_access_log(spark, folder)


def test_a_folder_of_empty_files(spark, scratch):
    write(f"{scratch}/nothing", "a.csv", "")
    assert read_access_log(spark, f"{scratch}/nothing").collect() == []
    assert read_access_log(spark, f"{scratch}/nothing", corrupt="bad").columns[-1] == "bad"


def test_records_that_do_not_fit_their_header(spark, scratch):
    folder = f"{scratch}/corrupt"
    write(folder, "a.csv", 'i,host,time,method,url,response,bytes\n1,h1,10,GET,/a,200,5\n2,h2,20,GET\n3,h3,30,GET,/c,200,7,more\n4,"h4",40,GET,"/d,e",200,8\n')
    write(folder, "b.csv", "i,bytes,agent,response,url,method,time,host\n5,9,x,200,/e,GET,50,h5\n6,9,x,200\n")
    got = {r.idx: r.bad for r in read_access_log(spark, folder, corrupt="bad").collect()}
    assert got == {"1": None, "2": "2,h2,20,GET", "3": "3,h3,30,GET,/c,200,7,more", "4": None, "5": None, "6": "6,9,x,200"}
    # without the column they are read as far as there are fields
    plain = {r.idx: tuple(r)[1:] for r in read_access_log(spark, folder).collect()}
    assert plain["2"] == ("h2", "20", "GET", None, None, None) and plain["3"] == ("h3", "30", "GET", "/c", "200", "7")


def test_the_job_from_files_to_files(spark, scratch):
    root = f"{scratch}/job"
    write(f"{root}/logs", "a.csv", "i,host,time,method,url,response,bytes\n1,10.0.0.1,0,GET,/a,200,5\n2,h2,20,GET\n3,b.com,86400,GET,/a,404,\n")
    write(f"{root}/logs", "b.csv", "n,url,response,host,bytes,time,method\n4,/a,200,10.9.0.1,7,86401,HEAD\n")
    write(root, "blocks.csv", "geoname_id,network\n1,10.0.0.0/16\n2,10.9.0.0/16\n")
    write(root, "locations.csv", "continent_code,continent_name,country_iso_code,country_name,geoname_id\nE,Europe,AA,A,1\nE,Europe,,,2\n")
    run_file_job(spark, f"{root}/logs", f"{root}/blocks.csv", f"{root}/locations.csv", f"{root}/out", corrupt_dir=f"{root}/bad")
    assert [tuple(r) for r in spark.read.parquet(f"{root}/bad").collect()] == [("2", "2,h2,20,GET")]
    stored = spark.read.parquet(f"{root}/out/enriched_logs_parquet")
    assert sorted((r.host, r.country_name, r.continent_name, r.bytes) for r in stored.collect()) == [("10.0.0.1", "A", "Europe", 5), ("10.9.0.1", "Unknown", "Europe", 7), ("b.com", "Unknown", "Unknown", 0)]
    pages = spark.read.option("header", True).csv(f"{root}/out/reports/top_pages")
    assert [tuple(r) for r in pages.collect()] == [("/a", "3", "12")]


def test_a_job_run_again_for_one_day_keeps_the_others(spark, scratch):
    """Two days, then the second again with other rows: the table and the reports hold the first and the new second."""
    out = f"{scratch}/days"
    blocks, locations = testdata.geo_blocks(spark, SF_SMALL), testdata.geo_locations(spark, SF_SMALL)

    def day(*seconds):
        return spark.createDataFrame([("i", f"h{s}", str(s), "GET", "/a", "200", "1") for s in seconds], "idx string, host string, time string, method string, url string, response string, bytes string")

    run_batch(spark, day(1, 2, 86401, 86402), blocks, locations, out)
    reports = run_batch(spark, day(86403), blocks, locations, out, replace="folders")
    assert [(r.date, r.requests, r.unique_hosts) for r in reports["daily_traffic"].collect()] == [(datetime.date(1970, 1, 1), 2, 2), (datetime.date(1970, 1, 2), 1, 1)]
    reports = run_batch(spark, day(5), blocks, locations, out)
    assert [r.requests for r in reports["daily_traffic"].collect()] == [1]


def test_replace_needs_folders(spark, scratch):
    with pytest.raises(ValueError, match="partition_by"):
        write_parquet(spark.range(1), f"{scratch}/x", replace="folders")
    with pytest.raises(ValueError, match="unknown"):
        write_parquet(spark.range(1), f"{scratch}/x", replace="some")
