"""C1-C8 and T1-T7 edge rows (FIXTURES.md §4)."""

import datetime as dt

from hitscope.operators.cleaning import clean
from hitscope.operators.enrich import enrich
from hitscope.schemas import RAW_LOG

ROWS = [
    ("0", "h1", "0", "GET", "/a", "200", "10"),
    ("1", "h2", "0", "GET", "/a", "abc", "10"),      # bad response -> dropped
    ("2", "h3", "0", "GET", "/a", "200.5", "10"),    # stated deviation: dropped
    ("3", "h4", "0", "GET", "/a", None, "10"),       # NULL response -> dropped
    ("4", "  ", "0", "GET", "/a", "200", "10"),      # blank host -> dropped
    ("5", "h6", "0", "GET", None, "200", "10"),      # NULL url -> dropped
    ("6", "h7", "0", "GET", "/a", "200", None),      # bytes NULL -> 0
    ("7", "h8", "0", "GET", "/a", "200", "-"),       # bytes '-' -> 0
    ("8", "h9", "0", "GET", "/a", "200", ""),        # bytes '' -> 0
    ("9", "h10", None, "GET", "/a", "200", "1"),     # NULL time kept
    ("10", "h11", "x", "GET", "/a", "200", "1"),     # bad time kept as NULL
    ("11", "h12", "0", None, "/a", "200", "1"),      # NULL method kept
    ("12", "a\t ", "0", " GET ", " /b ", " 404", "5"),  # trim spaces only
    ("13", "h14", "", "GET", "  ", "200", "1"),     # blank url -> dropped
]


def test_clean(spark):
    raw = spark.createDataFrame(ROWS, RAW_LOG)
    got = {r.host: r for r in clean(raw).collect()}
    assert set(got) == {"h1", "h7", "h8", "h9", "h10", "h11", "h12", "a\t"}
    assert clean(raw).columns == ["host", "time", "method", "url", "response", "bytes"]
    assert got["h7"].bytes == 0 and got["h8"].bytes == 0 and got["h9"].bytes == 0
    assert got["h10"].time is None and got["h11"].time is None
    assert got["h12"].method is None
    tab = got["a\t"]
    assert (tab.method, tab.url, tab.response, tab.bytes) == ("GET", "/b", 404, 5)


def test_clean_first_column_any_name(spark):
    raw = spark.createDataFrame([("9", "h", "1", "GET", "/", "200", "3")],
                                "_c0 string, host string, time string, method string, url string, "
                                "response string, bytes string")
    assert clean(raw).columns == ["host", "time", "method", "url", "response", "bytes"]
    streamed = raw.drop("_c0")
    assert clean(streamed, index_col=None).count() == 1


def test_enrich(spark):
    df = spark.createDataFrame(
        [("h", 804571201, "GET", "/", 200, 1536), ("h", None, "GET", "/x", 700, 0),
         ("h", 10 ** 15, "GET", "/x", 200, 1)],
        "host string, time long, method string, url string, response int, bytes long")
    rows = enrich(df).collect()
    first = rows[0]
    assert first.timestamp == dt.datetime(1995, 7, 1, 4, 0, 1)
    assert (first.hour_of_day, first.day_of_week, first.date) == (4, "Saturday", dt.date(1995, 7, 1))
    assert (first.url_category, first.response_category, first.bytes_kb) == ("Homepage", "Success", 1.5)
    for r in rows[1:]:
        assert r.timestamp is None and r.hour_of_day is None and r.date is None and r.day_of_week is None
    assert rows[1].response_category == "Other"


def test_bytes_kb_rounds_half_up(spark):
    # 1.005 KB exactly in decimal text: Spark rounds the text half-up
    df = spark.createDataFrame([(1029.12,)], "bytes double")
    from pyspark.sql import functions as F
    assert df.select(F.round(F.col("bytes") / 1024.0, 2)).first()[0] == 1.01


def test_enriched_schema(spark):
    from hitscope.plans import catalog
    from hitscope.schemas import ENRICHED_COLUMNS

    df = catalog.QUERIES["enrich_logs"](spark, "/root/testdata/sf0.001")
    assert df.columns == ENRICHED_COLUMNS
    types = dict(df.dtypes)
    assert (types["time"], types["response"], types["bytes"], types["ip_long"]) == ("bigint", "int", "bigint", "bigint")
    assert (types["timestamp"], types["date"], types["hour_of_day"], types["bytes_kb"]) == (
        "timestamp", "date", "int", "double")
    assert types["is_ip_host"] == "boolean"
