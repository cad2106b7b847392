"""G1-G4, T5, T6 on the hand-written edge rows of FIXTURES.md §4."""

import pytest

from hitscope.functions import (
    cidr_end,
    cidr_start,
    ip_to_long,
    is_ip_address,
    register_sql_functions,
    response_category,
    url_category,
)

IP_CASES = [
    ("1.2.3.4", True, 16909060),
    ("999.1.1.1", True, 999 * 16777216 + 65536 + 256 + 1),
    ("1.2.300.4", True, 16985092),
    ("1.2.3", False, -1),
    ("a.com", False, -1),
    ("a.b.c.d", False, -1),
    (None, False, -1),
    ("1.2.3.4\n", True, -1),  # Java '$' accepts a final newline; parseLong does not
    ("1.2.3.4.", False, 16909060),  # Java split drops the trailing empty part
    ("", False, -1),
    ("+1.2.3.4", False, 16909060),
    ("1..3.4", False, -1),
]


def test_ip_columns(spark):
    df = spark.createDataFrame([(h,) for h, _, _ in IP_CASES], "host string")
    got = df.select("host", is_ip_address("host").alias("ip"), ip_to_long("host").alias("n")).collect()
    assert [(r.host, r.ip, r.n) for r in got] == IP_CASES


def test_ip_sql_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(h,) for h, _, _ in IP_CASES], "host string")
    df.createOrReplaceTempView("ip_cases")
    got = spark.sql("select host, is_ip_address(host) ip, ip_to_long(host) n from ip_cases").collect()
    assert [(r.host, r.ip, r.n) for r in got] == IP_CASES


CIDR_CASES = [
    ("10.1.0.0/16", 167837696, 167903231),
    ("1.2.3.4/32", 16909060, 16909060),
    ("0.0.0.0/1", 0, 2147483647),
    ("0.0.0.0/0", 0, 4294967295),
    ("1.2.3.4", 16909060, 16909060),
    ("1.2.3.77/24", 16909056, 16909311),  # host bits masked
    ("bad", -1, -1),
    ("2001:db8::/32", -1, -1),
    ("1.2.3.4/33", -1, -1),
    ("256.1.1.1/8", -1, -1),
    ("", -1, -1),
    (None, -1, -1),
]


def test_cidr(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in CIDR_CASES], "network string")
    got = df.select("network", cidr_start("network").alias("s"), cidr_end("network").alias("e")).collect()
    assert [(r.network, r.s, r.e) for r in got] == CIDR_CASES


@pytest.mark.parametrize("url,expected", [
    ("/", "Homepage"), ("/ksc.html", "Homepage"), ("/kscx", "Homepage"), ("/shuttle", "Other"),
    ("/Shuttle/x", "Other"), ("/shuttle/countdown/", "Shuttle"), ("/history/apollo/", "History"),
    ("/images/a.gif", "Images"), ("/facilities/lc39a.html", "Facilities"), ("/software/x", "Software"),
    ("/facts/faq.html", "Facts"), ("/persons/a", "Persons"), ("/elv/x", "ELV"), ("/htbin/cdt", "CGI"),
    ("/cgi-bin/imagemap", "CGI"), ("/icons/x", "Other"), (None, "Other"),
])
def test_url_category(spark, url, expected):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(url_category("url")).first()[0] == expected


def test_response_category(spark):
    codes = [199, 200, 299, 300, 399, 400, 499, 500, 599, 600, None]
    expected = ["Other", "Success", "Success", "Redirect", "Redirect", "Client Error", "Client Error",
                "Server Error", "Server Error", "Other", "Other"]
    df = spark.createDataFrame([(c,) for c in codes], "response int")
    got = [r[0] for r in df.select(response_category("response")).collect()]
    assert got == expected


def test_expressions_stay_in_jvm(spark):
    """No Python UDF anywhere in the IP/CIDR expressions."""
    df = spark.createDataFrame([("1.2.3.4",)], "host string").select(
        ip_to_long("host"), is_ip_address("host"), cidr_start("host"), cidr_end("host"),
        url_category("host"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
