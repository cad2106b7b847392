"""A1-A15 semantics on hand-written rows (through geolocate and enrich)."""

import datetime as dt

import pytest

from paths import SF_SMALL
from hitscope.operators import reports as R
from hitscope.operators.enrich import enrich
from hitscope.operators.geo import RangeIndex, geolocate

LOG = "host string, time long, method string, url string, response int, bytes long"
RANGES = ("ip_start long, ip_end long, country_name string, continent_name string, "
          "country_iso_code string, continent_code string")
DAY = 1704067200  # 2024-01-01 00:00:00 UTC, a Monday


@pytest.fixture(scope="module")
def enriched(spark):
    ranges = spark.createDataFrame([
        (16909056, 16909311, "A", "Europe", "AA", "EU"),   # 1.2.3.0/24
        (84281096, 84281096, None, "Zed", None, "ZZ"),     # 5.6.7.8/32: no country
    ], RANGES)
    rows = [
        ("1.2.3.4", DAY + 3600, "GET", "/shuttle/a", 200, 100),
        ("1.2.3.4", DAY + 3600, "GET", "/shuttle/a", 404, 0),
        ("1.2.3.5", DAY + 7200, "POST", "/images/x", 500, 50),
        ("5.6.7.8", DAY + 90000, "GET", "/", 302, 10),
        ("a.example.com", None, None, "/facts/f", 200, 1),
        ("b.example.com", DAY, "HEAD", "/facts/f", 404, 3),
    ]
    return enrich(geolocate(spark.createDataFrame(rows, LOG), ranges)).cache()


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_country_and_continent(enriched):
    # NULL country with a real continent: not a country, but counted for its continent
    assert _rows(R.traffic_by_country(enriched)) == [("A", "AA", 3, 150, 2)]
    assert _rows(R.traffic_by_continent(enriched)) == [("Europe", "EU", 3, 150, 2), ("Zed", "ZZ", 1, 10, 1)]


def test_percentages_and_nulls(enriched):
    got = {r.response: (r.response_category, r.requests, r.percentage) for r in R.error_analysis(enriched).collect()}
    assert got == {200: ("Success", 2, 33.33), 404: ("Client Error", 2, 33.33),
                   500: ("Server Error", 1, 16.67), 302: ("Redirect", 1, 16.67)}
    # the caller's total wins when given (the reference's totalRows argument)
    assert R.error_analysis(enriched, 12).where("response = 200").first().percentage == 16.67
    methods = {r.method: r.requests for r in R.method_distribution(enriched).collect()}
    assert methods == {"GET": 3, "POST": 1, "HEAD": 1, None: 1}
    hours = {r.hour_of_day: r.requests for r in R.hourly_traffic(enriched).collect()}
    assert hours == {0: 1, 1: 3, 2: 1, None: 1}  # NULL time is a group in batch; 90000 s -> 01:00 next day
    days = {r.date: (r.requests, r.unique_hosts) for r in R.daily_traffic(enriched).collect()}
    assert days == {dt.date(2024, 1, 1): (4, 3), dt.date(2024, 1, 2): (1, 1), None: (1, 1)}
    assert {r.day_of_week for r in R.day_of_week_traffic(enriched).collect()} == {"Monday", "Tuesday", None}


def test_top_k_tie_breaks_and_filters(enriched):
    assert _rows(R.top_pages(enriched, limit=2)) == [("/facts/f", 2, 4), ("/shuttle/a", 2, 100)]
    assert _rows(R.top_hosts(enriched, limit=1)) == [("1.2.3.4", 2, 100)]
    assert _rows(R.top_error_pages(enriched)) == [("/facts/f", 1), ("/shuttle/a", 1)]
    cats = {r.url_category: (r.requests, r.total_bytes, r.avg_bytes) for r in R.bandwidth_by_category(enriched).collect()}
    assert cats == {"Shuttle": (2, 100, 50.0), "Images": (1, 50, 50.0), "Homepage": (1, 10, 10.0),
                    "Facts": (2, 4, 2.0)}
    mb = _rows(R.daily_bandwidth(enriched))
    assert mb == [(None, 1, 0.0), (dt.date(2024, 1, 1), 153, 0.0), (dt.date(2024, 1, 2), 10, 0.0)]


def test_heatmap_top_n(enriched):
    got = _rows(R.country_hour_heatmap(enriched, top_n=1))
    assert got == [("A", 1, 2), ("A", 2, 1)]


@pytest.mark.parametrize("name,geo", [("traffic_by_country", True), ("country_hour_heatmap", True), ("daily_traffic", False), ("top_hosts", False), ("method_distribution", False)])
def test_only_reports_by_place_look_addresses_up(spark, monkeypatch, name, geo):
    from hitscope.plans import catalog

    looked_up = []
    lookup = catalog.enriched_logs
    monkeypatch.setattr(catalog, "enriched_logs", lambda raw, ranges: looked_up.append(isinstance(ranges, RangeIndex)) or lookup(raw, ranges))
    catalog.QUERIES[name](spark, SF_SMALL).collect()
    assert looked_up == [geo]
