"""The sweep over range ends, and rows as often as ranges hold their address."""

import collections

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from paths import SF_SMALL

from hitscope.operators.geo import geolocate, index_ranges
from hitscope.operators.overlaps import Multiplicity, address_spans, multiplicity, overlaps, repeat_by_ranges
from hitscope.plans import catalog
from hitscope.plans.batch import enriched_logs
from hitscope.streaming.pipeline import enriched_stream

RANGE = "ip_start long, ip_end long, country_name string, continent_name string, country_iso_code string, continent_code string"
LOG = "host string, time long, method string, url string, response int, bytes long"


def frame(spark, ranges):
    return spark.createDataFrame([(a, b, "A", "E", "AA", "EU") for a, b in ranges], RANGE)


def brute(ranges):
    ranges = [(a, b) for a, b in ranges if a <= b]
    ends = sorted({a for a, _ in ranges} | {b + 1 for _, b in ranges})
    out = []
    for a, b in zip(ends, ends[1:]):
        n = sum(x <= a <= y for x, y in ranges)
        if n and out and out[-1][1] == a - 1 and out[-1][2] == n:
            out[-1] = (out[-1][0], b - 1, n)
        elif n:
            out.append((a, b - 1, n))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(-1, 15)), max_size=25), st.integers(1, 7))
def test_spans_against_brute_force(spark, sizes, parts):
    ranges = [(a, a + n) for a, n in sizes]
    got = sorted(tuple(r) for r in address_spans(frame(spark, ranges), parts).collect())
    assert got == brute(ranges)


def test_whole_space_and_touching_ranges(spark):
    top = (1 << 32) - 1
    assert [tuple(r) for r in address_spans(frame(spark, [(0, top)])).collect()] == [(0, top, 1)]
    assert [tuple(r) for r in address_spans(frame(spark, [(0, 9), (10, 19), (20, top)])).collect()] == [(0, top, 1)]
    assert sorted(tuple(r) for r in overlaps(frame(spark, [(0, top), (5, 5), (5, 5)])).collect()) == [(5, 5, 3)]
    assert overlaps(frame(spark, [])).collect() == []


def test_rows_as_often_as_the_geo_join_gives_them(spark):
    ranges = frame(spark, [(0x0A000000, 0x0AFFFFFF), (0x0A010000, 0x0A01FFFF), (0x0A010203, 0x0A010203)])
    hosts = ["10.0.0.1", "10.1.0.1", "10.1.2.3", "11.0.0.0", "a.example", "10.1.2.3"]
    logs = spark.createDataFrame([(h, 0, "GET", "/", 200, 1) for h in hosts], LOG)
    many = multiplicity(ranges)
    got = collections.Counter(r.host for r in repeat_by_ranges(logs, many).collect())
    assert got == collections.Counter(r.host for r in geolocate(logs, ranges).collect()) == {"10.0.0.1": 1, "10.1.0.1": 2, "10.1.2.3": 6, "11.0.0.0": 1, "a.example": 1}
    assert repeat_by_ranges(logs, many).columns == logs.columns


def test_no_join_if_ranges_are_disjoint(spark):
    logs = catalog._raw(spark, SF_SMALL)
    none = multiplicity(catalog._ranges(spark, SF_SMALL))
    assert none == Multiplicity(None)
    plan = enriched_logs(logs, none)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    some = multiplicity(catalog._wide_ranges(spark, SF_SMALL))
    plan = enriched_logs(logs, some)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    wide = catalog._wide_logs(spark, SF_SMALL)
    assert enriched_logs(wide, some).count() == enriched_logs(wide, index_ranges(catalog._wide_ranges(spark, SF_SMALL))).count()


def test_streams_without_geo_columns_have_no_join(spark, scratch, capsys):
    from hitscope.operators.windows import error_rate
    from hitscope.sources.stream import read_record_stream

    path = f"{scratch}/no-geo"
    spark.createDataFrame([], "value string").write.text(path)
    error_rate(enriched_stream(read_record_stream(spark, "text", path=path), Multiplicity(None))).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("from_json(") == 1
