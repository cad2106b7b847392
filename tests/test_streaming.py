"""Streams: versioned update-mode output, watermark, bad records (FIXTURES.md §4)."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from hitscope.operators.geo import index_ranges
from hitscope.plans.streams import StreamRun
from hitscope.sinks.records import encode_records
from hitscope.sources.stream import decode_records
from hitscope.streaming.sink import versioned_batch_writer
from hitscope.streaming.versions import latest_versions

LOG = "host string, time long, method string, url string, response int, bytes long"
RANGES = ("ip_start long, ip_end long, country_name string, continent_name string, "
          "country_iso_code string, continent_code string")
T0 = 300000  # a window start (multiple of 300 s)


def _ts(secs):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=secs)


@pytest.fixture()
def run(spark, scratch):
    return StreamRun(f"{scratch}/stream-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def ranges(spark):
    return index_ranges(spark.createDataFrame(
        [(167772160, 184549375, "A", "Europe", "AA", "EU")], RANGES))


def _rows(spark, times, response=200):
    return spark.createDataFrame([("10.0.0.1", t, "GET", "/shuttle/x", response, 100) for t in times], LOG)


def test_update_mode_versions_and_watermark(spark, run, ranges):
    name = "stream_error_rate"
    run.add_input(_rows(spark, [T0 + 10, T0 + 20]))
    # a malformed record and a record without time ride along in the first batch
    spark.createDataFrame([('{"host":"a","time":,"url":"/"}',),
                           ('{"host":"h","method":"GET","url":"/","response":200,"bytes":1}',)],
                          "value string").write.mode("append").text(run.input)
    run.run(spark, name, ranges)
    run.add_input(_rows(spark, [T0 + 30, T0 + 3600], response=404))
    run.run(spark, name, ranges)
    run.add_input(_rows(spark, [T0 + 40]))  # behind the watermark (T0 + 3000): dropped
    run.run(spark, name, ranges)

    versions = sorted((r.batch_id, r.window_start, r.total_requests, r.error_requests)
                      for r in run.versions(spark).collect())
    # window T0 is emitted twice (2, then 3 requests); the late row never shows up
    assert [(w, n, e) for _b, w, n, e in versions] == [
        (_ts(T0), 2, 0),
        (_ts(T0), 3, 1),
        (_ts(T0 + 3600), 1, 1),
    ]
    assert versions[0][0] < versions[1][0] == versions[2][0]
    latest = sorted((r.window_start, r.window_end, r.total_requests, r.error_rate_pct)
                    for r in run.latest(spark, name).collect())
    assert latest == [
        (_ts(T0), _ts(T0 + 300), 3, 33.33),
        (_ts(T0 + 3600), _ts(T0 + 3900), 1, 100.0),
    ]


def test_country_stream_matches_bounded(spark, run, ranges):
    name = "stream_requests_by_country"
    rows = _rows(spark, [T0 + 1, T0 + 2, T0 + 400]).unionByName(
        spark.createDataFrame([("user.example.com", T0 + 5, "GET", "/", 200, 7)], LOG))
    run.add_input(rows)
    run.run(spark, name, ranges)
    got = sorted((r.window_start, r.country_name, r.requests, r.total_bytes)
                 for r in run.latest(spark, name).collect())
    assert got == [(_ts(T0), "A", 2, 200), (_ts(T0 + 300), "A", 1, 100)]


def test_latest_versions_reader(spark):
    rows = [
        (_ts(0), _ts(300), "x", 1, 0), (_ts(0), _ts(300), "x", 5, 2), (_ts(0), _ts(300), "x", 5, 2),
        (_ts(0), _ts(300), "x", 3, 1), (_ts(0), _ts(300), "y", 9, 0),
    ]
    df = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, k string, "
                                     "requests long, batch_id long")
    got = sorted(tuple(r) for r in latest_versions(df, ["k"]).collect())
    assert got == [(_ts(0), _ts(300), "x", 5), (_ts(0), _ts(300), "y", 9)]


def test_records_round_trip(spark):
    raw = spark.createDataFrame(
        [("1", "h", "5", "GET", "/a", "200", ""), ("2", "h\"q", "6", "P\\T", "/b\n", "404", "12"),
         ("3", "h", "7", "GET", "/c", "abc", "1")],
        "idx string, host string, time string, method string, url string, response string, bytes string")
    back = decode_records(encode_records(raw), keep=["key"]).collect()
    assert [tuple(r) for r in back] == [
        ("h", "h", 5, "GET", "/a", 200, 0),
        ('h"q', 'h"q', 6, "P\\T", "/b\n", 404, 12),
        ("h", "h", 7, "GET", "/c", None, 1),
    ]


class _Boom:
    def write(self, df, batch_id, run):
        raise RuntimeError("database down")


class _Collect:
    def __init__(self):
        self.seen = []

    def write(self, df, batch_id, run):
        self.seen.append((batch_id, df.count(), "batch_id" in df.columns))


def test_sink_skip_empty_and_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    target = _Collect()
    writer = versioned_batch_writer(target)
    writer(df.limit(0), 0)
    writer(df, 1)
    assert target.seen == [(1, 1, True)]
    versioned_batch_writer(_Boom(), on_error="skip")(df, 2)
    with pytest.raises(RuntimeError):
        versioned_batch_writer(_Boom())(df, 3)


def test_four_queries_side_by_side(spark, scratch, ranges):
    """The four windowed queries on one enriched stream, one checkpoint each."""
    from hitscope.operators.windows import WINDOWED
    from hitscope.sources.stream import read_record_stream
    from hitscope.streaming.pipeline import enriched_stream
    from hitscope.streaming.sink import ParquetBatchTarget, start_windowed_queries
    from hitscope.streaming.versions import read_versions

    root = f"{scratch}/w7-{uuid.uuid4().hex}"
    StreamRun(root).add_input(_rows(spark, [T0 + 1, T0 + 2, T0 + 301]))
    enriched = enriched_stream(read_record_stream(spark, "text", path=f"{root}/input"), ranges)
    targets = {name: ParquetBatchTarget(f"{root}/out/{name}") for name in WINDOWED}
    queries = start_windowed_queries(enriched, targets, f"{root}/checkpoints",
                                     trigger={"availableNow": True})
    assert set(queries) == set(WINDOWED)
    for q in queries.values():
        q.awaitTermination()
    counts = {name: read_versions(spark, f"{root}/out/{name}").count() for name in WINDOWED}
    assert counts == {name: 2 for name in WINDOWED}
    volume = read_versions(spark, f"{root}/out/stream_traffic_volume").orderBy("window_start").collect()
    assert [(r.requests, r.total_bytes, r.unique_hosts) for r in volume] == [(2, 200, 1), (1, 100, 1)]


def test_kafka_source_arguments(spark):
    from hitscope.sources.stream import read_record_stream

    with pytest.raises(ValueError):
        read_record_stream(spark, "kafka", topic="logs")
    with pytest.raises(ValueError):
        read_record_stream(spark, "text")
    with pytest.raises(ValueError):
        read_record_stream(spark, "socket")


def test_append_mode_emits_final_windows_once(spark, run, ranges):
    name = "stream_requests_by_url_category"
    run.add_input(_rows(spark, [T0 + 10, T0 + 20]))
    run.run(spark, name, ranges, output_mode="append")
    assert run.versions(spark).count() == 0  # the watermark has not passed the window yet
    run.add_input(_rows(spark, [T0 + 30, T0 + 3600]))
    run.run(spark, name, ranges, output_mode="append")
    got = sorted((r.window_start, r.url_category, r.requests) for r in run.versions(spark).collect())
    # window T0 once, with its final count; the window at T0+3600 is still open
    assert got == [(_ts(T0), "Shuttle", 3)]



def test_parquet_target_retry_is_idempotent(spark, scratch):
    from hitscope.streaming.sink import ParquetBatchTarget
    from hitscope.streaming.versions import read_versions

    target = ParquetBatchTarget(f"{scratch}/retry-{uuid.uuid4().hex}")
    df = spark.createDataFrame([(_ts(0), _ts(300), 4)], "window_start timestamp, window_end timestamp, n long")
    writer = versioned_batch_writer(target)
    writer(df, 7)
    writer(df, 7)  # the same micro-batch retried after a failure
    writer(df.withColumn("n", F.lit(5).cast("long")), 8)
    back = read_versions(spark, target.path)
    assert sorted((r.batch_id, r.n) for r in back.collect()) == [(7, 4), (8, 5)]
    assert [r.n for r in latest_versions(back, []).collect()] == [5]


def test_versions_survive_a_new_checkpoint(spark, scratch, ranges):
    """Old batches 0..1 under one checkpoint, then a new checkpoint whose batches count from 0: nothing is
    overwritten, and the newer run's windows are the newest even where its batch ids are lower."""
    name = "stream_error_rate"
    first = StreamRun(f"{scratch}/two-{uuid.uuid4().hex}")
    first.add_input(_rows(spark, [T0 + 10]))
    first.run(spark, name, ranges)
    first.add_input(_rows(spark, [T0 + 20]))
    first.run(spark, name, ranges)
    before = first.versions(spark).count()
    second = StreamRun(first.root, checkpoint_name="other")
    second.add_input(_rows(spark, [T0 + 30, T0 + 400]))
    second.run(spark, name, ranges)
    versions = second.versions(spark)
    assert versions.select("run").distinct().count() == 2
    assert versions.count() == before + 2
    got = sorted((r.window_start, r.total_requests) for r in second.latest(spark, name).collect())
    assert got == [(_ts(T0), 3), (_ts(T0 + 300), 1)]


def test_jdbc_target_deletes_a_batch_before_appending(spark):
    from hitscope.streaming.sink import JdbcBatchTarget

    calls = []
    target = JdbcBatchTarget("jdbc:hitscope-no-such-driver:x", "windows", {"user": "u"}, execute=lambda *a: calls.append(a[1:]))
    with pytest.raises(Exception):
        target.write(spark.createDataFrame([(1,)], "n int"), 4, "run-1")
    assert calls == [("jdbc:hitscope-no-such-driver:x", {"user": "u"}, "windows",
                      "DELETE FROM windows WHERE run = ? AND batch_id = ?", ["run-1", 4])]


def test_two_part_replay_reemits_a_window(spark):
    """The registered W8 query really reads several versions of a window."""
    from hitscope.plans import catalog
    from hitscope.plans.streams import replay_in_two_parts

    from paths import SF_SMALL

    versions, newest = replay_in_two_parts(spark, catalog._raw(spark, SF_SMALL), catalog._index(spark, SF_SMALL),
                                           "stream_error_rate")
    per_window = versions.groupBy("window_start").count()
    assert per_window.where("count > 1").count() >= 1
    assert newest.count() == per_window.count() == versions.select("window_start").distinct().count()


def test_stream_run_without_any_window(spark, run, ranges):
    # only a malformed record: nothing reaches a window, the output is still readable
    spark.createDataFrame([("not json",)], "value string").write.text(run.input)
    run.run(spark, "stream_error_rate", ranges)
    latest = run.latest(spark, "stream_error_rate")
    assert latest.count() == 0
    assert latest.columns == ["window_start", "window_end", "total_requests", "error_requests", "error_rate_pct"]


def test_stream_keeps_going_when_the_database_is_down(spark, run, ranges):
    from hitscope.sources.stream import read_record_stream
    from hitscope.streaming.pipeline import enriched_stream
    from hitscope.streaming.sink import JdbcBatchTarget, start_query
    from hitscope.operators.windows import error_rate

    run.add_input(_rows(spark, [T0 + 1, T0 + 2]))
    target = JdbcBatchTarget("jdbc:hitscope-no-such-driver:x", "stream_error_rate", {})
    windows = error_rate(enriched_stream(read_record_stream(spark, "text", path=run.input), ranges))
    skipped = start_query(windows, f"skip_{uuid.uuid4().hex}", target, f"{run.root}/ckpt-skip",
                          trigger={"availableNow": True}, on_error="skip")
    skipped.awaitTermination()
    assert skipped.exception() is None
    failing = start_query(windows, f"raise_{uuid.uuid4().hex}", target, f"{run.root}/ckpt-raise",
                          trigger={"availableNow": True})
    with pytest.raises(Exception):
        failing.awaitTermination()


def test_staged_layout_equals_direct(spark, scratch, ranges):
    """Enrich once into a staged table, window from it: same windows as the bounded frame."""
    from hitscope.operators.cleaning import clean
    from hitscope.operators.enrich import enrich
    from hitscope.operators.geo import geolocate
    from hitscope.operators.windows import WINDOWED
    from hitscope.sources.stream import read_record_stream
    from hitscope.streaming.pipeline import enriched_stream
    from hitscope.streaming.sink import ParquetBatchTarget, start_windowed_queries
    from hitscope.streaming.staging import read_enriched_table, start_enriched_table
    from hitscope.streaming.versions import read_versions

    root = f"{scratch}/staged-{uuid.uuid4().hex}"
    rows = _rows(spark, [T0 + 1, T0 + 2, T0 + 301, T0 + 900]).unionByName(
        spark.createDataFrame([("u.example.com", T0 + 5, "GET", "/images/i", 404, 7)], LOG))
    StreamRun(root).add_input(rows)
    enriched = enriched_stream(read_record_stream(spark, "text", path=f"{root}/input"), ranges)
    staging = start_enriched_table(enriched, f"{root}/enriched", f"{root}/ckpt/enriched",
                                   trigger={"availableNow": True})
    staging.awaitTermination()
    staged = read_enriched_table(spark, f"{root}/enriched", enriched.schema)
    targets = {name: ParquetBatchTarget(f"{root}/out/{name}") for name in WINDOWED}
    for q in start_windowed_queries(staged, targets, f"{root}/ckpt", trigger={"availableNow": True}).values():
        q.awaitTermination()
    bounded = enrich(geolocate(clean(rows, index_col=None), ranges))
    for name, (fn, keys) in WINDOWED.items():
        got = sorted(tuple(r) for r in latest_versions(read_versions(spark, f"{root}/out/{name}"), keys).collect())
        assert got == sorted(tuple(r) for r in fn(bounded).collect()), name
