"""Snapshots, compaction and retention of a stream table; the interval join."""

import collections
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hitscope.operators.interval import interval_join, interval_join_streams
from hitscope.streaming.manifest import ManifestTable

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "window_start timestamp, window_end timestamp, total_requests long"


def batch(spark, *rows):
    """Rows (hour of the first day, requests)."""
    return spark.createDataFrame([(DAY + dt.timedelta(hours=h), DAY + dt.timedelta(hours=h, minutes=5), n) for h, n in rows], SCHEMA)


def newest(table, spark, **kw):
    return {int((r.window_start - DAY).total_seconds() // 3600): r.total_requests for r in table.latest(spark, **kw).collect()}


def table_at(spark, path):
    return ManifestTable(path, batch(spark, (0, 0)).schema)


def test_many_batches_compacted_are_the_same_windows(spark, scratch):
    table = table_at(spark, f"{scratch}/manifest")
    want = {}
    for n in range(12):
        rows = [(h, 100 * n + h) for h in range(n, 60, 7)]
        want |= dict(rows)
        table.write(batch(spark, *rows), n, "run-a")
    assert newest(table, spark) == want and len(table.folders(spark)) > 12
    table.compact(spark)
    assert newest(table, spark) == want
    assert sorted(table.folders(spark)) == [f"data/compact-{11:012d}/date=2024-01-0{d}" for d in (1, 2, 3)]
    # a later batch, and a new run that counts from 0, win over what was compacted
    table.write(batch(spark, (3, -1)), 12, "run-a")
    table.write(batch(spark, (4, -2)), 0, "run-b")
    assert newest(table, spark) == want | {3: -1, 4: -2}
    # what M4 reads: one folder of one day
    day = table.newest_day(spark)
    assert len(day.inputFiles()) >= 1 and {f.split("/")[-2] for f in day.inputFiles()} == {"date=2024-01-03"}
    table.retain(spark, dt.date(2024, 1, 2))
    assert newest(table, spark) == {h: n for h, n in want.items() if h >= 24}
    gone = table.vacuum(spark, keep=1)
    assert any(g.startswith("data/run-a") for g in gone) and newest(table, spark) == {h: n for h, n in want.items() if h >= 24}
    assert len(table.versions(spark)) == 1


def test_a_batch_run_again_replaces_itself(spark, scratch):
    table = table_at(spark, f"{scratch}/manifest-again")
    table.write(batch(spark, (0, 1), (1, 1)), 0)
    table.write(batch(spark, (0, 2)), 0)
    assert newest(table, spark) == {0: 2}


def test_a_snapshot_that_was_not_finished_is_not_read(spark, scratch):
    table = table_at(spark, f"{scratch}/manifest-half")
    assert table.latest(spark).collect() == [] and table.newest_day(spark).collect() == []
    table.write(batch(spark, (0, 1)), 0)
    half = spark.createDataFrame([("data/none/date=2024-01-01", dt.date(2024, 1, 1), "none")], "folder string, date date, write string")
    half.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/manifest/{1:012d}")
    assert table.versions(spark) == [0] and newest(table, spark) == {0: 1}
    table.write(batch(spark, (1, 5)), 1)
    assert newest(table, spark) == {0: 1, 1: 5}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), max_size=25)] * 2, st.integers(1, 30))
def test_interval_join_against_brute_force(spark, first, second, within):
    make = lambda rows, t: spark.createDataFrame([(k, None if s is None else DAY + dt.timedelta(seconds=s)) for k, s in rows], f"k string, {t} timestamp")
    got = interval_join(make(first, "t"), make(second, "u"), ["k"], "t", "u", within)
    assert got.columns == ["k", "t", "u"]
    want = [(k, a, b) for k, a in first for j, b in second if k is not None and k == j and a is not None and b is not None and a <= b <= a + within]
    seconds = lambda t: int((t - DAY).total_seconds())
    assert collections.Counter((r.k, seconds(r.t), seconds(r.u)) for r in got.collect()) == collections.Counter(want)


def test_stream_interval_join_meets_only_its_bucket(spark, scratch, capsys):
    """Pairs as by brute force, and a join on key and bucket: a row is not compared with all that its key has."""
    rows = {side: [(k, n * step) for k in ("a", "b", None) for n in range(40)] + [("a", None), ("a", 0), ("a", 100)] for side, step in (("t", 37), ("u", 23))}
    streams = []
    for time, listed in rows.items():
        path = f"{scratch}/interval-{time}"
        spark.createDataFrame([(k, None if s is None else DAY + dt.timedelta(seconds=s), i) for i, (k, s) in enumerate(listed)], f"k string, {time} timestamp, n{time} long").write.parquet(path)
        streams.append(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path))
    joined = interval_join_streams(*streams, ["k"], "t", "u", 100)
    assert joined.columns == ["k", "t", "nt", "u", "nu"]
    joined.explain()
    assert re.search(r"StreamingSymmetricHashJoin \[k#\w+, __bucket#\w+\], \[k#\w+, __bucket#\w+\]", capsys.readouterr().out)
    query = joined.writeStream.format("memory").queryName("interval_pairs").outputMode("append").option("checkpointLocation", f"{scratch}/interval-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    got = collections.Counter((r.k, r.nt, r.nu) for r in spark.table("interval_pairs").collect())
    want = [(k, i, j) for i, (k, a) in enumerate(rows["t"]) for j, (m, b) in enumerate(rows["u"]) if k is not None and k == m and a is not None and b is not None and a <= b <= a + 100]
    assert got == collections.Counter(want)
