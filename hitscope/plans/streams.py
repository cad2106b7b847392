"""Stream runs over files: replay log rows as records, run a windowed query to the end
of the available input (``availableNow``), and read back the newest window versions.

Everything lives under the session's shared checkpoint folder (``spark.checkpoint.dir``),
in a fresh sub-folder per run: input records, the query checkpoint, and the versioned
output. A restarted run resumes from its checkpoint.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.operators.cleaning import kept, typed
from hitscope.operators.geo import RangeIndex
from hitscope.operators.overlaps import Multiplicity
from hitscope.operators.interval import errors, interval_join_streams, successes
from hitscope.operators.sessions import session_stream
from hitscope.operators.windows import WINDOW_SECONDS, WINDOWED
from hitscope.session import scratch_path
from hitscope.sinks.records import write_records
from hitscope.sources.stream import read_record_stream
from hitscope.streaming.manifest import ManifestTable
from hitscope.streaming.pipeline import enriched_stream
from hitscope.streaming.late import read_split, start_late_split
from hitscope.streaming.sink import ParquetBatchTarget, start_four_tables, start_query
from hitscope.streaming.versions import latest_versions, read_versions


NO_RUN = "none"


class _CountingTarget:
    """Pass-through sink target that counts the batches written (the ``foreachBatch``
    function runs in this driver process)."""

    def __init__(self, inner):
        self.inner, self.writes = inner, 0

    def write(self, df: DataFrame, batch_id: int, run: str) -> None:
        self.inner.write(df, batch_id, run)
        self.writes += 1


@dataclass(frozen=True)
class StreamRun:
    """Folders of one file-fed stream run (``input_dir`` may be shared, read-only)."""

    root: str
    input_dir: str | None = None
    checkpoint_name: str = "checkpoint"

    @property
    def input(self) -> str:
        return self.input_dir or f"{self.root}/input"

    @property
    def output(self) -> str:
        return f"{self.root}/output"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/{self.checkpoint_name}"

    @classmethod
    def create(cls, spark: SparkSession, name: str, input_dir: str | None = None) -> StreamRun:
        return cls(scratch_path(spark, "streams", name), input_dir)

    def add_input(self, raw_rows: DataFrame) -> None:
        """Append log rows as JSON records (a new set of files = a new micro-batch)."""
        write_records(raw_rows, self.input)

    def run(self, spark: SparkSession, name: str, ranges: DataFrame | RangeIndex, *,
            output_mode: str = "update", **kw) -> None:
        """Process all input available now, then stop (resumes from the checkpoint).

        ``output_mode="update"`` re-emits a window each time it changes (versions);
        ``"append"`` emits each window once, when the watermark has passed its end."""
        fn, _keys = WINDOWED[name]
        records = read_record_stream(spark, "text", path=self.input)
        windows = fn(enriched_stream(records, ranges), **kw)
        target = _CountingTarget(ParquetBatchTarget(self.output))
        query = start_query(windows, f"{name}_{self.root.rsplit('/', 1)[-1]}",
                            target, self.checkpoint,
                            output_mode=output_mode, trigger={"availableNow": True})
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {query.exception()}")
        if not target.writes:
            # nothing emitted (yet): an empty, schema-only batch -1 keeps the output readable
            spark.createDataFrame([], windows.schema).write.mode("overwrite").parquet(
                f"{self.output}/run={NO_RUN}/batch_id=-1")

    def versions(self, spark: SparkSession) -> DataFrame:
        return read_versions(spark, self.output)

    def latest(self, spark: SparkSession, name: str) -> DataFrame:
        return latest_versions(self.versions(spark), WINDOWED[name][1])


def write_record_input(spark: SparkSession, raw_rows: DataFrame) -> str:
    """Encode log rows once into a record folder that several stream runs can read."""
    path = scratch_path(spark, "streams", "input")
    write_records(raw_rows, path)
    return path


def replay_windowed(spark: SparkSession, raw_rows: DataFrame | None, ranges: DataFrame | RangeIndex,
                    name: str, *, input_dir: str | None = None, **kw) -> DataFrame:
    """All rows as one input, one availableNow run: the final version of every window.

    Pass ``input_dir`` (from ``write_record_input``) to reuse encoded records."""
    run = StreamRun.create(spark, name, input_dir)
    if input_dir is None:
        run.add_input(raw_rows)
    run.run(spark, name, ranges, **kw)
    return run.latest(spark, name)


def _split_inside_a_window(raw_rows: DataFrame):
    """An event time ``s`` with a window holding cleaned rows both before and at/after it.

    The earliest window with two distinct event times is found by one aggregation (one
    row per window, then one row); ``s`` is its first time + 1. ``None`` if no window
    has two distinct times."""
    rows = typed(raw_rows).where(kept() & F.col("time").isNotNull())
    start = F.col("time") - F.pmod(F.col("time"), F.lit(WINDOW_SECONDS))
    spans = rows.groupBy(start.alias("w")).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    pick = spans.where(F.col("lo") < F.col("hi")).agg(F.min_by("lo", "w").alias("lo")).first()
    return None if pick is None or pick["lo"] is None else pick["lo"] + 1


def replay_in_two_parts(spark: SparkSession, raw_rows: DataFrame, ranges: DataFrame | RangeIndex,
                        name: str, **kw) -> tuple[DataFrame, DataFrame]:
    """Rows split by event time into two runs over one checkpoint.

    The split falls inside a window that has rows on both sides, so that window is
    emitted twice (update mode); every row of the second part is later than the first
    part's newest event, hence never behind the watermark, and the newest versions equal
    the bounded result. Returns ``(all versions, newest versions)``."""
    t = F.col("time").try_cast("long")
    split = _split_inside_a_window(raw_rows)
    first = F.coalesce(t < split, F.lit(False)) if split is not None else F.lit(True)
    run = StreamRun.create(spark, name)
    run.add_input(raw_rows.where(first))
    run.run(spark, name, ranges, **kw)
    run.add_input(raw_rows.where(~first))
    run.run(spark, name, ranges, **kw)
    return run.versions(spark), run.latest(spark, name)


def replay_with_two_checkpoints(spark: SparkSession, raw_rows: DataFrame, ranges: DataFrame | RangeIndex,
                                name: str, **kw) -> tuple[DataFrame, DataFrame]:
    """The first part of the rows under one checkpoint, then all rows from the start under a new one, into one
    output: the second run's batches count from 0 again, and its windows are the newest versions."""
    t = F.col("time").try_cast("long")
    split = _split_inside_a_window(raw_rows)
    first = F.coalesce(t < split, F.lit(False)) if split is not None else F.lit(True)
    before = StreamRun.create(spark, name)
    before.add_input(raw_rows.where(first))
    before.run(spark, name, ranges, **kw)
    after = StreamRun(before.root, checkpoint_name="checkpoint-2")
    after.add_input(raw_rows.where(~first))
    after.run(spark, name, ranges, **kw)
    return after.versions(spark), after.latest(spark, name)


def replay_late_rows(spark: SparkSession, raw_rows: DataFrame, ranges: DataFrame | RangeIndex,
                     name: str, late: Column, **kw) -> DataFrame:
    """All rows but the ``late`` ones, then those under the same checkpoint: what lies behind the watermark of
    the first run (its newest time less the delay) is dropped, the rest still changes its windows."""
    run = StreamRun.create(spark, name)
    run.add_input(raw_rows.where(~late))
    run.run(spark, name, ranges, **kw)
    run.add_input(raw_rows.where(late))
    run.run(spark, name, ranges, **kw)
    return run.latest(spark, name)


def replay_staged(spark: SparkSession, input_dir: str, ranges: DataFrame | RangeIndex,
                  name: str, **kw) -> DataFrame:
    """The staged layout on a record folder: one availableNow run enriches the records
    into a Parquet table, a second runs the windowed query on that table."""
    from hitscope.streaming.staging import read_enriched_table, start_enriched_table

    run = StreamRun.create(spark, f"{name}_staged", input_dir)
    enriched = enriched_stream(read_record_stream(spark, "text", path=run.input), ranges)
    table = f"{run.root}/enriched"
    start_enriched_table(enriched, table, f"{run.root}/checkpoint-enriched",
                         trigger={"availableNow": True}).awaitTermination()
    fn, _keys = WINDOWED[name]
    windows = fn(read_enriched_table(spark, table, enriched.schema), **kw)
    target = _CountingTarget(ParquetBatchTarget(run.output))
    query = start_query(windows, f"{name}_staged_{run.root.rsplit('/', 1)[-1]}", target, run.checkpoint,
                        trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream {name} (staged) failed: {query.exception()}")
    if not target.writes:
        spark.createDataFrame([], windows.schema).write.mode("overwrite").parquet(f"{run.output}/run={NO_RUN}/batch_id=-1")
    return run.latest(spark, name)


def replay_four_tables(spark: SparkSession, input_dir: str, ranges: DataFrame | RangeIndex) -> dict[str, DataFrame]:
    """All records through one query into four versioned tables: the newest versions of each."""
    root = scratch_path(spark, "streams", "four_tables")
    logs = enriched_stream(read_record_stream(spark, "text", path=input_dir), ranges)
    targets = {name: ParquetBatchTarget(f"{root}/{name}") for name in WINDOWED}
    query = start_four_tables(logs, targets, f"{root}/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"four tables failed: {query.exception()}")
    return {name: latest_versions(read_versions(spark, target.path), WINDOWED[name][1]) for name, target in targets.items()}


def replay_late_split(spark: SparkSession, raw_rows: DataFrame, late: Column) -> tuple[DataFrame, DataFrame]:
    """All rows but the ``late`` ones, then those, through the split at the watermark: (kept, late)."""
    run = StreamRun.create(spark, "late_split")
    for part in (raw_rows.where(~late), raw_rows.where(late)):
        run.add_input(part)
        rows = enriched_stream(read_record_stream(spark, "text", path=run.input), Multiplicity(None))
        query = start_late_split(rows, run.output, run.checkpoint, name=f"late_split_{run.root.rsplit('/', 1)[-1]}", trigger={"availableNow": True})
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"late split failed: {query.exception()}")
    return read_split(spark, run.output, "kept"), read_split(spark, run.output, "late")


def replay_sessions(spark: SparkSession, input_dir: str) -> DataFrame:
    """All records through the session stream: the sessions that the watermark has closed."""
    root = scratch_path(spark, "streams", "sessions")
    logs = enriched_stream(read_record_stream(spark, "text", path=input_dir), Multiplicity(None))
    sessions = session_stream(logs)
    query = start_query(sessions, f"sessions_{root.rsplit('/', 1)[-1]}", ParquetBatchTarget(f"{root}/sessions"), f"{root}/checkpoint",
                        output_mode="append", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"session stream failed: {query.exception()}")
    return read_versions(spark, f"{root}/sessions").select(*sessions.columns)


def replay_recovered_errors(spark: SparkSession, input_dir: str, within: int) -> DataFrame:
    """Errors and later successes of the same host, as two streams of the same records."""
    root = scratch_path(spark, "streams", "recovered")
    logs = enriched_stream(read_record_stream(spark, "text", path=input_dir), Multiplicity(None))
    again = enriched_stream(read_record_stream(spark, "text", path=input_dir), Multiplicity(None))
    pairs = interval_join_streams(errors(logs), successes(again), ["host"], "error_time", "success_time", within)
    query = start_query(pairs, f"recovered_{root.rsplit('/', 1)[-1]}", ParquetBatchTarget(f"{root}/pairs"), f"{root}/checkpoint",
                        output_mode="append", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"interval join failed: {query.exception()}")
    return read_versions(spark, f"{root}/pairs").select(*pairs.columns)


def replay_manifest(spark: SparkSession, input_dir: str, ranges: DataFrame | RangeIndex | Multiplicity, name: str) -> ManifestTable:
    """A windowed query into a table with snapshots, then compacted; the table."""
    root = scratch_path(spark, "streams", f"{name}_manifest")
    fn, keys = WINDOWED[name]
    windows = fn(enriched_stream(read_record_stream(spark, "text", path=input_dir), ranges))
    table = ManifestTable(f"{root}/table", windows.schema, keys)
    query = start_query(windows, f"{name}_manifest_{root.rsplit('/', 1)[-1]}", table, f"{root}/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream {name} (manifest) failed: {query.exception()}")
    table.compact(spark)
    return table
