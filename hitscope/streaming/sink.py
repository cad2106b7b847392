"""Versioned micro-batch sinks and query start-up.

In ``update`` mode a window is emitted again each time a later batch changes it, and
the sink appends, so a table holds several versions of a window. Every row written
here carries its version: ``run`` (when the query's checkpoint was made, and the query's id
in it) and the micro-batch id (``batch_id``), so readers can keep the newest
(``latest_versions``). Batch ids restart at 0 with a new checkpoint, but its run is a later one.
A retried batch writes the same rows with the same version: the Parquet target overwrites
that batch's directory, the JDBC target deletes its rows first.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitscope.sinks.jdbc import write_jdbc

log = logging.getLogger(__name__)


LOCAL_RUN = "local"


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The run of a started query: its checkpoint's time (sorts as text) and the query id stored in it."""
    made = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/metadata").first()
    started = int(made["modificationTime"].timestamp() * 1000)
    return f"{started:014d}-{json.loads(bytes(made['content']))['id']}"


@dataclass(frozen=True)
class ParquetBatchTarget:
    """One directory per run and batch id under ``path`` (``run=<run>/batch_id=<n>``), overwritten on retry.

    By default the output is rebalanced: Spark makes files by size, so a usual micro-batch (the
    windows it changed) is one file and a catch-up batch many. ``files_per_batch`` fixes a number."""

    path: str
    files_per_batch: int | None = None

    def write(self, df: DataFrame, batch_id: int, run: str = LOCAL_RUN) -> None:
        out = df.drop("run", "batch_id")
        out = out.repartition(self.files_per_batch) if self.files_per_batch else out.hint("rebalance")
        out.write.mode("overwrite").parquet(f"{self.path}/run={run}/batch_id={batch_id}")


def _execute(spark: SparkSession, url: str, properties: dict[str, str], table: str, sql: str, values: list) -> None:
    """One statement over the driver's JDBC connection; nothing if the table is not there yet."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for key, value in properties.items():
        props.setProperty(key, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        if connection.getMetaData().getTables(None, None, table, None).next():
            statement = connection.prepareStatement(sql)
            for i, value in enumerate(values, 1):
                statement.setObject(i, value)
            statement.executeUpdate()
    finally:
        connection.close()


@dataclass(frozen=True)
class JdbcBatchTarget:
    """Append each micro-batch to a JDBC table (``run`` and ``batch_id`` are columns).

    Rows that an earlier try of the same batch left are deleted first; ``execute`` runs that statement."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    execute: Callable = _execute

    def write(self, df: DataFrame, batch_id: int, run: str = LOCAL_RUN) -> None:
        sql = f"DELETE FROM {self.table} WHERE run = ? AND batch_id = ?"
        self.execute(df.sparkSession, self.url, self.properties, self.table, sql, [run, batch_id])
        write_jdbc(df, self.url, self.table, self.properties, mode="append")


def versioned_batch_writer(target, *, skip_empty: bool = True, on_error: str = "raise",
                           preview: Callable[[DataFrame, int], None] | None = None,
                           checkpoint: str | None = None):
    """K5: a ``foreachBatch`` function writing ``batch_df`` + ``run`` + ``batch_id`` to ``target``.

    ``run`` is read from ``checkpoint`` at the first batch (the query has made it by then).

    ``skip_empty`` skips batches without rows (each restart runs a no-data batch);
    ``on_error="skip"`` logs and drops a failed write (the checkpoint then moves on,
    so that batch is lost for good); ``preview`` gets the frame for display.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")

    runs: list[str] = []

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(checkpoint_run(batch_df.sparkSession, checkpoint) if checkpoint else LOCAL_RUN)
        out = batch_df.withColumns({"run": F.lit(runs[0]), "batch_id": F.lit(batch_id).cast("long")})
        cached = skip_empty or preview is not None
        if cached:
            out = out.persist()
        try:
            if skip_empty and out.isEmpty():
                return
            if preview is not None:
                preview(out, batch_id)
            try:
                target.write(out, batch_id, runs[0])
            except Exception:  # noqa: BLE001 - the caller chose to keep going
                if on_error == "raise":
                    raise
                log.warning("write of batch %s to %s failed; batch skipped", batch_id, target,
                            exc_info=True)
        finally:
            if cached:
                out.unpersist()

    return write_batch


def start_query(df: DataFrame, name: str, target, checkpoint: str, *,
                output_mode: str = "update", trigger: dict | None = None,
                on_error: str = "raise", skip_empty: bool = True,
                preview: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """K6: start one named windowed query with its own checkpoint.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: 30 s processing
    time, as the reference; tests use ``{"availableNow": True}``)."""
    trig = trigger or {"processingTime": "30 seconds"}
    return (
        df.writeStream.queryName(name)
        .outputMode(output_mode)
        .trigger(**trig)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(versioned_batch_writer(target, on_error=on_error, skip_empty=skip_empty,
                                             preview=preview, checkpoint=checkpoint))
        .start()
    )


def start_windowed_queries(enriched: DataFrame, targets: dict[str, object], checkpoint_root: str,
                           *, names: Iterable[str] | None = None, **kw) -> dict[str, StreamingQuery]:
    """The windowed queries side by side, one checkpoint each.

    ``targets`` maps a stream table name (see ``WINDOWED``) to its sink target;
    ``preview_for(name)`` may return a per-batch preview callback for that query."""
    from hitscope.operators.windows import WINDOWED

    started = {}
    preview_for = kw.pop("preview_for", None)
    for name in names or WINDOWED:
        fn, _keys = WINDOWED[name]
        preview = preview_for(name) if preview_for else None
        started[name] = start_query(fn(enriched), name, targets[name],
                                    f"{checkpoint_root.rstrip('/')}/{name}", preview=preview, **kw)
    return started


@dataclass(frozen=True)
class FourTargets:
    """Each micro-batch of ``four_tables`` to the four targets; ``versioned_batch_writer`` has it persisted, so it is computed once."""

    targets: dict[str, object]

    def write(self, df: DataFrame, batch_id: int, run: str = LOCAL_RUN) -> None:
        from hitscope.operators.windows import split_tables

        for name, part in split_tables(df).items():
            self.targets[name].write(part, batch_id, run)


def start_four_tables(enriched: DataFrame, targets: dict[str, object], checkpoint: str, **kw) -> StreamingQuery:
    """W7 as one query: one read of the records, one checkpoint and one state for the four tables.

    The tables are written one after the other; a batch that fails between them is run again and each
    target overwrites what it has of that version."""
    from hitscope.operators.windows import four_tables

    return start_query(four_tables(enriched), "four_tables", FourTargets(targets), checkpoint, **kw)
