"""A versioned stream table that can run for months: snapshots, compaction, retention.

Data lie in folders by write and date. A snapshot is a small table of the folders that make up the table at one moment;
it is valid once Spark has committed it (``_SUCCESS``), so a reader sees the old snapshot or the new
one and never half a write. Readers list no data folders: they take those of the newest snapshot, and of
these only the dates they ask for. ``compact`` replaces all versions of each window by the newest one,
``retain`` forgets old dates, ``vacuum`` deletes folders that no kept snapshot names. There is one writer (the
query's micro-batches, or maintenance between them); a write that is run again replaces its own folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hitscope.streaming.sink import LOCAL_RUN
from hitscope.streaming.versions import latest_versions

_ENTRY = "folder string, date date, write string"
Entry = tuple[str, dt.date, str]


@dataclass(frozen=True)
class ManifestTable:
    """``path``, the columns of the table's rows (without run and batch_id) and the keys of a window besides its bounds."""

    path: str
    schema: StructType
    keys: list[str] = field(default_factory=list)

    # -- snapshots

    def _fs(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = self._fs(spark)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self, spark: SparkSession) -> list[int]:
        """The numbers of the valid snapshots, oldest first."""
        names = self._names(spark, f"{self.path}/manifest")
        return [int(n) for n in names if "_SUCCESS" in self._names(spark, f"{self.path}/manifest/{n}")]

    def entries(self, spark: SparkSession, version: int | None = None) -> list[Entry]:
        """The folders of a snapshot (the newest by default): as many as writes since the last compaction, times their dates."""
        known = self.versions(spark)
        if not known:
            return []
        at = known[-1] if version is None else version
        return [tuple(r) for r in spark.read.schema(_ENTRY).parquet(f"{self.path}/manifest/{at:012d}").collect()]

    def _commit(self, spark: SparkSession, entries: list[Entry]) -> None:
        known = self.versions(spark)
        number = (known[-1] if known else -1) + 1  # a try that failed has no _SUCCESS and is written over
        spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{number:012d}")

    def _store(self, df: DataFrame, write: str) -> list[Entry]:
        """The rows by date under ``data/<write>``, and the folders that this made."""
        spark, folder = df.sparkSession, f"{self.path}/data/{write}"
        dated = df.withColumn("date", F.to_date("window_start"))
        dated.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(folder)
        found = [n.removeprefix("date=") for n in self._names(spark, folder) if n.startswith("date=")]
        return [(f"data/{write}/date={d}", dt.date.fromisoformat(d), write) for d in found]

    # -- the target of a query (see ``versioned_batch_writer``)

    def write(self, df: DataFrame, batch_id: int, run: str = LOCAL_RUN) -> None:
        spark, name = df.sparkSession, f"{run}-{batch_id:012d}"
        rows = df.drop("run", "batch_id").withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        others = [e for e in self.entries(spark) if e[2] != name]
        self._commit(spark, others + self._store(rows, name))

    # -- maintenance

    def compact(self, spark: SparkSession) -> None:
        """One row a window and key: its newest version, with the run and batch that it is from."""
        known = self.versions(spark)
        if known:
            self._commit(spark, self._store(latest_versions(self.read(spark), self.keys, keep_version=True), f"compact-{known[-1]:012d}"))

    def retain(self, spark: SparkSession, since: dt.date) -> None:
        """Forget the dates before ``since``."""
        self._commit(spark, [e for e in self.entries(spark) if e[1] >= since])

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Delete the writes that none of the last ``keep`` snapshots names, and older snapshots; what was deleted."""
        known = self.versions(spark)
        named = {e[2] for v in known[-keep:] for e in self.entries(spark, v)}
        gone = [f"data/{n}" for n in self._names(spark, f"{self.path}/data") if n not in named]
        gone += [f"manifest/{v:012d}" for v in known[:-keep]]
        fs, path = self._fs(spark), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in gone:
            fs.delete(path(f"{self.path}/{name}"), True)
        return gone

    # -- readers

    def folders(self, spark: SparkSession, dates: Iterable[dt.date] | None = None) -> list[str]:
        wanted = None if dates is None else set(dates)
        return [f for f, d, _ in self.entries(spark) if wanted is None or d in wanted]

    def read(self, spark: SparkSession, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """All versions in the newest snapshot, of the given dates only if there are any given."""
        schema = StructType([*self.schema.fields, StructField("run", StringType()), StructField("batch_id", LongType())])
        found = self.folders(spark, dates)
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in found])

    def latest(self, spark: SparkSession, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """The newest version of each window."""
        return latest_versions(self.read(spark, dates), self.keys)

    def newest_day(self, spark: SparkSession) -> DataFrame:
        """The newest versions of the last date: what M4 needs."""
        dates = [d for _, d, _ in self.entries(spark)]
        return self.latest(spark, [max(dates)] if dates else [])
