"""Stream sources (S4) and record decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.schemas import LOG_JSON


def decode_records(df: DataFrame, value_col: str = "value", keep: list[str] | tuple = ()) -> DataFrame:
    """Record value (binary or text) -> typed log columns (``keep``: columns to carry,
    e.g. the record ``key``).

    Malformed JSON gives an all-NULL row and a mistyped field gives NULL in that
    field only; ``clean`` then drops rows whose ``response`` is NULL.

    The parsed struct comes out of a one-element ``explode``: later filters on its
    fields cannot be pushed below the generator, so each record is parsed once
    (pushed through a plain projection, every predicate would re-parse the JSON).
    """
    parsed = F.from_json(F.col(value_col).cast("string"), LOG_JSON)
    return df.select(*keep, F.explode(F.array(parsed)).alias("data")).select(*keep, "data.*")


def read_record_stream(
    spark: SparkSession,
    source: str = "kafka",
    *,
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """An unbounded frame with one ``value`` column holding one JSON record per row.

    ``source="kafka"`` needs the Kafka connector on the classpath; ``source="text"``
    reads newline-delimited records from files (used by tests and replays).
    ``max_offsets_per_trigger`` / ``max_files_per_trigger`` bound one micro-batch, so a
    backlog (a restart after downtime) is worked off in batches of known size.
    ``fail_on_data_loss=False`` goes on over offsets that the broker no longer has.
    """
    if source == "kafka":
        if not bootstrap_servers or not topic:
            raise ValueError("kafka source needs bootstrap_servers and topic")
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        for key, value in (options or {}).items():
            reader = reader.option(key, value)
        return reader.load().select(F.col("value"))
    if source == "text":
        if not path:
            raise ValueError("text source needs a path")
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        for key, value in (options or {}).items():
            reader = reader.option(key, value)
        return reader.load(path)
    raise ValueError(f"unknown stream source {source!r}")
