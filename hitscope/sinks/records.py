"""Log rows -> stream records (key = host, value = JSON), the inverse of S5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.schemas import LOG_JSON


def encode_records(df: DataFrame) -> DataFrame:
    """Encode raw (text) or typed log rows as ``key, value`` records.

    Numeric fields are typed first (``try_cast`` to the record schema), so a number is
    written as a JSON number; empty/bad ``bytes`` becomes 0; a field that is NULL after
    typing is left out of the JSON and decodes back to NULL.
    """
    fields = []
    for f in LOG_JSON.fields:
        c = F.col(f.name).try_cast(f.dataType)
        if f.name == "bytes":
            c = F.coalesce(c, F.lit(0).cast("long"))
        fields.append(c.alias(f.name))
    return df.select(F.col("host").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def write_records(df: DataFrame, path: str, *, fmt: str = "text", options: dict | None = None) -> None:
    """Write encoded records: ``fmt="text"`` (one JSON line per row) or ``"kafka"``
    (needs the connector; ``options`` carries ``kafka.bootstrap.servers``/``topic``)."""
    records = encode_records(df)
    if fmt == "text":
        records.select("value").write.mode("append").text(path)
    elif fmt == "kafka":
        records.write.format("kafka").options(**(options or {})).save()
    else:
        raise ValueError(f"unknown record format {fmt!r}")
