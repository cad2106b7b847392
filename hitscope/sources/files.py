"""Batch file sources.

No source infers a schema: inference is an extra pass over the data and may type the
same key differently in two files. The access log is read as text columns and typed
by ``clean``; the two geo files are read by header name, as text, and typed here.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hitscope.schemas import GEO_BLOCKS, GEO_LOCATIONS, RAW_LOG

LOG_FIELDS = [f.name for f in RAW_LOG.fields[1:]]
#: Files whose first lines are read side by side.
HEADER_READERS = 16


def _file_names(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The data files under the paths, by Spark's own listing; no content is read."""
    return sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())


def _first_line(spark: SparkSession, name: str) -> str | None:
    """The first line of a file, decompressed by its name; None if the file is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(name)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each layout: header cells -> file names. Only the first line of a file is read (by the
    driver, ``HEADER_READERS`` at a time); empty files have no layout and are left out."""
    names = _file_names(spark, path)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda name: _first_line(spark, name), names))
    found: dict[tuple[str, ...], list[str]] = {}
    for name, line in zip(names, lines, strict=True):
        if line is not None:
            cells = tuple(next(csv.reader([line.removeprefix("\ufeff")]), []))
            found.setdefault(cells, []).append(name)
    return found


def read_access_log(spark: SparkSession, path: str | list[str], fmt: str = "csv", *, corrupt: str | None = None) -> DataFrame:
    """CSV with a header, ``"`` as both quote and escape, every field a string.

    Each file's own header says where its fields are: files are grouped by header, each group is one plan
    with its schema, and the groups are united by name, so files with another order of columns or with
    further ones can lie in one folder. A file without one of the fields is an error that names it. The
    first column is an index of any name, kept first so that ``clean`` drops it by position.

    With ``corrupt`` the records whose number of fields differs from their file's header are told in a
    column of that name (the record's text, else NULL); their fields are read as far as there are any, as
    without it. ``fmt="parquet"`` reads the same layout from Parquet (fields cast to text, so the
    cleaning rules are the same).
    """
    if fmt == "parquet":
        table = spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
        index = table.columns[0]
        return table.select(F.col(f"`{index}`").cast("string").alias("idx"),
                            *[F.col(c).cast("string").alias(c) for c in LOG_FIELDS])
    if fmt != "csv":
        raise ValueError(f"unknown access-log format {fmt!r}")
    parts = []
    for cells, names in sorted(headers(spark, path).items()):
        if not cells or cells[0] in LOG_FIELDS or not set(LOG_FIELDS) <= set(cells):
            raise ValueError(f"expected an index column and then {LOG_FIELDS} in any order, got {list(cells)} in {names[0]}")
        # by place: names may be empty or occur twice, only the log's fields must be there
        places = {f: cells.index(f) for f in LOG_FIELDS}
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(cells))] + ([StructField("bad", StringType())] if corrupt else []))
        reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
        if corrupt:  # all fields are parsed, or a record could not be told from a shorter one
            reader = reader.option("columnNameOfCorruptRecord", "bad").option("columnPruning", False)
        rows = reader.csv(names)
        more = [F.col("bad").alias(corrupt)] if corrupt else []
        parts.append(rows.select(F.col("c0").alias("idx"), *[F.col(f"c{i}").alias(f) for f, i in places.items()], *more))
    if not parts:
        return spark.createDataFrame([], StructType(RAW_LOG.fields + ([StructField(corrupt, StringType())] if corrupt else [])))
    return reduce(DataFrame.unionByName, parts)


def _read_by_header(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    text = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    return text.select([
        F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema.fields
    ])


def read_geo_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CIDR blocks; only ``network`` and ``geoname_id`` are used."""
    return _read_by_header(spark, path, GEO_BLOCKS)


def read_geo_locations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: locations; ``geoname_id`` plus the four names/codes."""
    return _read_by_header(spark, path, GEO_LOCATIONS)
