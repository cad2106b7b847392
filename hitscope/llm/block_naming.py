"""Exact dedup by deterministic block naming (operator 8).

A text, with each run of white space replaced by one space, is cut into blocks of fixed size.
Equal blocks get one integer name, distinct blocks distinct names: rows are dealt by content,
sorted, and numbered where the content changes. Then the names of adjacent blocks are paired
and the pairs named the same way, level by level, until each document has one name. Names
stand for contents compared byte by byte, so no hash collision can merge two texts.

A content that occurs very often (up to ``HEAVY`` contents, the most frequent first) is named
from a small table in every task and is not dealt at all, so no task gets a hot group; any other
content has at most ``max(HEAVY_FROM, rows / HEAVY)`` rows.

Defined results: null text counts as empty, and empty texts are equal to each other; rows with
the same doc_id and the same text are one document (one row); of equal texts the smallest
doc_id stays, null doc_id counting as largest, and between equal ids the smaller text hash;
an empty table gives an empty table; a text of any length is named block by block, in as many levels as it
needs; only doc_id and the text column are read, so extra
columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.llm.textio import _SPACES, binary_array, slices, string_bytes
from hitscope.session import scratch_path

BLOCK_BYTES = 2048
HEAVY = 1000
HEAVY_FROM = 1000
SPACE_RUN = r"[\x20\x09-\x0D]+"
_ROW = "doc_id long, tag long, part long, parts long"


def single_spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with every run of white space replaced by one space."""
    data, at = string_bytes(texts)
    blank = _SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    again = blank.copy()
    again[1:] &= blank[:-1]
    again &= ~edge[:-1]
    keep = ~again
    kept = np.append(0, np.cumsum(keep))
    return np.where(blank, np.uint8(0x20), data)[keep], kept[at]


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            data, at = single_spaced(rows.column("text"))
            length = np.diff(at)
            parts = np.maximum(-(-length // size), 1)
            doc = np.repeat(np.arange(len(parts)), parts)
            part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = at[doc] + part * size
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(doc)), rows.column("tag").take(pa.array(doc)), pa.array(part), pa.array(parts[doc]),
                 binary_array(data, np.append(start, at[-1])).cast(pa.binary())],
                ["doc_id", "tag", "part", "parts", "key"],
            )

    return run


def _number(heavy: dict[bytes, int]):
    """Names of sorted keys: a task's number and a count of distinct keys; heavy keys have theirs already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = (TaskContext.get().partitionId() << 33) - 1, None
        for rows in batches:
            coded = rows.column("key").dictionary_encode()
            names = np.empty(len(coded.dictionary), np.int64)
            for i, key in enumerate(coded.dictionary.to_pylist()):  # in order of appearance, which is sorted
                if key in heavy:
                    names[i] = heavy[key]
                    continue
                if key != last:
                    name, last = name + 1, key
                names[i] = name
            out = pa.array(names[coded.indices.to_numpy()]) if rows.num_rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("doc_id", "tag", "part", "parts")] + [out], ["doc_id", "tag", "part", "parts", "name"])

    return run


def _named(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows with an integer ``name`` for their ``key``: equal names for equal keys and for no others. Written once."""
    mark = F.xxhash64("key")
    often = rows.groupBy(mark.alias("mark")).count().where(F.col("count") > HEAVY_FROM).orderBy(F.desc("count"), "mark").limit(HEAVY)
    marks = [r.mark for r in often.collect()]
    keys = sorted(bytes(r.key) for r in rows.where(mark.isin(marks)).select("key").distinct().collect()) if marks else []
    heavy = {key: -1 - i for i, key in enumerate(keys)}
    target = F.when(mark.isin(marks), F.xxhash64("doc_id", "tag", "part")).otherwise(mark) if marks else mark
    path = scratch_path(spark, "block_names")
    dealt = rows.withColumn("target", target).repartition("target").drop("target").sortWithinPartitions("key")
    dealt.mapInArrow(_number(heavy), f"{_ROW}, name long").write.parquet(path)
    return spark.read.parquet(path)


def identities(documents: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, tag (hash of the text, to tell rows with one doc_id apart), level and name of every distinct (doc_id, text).

    Two documents have equal (level, name) exactly if their texts are equal.
    """
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    named = _named(spark, source.mapInArrow(_blocks(block_bytes), f"{_ROW}, key binary"))
    most = named.agg(F.max("parts")).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(named.where("parts = 1").select("doc_id", "tag", F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        number = [F.max(F.when(F.col("part") % 2 == side, F.col("name"))) for side in (0, 1)]
        pairs = (
            named.where("parts > 1")
            .groupBy("doc_id", "tag", (F.col("part") / 2).cast("long").alias("part"), F.ceil(F.col("parts") / 2).cast("long").alias("parts"))
            .agg(number[0].alias("left"), number[1].alias("right"))
        )
        key = F.encode(F.concat_ws(":", "left", F.coalesce(F.col("right").cast("string"), F.lit("end"))), "UTF-8")
        named = _named(spark, pairs.select("doc_id", "tag", "part", "parts", key.alias("key")))
        most, level = -(-most // 2), level + 1
    out = done[0]
    for rows in done[1:]:
        out = out.union(rows)
    return out.distinct()


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def deduplicate(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document, those that go included."""
    own = identities(documents, text)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tag")
    groups = own.groupBy("level", "name").agg(F.min(order).alias("keep"), F.count("*").alias("group_size"))
    member = own.join(groups, ["level", "name"]).select(
        F.col("doc_id").alias("own_id"), F.col("tag").alias("own_tag"), F.col("keep.doc_id").alias("keep_id"), "group_size",
        (order == F.col("keep")).alias("kept"),
    )
    texts = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tag"), F.sha2(normalised(F.col(text)), 256).alias("text_sha256")
    ).dropDuplicates(["doc_id", "tag"])
    return texts.join(member, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tag") == F.col("own_tag"))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""
