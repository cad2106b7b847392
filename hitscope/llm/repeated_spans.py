"""Substring dedup with a count-min prefilter (operator 10).

A window is 13 consecutive words of one document. A word goes if a window that covers it also
occurs in a document with a smaller doc_id.

1. Each task hashes its windows and sends a sketch: the cells of each line of a count-min table
   that it has hit, and those it has hit more than once. Sketches are merged by ranges of cells
   into one bit per cell: hit at least twice. The table has a fixed size (two lines of
   2 ** 28 bits, 64 MB in all), so the broadcast does not grow with the data.
2. A second pass over all texts sends only windows whose cells all have that bit. A sketch can
   only overestimate, so every repeated window is among them; on more data than the table can
   tell apart more windows come through, none is lost. Windows are dealt by the upper bits of
   their hash and grouped by it and by 32 further bits of their words, and those in a document other than the
   smallest of their group are returned to their documents.
3. The documents are joined with what goes.

A window that occurs very often (at most 1000 such) is sent once per slice of a task, and
what goes of it is decided in the last pass from a small table, so no task gets all of it.

Defined results: null or empty text has no words and keeps the empty text; fewer than 13 words
lose nothing; a null doc_id counts as larger than any other; rows with the same doc_id are not
smaller than one another, so none of them loses words to another; repeated rows each give a row,
with equal results; an empty table gives an empty table; a text of any length is read whole, in memory in proportion to it; only doc_id
and the text column are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.llm.count_min import Sketch, gaps_packed, gaps_unpacked, sketch
from hitscope.llm.textio import _SPACES, Words, binary_array, sequence_checks, sequence_hashes, slices, string_bytes, words
from hitscope.session import scratch_path

WINDOW = 13
#: Windows in one range of hashes, as far as windows can be told before the second pass.
RANGE_WINDOWS = 4_000_000
_LAST = np.iinfo(np.int64).max


def _windows(rows: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    found = words(rows.column("text"))
    return found, *sequence_hashes(found.hashes(), found.first, WINDOW)


def _window_hashes(rows: pa.RecordBatch) -> np.ndarray:
    return _windows(rows)[1]


_SENT = "range int, ids binary, tags binary, counts binary, lengths binary, starts binary, hashes binary, checks binary"


def _sent(table, range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Sketch = table.value
        for rows in slices(batches, "text"):
            found, hashes, doc, start = _windows(rows)
            ids = rows.column("order").to_numpy()
            tags = rows.column("tag").to_numpy()
            use = seen.may_repeat(hashes)
            if len(seen.heavy) and len(hashes):
                at = np.minimum(np.searchsorted(seen.heavy, hashes), len(seen.heavy) - 1)
                spots = np.flatnonzero(seen.heavy[at] == hashes)
                use[spots] = False
                by = spots[np.lexsort((ids[doc[spots]], hashes[spots]))]  # of each heavy window only its smallest document
                use[by[np.flatnonzero(np.diff(hashes[by], prepend=hashes[by[:1]] + np.uint64(1)))] if len(by) else by] = True
            checks = sequence_checks(found.hashes(), start[use], WINDOW)
            hashes, doc, start = hashes[use], doc[use], start[use] - found.first[doc[use]]
            shard = (hashes >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(hashes), np.int64)
            by = np.argsort(shard, kind="stable")
            out, edges = [], np.searchsorted(shard[by], np.arange((1 << range_bits) + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own = by[edges[k] : edges[k + 1]]
                docs, count = np.unique(doc[own], return_counts=True)
                far = start[own] + np.repeat(np.cumsum(np.append(0, found.first[docs[:-1] + 1] - found.first[docs[:-1]])), count)
                out.append((k, ids[docs].tobytes(), tags[docs].tobytes(), count.astype(np.uint32).tobytes(), np.diff(found.first)[docs].astype(np.uint32).tobytes(), gaps_packed(far), hashes[own].tobytes(), checks[own].tobytes()))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], ["range", "ids", "tags", "counts", "lengths", "starts", "hashes", "checks"])

    return run


_GONE = "order long, tag int, hash long, starts binary"


def _grouped(heavy: np.ndarray):
    """Per document the starts of its windows that a smaller document has too; per heavy window its smallest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True))
        for _, group in groupby(rows, key=lambda r: r[0]):
            parts = [[] for _ in range(5)]
            for _, ids, tags, counts, lengths, starts, hashes, checks in group:
                count, length = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (counts, lengths))
                own = gaps_unpacked(starts) - np.repeat(np.cumsum(np.append(0, length[:-1])), count)
                for part, values in zip(parts, (np.repeat(np.frombuffer(ids, np.int64), count), np.repeat(np.frombuffer(tags, np.int32), count), own.astype(np.uint32), np.frombuffer(hashes, np.uint64), np.frombuffer(checks, np.uint32)), strict=True):
                    part.append(values)
            ids, tags, starts, hashes, checks = (np.concatenate(p) for p in parts)
            by = np.argsort(hashes, kind="stable")
            if np.any((hashes[by[1:]] == hashes[by[:-1]]) & (checks[by[1:]] != checks[by[:-1]])):
                by = np.lexsort((checks, hashes))  # different words with one hash
            edge = np.flatnonzero(np.append(True, (hashes[by[1:]] != hashes[by[:-1]]) | (checks[by[1:]] != checks[by[:-1]])))
            least = np.minimum.reduceat(ids[by], edge)
            size = np.diff(np.append(edge, len(by)))
            gone = by[ids[by] > np.repeat(least, size)]
            known = np.isin(hashes[by[edge]], heavy)
            gone = gone[~np.isin(hashes[gone], heavy)]
            gone = gone[np.lexsort((starts[gone], tags[gone], ids[gone]))]
            other = (ids[gone[1:]] != ids[gone[:-1]]) | (tags[gone[1:]] != tags[gone[:-1]])
            new = np.append(0, np.flatnonzero(other) + 1) if len(gone) else gone
            offsets = np.append(new, len(gone)) * 4
            n = int(known.sum())
            order = pa.array(np.append(ids[gone[new]], least[known]))
            tag = pa.concat_arrays([pa.array(tags[gone[new]]), pa.nulls(n, pa.int32())])
            key = pa.concat_arrays([pa.nulls(len(new), pa.int64()), pa.array(hashes[by[edge]][known].view(np.int64))])
            blobs = pa.concat_arrays([binary_array(starts[gone].astype("<u4"), offsets).cast(pa.binary()), pa.nulls(n, pa.binary())])
            yield pa.RecordBatch.from_arrays([order, tag, key, blobs], ["order", "tag", "hash", "starts"])

    return run


def _cut(heavy: np.ndarray, least: np.ndarray):
    """Number of words, of words that go, and the words that stay, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            found = words(rows.column("text"))
            step = np.zeros(len(found.start) + WINDOW + 1, np.int32)
            gone = rows.column("gone")
            blobs = gone.flatten()
            per_blob = np.repeat(np.arange(len(gone)), np.nan_to_num(gone.value_lengths().to_numpy(zero_copy_only=False)).astype(int))
            starts = [np.frombuffer(b, "<u4").astype(np.int64) + found.first[d] for b, d in zip(blobs.to_pylist(), per_blob.tolist(), strict=True)]
            if len(heavy) and len(found.start):
                hashes, doc, start = sequence_hashes(found.hashes(), found.first, WINDOW)
                at = np.minimum(np.searchsorted(heavy, hashes), len(heavy) - 1)
                starts.append(start[(heavy[at] == hashes) & (rows.column("order").to_numpy()[doc] > least[at])])
            starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + WINDOW, -1)
            stays = np.cumsum(step)[: len(found.start)] == 0
            sums = np.append(0, np.cumsum(stays))
            n_words, n_kept = np.diff(found.first), np.diff(sums[found.first])
            kept = np.flatnonzero(stays)
            doc = found.doc[kept]
            inner = np.append(doc[1:] == doc[:-1], False)[: len(kept)]
            edge = np.zeros(len(found.data) + 2, np.int8)
            edge[found.start[kept]] += 1
            np.add.at(edge, found.end[kept] + inner, -1)
            mask = np.cumsum(edge, dtype=np.int8)[: len(found.data)] > 0
            body = np.where(_SPACES[found.data], np.uint8(0x20), found.data)[mask]
            _, at = string_bytes(rows.column("text"))
            text = binary_array(body, np.append(0, np.cumsum(mask))[at]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n_words), pa.array(n_words - n_kept), text], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(documents: DataFrame, text: str = "text", **heavy: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text's remaining words, joined by one space) of every distinct (doc_id, text)."""
    spark: SparkSession = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the tag tells rows with one doc_id apart
    source = source.withColumn("tag", F.hash("text")).withColumn("order", F.coalesce("doc_id", F.lit(int(_LAST))))
    table = sketch(source, _window_hashes, **heavy)
    range_bits = max(6, int(np.ceil(np.log2(max(table.total, 1) / RANGE_WINDOWS + 1))))
    shared = spark.sparkContext.broadcast(table)
    sent = source.select("order", "tag", "text").mapInArrow(_sent(shared, range_bits), _SENT)
    path = scratch_path(spark, "repeated_spans")
    # sorted by range, so that a task has one range in memory at a time
    sent.repartition(1 << range_bits, "range").sortWithinPartitions("range").mapInArrow(_grouped(table.heavy), _GONE).write.parquet(path)
    found = spark.read.schema(_GONE).parquet(path)
    smallest = found.where("hash IS NOT NULL").groupBy("hash").agg(F.min("order").alias("order"))
    least = {r.hash & ((1 << 64) - 1): r.order for r in smallest.collect()} if len(table.heavy) else {}  # at most 1000 rows
    keys = np.array(sorted(least), np.uint64)
    values = np.array([least[k] for k in keys.tolist()], np.int64)
    gone = found.where("hash IS NULL").groupBy(F.col("order").alias("gone_order"), F.col("tag").alias("gone_tag")).agg(F.collect_list("starts").alias("gone"))
    joined = source.join(gone, (F.col("order") == F.col("gone_order")) & (F.col("tag") == F.col("gone_tag")), "left")
    joined = joined.select("doc_id", "order", "text", F.coalesce("gone", F.array().cast("array<binary>")).alias("gone"))
    shared.unpersist()
    return joined.mapInArrow(_cut(keys, values), "doc_id long, n_words long, n_removed long, kept binary")


def digest(documents: DataFrame, **heavy: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return remove_repeats(documents, **heavy).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS span
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
least AS (SELECT span, min(doc_id) AS first_id FROM k GROUP BY span),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT k.doc_id, unnest(range(k.i, k.i + 13)) AS p FROM k JOIN least USING (span) WHERE first_id < k.doc_id)),
u AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w)
SELECT w.doc_id, count(u.p) AS n_words, count(gone.p) AS n_removed,
       sha256(coalesce(string_agg(u.word, ' ' ORDER BY u.p) FILTER (WHERE gone.p IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN u ON u.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.p = u.p GROUP BY w.doc_id
"""
