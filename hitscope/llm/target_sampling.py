"""Target-distribution importance resampling (operator 11).

Features of a text are its runs of words; each falls into one of ``BUCKETS`` buckets by CRC-32.
The log ratio of a bucket in the target texts and in the corpus is its gain, and a text's weight
is the sum of the gains of its features. With keyed Gumbel noise added, taking the highest
scores draws documents in proportion to their importance without replacement.

1. One pass counts the corpus by bucket (an array a task, at most ``BUCKETS`` rows each); the gains
   are an array of ``BUCKETS`` integers.
2. A second pass sums the gains of every text's features (numpy, whole texts in slices), and the
   scored rows (no text) are written as a table.
3. The score of the last drawn row is found by bisection: each job counts, exactly and over the
   persisted table, the rows between thresholds that cut what is left of the interval into ``WAYS``
   equal parts. Rows with that score are cut by doc_id in the same way, then by their number
   of features and by their number in the table, so the draw is exact without a global sort.
4. Only drawn rows are sorted, by ranges; a rank is the row's place in its range plus the sizes of
   the ranges before it (one number a range is collected).

Defined results: null or empty text has no features and weight 0; a null doc_id has the noise of
the empty string and comes last among ties; rows with the same doc_id are drawn each on their
own, ties among them go to fewer features, and rows that are equal in all that is returned get
consecutive ranks; with no target texts every count of the target is 0; fewer than ``LEAST_WORDS``
words are never drawn; a text of any length is read whole, in memory in proportion to the longest text
of a slice; an empty table gives an empty table; only doc_id and the text column are read, so
extra columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.llm.crc import CRC_TABLE, crc32_ranges, crc_sql
from hitscope.llm.textio import Words, slices, words
from hitscope.session import scratch_path

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
KEY = "2024"
#: Longest run of words that is a feature.
RUN = 1
#: Parts into which a counting job cuts the interval that holds the cutoff.
WAYS = 1024
#: Drawn rows in one range of the final sort.
RANGE_ROWS = 500_000

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _runs(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The slice with one space between the words of a text, and the byte ranges and text of every run of ``size`` words."""
    lower = _LOWER[found.data]
    if size == 1:
        return lower, found.start, found.end, found.doc
    length = found.end - found.start
    start = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    place = np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)
    origin = np.arange(int(length.sum())) + np.repeat(found.start - (np.cumsum(length) - length), length)
    joined[place] = lower[origin]
    first = np.flatnonzero(found.doc[: len(start) - size + 1] == found.doc[size - 1 :]) if len(start) >= size else np.empty(0, np.int64)
    return joined, start[first], start[first + size - 1] + length[first + size - 1], found.doc[first]


def _features(texts: pa.Array, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature of a slice, and the number of words of each text."""
    found = words(texts, _APART)
    parts = []
    for size in range(1, run + 1):
        data, start, end, doc = _runs(found, size)
        parts.append((crc32_ranges(data, start, end) % np.uint32(buckets), doc))
    return np.concatenate([b for b, _ in parts]).astype(np.int64), np.concatenate([d for _, d in parts]), np.diff(found.first)


def bucket_counts(documents: DataFrame, text: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: an array of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for rows in slices(batches, "text"):
            total += np.bincount(_features(rows.column("text"), run, buckets)[0], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = documents.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, in doubles."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(corpus, target, strict=True)], np.int64)


def scored(documents: DataFrame, gain: np.ndarray, key: str = KEY, text: str = "text", run: int = RUN) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)  # ``buckets`` integers

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for rows in slices(batches, "text"):
            bucket, doc, n_words = _features(rows.column("text"), run, len(table))
            order = np.argsort(doc, kind="stable") if run > 1 else slice(None)
            sums = np.append(0, np.cumsum(table[bucket[order]]))
            edge = np.searchsorted(doc[order], np.arange(rows.num_rows + 1))
            weight = sums[edge[1:]] - sums[edge[:-1]]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(edge)), pa.array(n_words), pa.array(weight)], ["doc_id", "n_features", "n_words", "weight"])

    weighed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(weigh, "doc_id long, n_features long, n_words long, weight long")
    name = F.concat(F.lit(f"{key}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


def _part(value: Column, low: int, step: int) -> Column:
    """Which part of ``step`` values from ``low`` on holds a value; whole numbers throughout."""
    return F.call_function("div", value - F.lit(low), F.lit(step)).cast("int")


def _nth(rows: DataFrame, key: str, n: int) -> tuple[int, int, int]:
    """The n-th smallest value of ``key`` and the numbers of rows below it and at it, by counting jobs."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows below ``low``
    while True:
        step = -(-(high - low + 1) // WAYS)
        wide = F.col(key) if high - low < 1 << 63 else F.col(key).cast("decimal(20,0)")
        counts = rows.where(F.col(key).between(low, high)).groupBy(_part(wide, low, step).alias("part")).count().collect()  # at most WAYS rows
        for row in sorted(counts):
            if below + row["count"] >= n:
                break
            below += row["count"]
        low, high = low + row["part"] * step, min(low + (row["part"] + 1) * step - 1, high)
        if low == high:
            return low, below, row["count"]


#: The order of the draw: ascending by each of these; ``row`` parts rows that are equal in all that is returned.
_ORDER = {"falling": "-score", "nameless": "int(doc_id IS NULL)", "name": "coalesce(doc_id, 0L)", "features": "n_features", "row": "row"}


def cutoff(rows: DataFrame, keys: Sequence[str], n: int) -> list[tuple[str, int]]:
    """The keys of the n-th row in the order of ``keys``; later keys are left out where all tied rows belong to the n."""
    found: list[tuple[str, int]] = []
    for key in keys:
        value, below, at = _nth(rows, key, n)
        found.append((key, value))
        n -= below
        if at == n:
            break
        rows = rows.where(F.col(key) == value)
    return found


def _up_to(found: list[tuple[str, int]]) -> Column:
    """Rows at or before the cutoff."""
    out = F.lit(True)
    for key, value in reversed(found):
        out = (F.col(key) < value) | ((F.col(key) == value) & out)
    return out


def ranked(rows: DataFrame, keys: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """``rows`` (at most ``n`` of them) with their place 1, 2, 3... in the order of ``keys``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "target_ranks")
    spread = rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *keys).sortWithinPartitions(*keys)
    # the id of a row holds its range in the upper bits and its place in the range in the lower 33
    spread.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    ends = placed.groupBy(F.shiftright("place", 33).alias("range")).count().orderBy("range").collect()  # one row a range
    before = dict(zip((r["range"] for r in ends), np.append(0, np.cumsum([r["count"] for r in ends])[:-1]).tolist(), strict=True)) if ends else {}
    offsets = spark.createDataFrame(sorted(before.items()), "range long, before long")
    place = F.col("place").bitwiseAND((1 << 33) - 1)
    joined = placed.withColumn("range", F.shiftright("place", 33)).join(F.broadcast(offsets), "range")
    return joined.withColumn(name, F.col("before") + place + 1).drop("range", "before", "place")


def draw(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, key: str = KEY, run: int = RUN, buckets: int = BUCKETS, text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn."""
    spark = documents.sparkSession
    gain = gains(bucket_counts(documents, text, run, buckets), bucket_counts(target, target_text, run, buckets))
    path = scratch_path(spark, "target_scores")
    scored(documents, gain, key, text, run).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    table = spark.read.parquet(path).withColumns({name: F.expr(rule) for name, rule in _ORDER.items()})
    fields = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= least_words
    n = table.where(eligible).count() * percent // 100
    if not n:
        return table.select(*fields, F.lit(None).cast("long").alias("rank"))
    taken = eligible & _up_to(cutoff(table.where(eligible), list(_ORDER), n))
    drawn = ranked(table.where(taken), list(_ORDER), n)
    return drawn.select(*fields, "rank").union(table.where(~taken).select(*fields, F.lit(None).cast("long").alias("rank")))


def selected(documents: DataFrame, target: DataFrame, **options: object) -> DataFrame:
    """The drawn documents with the columns of ``documents``; of rows with one doc_id all that have a drawn row's id."""
    ids = draw(documents, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct()
    return documents.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi").select(*documents.columns)


ORACLE = rf"""
WITH RECURSIVE {CRC_TABLE},
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY ALL),
vocab AS (SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (SELECT word, n AS s, 0 AS t FROM dw UNION ALL SELECT word, 0, 1 FROM bw) GROUP BY word),
named AS (SELECT word, {crc_sql('word')} % 10000 AS bucket, s, t FROM vocab, crc_table),
per AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM named GROUP BY bucket),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM per),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS g FROM per, total),
weights AS (SELECT doc_id, sum(n * g)::BIGINT AS weight FROM dw JOIN named USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (SELECT w.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weights ON weights.doc_id = w.doc_id),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores s LEFT JOIN places p ON p.doc_id = s.doc_id
"""
