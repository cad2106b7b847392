"""Line dedup by an exact set-similarity join (operator 3).

A line is the set of its 5-word shingles (A-Z lower-cased; a line of fewer words is one
shingle). Two lines match at a Jaccard similarity of ``PERCENT`` or more, and a line goes if an
earlier line of the corpus (by doc_id, then by place) matches it, whether that one stays or not.

1. Lines with equal sets are one class. Classes of which too many shingles occur nowhere else
   cannot match another; a count-min table tells such shingles without listing them. It counts the
   earliest line of each class only; a second table of fixed size tells which lines those are.
2. The tokens of the other classes are ordered by rarity (frequencies hashed into a table of
   fixed size, ties by hash). The first of them, as many as a match cannot miss, are the keys of
   an inverted list; a pair must fit in length, and its common key must stand early enough in both
   for the needed overlap (positional filter).
3. Each list first gives the pairs of its earliest line with the others. A line that matches is
   settled; only those that do not are paired with the earlier lines of the list. Pairs are
   verified by exact overlap.
4. Lines are looked up in the settled classes, and the documents are joined with what goes.

Defined results: lines end with a line feed; a line without words never goes; null text counts as
empty and comes back unchanged; a null doc_id comes after all others; rows with the same doc_id are
ordered by a hash of their text, and repeated rows are one place, so all of them lose the same lines;
an empty table gives an empty table; a text or line of any length is read whole, in memory in proportion to it; the columns of the documents are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.llm.count_min import sketch
from hitscope.llm.textio import mix, sequence_hashes, short_hashes, slices, string_bytes, words
from hitscope.session import scratch_path

SHINGLE = 5
PERCENT = 75
#: Buckets of the table of frequencies, and the rows in which it is summed.
RARITY_BITS = 18
RARITY_ROWS = 16
_LAST = np.iinfo(np.int64).max
# What tells the two hashes of a line's set apart.
_SALTS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _line_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each line, the lines' offsets in them, each line's text and its place there."""
    found = words(texts)
    data, at = string_bytes(texts)
    feed = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([at[:-1], feed + 1]), kind="stable")
    per_text = np.diff(np.searchsorted(feed, at)) + 1
    text = np.repeat(np.arange(len(texts)), per_text)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = np.append(np.searchsorted(found.start, start), len(found.start))
    hashes = found.keys(lower=True)
    long, _, _ = sequence_hashes(hashes, first, SHINGLE)
    short, short_line = short_hashes(hashes, first, SHINGLE)
    count = np.maximum(np.diff(first) - SHINGLE + 1, 0)
    count[short_line] = 1
    at = np.append(0, np.cumsum(count))
    values, of_long = np.empty(at[-1], np.uint64), np.ones(at[-1], bool)
    of_long[at[short_line]] = False
    values[of_long], values[at[short_line]] = long, short
    values, at = _distinct(values, at)
    return values, at, text, place


def _distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value of a line once, and the lines' offsets. Few lines have one twice: a sort of numbers of line and value finds them, only they are looked at in full."""
    line = np.repeat(np.arange(len(at) - 1), np.diff(at))
    key = np.sort((line.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20)))  # past 2 ** 20 lines they share numbers, which finds some too many
    twice = np.zeros(1 << 20, bool)
    twice[key[1:][key[1:] == key[:-1]] >> np.uint64(44)] = True
    odd = np.flatnonzero(twice[line & ((1 << 20) - 1)])
    if not len(odd):
        return values, at
    odd = odd[np.lexsort((values[odd], line[odd]))]
    keep = np.ones(len(values), bool)
    keep[odd[1:][(values[odd[1:]] == values[odd[:-1]]) & (line[odd[1:]] == line[odd[:-1]])]] = False
    return values[keep], np.append(0, np.cumsum(keep))[at]


def _place_hashes(doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of each line's place in the corpus."""
    doc, tag, place = (np.ascontiguousarray(x).view(np.uint64) for x in (doc, tag, place))
    return mix(doc ^ mix(tag ^ mix(place + np.uint64(_SALTS[0]))))


def _first_places(rows: pa.RecordBatch) -> np.ndarray:
    """The place of each class's earliest line, two times, so that the table has it as one that is there."""
    first = rows.column("first")
    return np.repeat(_place_hashes(*(first.field(c).to_numpy() for c in ("doc", "tag", "place"))), 2)


def _earliest(earliest, rows: pa.RecordBatch, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether a line is the earliest of its class; true for a few others too."""
    doc, tag = (rows.column(c).to_numpy()[text] for c in ("doc", "tag"))
    return earliest.value.may_repeat(_place_hashes(doc, tag, place))


def _line_hashes(earliest):
    """The shingles of a slice, of lines that are the earliest of their class."""

    def hashes(rows: pa.RecordBatch) -> np.ndarray:
        values, at, text, place = _line_sets(rows.column("text"))
        return values[np.repeat(_earliest(earliest, rows, text, place), np.diff(at))]

    return hashes


def _sums(values: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each line's set: the sum of its mixed shingle hashes; 0 for a line without any."""
    out = np.zeros(len(at) - 1, np.uint64)
    own = np.flatnonzero(np.diff(at))
    if len(own):
        out[own] = mix(np.add.reduceat(mix(values ^ np.uint64(salt)), at[own]) + np.uint64(salt))
    return out.view(np.int64)


def _keys(values: np.ndarray, at: np.ndarray, again: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each line's set and a second one; sets whose first is in ``again`` use the second."""
    first, second = _sums(values, at, _SALTS[0]), _sums(values, at, _SALTS[1])
    if again:
        first = np.where(np.isin(first, list(again)), second, first)
    return first, second


_FIRST = "struct<doc: long, tag: long, place: long>"
_LINE = "doc long, tag long, place long, key long, second long"


def _lines(again: frozenset[int]):
    """Place and class of every line with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            values, at, text, place = _line_sets(rows.column("text"))
            key, second = _keys(values, at, again)
            own = np.flatnonzero(np.diff(at))
            doc = pa.array(text[own])
            columns = [rows.column("doc").take(doc), rows.column("tag").take(doc), pa.array(place[own]), pa.array(key[own]), pa.array(second[own])]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "tag", "place", "key", "second"])

    return run


def _least(size):
    """Shingles that a line shares with any that matches it."""
    return (PERCENT * size + 99) // 100


def _candidates(table, earliest, again: frozenset[int]):
    """Classes that may match another: their shingles that may occur elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            values, at, text, place = _line_sets(rows.column("text"))
            key, _ = _keys(values, at, again)
            size = np.diff(at)
            use = table.value.may_repeat(values)
            sums = np.append(0, np.cumsum(use))
            shared = np.diff(sums[at])
            own = np.flatnonzero((size > 0) & (shared >= _least(size)) & _earliest(earliest, rows, text, place))
            doc, tag = (rows.column(c).to_numpy()[text] for c in ("doc", "tag"))
            own = own[np.lexsort((place[own], tag[own], doc[own], key[own]))]
            own = own[np.diff(key[own], prepend=~key[own[:1]]) != 0]  # each class once, by its earliest line
            ends = np.append(0, np.cumsum(shared[own]))
            line = np.repeat(np.arange(len(own)), size[own])
            pick = np.arange(len(line)) + np.repeat(at[own] - (np.cumsum(size[own]) - size[own]), size[own])
            tokens = values[pick[use[pick]]].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))
            columns = [pa.array(x[own]) for x in (key, doc, tag, place, size)]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["key", "doc", "tag", "place", "size", "tokens"])

    return run


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _tokens(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << RARITY_BITS, np.int64)
    for rows in batches:
        flat, _ = _tokens(rows.column("tokens"))
        total += np.bincount(_bucket(flat), minlength=len(total))
    parts = total.reshape(RARITY_ROWS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(RARITY_ROWS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}  # at most RARITY_ROWS entries of fixed size
    for rows in batches:
        for part, counts in zip(*(rows.column(i).to_pylist() for i in range(2)), strict=True):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])


def _rarity(spark: SparkSession, classes: DataFrame) -> np.ndarray:
    """How often the tokens of each bucket occur: a table of fixed size."""
    schema = "part int, counts binary"
    rows = classes.select("tokens").mapInArrow(_frequencies, schema).repartition(RARITY_ROWS, "part").mapInArrow(_summed, schema).collect()
    out = np.zeros(1 << RARITY_BITS, np.int64)
    for part, counts in rows:
        out.reshape(RARITY_ROWS, -1)[part] += np.frombuffer(counts, np.int64)
    return out


def _listed(rarity: np.ndarray):
    """Inverted list entries: a class's rarest tokens, with the place of each among all of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            flat, count = _tokens(rows.column("tokens"))
            size = rows.column("size").to_numpy()
            line = np.repeat(np.arange(len(count)), count)
            by = np.lexsort((flat, rarity[_bucket(flat)], line))
            flat = flat[by]
            # tokens that occur nowhere else come before all others
            place = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count) + (size - count)[line]
            own = np.flatnonzero(place < (size - _least(size) + 1)[line])
            line = line[own]
            columns = [pa.array(flat[own]), pa.array(rows.column("key").to_numpy()[line]), pa.array(size[line]), pa.array(place[own]), rows.column("first").take(pa.array(line))]
            yield pa.RecordBatch.from_arrays(columns, ["token", "key", "size", "place", "first"])

    return run


def _stored(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = scratch_path(spark, "line_join", name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _may_match(size_a: Column, place_a: Column, size_b: Column, place_b: Column) -> Column:
    """Length filter, and positional filter: the overlap that is still possible after a common first token."""
    needed = F.ceil((size_a + size_b) * F.lit(PERCENT) / F.lit(100 + PERCENT) - F.lit(1e-9))
    left = 1 + F.least(size_a - place_a - 1, size_b - place_b - 1)
    return (size_a * 100 >= size_b * PERCENT) & (size_b * 100 >= size_a * PERCENT) & (left >= needed)


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Later classes of pairs that match."""
    a = classes.select(F.col("key").alias("earlier"), F.col("size").alias("a_size"), F.col("tokens").alias("a_tokens"))
    b = classes.select(F.col("key").alias("later"), F.col("size").alias("b_size"), F.col("tokens").alias("b_tokens"))
    both = pairs.join(b, "later").join(a, "earlier").withColumn("overlap", F.size(F.array_intersect("a_tokens", "b_tokens")))
    return both.where(100 * F.col("overlap") >= PERCENT * (F.col("a_size") + F.col("b_size") - F.col("overlap"))).select("later").distinct()


def _matched(spark: SparkSession, source: DataFrame, firsts: DataFrame, again: frozenset[int]) -> DataFrame:
    """later: classes whose first line matches an earlier line of another class."""
    earliest = spark.sparkContext.broadcast(sketch(firsts, _first_places, lines=1, columns=("first",)))
    # each class counts once, or copies of a line would make all its shingles look common
    table = spark.sparkContext.broadcast(sketch(source, _line_hashes(earliest), lines=1, columns=("doc", "tag", "text")))
    found = source.mapInArrow(_candidates(table, earliest, again), "key long, doc long, tag long, place long, size long, tokens array<long>")
    # a class that is a candidate is so by its earliest line, and perhaps by others too
    found = found.groupBy("key").agg(F.min(F.struct("doc", "tag", "place")).alias("first"), F.first("size").alias("size"), F.first("tokens").alias("tokens"))
    classes = _stored(found, "classes")
    for shared in (table, earliest):  # what follows reads the stored classes
        shared.destroy()
    rarity = _rarity(spark, classes)
    lists = classes.mapInArrow(_listed(rarity), f"token long, key long, size long, place long, first {_FIRST}")
    lists = _stored(lists, "lists")
    hubs = lists.groupBy("token").agg(F.min(F.struct("first", "key", "size", "place")).alias("hub"), F.count("*").alias("members")).where("members > 1")
    # from here on only tokens that several lines have, each entry with its list's earliest line
    lists = _stored(lists.join(hubs.select("token", F.struct("hub.key", "hub.size", "hub.place").alias("hub")), "token"), "shared_lists")
    pairs = lists.where(F.col("key") != F.col("hub.key"))
    pairs = pairs.where(_may_match(F.col("hub.size"), F.col("hub.place"), F.col("size"), F.col("place")))
    tried = _stored(pairs.select(F.col("hub.key").alias("earlier"), F.col("key").alias("later")).distinct(), "pairs")
    settled = _stored(_verified(tried, classes), "settled")
    # the rest: lines that did not match the earliest of their list, with all earlier ones but that
    open_ = lists.where(F.col("key") != F.col("hub.key")).join(settled, F.col("key") == F.col("later"), "left_anti")
    open_ = open_.select("token", F.col("key").alias("later"), F.col("size").alias("b_size"), F.col("place").alias("b_place"), F.col("first").alias("b_first"))
    pairs = lists.drop("hub").join(open_, "token").where((F.col("first") < F.col("b_first")) & _may_match(F.col("size"), F.col("place"), F.col("b_size"), F.col("b_place")))
    pairs = pairs.select(F.col("key").alias("earlier"), "later").distinct().join(tried, ["earlier", "later"], "left_anti")
    return settled.union(_verified(pairs, classes))


def _keyed(documents: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))).alias("doc"), F.xxhash64(body).alias("tag"), body.alias("text"))


def removed_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc, tag (id and hash of the text) and the places of the lines that go, of every document that loses some."""
    spark = documents.sparkSession
    source = _keyed(documents, text)
    lines = _stored(source.mapInArrow(_lines(frozenset()), _LINE), "lines")

    def grouped(rows: DataFrame) -> DataFrame:
        meet = (F.min("second") != F.max("second")).alias("meet")
        return _stored(rows.groupBy("key").agg(F.min(F.struct("doc", "tag", "place")).alias("first"), F.count("*").alias("lines"), meet), "firsts")

    firsts = grouped(lines)
    again = frozenset(r.key for r in firsts.where("meet").collect())  # about lines ** 2 / 2 ** 65 of them
    if again:
        lines = lines.withColumn("key", F.when(F.col("key").isin(list(again)), F.col("second")).otherwise(F.col("key")))
        firsts = grouped(lines)
    matched = _stored(_matched(spark, source, firsts, again).distinct(), "matched")
    marks = firsts.join(matched, F.col("key") == F.col("later"), "left").where((F.col("lines") > 1) | F.col("later").isNotNull())
    marks = marks.select("key", "first", F.col("later").isNotNull().alias("all_go"))
    gone = lines.join(marks, "key").where(F.col("all_go") | (F.struct("doc", "tag", "place") != F.col("first")))
    return gone.groupBy("doc", "tag").agg(F.array_distinct(F.collect_list("place")).alias("places"))


def _without(text: Column, places: Column) -> Column:
    """A text without some of its lines."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(places, i.cast("long"))), "\n")


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``documents``, with the text without lines that go, and __lines and __removed (their numbers)."""
    gone = removed_lines(documents, text).select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("places").alias("__places"))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST)))
    body = F.coalesce(F.col(text), F.lit(""))
    joined = documents.join(gone, (own == F.col("__doc")) & (F.xxhash64(body) == F.col("__tag")), "left")
    kept = F.when(F.col("__places").isNull(), F.col(text)).otherwise(_without(F.col(text), F.col("__places")))
    count = F.size(F.split(body, "\n", -1)).cast("long")
    columns = [kept.alias(c) if c == text else F.col(c) for c in documents.columns]
    return joined.select(*columns, count.alias("__lines"), F.coalesce(F.size("__places"), F.lit(0)).cast("long").alias("__removed"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left) of every row."""
    out = with_counts(documents.select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text")


def remove(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents without repeated lines, with their columns; those that lose all their words go."""
    out = with_counts(documents, text)
    emptied = (F.col("__removed") > 0) & ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).select(*documents.columns)
