"""Document fingerprints by a threshold-scaled sketch (operator 9). DataFrame functions only.

Every run of five consecutive words gets a 63-bit hash. A fingerprint keeps all distinct hashes
below a fixed fraction (1/``SCALE``) of the range, so its size follows the document's and the
sketches of any two documents, however unequal, are samples by the same rule: intersections and
unions of sketches estimate those of the documents, and the union of two sketches is the sketch
of the two documents together. The smallest hash is kept too, so that a text with words never
has an empty fingerprint. Documents are shuffled without their sketches, which are made where the
documents arrive.

Defined results: a text with fewer than five words has its whole word sequence as its only
shingle; null or empty text, or white space alone, has an empty fingerprint; two empty
fingerprints have likeness 1; equal texts have equal fingerprints; rows with the same doc_id
and text are one document (one row); documents with the same doc_id follow each other by the
hash of their text; a null doc_id comes after all others; the only document of a table is its own
next; an empty table gives an empty table; a text of any length is sketched whole, in a row of its own; only doc_id and the text column are read, so extra
columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.session import scratch_path

SHINGLE = 5
SCALE = 8
HASH_BITS = 63
_LEAST = -(1 << 63)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _short(word_hashes: Column) -> Column:
    """A hash of a whole short sequence; null for no words."""
    return F.when(F.size(word_hashes) > 0, F.xxhash64(word_hashes, F.lit("short")))


def with_sketch(frame: DataFrame, text: str, into: str, scale: int = SCALE) -> DataFrame:
    """``frame`` with the sorted hashes of ``text``'s sketch in column ``into``."""
    hashed = frame.withColumn("__words", F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)))
    at = F.col("__words")
    positions = F.when(F.size(at) >= SHINGLE, F.sequence(F.lit(1), F.size(at) - (SHINGLE - 1))).otherwise(F.array().cast("array<int>"))
    shift = 64 - HASH_BITS
    runs = F.transform(positions, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.element_at(at, (i + k).cast("int")) for k in range(SHINGLE)]), shift))
    hashed = hashed.withColumn("__runs", F.when(F.size(at) >= SHINGLE, runs).otherwise(F.filter(F.array(F.shiftrightunsigned(_short(at), shift)), lambda h: h.isNotNull())))
    runs = F.col("__runs")
    low = F.filter(runs, lambda h: h < (1 << HASH_BITS) // scale)
    kept = F.when(F.size(runs) > 0, F.array_sort(F.array_distinct(F.concat(low, F.array(F.array_min(runs)))))).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn(into, kept).drop("__words", "__runs")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the documents of two sketches."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union).cast("double")


def containment(part: Column, whole: Column, scale: int = SCALE) -> Column:
    """Estimated share of the shingles of ``part`` that ``whole`` has; 1 for an empty part.

    Hashes at or above the threshold count only up to the smallest of both, where both sketches would
    have them. Null if no hash of a part can be compared.
    """
    least = F.least(F.array_min(part), F.array_min(whole))
    limit = F.greatest(F.lit((1 << HASH_BITS) // scale - 1), F.when(F.size(whole) > 0, least).otherwise(F.array_min(part)))
    sampled = F.filter(part, lambda h: h <= limit)
    share = F.when(F.size(sampled) > 0, F.size(F.array_intersect(sampled, whole)) / F.size(sampled))
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(share).cast("double")


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents together (but for the extra smallest hashes, which stay)."""
    return F.array_sort(F.array_union(a, b))


def as_text(sketch: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), -(-HASH_BITS // 4), "0"))), "")


def _next_documents(ids: DataFrame) -> DataFrame:
    """For each (id, tag) the one that follows by descending id, the first after the last.

    Rows are sorted in ranges of ids; a range looks up the one after it in a table of one row per range.
    """
    order = [F.col("id").desc(), F.col("tag").desc()]
    path = scratch_path(ids.sparkSession, "id_ranges")
    ids.repartitionByRange(*order).withColumn("range", F.spark_partition_id()).write.parquet(path)
    ranged = ids.sparkSession.read.parquet(path)
    first = F.struct("id", "tag")
    heads = ranged.groupBy("range").agg(F.max(first).alias("head"))
    by_range = Window.orderBy("range")
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.col("range").alias("of"), F.coalesce(F.lead("head").over(by_range), F.max("head").over(whole)).alias("beyond"))
    follow = F.lead(first).over(Window.partitionBy("range").orderBy(*order))
    found = ranged.withColumn("follow", follow).join(heads, F.col("range") == F.col("of"))
    follow = F.coalesce("follow", "beyond")
    return found.select("id", "tag", "size", follow["id"].alias("next_id"), follow["tag"].alias("next_tag"))


def fingerprints(documents: DataFrame, text: str = "text", scale: int = SCALE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text ends in the beginning of the next document instead of its own last third.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # id and tag together name a document; the id of a document without one is the least
    source = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("id"), F.xxhash64(body).alias("tag"), body.alias("text"))
    sizes = source.select("id", "tag", F.char_length("text").cast("long").alias("size")).dropDuplicates(["id", "tag"])
    follow = _next_documents(sizes)
    sketched = with_sketch(source.repartition("id", "tag").dropDuplicates(["id", "tag"]), "text", "sketch", scale)
    heads = follow.select(F.col("id").alias("of_id"), F.col("tag").alias("of_tag"), "size", "next_id", "next_tag")
    heads = sketched.join(heads, (F.col("id") == F.col("next_id")) & (F.col("tag") == F.col("next_tag"))).select(
        "of_id", "of_tag", "size", F.substring("text", F.lit(1), F.floor(F.col("size") / 3).cast("int")).alias("head"), F.col("sketch").alias("next_sketch")
    )
    both = sketched.join(heads, (F.col("id") == F.col("of_id")) & (F.col("tag") == F.col("of_tag")))
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("size") - F.floor(F.col("size") / 3)).cast("int")), "head"))
    both = with_sketch(both, "edited", "edited_sketch", scale)
    return both.select(
        F.when(F.col("id") != _LEAST, F.col("id")).alias("doc_id"),
        F.col("size").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
