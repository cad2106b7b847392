"""Mixing sources to target weights by pivotal dependent rounding (operator 7).

A source's target divided by its words is the expected number of copies of each of its
documents. The whole part is taken for sure; the fractional parts are rounded in pairs: words
move at random from one document of a pair to the other until one of the two is taken or left.
That keeps the expected copies of every document, and the source's words exactly, until a single
document with a fraction is left; it is rounded by chance. Larger documents are paired first,
so what is left last is small.

Pairs are formed in blocks of about ``BLOCK_ROWS`` documents (a hot source is many blocks). The
one open document of each block goes up a tree of fan-in ``FAN_IN`` to the block above, until
each source is one block. Chance comes from a hash of seed, level and the two documents, so
runs agree whatever the partitioning.

Defined results: null or empty text has size 0 and is never taken; every row is a document of its
own, rows with the same doc_id, source and text are told apart by a number; null is a source of its
own, the last; a source without words has target 0; an empty table gives an empty table; ties in size
fall by doc_id (null last), text hash and number; a text of any length is one document, its words are
counted in place; only doc_id, source and the text column are read, so extra columns never clash.
Sources are few: the water level of the targets is found in one task over one row a source.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitscope.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 4096
FAN_IN = 256
SALTS = 32
#: Equal rows that one task numbers.
CHUNK = 100_000
_OPEN = 1e-9
_SCHEMA = "doc_id long, source string, tag long, number long, size long, source_size long, target double, base long, block long, chance double, copies long"


_FIELDS = [f.split()[0] for f in _SCHEMA.split(", ")]


def targets(sizes: DataFrame, share: float, weights: Sequence[float], cap: float) -> DataFrame:
    """source, documents, source_size, target of every source: ``share`` of all words by weight, at most ``cap`` times the source.

    Targets are min(cap, weight * level); level is found on the sources in the order in which they reach their cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    sources = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    sources = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    full_at = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_at.rowsBetween(0, Window.unboundedFollowing)
    whole = full_at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    fits = F.when(level <= F.col("most") / F.col("weight"), level)
    ranked = sources.select("*", F.row_number().over(full_at).alias("rank"), fits.alias("level"))
    found = F.min(F.when(F.col("level").isNotNull(), F.struct("rank", "level"))).over(whole)
    # share > cap leaves no level: then all sources are full.
    return ranked.select("source", "documents", "source_size", F.least(F.col("most"), F.coalesce(F.col("weight") * found["level"], F.col("most"))).alias("target"))


def _rounding(seed: int, level: int, last: bool, fan_in: int):
    def draw(*what: object) -> float:
        return xxhash.xxh3_64_intdigest(repr((seed, level, what)).encode()) / 2.0**64

    def run(rows: pa.Table) -> pa.Table:
        # Arrow keeps whole numbers beside nulls; a frame would make them floats
        size, chance = rows["size"].to_pylist(), rows["chance"].to_pylist()
        name = list(zip(rows["doc_id"].to_pylist(), rows["tag"].to_pylist(), rows["number"].to_pylist(), strict=True))
        a = None
        for b in sorted(range(len(size)), key=lambda i: (-size[i], name[i][0] is None, name[i][0] or 0, name[i][1:])):
            if a is None:
                a = b
                continue
            up = min((1 - chance[a]) * size[a], chance[b] * size[b])
            down = min(chance[a] * size[a], (1 - chance[b]) * size[b])
            moved = up if draw(name[a], name[b]) * (up + down) < down else -down
            chance[a] += moved / size[a]
            chance[b] -= moved / size[b]
            open_a, open_b = (_OPEN < chance[i] < 1 - _OPEN for i in (a, b))
            a = a if open_a else b if open_b else None
        if a is not None and last:
            chance[a] = float(draw(name[a]) < chance[a])
        base = rows["base"].to_pylist()
        made = {
            "copies": pa.array([n + round(c) if not _OPEN < c < 1 - _OPEN else None for n, c in zip(base, chance, strict=True)], pa.int64()),
            "chance": pa.array(chance, pa.float64()),
            "block": pa.array(rows["block"].to_numpy() // fan_in),
        }
        return pa.table({f: made.get(f, rows[f]) for f in _FIELDS})

    return run


def _numbered(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with a number 0, 1, 2... among those of equal ``keys``, given out part by part so that no task has all of a large group."""
    spark = rows.sparkSession
    path = scratch_path(spark, "mix_numbers")
    rows.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)  # the number of the part is in the upper bits
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__row", 33))
    by_part = rows.groupBy(*keys, "__part").count()
    before = F.sum("count").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_part.select(*[F.col(k).alias(f"{k}_of") for k in keys], F.col("__part").alias("__of"), F.coalesce(before, F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy("__row")) - 1
    same = F.col("__part") == F.col("__of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return rows.withColumn(name, own).join(starts, same).withColumn(name, F.col(name) + F.col("__start")).drop("__row", "__part", "__of", "__start", *[f"{k}_of" for k in keys])


def mix(documents: DataFrame, share: float = 1.5, weights: Sequence[float] = (3, 1, 2), cap: float = 2.0, seed: int = 7, text: str = "text") -> DataFrame:
    """doc_id, source, tag (hash of the text), number (among equal rows), size, source_size, target, copies of every row."""
    spark = documents.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    path = scratch_path(spark, "mix_sizes")
    sizes = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64(body).alias("tag"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"))
    sizes = sizes.groupBy("doc_id", "source", "tag").agg(F.first("size").alias("size"), F.count("*").alias("equal"))
    chunks = sizes.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("equal") - 1) / CHUNK))))
    many = chunks.where(F.col("equal") > CHUNK).repartition("doc_id", "tag", "chunk")  # a large group of equal rows is numbered by several tasks
    parts = chunks.where(F.col("equal") <= CHUNK).union(many)
    last = F.least((F.col("chunk") + 1) * CHUNK, F.col("equal")) - 1
    parts.select("doc_id", "source", "tag", "size", F.explode(F.sequence(F.col("chunk") * CHUNK, last)).alias("number")).write.parquet(path)
    sizes = spark.read.parquet(path)
    goals = targets(sizes, share, weights, cap).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "goal")
    own = F.xxhash64("doc_id", "tag", "number", F.lit(seed))
    salted = sizes.withColumn("salt", F.pmod(own, F.lit(SALTS)).cast("int")).alias("d")
    rows = salted.join(goals.alias("g"), (F.col("d.salt") == F.col("g.salt")) & F.col("d.source").eqNullSafe(F.col("g.goal")))
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(ratio + _OPEN).cast("long")
    chance = F.greatest(ratio - F.floor(ratio + _OPEN), F.lit(0.0))
    block = F.pmod(F.xxhash64("doc_id", "tag", "number", F.lit(seed + 1)), F.ceil(F.col("documents") / BLOCK_ROWS).cast("long"))
    rows = rows.select("doc_id", "source", "tag", "number", "size", "source_size", "target", base.alias("base"), block.alias("block"), chance.alias("chance"), "documents")
    rows = rows.withColumn("copies", F.when(F.col("chance") <= _OPEN, F.col("base")))
    blocks = -(-(sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 1) // BLOCK_ROWS)
    settled = [rows.where("copies IS NOT NULL").select(*_FIELDS)]
    waiting, level = rows.where("copies IS NULL").select(*_FIELDS), 0
    while True:
        last = blocks <= 1
        path = scratch_path(spark, "mix_level")
        waiting.groupBy("source", "block").applyInArrow(_rounding(seed, level, last, FAN_IN), _SCHEMA).write.parquet(path)
        ended = spark.read.parquet(path)
        settled.append(ended.where("copies IS NOT NULL"))
        waiting = ended.where("copies IS NULL")
        if last:
            break
        blocks, level = -(-blocks // FAN_IN), level + 1
    out = settled[0]
    for rows in settled[1:]:
        out = out.union(rows)
    return out.select("doc_id", "source", "tag", "number", "size", "source_size", "target", "copies")


def repeated(documents: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The mixed documents: every row as often as it is taken, with the columns of ``documents``.

    Of rows with the same doc_id, source and text each has its own number of copies; those that differ in
    other columns are numbered in no fixed order.
    """
    keys = ["doc_id", "source", "tag"]
    taken = mix(documents, text=text, **options)
    groups = taken.groupBy(*keys).agg(F.count("*").alias("__equal"), F.sum("copies").alias("__copies"))
    picks = groups.where("__copies > 0").select(*[F.col(k).alias(f"__{k}") for k in keys], "__equal", "__copies")
    own = documents.withColumn("__own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id")) & F.col("source").cast("string").eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__tag"))
    met = own.join(picks, same)
    once = met.where("__equal = 1").withColumn("__times", F.col("__copies"))
    if groups.where("__equal > 1").isEmpty():
        return once.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*documents.columns)
    # equal rows share the copies of their group: all the whole part, the first ones one more
    again = _numbered(met.where("__equal > 1"), ["__doc_id", "__source", "__tag"], "__number")
    again = again.withColumn("__times", F.floor(F.col("__copies") / F.col("__equal")) + (F.col("__number") < F.col("__copies") % F.col("__equal")).cast("long")).drop("__number")
    out = once.unionByName(again).where("__times > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*documents.columns)


def summary(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes from the document, repeats counted)."""
    return mix(documents).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
