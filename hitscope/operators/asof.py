"""As-of join: each row with the last earlier row of another table that has its key.

Both tables are united, dealt by ranges of (key, time) and sorted inside them, so a key with a third
of all rows is many ranges. Inside a range the last row of the other table is carried forward; what a range
needs from the ranges before it is in a boundary table of two rows a range. Each row moves once, and no pair
of rows that is not in the result is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitscope.session import scratch_path

PARTS = 64


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str], parts: int = PARTS) -> DataFrame:
    """The columns of ``left`` and, of the last row of ``right`` with the same key and ``right_time`` <= ``left_time``,
    its ``values`` (NULL without one). Keys that are NULL are equal; a row of ``left`` without a time has no earlier row, and
    rows of ``right`` without one are never found. Of rows of ``right`` with equal key and time the one with the largest values counts."""
    spark = left.sparkSession
    packed = F.struct(*[F.col(v).alias(v) for v in values])
    own = F.struct(*[F.col(c).alias(c) for c in left.columns])
    after = right.where(F.col(right_time).isNotNull()).groupBy(F.col(key).alias("k"), F.col(right_time).alias("t")).agg(F.max(packed).alias("v"))
    # at one time the row that is found comes first
    both = left.select(F.col(key).alias("k"), F.col(left_time).alias("t"), F.lit(1).alias("kind"), own.alias("row")).unionByName(after.select("k", "t", F.lit(0).alias("kind"), "v"), allowMissingColumns=True)
    order = [F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first(), F.col("kind")]
    path = scratch_path(spark, "asof")
    # the number of a row holds its range in the upper bits
    both.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id()).withColumn("part", F.shiftright("n", 33)).write.parquet(path)
    rows = spark.read.parquet(path)
    inside = Window.partitionBy("part", "k").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn("found", F.last("v", ignorenulls=True).over(inside))
    # of each range only its last key can go on in the next one, and only its first key can come from one before
    ends = rows.groupBy("part").agg(F.min_by(F.struct("k"), "n")["k"].alias("first"), F.max_by(F.struct("k"), "n")["k"].alias("last"))
    last = rows.where("v IS NOT NULL").join(F.broadcast(ends), "part").where(F.col("k").eqNullSafe(F.col("last"))).groupBy("part").agg(F.max_by("v", "n").alias("v"))
    gives = ends.join(last, "part", "left").select("part", F.col("last").alias("k"), F.lit(1).alias("kind"), "v")
    takes = ends.select("part", F.col("first").alias("k"), F.lit(0).alias("kind"))
    before = Window.partitionBy("k").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    needed = gives.unionByName(takes, allowMissingColumns=True).withColumn("v", F.last("v", ignorenulls=True).over(before)).where("kind = 0 AND v IS NOT NULL")
    needed = needed.select(F.col("part").alias("p"), F.col("k").alias("of"), F.col("v").alias("earlier"))
    joined = carried.where("kind = 1").join(F.broadcast(needed), (F.col("part") == F.col("p")) & F.col("k").eqNullSafe(F.col("of")), "left")
    best = F.when(F.col("t").isNotNull(), F.coalesce("found", "earlier"))
    return joined.select("row.*", *[best[v].alias(v) for v in values])
