"""Overlaps of address ranges, by a distributed sweep, and rows as often as ranges hold their address.

Overlapping ranges multiply log rows in the geo join. A query that uses no geo column needs only the
number of ranges that hold a row's address: 1 everywhere if the ranges are disjoint (or none hold it), so
such a query pays no geo join at all; else the spans of two and more ranges, which are few.

The sweep: each range gives +1 at its first address and -1 after its last; the changes are summed by
address, dealt by address ranges and sorted inside them, and the running sum of a part starts from the sum
of the parts before it (one row a part, so no task sees all ranges). Constant stretches are the spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitscope.operators.geo import RangeIndex, add_ip_columns, index_ranges, join_ranges
from hitscope.session import scratch_path

#: Address parts of the sweep.
PARTS = 64


def address_spans(ranges: DataFrame, parts: int = PARTS) -> DataFrame:
    """span_start, span_end, n_ranges: the maximal stretches of addresses that equally many ranges (one at least) hold."""
    spark = ranges.sparkSession
    both = F.array(F.struct(F.col("ip_start").alias("at"), F.lit(1).alias("step")), F.struct((F.col("ip_end") + 1).alias("at"), F.lit(-1).alias("step")))
    # a range with its end before its start holds nothing
    changes = ranges.where(F.col("ip_start") <= F.col("ip_end")).select(F.explode(both).alias("e")).groupBy("e.at").agg(F.sum("e.step").alias("step")).where("step <> 0")
    path = scratch_path(spark, "range_sweep")
    # the number of a row holds its part in the upper bits
    changes.repartitionByRange(parts, "at").sortWithinPartitions("at").withColumn("part", F.shiftright(F.monotonically_increasing_id(), 33)).write.parquet(path)
    changes = spark.read.parquet(path)
    in_order = Window.orderBy("part")
    sums = changes.groupBy("part").agg(F.sum("step").alias("total"), F.min("at").alias("first"))  # one row a part
    sums = sums.select("part", F.coalesce(F.sum("total").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                       F.lead("first").over(in_order).alias("next"))
    inside = Window.partitionBy("part").orderBy("at")
    swept = changes.join(F.broadcast(sums), "part").select(
        F.col("at").alias("span_start"), (F.coalesce(F.lead("at").over(inside), F.col("next")) - 1).alias("span_end"),
        (F.sum("step").over(inside) + F.col("before")).alias("n_ranges"))
    return swept.where(F.col("n_ranges") > 0)


def overlaps(ranges: DataFrame, parts: int = PARTS) -> DataFrame:
    """The spans that two and more ranges hold; none if the ranges are disjoint."""
    return address_spans(ranges, parts).where(F.col("n_ranges") > 1)


@dataclass(frozen=True)
class Multiplicity:
    """The overlaps of a geo table as an index for joins; ``index`` is None if the ranges are proven disjoint."""

    index: RangeIndex | None


def multiplicity(ranges: DataFrame, persist: bool = False, **options) -> Multiplicity:
    """Sweep the ranges once and index what overlaps (small jobs on the dimension table)."""
    spark = ranges.sparkSession
    path = scratch_path(spark, "range_overlaps")
    overlaps(ranges).write.parquet(path)
    found = spark.read.parquet(path)
    if found.isEmpty():
        return Multiplicity(None)
    spans = found.select(F.col("span_start").alias("ip_start"), F.col("span_end").alias("ip_end"), "n_ranges")
    return Multiplicity(index_ranges(spans, persist=persist, columns=("n_ranges",), **options))


def repeat_by_ranges(logs: DataFrame, many: Multiplicity) -> DataFrame:
    """Each row as often as the geo join would give it, without geo columns; the rows themselves if nothing overlaps."""
    if many.index is None:
        return logs
    columns = logs.columns
    joined = join_ranges(add_ip_columns(logs), many.index)
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce(F.col("n_ranges"), F.lit(1)).cast("int")))).select(*columns)
