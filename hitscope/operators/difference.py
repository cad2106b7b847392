"""Rows gained and lost between two runs, as bags: a row that occurs again counts each time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_difference(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns, ``change`` and ``n``: how many times a row of these columns was gained, lost, or is in both.

    One shuffle for all three: each side counts its rows before it (a row that a third of the table repeats is one
    row a task), and the counts of both meet. NULLs are equal. ``gained`` rows are ``after EXCEPT ALL before``, ``lost`` the
    converse, ``same`` is ``INTERSECT ALL``."""
    columns = list(columns or before.columns)
    side = lambda df, a, b: df.select(*columns, F.lit(a).alias("__before"), F.lit(b).alias("__after"))
    counted = side(before, 1, 0).unionByName(side(after, 0, 1)).groupBy(*columns).agg(F.sum("__before").alias("__before"), F.sum("__after").alias("__after"))
    b, a = F.col("__before"), F.col("__after")
    changes = [("gained", a - b), ("lost", b - a), ("same", F.least(a, b))]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("change"), n.alias("n")) for name, n in changes])).alias("c")
    return counted.select(*columns, each).where("c.n > 0").select(*columns, "c.change", "c.n")
