"""Stream pipeline: records -> decode -> clean -> geolocate -> enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hitscope.operators.cleaning import clean
from hitscope.operators.enrich import enrich
from hitscope.operators.geo import RangeIndex, geolocate
from hitscope.operators.overlaps import Multiplicity, repeat_by_ranges
from hitscope.sources.stream import decode_records


def enriched_stream(records: DataFrame, ranges: DataFrame | RangeIndex | Multiplicity, *,
                    value_col: str = "value", strategy: str = "auto") -> DataFrame:
    """The batch functions applied to an unbounded frame of JSON records.

    The geo ranges are the static side of a stream-static left join; pass a
    ``RangeIndex`` (measured once) so every query reuses the same decision. With a ``Multiplicity``
    the rows are the same in number and have no geo columns: no join at all if no ranges overlap.
    """
    typed = clean(decode_records(records, value_col), index_col=None)
    if isinstance(ranges, Multiplicity):
        return enrich(repeat_by_ranges(typed, ranges))
    return enrich(geolocate(typed, ranges, strategy=strategy))
