"""Sources: CSV files (S1-S3), stream records (S4-S5), and the test-table adapter."""

from hitscope.sources.files import read_access_log, read_geo_blocks, read_geo_locations
from hitscope.sources.stream import decode_records, read_record_stream

__all__ = [
    "decode_records",
    "read_access_log",
    "read_geo_blocks",
    "read_geo_locations",
    "read_record_stream",
]
