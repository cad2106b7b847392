"""Sinks: JDBC tables (K1, K2, K10), CSV/Parquet files (K3, K4, K7), records."""

from hitscope.sinks.files import export_csv, export_reports, write_parquet
from hitscope.sinks.jdbc import jdbc_options, write_jdbc
from hitscope.sinks.records import encode_records, write_records

__all__ = [
    "encode_records",
    "export_csv",
    "export_reports",
    "jdbc_options",
    "write_jdbc",
    "write_parquet",
    "write_records",
]
