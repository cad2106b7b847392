"""The IP functions as SQL functions, for ``spark.sql`` users.

They are SQL-bodied temporary functions, so Catalyst inlines them: no UDF boundary,
codegen and pushdown still apply.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_IS_IP = r"coalesce(host rlike '^(\\d{1,3})\\.(\\d{1,3})\\.(\\d{1,3})\\.(\\d{1,3})$', false)"

_IP_TO_LONG = r"""
coalesce(
  CASE WHEN trim(TRAILING '.' FROM ip) rlike '^[+-]?[0-9]+\\.[+-]?[0-9]+\\.[+-]?[0-9]+\\.[+-]?[0-9]+\\z'
       THEN try_add(try_add(try_add(
              shiftleft(try_cast(split(trim(TRAILING '.' FROM ip), '\\.', -1)[0] AS BIGINT), 24),
              shiftleft(try_cast(split(trim(TRAILING '.' FROM ip), '\\.', -1)[1] AS BIGINT), 16)),
              shiftleft(try_cast(split(trim(TRAILING '.' FROM ip), '\\.', -1)[2] AS BIGINT), 8)),
              try_cast(split(trim(TRAILING '.' FROM ip), '\\.', -1)[3] AS BIGINT))
  END,
  CAST(-1 AS BIGINT))
"""


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``is_ip_address(host)`` and ``ip_to_long(ip)`` for this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_ip_address(host STRING) "
        f"RETURNS BOOLEAN RETURN {_IS_IP}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ip_to_long(ip STRING) "
        f"RETURNS BIGINT RETURN {_IP_TO_LONG}"
    )
