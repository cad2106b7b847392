"""Column-expression functions (no Python UDFs): IP parsing, CIDR ranges, categories."""

from hitscope.functions.categories import (
    RESPONSE_CLASSES,
    URL_RULES,
    response_category,
    url_category,
)
from hitscope.functions.ip import cidr_end, cidr_start, ip_to_long, is_ip_address
from hitscope.functions.sql import register_sql_functions

__all__ = [
    "RESPONSE_CLASSES",
    "URL_RULES",
    "cidr_end",
    "cidr_start",
    "ip_to_long",
    "is_ip_address",
    "register_sql_functions",
    "response_category",
    "url_category",
]
