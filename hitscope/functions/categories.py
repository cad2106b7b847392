"""URL and response categories (T5, T6) as ordered rule lists; first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL rules in the reference's order, case-sensitive.
# ("prefix", p) matches url.startswith(p); ("equals", v) matches url == v.
URL_RULES: list[tuple[str, list[tuple[str, str]]]] = [
    ("Shuttle", [("prefix", "/shuttle/")]),
    ("History", [("prefix", "/history/")]),
    ("Images", [("prefix", "/images/")]),
    ("Facilities", [("prefix", "/facilities/")]),
    ("Homepage", [("equals", "/"), ("prefix", "/ksc")]),
    ("Software", [("prefix", "/software/")]),
    ("Facts", [("prefix", "/facts/")]),
    ("Persons", [("prefix", "/persons/")]),
    ("ELV", [("prefix", "/elv/")]),
    ("CGI", [("prefix", "/htbin/")]),
    ("CGI", [("prefix", "/cgi-bin/")]),
]
URL_DEFAULT = "Other"

# Response classes, both ends inclusive, in order.
RESPONSE_CLASSES: list[tuple[str, int, int]] = [
    ("Success", 200, 299),
    ("Redirect", 300, 399),
    ("Client Error", 400, 499),
    ("Server Error", 500, 599),
]
RESPONSE_DEFAULT = "Other"


def _matches(url: Column, kind: str, value: str) -> Column:
    if kind == "prefix":
        return url.startswith(value)
    if kind == "equals":
        return url == value
    raise ValueError(f"unknown url rule kind {kind!r}")


def url_category(url: Column | str, rules=URL_RULES, default: str = URL_DEFAULT) -> Column:
    """T5: one CASE expression built from the ordered rule list."""
    col = F.col(url) if isinstance(url, str) else url
    expr = None
    for label, tests in rules:
        cond = None
        for kind, value in tests:
            test = _matches(col, kind, value)
            cond = test if cond is None else (cond | test)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def response_category(response: Column | str, classes=RESPONSE_CLASSES,
                      default: str = RESPONSE_DEFAULT) -> Column:
    """HTTP status class."""
    col = F.col(response) if isinstance(response, str) else response
    expr = None
    for label, low, high in classes:
        cond = col.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
