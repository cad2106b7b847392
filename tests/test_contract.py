"""The driver contract: entry() and every registered query against its DuckDB oracle."""

import os
import sys

import pytest

from paths import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from hitscope.plans.catalog import QUERIES, ROWS_ONLY  # noqa: E402


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["country_name", "country_iso_code", "requests", "total_bytes", "unique_hosts"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) & set(QUERIES) == set(QUERIES) - ROWS_ONLY


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])[name]
    assert res[0] in ("OK", "ROWS-ONLY"), res
