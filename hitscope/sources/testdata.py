"""Adapter from the driver's test tables to log-shaped inputs.

The test tables hold no access log, so one is derived from ``events`` (and the geo
inputs from ``nation``/``region``) with the projection documented in FIXTURES.md §3.
All three are pure projections: they scale with the tables and push down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# The URL prefix chosen for ``event_id % 14`` = 0..13, in order.
URL_PREFIXES = [
    "/shuttle/", "/history/", "/images/", "/facilities/", "/ksc", "/software/", "/facts/",
    "/persons/", "/elv/", "/htbin/", "/cgi-bin/", "/", "/icons/", "/Shuttle/",
]


def raw_logs_from_events(events: DataFrame) -> DataFrame:
    """Access-log rows (all text) derived from ``events``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    host = (
        F.when(eid % 101 == 0, F.lit(""))
        .when(eid % 5 == 0, F.concat(F.lit("user"), _s(uid), F.lit(".example.com")))
        .when(eid % 5 == 4, F.concat(F.lit("192.0.2."), _s(uid % 250)))
        .otherwise(F.concat(F.lit("10."), _s(uid % 25), F.lit("."), _s((uid * 7) % 250),
                            F.lit("."), _s((uid * 3) % 250)))
    )
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    method = (
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST"))
        .when(F.col("event_type") == "error", F.lit("HEAD"))
        .otherwise(F.lit("GET"))
    )
    prefix = F.element_at(F.array(*[F.lit(p) for p in URL_PREFIXES]), (eid % 14 + 1).cast("int"))
    suffix = F.when(eid % 14 == 11, F.lit("")).otherwise(
        F.concat(F.lit("p"), F.regexp_extract("props", "([0-9]+)", 1)))
    url = F.when(eid % 103 == 0, F.lit("  ")).otherwise(F.concat(prefix, suffix))
    error_code = F.when(uid % 3 == 0, F.lit("404")).when(uid % 3 == 1, F.lit("500")).otherwise(F.lit("403"))
    response = (
        F.when(eid % 97 == 0, F.lit("abc"))
        .when(F.col("event_type") == "error", error_code)
        .when(eid % 11 == 0, F.lit("304"))
        .when(eid % 11 == 1, F.lit("302"))
        .when(eid % 11 == 2, F.lit("700"))
        .otherwise(F.lit("200"))
    )
    nbytes = F.when(eid % 17 == 0, F.lit("")).otherwise(_s(F.floor(F.col("value") * 1024)))
    return events.select(
        _s(eid).alias("idx"), host.alias("host"), _s(epoch).alias("time"), method.alias("method"),
        url.alias("url"), response.alias("response"), nbytes.alias("bytes"),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return raw_logs_from_events(table(spark, sf_dir, "events"))


def geo_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CIDR blocks: ``10.<n>.0.0/16|17`` per nation, plus an upper /17 for a third of them."""
    n = F.col("n_nationkey")
    nation = table(spark, sf_dir, "nation")
    lower = nation.select(
        F.concat(F.lit("10."), _s(n), F.lit(".0.0/"), F.when(n % 3 == 0, F.lit("16")).otherwise(F.lit("17")))
        .alias("network"),
        (n + 1000000).cast("long").alias("geoname_id"),
    )
    upper = nation.where(n % 3 == 1).select(
        F.concat(F.lit("10."), _s(n), F.lit(".128.0/17")).alias("network"),
        (n + 1000000).cast("long").alias("geoname_id"),
    )
    return lower.unionByName(upper)


def raw_logs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_logs`` with NULL and bad times, NULL methods, and hosts all over the 10.0.0.0/8 block (FIXTURES.md §3.1)."""
    eid = F.col("idx").cast("long")
    spread = F.concat(F.lit("10."), _s(eid % 25), F.lit("."), _s(eid % 200), F.lit(".7"))
    return raw_logs(spark, sf_dir).withColumns({
        "host": F.when(eid % 7 == 3, spread).otherwise(F.col("host")),
        "time": F.when(eid % 89 == 0, F.lit(None)).when(eid % 83 == 0, F.lit("x")).otherwise(F.col("time")),
        "method": F.when(eid % 79 == 0, F.lit(None)).otherwise(F.col("method")),
    })


def geo_blocks_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``geo_blocks`` with nested and covering blocks, single addresses, and blocks that drop out."""
    n = F.col("n_nationkey")
    block = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else _s(x) for x in parts])
    known = (n + 1000000).cast("long")
    extra = [
        (n % 2 == 0, block("10.", n, ".64.0/18"), ((n + 1) % 25 + 1000000).cast("long")),
        (n == 0, F.lit("10.0.0.0/8"), known),
        (n % 5 == 0, block("10.", n, ".7.7/32"), known),
        (n % 5 == 1, block("10.", n, ".7.7"), known),
        (n == 1, F.lit("2001:db8::/32"), known),
        (n == 2, F.lit("bad"), known),
        (n == 3, F.lit(None).cast("string"), known),
        (n == 4, F.lit("10.4.0.0/16"), F.lit(None).cast("long")),
        (n == 5, F.lit("10.5.0.0/16"), F.lit(99).cast("long")),
        (n == 6, F.lit("10.6.3.0/33"), known),
    ]
    nation = table(spark, sf_dir, "nation")
    out = geo_blocks(spark, sf_dir)
    for where, network, geoname in extra:
        out = out.unionByName(nation.where(where).select(network.alias("network"), geoname.alias("geoname_id")))
    return out


def geo_locations_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``geo_locations`` with some names of countries and continents NULL."""
    key = F.col("geoname_id") - 1000000
    return geo_locations(spark, sf_dir).withColumns({
        "country_name": F.when(key % 11 != 0, F.col("country_name")),
        "continent_name": F.when(key % 13 != 0, F.col("continent_name")),
    })


def geo_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1000000).cast("long").alias("geoname_id"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("continent_name"),
        F.concat(F.lit("N"), _s(F.col("n_nationkey"))).alias("country_iso_code"),
        F.concat(F.lit("R"), _s(F.col("r_regionkey"))).alias("continent_code"),
    )
