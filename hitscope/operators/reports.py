"""The fifteen batch reports over the enriched table.

Each is a ``groupBy().agg()`` (partial + final hash aggregate, so a hot key is combined
map-side before the shuffle). Where the reference applies a limit, the group key is
added as a tie-break so the top-k is deterministic; ``orderBy().limit()`` plans as
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge).

Percentages use the whole-table row count. When the caller does not pass it, it is the
sum of the group counts (every row falls in exactly one group). The groups are written once in the
shared folder and read for the total and for the shares, so the logs are aggregated in one scan and the
groups are never gathered in one task (methods and status codes come from requests, so junk can make
them many).

``lattice`` aggregates the logs for all fifteen reports in one scan: grouping sets of the finest keys
that the reports need, from which each is rolled up (a distinct count of hosts is a count of groups
that have the host as a key).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.session import scratch_path

UNKNOWN = "Unknown"

# Report sizes and the error status, as in the reference.
TOP_COUNTRIES = 20
TOP_PAGES = 50
TOP_HOSTS = 50
HEATMAP_COUNTRIES = 10
TOP_ERROR_PAGES = 30
ERROR_STATUS = 404


def _requests() -> Column:
    return F.count(F.lit(1)).alias("requests")


def _total_bytes() -> Column:
    return F.sum("bytes").alias("total_bytes")


def _top(df: DataFrame, metric: str, keys: list[str], k: int | None) -> DataFrame:
    ordered = df.orderBy(F.desc(metric), *[F.asc_nulls_first(c) for c in keys])
    return ordered.limit(k) if k else ordered


def with_percentage(grouped: DataFrame, total_rows: int | None = None) -> DataFrame:
    """round(requests / total * 100, 2); ``total`` from the argument if > 0, else the
    sum of ``requests`` over the grouped rows."""
    if total_rows is not None and total_rows > 0:
        return grouped.withColumn("percentage", F.round(F.col("requests") / F.lit(float(total_rows)) * 100, 2))
    path = scratch_path(grouped.sparkSession, "report_groups")
    grouped.write.parquet(path)
    grouped = grouped.sparkSession.read.schema(grouped.schema).parquet(path)
    total = grouped.agg(F.sum("requests")).first()[0] or 0
    return grouped.withColumn("percentage", F.round(F.col("requests") / F.lit(float(total)) * 100, 2))


# Base aggregates shared by reports with the same group key.
# Used alone, a report's unused aggregate columns are pruned by Catalyst; run together
# (``run_reports(..., share=True)``) the base is aggregated once.

def by_response(df: DataFrame) -> DataFrame:
    return df.groupBy("response", "response_category").agg(_requests())


def by_url_category(df: DataFrame) -> DataFrame:
    return df.groupBy("url_category").agg(
        _requests(), _total_bytes(), F.round(F.avg("bytes"), 2).alias("avg_bytes"))


def by_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(
        _requests(), F.count_distinct("host").alias("unique_hosts"), _total_bytes(),
        F.round(F.sum("bytes") / 1024.0 / 1024.0, 2).alias("total_mb"))


BASES = {"by_response": by_response, "by_url_category": by_url_category, "by_date": by_date}


def traffic_by_country(df: DataFrame, limit: int = TOP_COUNTRIES) -> DataFrame:
    """A1: top countries by requests, with bytes and exact distinct hosts."""
    keys = ["country_name", "country_iso_code"]
    agg = df.where(F.col("country_name") != UNKNOWN).groupBy(*keys).agg(
        _requests(), _total_bytes(), F.count_distinct("host").alias("unique_hosts"))
    return _top(agg, "requests", keys, limit)


def traffic_by_continent(df: DataFrame) -> DataFrame:
    """A2: continents by requests."""
    keys = ["continent_name", "continent_code"]
    agg = df.where(F.col("continent_name") != UNKNOWN).groupBy(*keys).agg(
        _requests(), _total_bytes(), F.count_distinct("host").alias("unique_hosts"))
    return _top(agg, "requests", keys, None)


def top_pages(df: DataFrame, limit: int = TOP_PAGES) -> DataFrame:
    """A3: most requested URLs."""
    agg = df.groupBy("url").agg(_requests(), _total_bytes())
    return _top(agg, "requests", ["url"], limit)


def error_analysis(df: DataFrame, total_rows: int | None = None, *,
                   base: DataFrame | None = None) -> DataFrame:
    """A4: every status code with its class, count and share of all requests."""
    keys = ["response", "response_category"]
    agg = with_percentage(by_response(df) if base is None else base, total_rows)
    return _top(agg, "requests", keys, None)


def hourly_traffic(df: DataFrame) -> DataFrame:
    """A5: requests and bytes per hour of day."""
    return df.groupBy("hour_of_day").agg(_requests(), _total_bytes()).orderBy("hour_of_day")


def daily_traffic(df: DataFrame, *, base: DataFrame | None = None) -> DataFrame:
    """Requests and exact distinct hosts per day."""
    agg = by_date(df) if base is None else base
    return agg.select("date", "requests", "unique_hosts").orderBy("date")


def day_of_week_traffic(df: DataFrame) -> DataFrame:
    """Requests and bytes per weekday name."""
    agg = df.groupBy("day_of_week").agg(_requests(), _total_bytes())
    return _top(agg, "requests", ["day_of_week"], None)


def bandwidth_by_category(df: DataFrame, *, base: DataFrame | None = None) -> DataFrame:
    """Requests, bytes and mean bytes per URL category."""
    agg = by_url_category(df) if base is None else base
    return _top(agg, "total_bytes", ["url_category"], None)


def top_hosts(df: DataFrame, limit: int = TOP_HOSTS) -> DataFrame:
    """Most active hosts (IPs and DNS names)."""
    agg = df.groupBy("host").agg(_requests(), _total_bytes())
    return _top(agg, "requests", ["host"], limit)


def url_category_distribution(df: DataFrame, total_rows: int | None = None, *,
                              base: DataFrame | None = None) -> DataFrame:
    """A10: requests and share per URL category."""
    agg = (by_url_category(df) if base is None else base).select("url_category", "requests")
    return _top(with_percentage(agg, total_rows), "requests", ["url_category"], None)


def response_distribution(df: DataFrame, *, base: DataFrame | None = None) -> DataFrame:
    """Requests per status code and class (A4 without the share)."""
    keys = ["response", "response_category"]
    return _top(by_response(df) if base is None else base, "requests", keys, None)


def country_hour_heatmap(df: DataFrame, top_n: int = HEATMAP_COUNTRIES) -> DataFrame:
    """Requests per (country, hour) for the ``top_n`` countries by requests.

    One pass over the logs: the (country, hour) counts are aggregated once (at most
    countries x 25 rows, NULL hour included); a country's total is the sum of its hour
    groups, and the top countries are ranked on that small aggregate (country name
    breaks ties). Filtering the logs by a top list instead would read them twice.
    """
    by_hour = (
        df.where(F.col("country_name") != UNKNOWN)
        .groupBy("country_name", "hour_of_day").agg(_requests())
    )
    return _heatmap(by_hour, top_n)


def _heatmap(by_hour: DataFrame, top_n: int) -> DataFrame:
    totals = by_hour.withColumn(
        "_total", F.sum("requests").over(Window.partitionBy("country_name")))
    ranked = totals.withColumn("_rank", F.dense_rank().over(
        Window.orderBy(F.desc("_total"), F.asc_nulls_first("country_name"))))
    return (
        ranked.where(F.col("_rank") <= top_n)
        .select("country_name", "hour_of_day", "requests")
        .orderBy("country_name", "hour_of_day")
    )


def top_error_pages(df: DataFrame, limit: int = TOP_ERROR_PAGES, status: int = ERROR_STATUS) -> DataFrame:
    """URLs most often answered with 404."""
    agg = df.where(F.col("response") == status).groupBy("url").agg(_requests())
    return _top(agg, "requests", ["url"], limit)


def daily_bandwidth(df: DataFrame, *, base: DataFrame | None = None) -> DataFrame:
    """Bytes and megabytes per day."""
    agg = by_date(df) if base is None else base
    return agg.select("date", "total_bytes", "total_mb").orderBy("date")


def method_distribution(df: DataFrame, total_rows: int | None = None) -> DataFrame:
    """Requests and share per HTTP method (NULL method is its own group)."""
    agg = with_percentage(df.groupBy("method").agg(_requests()), total_rows)
    return _top(agg, "requests", ["method"], None)


# Report name -> (shared base or None, function(enriched, total_rows, base)), in the
# reference's listing order.
REPORT_SPECS: dict[str, tuple[str | None, Callable[..., DataFrame]]] = {
    "traffic_by_country": (None, lambda df, total, base: traffic_by_country(df)),
    "traffic_by_continent": (None, lambda df, total, base: traffic_by_continent(df)),
    "top_pages": (None, lambda df, total, base: top_pages(df)),
    "error_analysis": ("by_response", lambda df, total, base: error_analysis(df, total, base=base)),
    "hourly_traffic": (None, lambda df, total, base: hourly_traffic(df)),
    "daily_traffic": ("by_date", lambda df, total, base: daily_traffic(df, base=base)),
    "day_of_week_traffic": (None, lambda df, total, base: day_of_week_traffic(df)),
    "bandwidth_by_category": ("by_url_category", lambda df, total, base: bandwidth_by_category(df, base=base)),
    "top_hosts": (None, lambda df, total, base: top_hosts(df)),
    "url_category_distribution": ("by_url_category",
                                  lambda df, total, base: url_category_distribution(df, total, base=base)),
    "response_distribution": ("by_response", lambda df, total, base: response_distribution(df, base=base)),
    "country_hour_heatmap": (None, lambda df, total, base: country_hour_heatmap(df)),
    "top_error_pages": (None, lambda df, total, base: top_error_pages(df)),
    "daily_bandwidth": ("by_date", lambda df, total, base: daily_bandwidth(df, base=base)),
    "method_distribution": (None, lambda df, total, base: method_distribution(df, total)),
}

# Report name -> function(enriched, total_rows=None): each report on its own.
REPORTS: dict[str, Callable[..., DataFrame]] = {
    name: (lambda fn: (lambda df, total=None: fn(df, total, None)))(fn)
    for name, (_base, fn) in REPORT_SPECS.items()
}


def run_reports(enriched: DataFrame, total_rows: int | None = None,
                names: list[str] | None = None, *, share: bool = False
                ) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Build the named reports (lazy) over one enriched table.

    With ``share``, a base aggregate used by two chosen reports is built once and
    persisted (it has one row per status code, category or day); the persisted bases
    are returned so the caller can release them after the writes."""
    chosen = names or list(REPORT_SPECS)
    uses: dict[str, int] = {}
    for name in chosen:
        key = REPORT_SPECS[name][0]
        if key:
            uses[key] = uses.get(key, 0) + 1
    bases = {key: BASES[key](enriched).persist() for key, n in uses.items() if share and n > 1}
    reports = {}
    for name in chosen:
        key, fn = REPORT_SPECS[name]
        reports[name] = fn(enriched, total_rows, bases.get(key))
    return reports, list(bases.values())


# Finest keys of the reports, each a grouping set of the one pass.
LATTICE: dict[str, tuple[str, ...]] = {
    "country_host": ("country_name", "country_iso_code", "host"),
    "continent_host": ("continent_name", "continent_code", "host"),
    "date_host": ("date", "host"),
    "url_missing": ("url", "is_missing"),
    "response": ("response", "response_category"),
    "country_hour": ("country_name", "hour_of_day"),
    "url_category": ("url_category",),
    "method": ("method",),
}
# The grouping set that a report is rolled up from.
FROM_LATTICE = {
    "traffic_by_country": "country_host", "traffic_by_continent": "continent_host", "top_pages": "url_missing",
    "error_analysis": "response", "hourly_traffic": "country_hour", "daily_traffic": "date_host",
    "day_of_week_traffic": "date_host", "bandwidth_by_category": "url_category", "top_hosts": "date_host",
    "url_category_distribution": "url_category", "response_distribution": "response",
    "country_hour_heatmap": "country_hour", "top_error_pages": "url_missing", "daily_bandwidth": "date_host",
    "method_distribution": "method",
}


def lattice(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``level`` (the grouping set), its keys, ``requests`` and ``total_bytes``: one scan of the enriched rows for
    the named reports (all by default), partially aggregated before the only shuffle. Sums of its rows are again
    what a scan would give, so tables of several days can be united and summed."""
    wanted = {FROM_LATTICE[n] for n in (names or FROM_LATTICE)}
    sets = {name: keys for name, keys in LATTICE.items() if name in wanted}
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    # the number that grouping_id gives a set: one bit for each column that is not in it
    number = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys): name for name, keys in sets.items()}
    source = df.withColumn("is_missing", F.col("response") == ERROR_STATUS) if "is_missing" in columns else df
    grouped = source.groupingSets([[F.col(c) for c in keys] for keys in sets.values()], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("__level"), _requests(), _total_bytes())
    level = F.element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), F.col("__level").cast("int"))
    return grouped.select(level.alias("level"), *columns, "requests", "total_bytes")


def reports_from_lattice(base: DataFrame, names: list[str] | None = None, total_rows: int | None = None) -> dict[str, DataFrame]:
    """The named reports rolled up from a stored lattice (partitioned by ``level``: a report reads its own folder)."""
    chosen = names or list(REPORT_SPECS)
    counts = [F.sum("requests").alias("requests"), F.sum("total_bytes").alias("total_bytes")]

    def rolled(name: str, *keys: str, known: str | None = None) -> DataFrame:
        rows = base.where(F.col("level") == FROM_LATTICE[name])
        rows = rows.where(F.col(known) != UNKNOWN) if known else rows
        hosts = [F.count("host").alias("unique_hosts")] if "host" in LATTICE[FROM_LATTICE[name]] and "host" not in keys else []
        return rows.groupBy(*keys).agg(*counts, *hosts)

    if total_rows is None and {"error_analysis", "url_category_distribution", "method_distribution"} & set(chosen):
        share = next(n for n in chosen if n in ("error_analysis", "url_category_distribution", "method_distribution"))
        total_rows = base.where(F.col("level") == FROM_LATTICE[share]).agg(F.sum("requests")).first()[0] or 0

    def part(name: str, *keys: str) -> DataFrame:
        share = F.round(F.col("requests") / F.lit(float(total_rows)) * 100, 2)
        return _top(rolled(name, *keys).select(*keys, "requests", share.alias("percentage")), "requests", list(keys), None)

    def made(name: str) -> DataFrame:
        match name:
            case "traffic_by_country" | "traffic_by_continent":
                keys = ["country_name", "country_iso_code"] if name == "traffic_by_country" else ["continent_name", "continent_code"]
                return _top(rolled(name, *keys, known=keys[0]), "requests", keys, TOP_COUNTRIES if name == "traffic_by_country" else None)
            case "top_pages":
                return _top(rolled(name, "url"), "requests", ["url"], TOP_PAGES)
            case "error_analysis":
                return part(name, "response", "response_category")
            case "hourly_traffic":
                return rolled(name, "hour_of_day").orderBy("hour_of_day")
            case "daily_traffic":
                return rolled(name, "date").select("date", "requests", "unique_hosts").orderBy("date")
            case "day_of_week_traffic":
                days = rolled(name, "date").withColumn("day_of_week", F.date_format("date", "EEEE"))
                return _top(days.groupBy("day_of_week").agg(*counts), "requests", ["day_of_week"], None)
            case "bandwidth_by_category":
                mean = F.round(F.col("total_bytes") / F.col("requests"), 2).alias("avg_bytes")
                return _top(rolled(name, "url_category").select("*", mean), "total_bytes", ["url_category"], None)
            case "top_hosts":
                return _top(rolled(name, "host"), "requests", ["host"], TOP_HOSTS)
            case "url_category_distribution":
                return part(name, "url_category")
            case "response_distribution":
                return _top(rolled(name, "response", "response_category").drop("total_bytes"), "requests", ["response", "response_category"], None)
            case "country_hour_heatmap":
                return _heatmap(rolled(name, "country_name", "hour_of_day", known="country_name").drop("total_bytes"), HEATMAP_COUNTRIES)
            case "top_error_pages":
                missing = base.where((F.col("level") == FROM_LATTICE[name]) & F.col("is_missing"))
                return _top(missing.groupBy("url").agg(counts[0]), "requests", ["url"], TOP_ERROR_PAGES)
            case "daily_bandwidth":
                megabytes = F.round(F.col("total_bytes") / 1024.0 / 1024.0, 2).alias("total_mb")
                return rolled(name, "date").select("date", "total_bytes", megabytes).orderBy("date")
            case "method_distribution":
                return part(name, "method")
        raise ValueError(f"unknown report {name!r}")

    return {name: made(name) for name in chosen}


# Key columns of each report in the long table.
REPORT_KEYS = {
    "traffic_by_country": ("country_name", "country_iso_code"), "traffic_by_continent": ("continent_name", "continent_code"),
    "top_pages": ("url",), "error_analysis": ("response", "response_category"), "hourly_traffic": ("hour_of_day",),
    "daily_traffic": ("date",), "day_of_week_traffic": ("day_of_week",), "bandwidth_by_category": ("url_category",),
    "top_hosts": ("host",), "url_category_distribution": ("url_category",), "response_distribution": ("response", "response_category"),
    "country_hour_heatmap": ("country_name", "hour_of_day"), "top_error_pages": ("url",), "daily_bandwidth": ("date",),
    "method_distribution": ("method",),
}
METRICS = {"requests": "bigint", "total_bytes": "bigint", "unique_hosts": "bigint", "percentage": "double", "avg_bytes": "double", "total_mb": "double"}


def long_table(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports as one table: report, key_1, key_2 (as text) and the metrics, NULL where a report has none."""
    parts = []
    for name, df in reports.items():
        keys = [F.col(k).cast("string") for k in REPORT_KEYS[name]] + [F.lit(None).cast("string")]
        metrics = [(F.col(m) if m in df.columns else F.lit(None)).cast(t).alias(m) for m, t in METRICS.items()]
        parts.append(df.select(F.lit(name).alias("report"), keys[0].alias("key_1"), keys[1].alias("key_2"), *metrics))
    return reduce(DataFrame.unionByName, parts)
