"""DuckDB oracle texts for the registered queries (driver correctness gate).

Each text re-derives the log-shaped inputs from the test tables (FIXTURES.md §3) and
half-up rounding of the decimal text, HUGEINT sums cast to BIGINT, INTEGER hours,
naive UTC timestamps, explicit NULLS FIRST tie-breaks under every limit.
"""

from __future__ import annotations

from hitscope.plans.catalog import CATEGORIES, COUNTRIES, DATE_RANGE, HOURS

IP_RE = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
QUAD4 = r"^[+-]?[0-9]+\.[+-]?[0-9]+\.[+-]?[0-9]+\.[+-]?[0-9]+$"
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CIDR_RE = rf"{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}(/(3[0-2]|[12]?[0-9]))?"


def R(x: str) -> str:
    """Spark's round(double, 2): half-up on the shortest decimal text."""
    return f"round(cast(cast(({x}) as varchar) as decimal(38,17)), 2)::double"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def is_ip(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(IP_RE)}), false)"


def ip_to_long(x: str) -> str:
    s = f"rtrim({x}, '.')"
    parts = [f"try_cast(split_part({s}, '.', {i}) as bigint)" for i in range(1, 5)]
    total = f"{parts[0]} * 16777216 + {parts[1]} * 65536 + {parts[2]} * 256 + {parts[3]}"
    return f"coalesce(case when regexp_matches({s}, {q(QUAD4)}) then {total} end, -1)::bigint"


# Seconds of 0001-01-01 and of 9999-12-31 23:59:59.
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300799


def url_category(x: str) -> str:
    return (f"case when {x} like '/shuttle/%' then 'Shuttle' when {x} like '/history/%' then 'History' "
            f"when {x} like '/images/%' then 'Images' when {x} like '/facilities/%' then 'Facilities' "
            f"when {x} = '/' or {x} like '/ksc%' then 'Homepage' when {x} like '/software/%' then 'Software' "
            f"when {x} like '/facts/%' then 'Facts' when {x} like '/persons/%' then 'Persons' "
            f"when {x} like '/elv/%' then 'ELV' when {x} like '/htbin/%' or {x} like '/cgi-bin/%' then 'CGI' else 'Other' end")


def response_category(x: str) -> str:
    return (f"case when {x} >= 200 and {x} < 300 then 'Success' when {x} >= 300 and {x} < 400 then 'Redirect' "
            f"when {x} >= 400 and {x} < 500 then 'Client Error' when {x} >= 500 and {x} < 600 then 'Server Error' "
            f"else 'Other' end")


URL_PREFIX_CASE = (
    "case event_id % 14 when 0 then '/shuttle/' when 1 then '/history/' when 2 then '/images/' "
    "when 3 then '/facilities/' when 4 then '/ksc' when 5 then '/software/' when 6 then '/facts/' "
    "when 7 then '/persons/' when 8 then '/elv/' when 9 then '/htbin/' when 10 then '/cgi-bin/' "
    "when 11 then '/' when 12 then '/icons/' else '/Shuttle/' end"
)

RAW = f"""raw_logs as (
select cast(event_id as varchar) as idx,
 case when event_id % 101 = 0 then ''
      when event_id % 5 = 0 then concat('user', cast(user_id as varchar), '.example.com')
      when event_id % 5 = 4 then concat('192.0.2.', cast(user_id % 250 as varchar))
      else concat('10.', cast(user_id % 25 as varchar), '.', cast((user_id * 7) % 250 as varchar), '.',
                  cast((user_id * 3) % 250 as varchar)) end as host,
 cast(cast(floor(epoch(ts)) as bigint) as varchar) as time,
 case event_type when 'purchase' then 'POST' when 'signup' then 'POST' when 'error' then 'HEAD' else 'GET' end as method,
 case when event_id % 103 = 0 then '  '
      else concat({URL_PREFIX_CASE},
                  case when event_id % 14 = 11 then '' else concat('p', regexp_extract(props, '([0-9]+)', 1)) end) end as url,
 case when event_id % 97 = 0 then 'abc'
      when event_type = 'error' then case user_id % 3 when 0 then '404' when 1 then '500' else '403' end
      when event_id % 11 = 0 then '304' when event_id % 11 = 1 then '302' when event_id % 11 = 2 then '700'
      else '200' end as response,
 case when event_id % 17 = 0 then '' else cast(cast(floor(value * 1024) as bigint) as varchar) end as bytes
from events)"""

CLEAN_COLS = """trim(host) as host, try_cast(time as bigint) as time, trim(method) as method, trim(url) as url,
 try_cast(response as integer) as response, coalesce(try_cast(bytes as bigint), 0) as bytes"""
CLEAN_WHERE = "try_cast(response as integer) is not null and trim(host) <> '' and trim(url) <> ''"

CLEANED = f"""cleaned as (select {CLEAN_COLS} from raw_logs where {CLEAN_WHERE})"""

GEO = f"""geo_blocks as (
 select concat('10.', cast(n_nationkey as varchar), '.0.0/', case when n_nationkey % 3 = 0 then '16' else '17' end) as network,
        cast(n_nationkey + 1000000 as bigint) as geoname_id from nation
 union all
 select concat('10.', cast(n_nationkey as varchar), '.128.0/17') as network,
        cast(n_nationkey + 1000000 as bigint) as geoname_id from nation where n_nationkey % 3 = 1),
geo_locations as (
 select cast(n_nationkey + 1000000 as bigint) as geoname_id, n_name as country_name, r_name as continent_name,
        concat('N', cast(n_nationkey as varchar)) as country_iso_code, concat('R', cast(r_regionkey as varchar)) as continent_code
 from nation join region on n_regionkey = r_regionkey),
blocks_parsed as (
 select geoname_id, valid, base, size, case when valid then base - base % size else -1 end as ip_start,
        case when valid then base - base % size + size - 1 else -1 end as ip_end
 from (select geoname_id,
         coalesce(regexp_full_match(network, {q(CIDR_RE)}), false) as valid,
         case when coalesce(regexp_full_match(network, {q(CIDR_RE)}), false) then
           cast(split_part(split_part(network, '/', 1), '.', 1) as bigint) * 16777216
         + cast(split_part(split_part(network, '/', 1), '.', 2) as bigint) * 65536
         + cast(split_part(split_part(network, '/', 1), '.', 3) as bigint) * 256
         + cast(split_part(split_part(network, '/', 1), '.', 4) as bigint) end as base,
         case when coalesce(regexp_full_match(network, {q(CIDR_RE)}), false) then
           (cast(1 as bigint) << (32 - cast(coalesce(nullif(split_part(network, '/', 2), ''), '32') as integer))) end as size
       from geo_blocks)),
geo_ranges as (
 select b.ip_start, b.ip_end, l.country_name, l.continent_name, l.country_iso_code, l.continent_code
 from blocks_parsed b join geo_locations l on b.geoname_id = l.geoname_id
 where b.ip_start >= 0 and b.ip_end >= 0)"""

GEOLOCATED = f"""geolocated as (
 select c.host, c.time, c.method, c.url, c.response, c.bytes, c.is_ip_host, c.ip_long,
        coalesce(r.country_name, 'Unknown') as country_name, coalesce(r.continent_name, 'Unknown') as continent_name,
        coalesce(r.country_iso_code, 'Unknown') as country_iso_code, coalesce(r.continent_code, 'Unknown') as continent_code
 from (select *, {is_ip('host')} as is_ip_host,
              case when {is_ip('host')} then {ip_to_long('host')} else cast(-1 as bigint) end as ip_long
       from cleaned) c
 left join geo_ranges r on c.ip_long >= r.ip_start and c.ip_long <= r.ip_end)"""

ENRICHED = f"""enriched as (
 select g.* exclude (ts), ts as "timestamp", cast(hour(ts) as integer) as hour_of_day, dayname(ts) as day_of_week,
        cast(ts as date) as "date", {url_category('url')} as url_category,
        {response_category('response')} as response_category, {R('cast(bytes as double) / 1024.0::double')} as bytes_kb
 from (select *, case when time between {MIN_EPOCH} and {MAX_EPOCH} then make_timestamp(time * 1000000) end as ts
       from geolocated) g)"""

CHAIN = ",\n".join([RAW, CLEANED, GEO, GEOLOCATED, ENRICHED])


# FIXTURES.md §3.1: overlapping, odd and bad blocks, NULL names, times and methods.
WIDE_LOGS = """raw_logs as (
 select idx,
  case when cast(idx as bigint) % 7 = 3 then concat('10.', cast(cast(idx as bigint) % 25 as varchar), '.', cast(cast(idx as bigint) % 200 as varchar), '.7') else host end as host,
  case when cast(idx as bigint) % 89 = 0 then null when cast(idx as bigint) % 83 = 0 then 'x' else time end as time,
  case when cast(idx as bigint) % 79 = 0 then null else method end as method, url, response, bytes from narrow_logs)"""
WIDE_GEO = """geo_blocks as (
 select * from narrow_blocks
 union all select concat('10.', cast(n_nationkey as varchar), '.64.0/18'), cast((n_nationkey + 1) % 25 + 1000000 as bigint) from nation where n_nationkey % 2 = 0
 union all select '10.0.0.0/8', 1000000
 union all select concat('10.', cast(n_nationkey as varchar), '.7.7/32'), cast(n_nationkey + 1000000 as bigint) from nation where n_nationkey % 5 = 0
 union all select concat('10.', cast(n_nationkey as varchar), '.7.7'), cast(n_nationkey + 1000000 as bigint) from nation where n_nationkey % 5 = 1
 union all select '2001:db8::/32', 1000001 union all select 'bad', 1000002 union all select null, 1000003
 union all select '10.4.0.0/16', null union all select '10.5.0.0/16', 99 union all select '10.6.3.0/33', 1000006),
geo_locations as (
 select geoname_id, case when (geoname_id - 1000000) % 11 <> 0 then country_name end as country_name,
        case when (geoname_id - 1000000) % 13 <> 0 then continent_name end as continent_name, country_iso_code, continent_code
 from narrow_locations)"""
_narrow_geo, _parsed = GEO.split(",\nblocks_parsed as", 1)
_narrow_geo = _narrow_geo.replace("geo_blocks as (", "narrow_blocks as (", 1).replace("geo_locations as (", "narrow_locations as (", 1)
WIDE_CHAIN = ",\n".join([RAW.replace("raw_logs as", "narrow_logs as", 1), WIDE_LOGS, CLEANED, _narrow_geo, WIDE_GEO, f"blocks_parsed as{_parsed}", GEOLOCATED, ENRICHED])


def with_chain(body: str, wide: bool = False) -> str:
    return f"with {WIDE_CHAIN if wide else CHAIN}\n{body}"


REQ = "count(*) as requests"
BYTES = "cast(sum(bytes) as bigint) as total_bytes"
MB = R("cast(sum(bytes) as double) / 1024.0::double / 1024.0::double")


def _pct(keys: str, where: str = "") -> str:
    return (f"select {keys}, requests, {R('cast(requests as double) / cast(total as double) * 100')} as percentage "
            f"from (select {keys}, count(*) as requests, sum(count(*)) over () as total from enriched {where} "
            f"group by {keys})")


REPORT_BODIES = {
    "traffic_by_country": f"""select country_name, country_iso_code, {REQ}, {BYTES}, count(distinct host) as unique_hosts
 from enriched where country_name <> 'Unknown' group by country_name, country_iso_code
 order by requests desc, country_name asc nulls first, country_iso_code asc nulls first limit 20""",
    "traffic_by_continent": f"""select continent_name, continent_code, {REQ}, {BYTES}, count(distinct host) as unique_hosts
 from enriched where continent_name <> 'Unknown' group by continent_name, continent_code""",
    "top_pages": f"""select url, {REQ}, {BYTES} from enriched group by url
 order by requests desc, url asc nulls first limit 50""",
    "error_analysis": _pct("response, response_category"),
    "hourly_traffic": f"select hour_of_day, {REQ}, {BYTES} from enriched group by hour_of_day",
    "daily_traffic": f"select \"date\", {REQ}, count(distinct host) as unique_hosts from enriched group by \"date\"",
    "day_of_week_traffic": f"select day_of_week, {REQ}, {BYTES} from enriched group by day_of_week",
    "bandwidth_by_category": f"""select url_category, {REQ}, {BYTES}, {R('avg(bytes)')} as avg_bytes
 from enriched group by url_category""",
    "top_hosts": f"""select host, {REQ}, {BYTES} from enriched group by host
 order by requests desc, host asc nulls first limit 50""",
    "url_category_distribution": _pct("url_category"),
    "response_distribution": f"select response, response_category, {REQ} from enriched group by response, response_category",
    "country_hour_heatmap": f"""select country_name, hour_of_day, {REQ} from enriched
 where country_name in (select country_name from enriched where country_name <> 'Unknown' group by country_name
                        order by count(*) desc, country_name asc nulls first limit 10)
 group by country_name, hour_of_day""",
    "top_error_pages": f"""select url, {REQ} from enriched where response = 404 group by url
 order by requests desc, url asc nulls first limit 30""",
    "daily_bandwidth": f"select \"date\", {BYTES}, {MB} as total_mb from enriched group by \"date\"",
    "method_distribution": _pct("method"),
}


def _window(keys: list[str], aggs: str, where: str = "") -> str:
    k = "".join(f", {c}" for c in keys)
    cond = "\"timestamp\" is not null" + (f" and {where}" if where else "")
    return (f"select make_timestamp(wstart * 1000000) as window_start, make_timestamp((wstart + 300) * 1000000) as window_end"
            f"{k}, {aggs} from (select *, cast(floor(time / 300) as bigint) * 300 as wstart from enriched where {cond}) "
            f"group by wstart{k}")


ERR = "sum(case when response >= 400 then 1 else 0 end)"
STREAM_BODIES = {
    "stream_requests_by_country": _window(["country_name"], f"{REQ}, {BYTES}", "country_name <> 'Unknown'"),
    "stream_requests_by_url_category": _window(["url_category"], f"{REQ}, {BYTES}, {R('avg(bytes)')} as avg_bytes"),
    "stream_error_rate": _window([], f"count(*) as total_requests, cast({ERR} as bigint) as error_requests, "
                                     f"{R(f'cast({ERR} as double) / cast(count(*) as double) * 100')} as error_rate_pct"),
    "stream_traffic_volume": _window([], f"{REQ}, {BYTES}, {MB} as total_mb"),
    "stream_traffic_volume_hosts": _window([], f"{REQ}, {BYTES}, {MB} as total_mb, count(distinct host) as exact_hosts, true as estimate_ok"),
    # rows that arrive late count only in windows that the watermark (newest earlier time - 10 minutes) has not passed
    "stream_late_rows": f"""select make_timestamp(wstart * 1000000) as window_start, make_timestamp((wstart + 300) * 1000000) as window_end,
 count(*) as total_requests, cast({ERR} as bigint) as error_requests, {R(f'cast({ERR} as double) / cast(count(*) as double) * 100')} as error_rate_pct
 from (select *, cast(floor(time / 300) as bigint) * 300 as wstart, cast(idx as bigint) % 3 = 0 as late from
        (select idx, {CLEAN_COLS} from raw_logs where {CLEAN_WHERE}) where time is not null)
 where not late or wstart + 300 > (select max(time) - 600 from (select idx, {CLEAN_COLS} from raw_logs where {CLEAN_WHERE})
                                   where cast(idx as bigint) % 3 <> 0)
 group by wstart""",
}


def _on(report: str) -> str:
    return f"({REPORT_BODIES[report]})"


def _hours() -> str:
    return ", ".join(f"cast(sum(requests) filter (where hour_of_day = {h}) as bigint) as h{h:02d}" for h in range(24))


OTHER_BODIES = {
    "clean_logs": "select * from cleaned",
    "ip_functions": f"select host, {is_ip('host')} as is_ip_address, {ip_to_long('host')} as ip_to_long from raw_logs",
    "geo_ranges": "select * from geo_ranges",
    "geolocate_logs": "select * from geolocated",
    "geolocate_logs_shuffled": "select * from geolocated",
    "enrich_logs": "select * from enriched",
    "latest_windows": STREAM_BODIES["stream_error_rate"],
    "latest_windows_two_checkpoints": STREAM_BODIES["stream_error_rate"],
    "stream_requests_by_country_staged": STREAM_BODIES["stream_requests_by_country"],
    "json_records": f"select host as key, {CLEAN_COLS} from raw_logs where {CLEAN_WHERE}",
    "pipeline_counts": """select 'raw' as stage, count(*) as rows from raw_logs
 union all select 'geo_blocks', count(*) from geo_blocks
 union all select 'geo_locations', count(*) from geo_locations
 union all select 'cleaned', count(*) from cleaned
 union all select 'geo_ranges', count(*) from geo_ranges
 union all select 'enriched', count(*) from enriched""",
    "client_error_rate": f"""select cast(sum(case when response_category = 'Client Error' then requests else 0 end) as double)
 / cast(sum(requests) as double) * 100 as client_error_rate_pct from {_on('error_analysis')}""",
    "total_megabytes": f"select {R('sum(total_mb)')} as total_mb from {_on('daily_bandwidth')}",
    "peak_hour": f"""select hour_of_day, requests from {_on('hourly_traffic')} a
 where requests = (select max(requests) from {_on('hourly_traffic')} b)""",
    "latest_error_rate": f"""select window_start, window_end, error_rate_pct from ({STREAM_BODIES['stream_error_rate']}) w
 where error_rate_pct is not null and window_start = (select max(window_start) from ({STREAM_BODIES['stream_error_rate']}) v
                                                     where error_rate_pct is not null)""",
    "daily_traffic_between": f"""select * from {_on('daily_traffic')} d
 where "date" between date '{DATE_RANGE[0]}' and date '{DATE_RANGE[1]}'""",
    "country_slice": f"select * from {_on('traffic_by_country')} c where country_name in ({', '.join(q(c) for c in COUNTRIES)})",
    "category_slice": f"select * from {_on('url_category_distribution')} c where url_category in ({', '.join(q(c) for c in CATEGORIES)})",
    "hour_slice": f"select * from {_on('hourly_traffic')} h where hour_of_day between {HOURS[0]} and {HOURS[1]}",
    "heatmap_matrix": f"select country_name, {_hours()} from {_on('country_hour_heatmap')} m group by country_name",
}


_METRICS = {"requests": "bigint", "total_bytes": "bigint", "unique_hosts": "bigint", "percentage": "double", "avg_bytes": "double", "total_mb": "double"}
_LONG = {  # report: key columns, metrics, order
    "traffic_by_country": ("country_name country_iso_code", "requests total_bytes unique_hosts", "requests"),
    "traffic_by_continent": ("continent_name continent_code", "requests total_bytes unique_hosts", "requests"),
    "top_pages": ("url", "requests total_bytes", "requests"),
    "error_analysis": ("response response_category", "requests percentage", "requests"),
    "hourly_traffic": ("hour_of_day", "requests total_bytes", None),
    "daily_traffic": ("date", "requests unique_hosts", None),
    "day_of_week_traffic": ("day_of_week", "requests total_bytes", "requests"),
    "bandwidth_by_category": ("url_category", "requests total_bytes avg_bytes", "total_bytes"),
    "top_hosts": ("host", "requests total_bytes", "requests"),
    "url_category_distribution": ("url_category", "requests percentage", "requests"),
    "response_distribution": ("response response_category", "requests", "requests"),
    "country_hour_heatmap": ("country_name hour_of_day", "requests", None),
    "top_error_pages": ("url", "requests", "requests"),
    "daily_bandwidth": ("date", "total_bytes total_mb", None),
    "method_distribution": ("method", "requests percentage", "requests"),
}


def _long(first: int | None = None) -> str:
    parts = []
    for report, (keys, metrics, order) in _LONG.items():
        keys = [f'"{k}"' for k in keys.split()]
        cells = [f"cast({keys[i]} as varchar)" if i < len(keys) else "cast(null as varchar)" for i in range(2)]
        values = [f"cast({m if m in metrics.split() else 'null'} as {t}) as {m}" for m, t in _METRICS.items()]
        by = ", ".join(([f"{order} desc"] if order else []) + [f"{k} asc nulls first" for k in keys])
        rows = f"select * from ({REPORT_BODIES[report]}) r" + (f" order by {by} limit {first}" if first else "")
        parts.append(f"select '{report}' as report, {cells[0]} as key_1, {cells[1]} as key_2, {', '.join(values)} from ({rows}) t")
    return "\nunion all ".join(parts)


WIDE_BODIES = {
    "clean_logs_wide": "select * from cleaned",
    "geo_ranges_wide": "select * from geo_ranges",
    "geolocate_logs_wide": "select * from geolocated",
    # every stretch between two neighbouring ends, counted on its own; equal neighbours are one span
    "geo_overlaps": """select min(a) as span_start, max(b) as span_end, n as n_ranges from (
  select *, sum(case when n = before and a = after then 0 else 1 end) over (order by a) as span from (
   select *, lag(n) over (order by a) as before, lag(b) over (order by a) + 1 as after from (
    select a, b, cast((select count(*) from geo_ranges g where g.ip_start <= p.a and g.ip_end >= p.a) as bigint) as n
    from (select a, lead(a) over (order by a) - 1 as b from (select ip_start as a from geo_ranges union select ip_end + 1 from geo_ranges)) p where b is not null)))
 where n > 1 group by span, n""",
    "url_categories_with_overlaps": STREAM_BODIES["stream_requests_by_url_category"],
    "pipeline_counts_with_overlaps": OTHER_BODIES["pipeline_counts"],
    "file_job_enriched": "select * from enriched",
    "file_job_reports": _long(),
}
OTHER_BODIES["all_reports"] = _long()
_BY_PERIOD = f"cast(count(*) as bigint) as requests, {BYTES}, count(distinct host) as exact_hosts, true as estimate_ok from enriched where \"date\" is not null"
_DAY, _MONTH = "strftime(\"date\", '%Y-%m-%d')", "strftime(\"date\", '%Y-%m')"
OTHER_BODIES["hosts_by_period"] = "\nunion all ".join(
    f"select '{level}' as level, {period} as period, {country} as country_name, {_BY_PERIOD}{by}"
    for level, period, country, by in [
        ("day", _DAY, "country_name", f" group by {_DAY}, country_name"), ("day", _DAY, "null", f" group by {_DAY}"),
        ("month", _MONTH, "country_name", f" group by {_MONTH}, country_name"), ("month", _MONTH, "null", f" group by {_MONTH}"),
        ("all", "'all'", "country_name", " group by country_name"), ("all", "'all'", "null", " having count(*) > 0"),
    ])
OTHER_BODIES["stream_four_tables"] = "\nunion all ".join(
    f"select '{name}' as table_name, window_start, window_end, {key} as \"key\", cast({requests} as bigint) as requests, "
    + ", ".join(f"cast({m if m in metrics.split() else 'null'} as {t}) as {m}" for m, t in
                {"total_bytes": "bigint", "avg_bytes": "double", "error_requests": "bigint", "error_rate_pct": "double", "total_mb": "double"}.items())
    + f" from ({STREAM_BODIES[name]}) s"
    for name, key, requests, metrics in [
        ("stream_requests_by_country", "country_name", "requests", "total_bytes"),
        ("stream_requests_by_url_category", "url_category", "requests", "total_bytes avg_bytes"),
        ("stream_error_rate", "cast(null as varchar)", "total_requests", "error_requests error_rate_pct"),
        ("stream_traffic_volume", "cast(null as varchar)", "requests", "total_bytes total_mb"),
    ])
OTHER_BODIES["recovered_errors"] = """select e.host, make_timestamp(e.time * 1000000) as error_time, e.url as error_url, e.response as error_response,
 make_timestamp(s.time * 1000000) as success_time, s.url as success_url
 from cleaned e join cleaned s on e.host = s.host and e.response >= 400 and s.response between 200 and 299 and s.time between e.time and e.time + 3600"""
OTHER_BODIES["stream_recovered_errors"] = OTHER_BODIES["recovered_errors"]
OTHER_BODIES["latest_windows_manifest"] = STREAM_BODIES["stream_error_rate"]
_SESSIONS = """select make_timestamp(min(time) * 1000000) as session_start, make_timestamp((max(time) + 1800) * 1000000) as session_end,
 host, count(*) as requests, cast(sum(bytes) as bigint) as total_bytes from (
  select *, sum(fresh) over (partition by host order by time rows unbounded preceding) as session from (
   select *, case when time - lag(time) over (partition by host order by time) <= 1800 then 0 else 1 end as fresh from cleaned where time is not null))
 group by host, session"""
OTHER_BODIES["host_sessions"] = _SESSIONS
# a session is emitted once the newest time less ten minutes has reached its end
OTHER_BODIES["stream_host_sessions"] = f"select * from ({_SESSIONS}) s where session_end <= (select make_timestamp((max(time) - 600) * 1000000) from cleaned)"
OTHER_BODIES["requests_with_error_rate"] = f"""select e.host, e.url, e.response, e.bytes, e."timestamp", r.window_end, r.error_rate_pct
 from enriched_once e asof left join (
  select host, make_timestamp((cast(floor(time / 300) as bigint) * 300 + 300) * 1000000) as window_end,
         {R(f'cast({ERR} as double) / cast(count(*) as double) * 100')} as error_rate_pct
  from cleaned where time is not null group by host, cast(floor(time / 300) as bigint)) r
 on e.host = r.host and e."timestamp" >= r.window_end"""
OTHER_BODIES["requests_with_error_rate"] = ("select * from (" + OTHER_BODIES["requests_with_error_rate"].replace(
    "enriched_once", "(select *, make_timestamp(time * 1000000) as \"timestamp\" from cleaned)") + ")")
WIDE_BODIES["run_difference"] = f"""select host, method, response, bytes, change, cast(n as bigint) as n from (
 select host, method, response, bytes, unnest(['gained', 'lost', 'same']) as change, unnest([a - b, b - a, least(a, b)]) as n from (
  select host, method, response, bytes, sum(b) as b, sum(a) as a from (
   select host, method, response, bytes, 1 as b, 0 as a from (select {CLEAN_COLS} from narrow_logs where {CLEAN_WHERE})
   union all select host, method, response, bytes, 0, 1 from cleaned) group by all)) where n > 0"""
OTHER_BODIES["stream_late_split"] = f"""select host, time, method, url, response, bytes,
 coalesce(cast(idx as bigint) % 3 = 0 and cast(floor(time / 300) as bigint) * 300 + 300
   <= (select max(time) - 600 from (select idx, {CLEAN_COLS} from raw_logs where {CLEAN_WHERE}) where cast(idx as bigint) % 3 <> 0), false) as late
 from (select idx, {CLEAN_COLS} from raw_logs where {CLEAN_WHERE})"""
OTHER_BODIES["previews_of_reports"] = _long(5)


def oracle_sql() -> dict[str, str]:
    bodies = {**OTHER_BODIES, **REPORT_BODIES, **STREAM_BODIES}
    return {name: with_chain(body) for name, body in bodies.items()} | {name: with_chain(body, wide=True) for name, body in WIDE_BODIES.items()}
