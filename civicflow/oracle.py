"""Independent SQL (DuckDB dialect) for every registered query.

Used as the correctness oracle: the same questions written directly in SQL
over the driver's tables, without any of the Spark code. Means are written
in the same exact form (integer microsecond sums) so values agree to the bit.
"""

from __future__ import annotations

from .schema import DATE_COLUMNS, EXPECTED_COLUMNS, KEY, NUMERIC_COLUMNS
from .sources.testdata import PRESENT_COLUMNS

# Parameters of the registered queries (shared with __spark_entry__).
AS_OF = "2001-08-01"
TREND_DAYS = 90
TOP_DAYS = 365
GEO_DAYS = 365
AGENCY_MONTHS = 12
RECENT_LIMIT = 100
RECENT_FILTER = {"borough": "EUROPE", "status": "F"}
PAGE_SIZE = 1000
BULK_PAGE_SIZE = 5000
PAGE_AFTER = ("1998-01-01 06:00:00", 5000)
TIES_AT = ("1998-01-01 06:00:00", 0)
SINCE = "2001-01-01 00:00:00"
LOOKUP_KEY = 777
TARGET_BEFORE = "1998-01-01 00:00:00"
BATCH_FROM = "1997-01-01 00:00:00"
UNDATED_EVERY = 13
KEYLESS_EVERY = 17
SMALL_BATCH = 3000
LARGE_BATCH = 100_000
REFRESH_FROM = "2001-01-01 00:00:00"
# Layouts of the stored warehouse with the suffix of their queries, and the tables registered for each.
LAYOUTS = {"flat": "built", "monthly": "monthly", "refreshed": "refreshed"}
BUILT_TABLES = {"fact": "fct", "daily": "daily", "geo_heatmap": "geo", "agency_performance": "agency_perf",
                "dim_agency": "dim_agency", "dim_borough": "dim_borough", "dim_complaint_type": "dim_complaint_type"}
# Tables of the delta warehouse: aggregates and dimensions by name.
DELTA_TABLES = {"daily": "daily", "geo_heatmap": "geo", "agency_performance": "agency_perf",
                "dim_agency": "dim_agency", "dim_borough": "dim_borough", "dim_complaint_type": "dim_complaint_type"}
LATEST_EVERY = 4  # requests whose changed version is loaded over the first
BAD_KEY_EVERY, BAD_CREATED_EVERY, BAD_LATITUDE_EVERY = 101, 53, 37  # landed requests with cells that no type fits
COUNTED_BATCHES = ((3, 1), (2, 1), (5, 2))  # batches of the uniqueness tests kept by batch: keys whose remainder by the first is below the second
MERGE_STATE_BEFORE = "2000-01-01 00:00:00"
MERGE_NEW_FROM = "1999-06-01 00:00:00"
MERGE_AGENCY_SPLIT = "NATION_2"
CALENDAR_SQL_START = "1990-01-01"
CALENDAR_SQL_END = "2035-12-31"

_H = "cast(3600000000 as double)"


def _raw_type(c: str) -> str:
    if c == KEY:
        return "bigint"
    if c in DATE_COLUMNS:
        return "timestamp"
    if c in NUMERIC_COLUMNS:
        return "decimal(38,18)"
    return "varchar"


REQUESTS = """
select o_orderkey as unique_key, created_date,
  case when o_orderstatus = 'O' then null
       when o_orderkey % 11 = 0 then created_date
       else created_date + cast((o_orderkey * 7919) % 432000 as int) * interval '1' second end as closed_date,
  n_name as agency,
  case when o_orderkey % 97 = 0 then 'Agency (old name)' else concat('Agency ', n_name) end as agency_name,
  c_mktsegment as complaint_type,
  case when o_orderkey % 70 = 0 then null else o_orderpriority end as descriptor,
  concat('1', lpad(cast(o_custkey % 300 as varchar(10)), 4, '0')) as incident_zip,
  n_name as city,
  case when o_orderkey % 50 = 0 then null else r_name end as borough,
  o_orderstatus as status,
  case when o_orderkey % 20 = 0 then null else cast(40.5 as double) + (o_custkey % 400) / cast(1000 as double) end as latitude,
  case when o_orderkey % 20 = 0 then null else cast(-74.2 as double) + (o_custkey % 450) / cast(1000 as double) end as longitude,
  case when o_orderkey % 3 = 0 then 'PHONE' when o_orderkey % 3 = 1 then 'ONLINE' else 'MOBILE' end as open_data_channel_type,
  created_date + interval '3' day as due_date
from (select *, o_orderdate + cast(o_orderkey % 4 * 6 as int) * interval '1' hour as created_date from orders) o
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""

RAW = "select " + ",\n  ".join(
    (f"cast({f'cast({c} as varchar)' if c in NUMERIC_COLUMNS else c} as {_raw_type(c)}) as {c}" if c in PRESENT_COLUMNS else f"cast(null as {_raw_type(c)}) as {c}")
    for c in EXPECTED_COLUMNS) + "\nfrom requests"

STG = f"""
select unique_key, created_date as created_at, closed_date as closed_at, due_date as due_at,
  agency, agency_name, complaint_type, descriptor as complaint_subtype, descriptor_2,
  borough, incident_zip as zip_code, city, status, resolution_description,
  resolution_action_updated_date as resolution_updated_at,
  cast(latitude as double) as latitude, cast(longitude as double) as longitude,
  council_district, police_precinct, community_board, open_data_channel_type as submission_channel,
  cast(date_diff('microsecond', created_date, closed_date) as double) / {_H} as resolution_hours
from raw where unique_key is not null
"""

ENR = """
select *,
  case when resolution_hours <= 24 then 'under_24h' when resolution_hours <= 72 then '1-3_days'
       else 'over_3_days' end as resolution_bucket,
  (closed_at is not null and closed_at = created_at) as is_instant_close,
  cast(date_trunc('day', created_at) as timestamp) as created_date,
  (latitude is not null and longitude is not null) as has_location_data,
  cast(round(cast(cast(cast(latitude as double) as varchar) as decimal(38,18)), 2) as decimal(9,2)) as latitude_rounded,
  cast(round(cast(cast(cast(longitude as double) as varchar) as decimal(38,18)), 2) as decimal(9,2)) as longitude_rounded
from stg
"""

FCT = """
select unique_key, created_at, closed_at, created_date, is_instant_close, borough, agency, complaint_type,
  status, resolution_hours, resolution_bucket, has_location_data, latitude, longitude,
  latitude_rounded, longitude_rounded
from enr
"""


def _measures(extra: str = "") -> str:
    return (f"count(*) as complaint_count,"
            f" cast(sum(us) as double) / ({_H} * cast(nullif(count(us), 0) as double)) as avg_resolution_hours,"
            f" count(us) as closed_count, sum(cast(us as decimal(38,0))) as resolution_us_sum{extra}")


_FCT_US = "(select *, date_diff('microsecond', created_at, closed_at) as us from fct)"
# A group's mean in whole microseconds, and a table of groups with it.
_MU = "cast(round(cast(resolution_us_sum as double) / cast(nullif(closed_count, 0) as double)) as bigint)"


def _with_mu(table: str) -> str:
    return f"(select *, {_MU} as mu from {table})"


_MEAN_OF_MEANS = f"cast(sum(mu) as double) / ({_H} * cast(nullif(count(mu), 0) as double))"

DAILY = f"select created_date, borough, complaint_type, {_measures()} from {_FCT_US} group by all"
GEO = (f"select created_date, latitude_rounded, longitude_rounded, {_measures()} from {_FCT_US}"
       f" where has_location_data group by all")
AGENCY_PERF = (f"select agency, cast(date_trunc('month', created_at) as timestamp) as month,"
               f" {_measures(', max(created_at) as latest_created_at')} from {_FCT_US} group by all")
META = f"""
select 'service_requests' as source_name, created_date as last_created_date, unique_key as last_unique_key,
  timestamp '{AS_OF} 00:00:00' as updated_at
from raw where created_date is not null order by created_date desc, unique_key desc limit 1
"""

CALENDAR = f"""
select d as date_day,
  cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
  rpad(strftime(d, '%B'), 9, ' ') as month_name, strftime(d, '%b') as month_abbrev,
  cast(extract(week from d) as integer) as week_of_year, cast(dayofyear(d) as integer) as day_of_year,
  cast(day(d) as integer) as day_of_month, cast(extract(dow from d) as integer) as day_of_week,
  rpad(strftime(d, '%A'), 9, ' ') as day_name, strftime(d, '%a') as day_abbrev,
  extract(dow from d) in (0, 6) as is_weekend,
  d = cast(date_trunc('month', d) as date) as is_month_start,
  d = last_day(d) as is_month_end,
  strftime(d, '%Y-%m') as year_month, strftime(d, '%G-%V') as iso_year_week
from (select cast(range as date) as d
      from range(date '{CALENDAR_SQL_START}', date '{CALENDAR_SQL_END}' + interval 1 day, interval 1 day))
"""

# Replayed copies: open requests come back closed five days later; closed ones with a new agency name.
REPLAY = "select " + ",\n  ".join({
    "closed_date": "coalesce(closed_date, created_date + interval '5' day) as closed_date",
    "status": "case when closed_date is null then 'C' else status end as status",
    "agency_name": "case when closed_date is null then agency_name else 'Agency (replayed)' end as agency_name",
}.get(c, c) for c in EXPECTED_COLUMNS) + "\nfrom raw"

BASE = [("requests", REQUESTS), ("raw", RAW), ("stg", STG), ("enr", ENR), ("fct", FCT),
        ("daily", DAILY), ("geo", GEO), ("agency_perf", AGENCY_PERF), ("meta", META), ("calendar", CALENDAR),
        ("replay", REPLAY)]


def with_base(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = BASE + (extra or [])
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes) + "\n" + body


def _window(days: int) -> str:
    return f"created_date >= timestamp '{AS_OF} 00:00:00' - interval '{int(days)}' day"


def _batch_top(src: str, by: str) -> str:
    return f"""select source_name, created_date as last_created_date, unique_key as last_unique_key from (
      select {by} as source_name, created_date, unique_key,
        row_number() over (partition by {by} order by created_date desc, unique_key desc) as rn
      from {src} where created_date is not null) where rn = 1"""


def _status(n: str) -> str:
    return f"case when {n} > 0 then 'fail' else 'pass' end"


def _not_null_sql() -> str:
    from .operators.quality import NOT_NULL
    tables = _model_tables()
    parts = []
    for model, cols in NOT_NULL.items():
        for c in cols:
            n = f"count(*) filter (where {c} is null)"
            parts.append(f"select 'not_null' as test, '{model}' as model, '{c}' as column_name,"
                         f" cast({n} as bigint) as failures, {_status(n)} as status from {tables[model]}")
    return "\nunion all\n".join(parts)


def _unique_sql() -> str:
    from .operators.quality import UNIQUE
    tables = _model_tables()
    parts = []
    for model, cols in UNIQUE.items():
        for c in cols:
            inner = f"(select {c} from {tables[model]} where {c} is not null group by {c} having count(*) > 1)"
            parts.append(f"select 'unique' as test, '{model}' as model, '{c}' as column_name,"
                         f" count(*) as failures, {_status('count(*)')} as status from {inner}")
    return "\nunion all\n".join(parts)


def _model_tables() -> dict[str, str]:
    return {
        "stg_requests": "stg", "int_requests_enriched": "enr", "fct_requests": "fct",
        "dim_borough": "(select distinct borough from stg where borough is not null)",
        "dim_agency": "(select distinct agency, agency_name from stg)",
        "dim_complaint_type": "(select distinct complaint_type, complaint_subtype from stg)",
        "dim_date": "calendar",
        "fct_geo_heatmap": "geo", "fct_daily": "daily", "fct_agency_performance": "agency_perf",
    }


def _display(c: str) -> str:
    # offset of the later reading, minus one hour when the wall clock is also reached an hour
    # earlier (the repeated autumn hour): ambiguous times take the earlier (daylight) offset
    z = "'America/New_York'"
    later = f"(epoch_us(timezone({z}, {c})) - epoch_us({c})) // 3600000000"
    repeated = f"timezone({z}, timezone({z}, {c}) - interval 1 hour) = {c}"
    off = f"({later} - case when {repeated} then 1 else 0 end)"
    return (f"case when {c} is null then 'Unavailable' else strftime({c}, '%Y-%m-%d %I:%M %p') || ' ' ||"
            f" case {off} when 5 then 'EST' when 4 then 'EDT' end end")


def _merge_sql() -> str:
    old = (f"select source_name, last_created_date as od, last_unique_key as ok,"
           f" timestamp '{MERGE_STATE_BEFORE}' as ou from ("
           + _batch_top(f"(select * from raw where created_date < timestamp '{MERGE_STATE_BEFORE}')", "agency") + ")")
    batch = (f"(select * from raw where created_date >= timestamp '{MERGE_NEW_FROM}' and agency >= '{MERGE_AGENCY_SPLIT}'"
             f" union all select * from raw where created_date < timestamp '{TARGET_BEFORE}'"
             f" and agency < '{MERGE_AGENCY_SPLIT}')")
    new = "select source_name, last_created_date as nd, last_unique_key as nk from (" + _batch_top(batch, "agency") + ")"
    return with_base(f"""
select coalesce(o.source_name, n.source_name) as source_name,
  greatest(od, nd) as last_created_date,
  case when nd is null then ok when od is null or nd > od then nk when nd = od then greatest(ok, nk) else ok end
    as last_unique_key,
  case when nd is not null or nk is not null then timestamp '{AS_OF} 00:00:00' else ou end as updated_at
from o full outer join n on o.source_name = n.source_name""", [("o", old), ("n", new)])


# Requests of which some have lost their creation time and some their key.
_GAPPY = (f"select * from (select * replace (case when unique_key % {UNDATED_EVERY} <> 0 then created_date end as created_date,"
          f" case when unique_key % {KEYLESS_EVERY} <> 0 then unique_key end as unique_key) from raw)")

_FAILED = f"""
select case when unique_key % {BAD_KEY_EVERY} <> 0 then unique_key end as unique_key, c.n as "column", c.t as raw_text, c.r as reason
from raw, lateral (
  select 'unique_key' as n, 'K-' || unique_key as t, 'not a bigint' as r where unique_key % {BAD_KEY_EVERY} = 0
  union all select 'created_date', 'soon', 'not a timestamp_ntz' where unique_key % {BAD_CREATED_EVERY} = 0
  union all select 'latitude', 'n/a ' || unique_key, 'not a decimal(38,18)' where unique_key % {BAD_LATITUDE_EVERY} = 0) c"""


def _by_batch(test: str, model: str, columns: str, distinct: str, tested: str) -> str:
    """A uniqueness test over the first batch, the first two, and so on."""
    batches = [f"select {distinct} {columns} from stg where unique_key % {every} < {below}" for every, below in COUNTED_BATCHES]
    out = []
    for i in range(len(batches)):
        rows = " union all ".join(f"select * from ({b})" for b in batches[:i + 1])
        out.append(f"select cast({i} as bigint) as batch_id, '{test}' as test, '{model}' as model, '{columns}' as column_name,"
                   f" count(*) as failures, {_status('count(*)')} as status"
                   f" from (select {columns} from ({rows}) where {tested} group by {columns} having count(*) > 1)")
    return " union all ".join(out)


def queries_sql() -> dict[str, str]:
    asof = f"timestamp '{AS_OF} 00:00:00'"
    cols44 = ", ".join(EXPECTED_COLUMNS)
    order_all = ", ".join(f"{c} desc nulls last" for c in EXPECTED_COLUMNS if c != KEY)
    d, k = PAGE_AFTER
    td, tk = TIES_AT
    rec = "unique_key, created_at, closed_at, borough, agency, complaint_type, status, resolution_hours"
    q = {
        # ingestion
        "conform": with_base("select * from raw"),
        "batch_dedupe": with_base(
            f"select {cols44} from (select *, row_number() over (partition by unique_key order by {order_all}) as rn"
            f" from (select * from raw union all select * from replay)) where rn = 1"),
        "insert_absent": with_base(
            f"select * from raw where created_date < timestamp '{TARGET_BEFORE}' union all"
            f" select * from replay b where created_date >= timestamp '{BATCH_FROM}' and not exists"
            f" (select 1 from raw t where t.created_date < timestamp '{TARGET_BEFORE}' and t.unique_key = b.unique_key)"),
        "batch_max": with_base(_batch_top("raw", "agency")),
        "watermark_merge": _merge_sql(),
        "keyset_page": with_base(
            f"select * from raw where created_date > timestamp '{d}' or (created_date = timestamp '{d}'"
            f" and unique_key > {k}) order by created_date, unique_key limit {PAGE_SIZE}"),
        "keyset_page_bulk": with_base(
            f"select * from raw where created_date > timestamp '{d}' or (created_date = timestamp '{d}'"
            f" and unique_key > {k}) order by created_date, unique_key limit {BULK_PAGE_SIZE}"),
        "keyset_ties": with_base(
            f"select * from raw where created_date = timestamp '{td}' and unique_key > {tk}"
            f" order by created_date, unique_key limit {PAGE_SIZE}"),
        "since_date": with_base(
            f"select * from raw where created_date >= timestamp '{SINCE}' order by created_date, unique_key"
            f" limit {PAGE_SIZE}"),
        "latest_n": with_base(
            f"select * from raw order by created_date desc nulls last, unique_key desc limit {PAGE_SIZE}"),
        "latest_n_bulk": with_base(
            f"select * from raw order by created_date desc nulls last, unique_key desc limit {BULK_PAGE_SIZE}"),
        "key_lookup": with_base(f"select * from raw where unique_key = {LOOKUP_KEY}"),
        "stream_ingest": with_base("select * from raw"),
        "stream_replay": with_base("select * from raw"),
        "stream_delta": with_base("select * from raw"),
        "latest_ingest": with_base(f"select * from raw where unique_key % {LATEST_EVERY} <> 0"
                                   f" union all select * from replay where unique_key % {LATEST_EVERY} = 0"),
        "json_array_split": with_base("select * from raw"),
        "page_ingest": with_base("select * from raw"),
        "page_ingest_small": with_base(_GAPPY + " where unique_key is not null"),
        "page_ingest_large": with_base(_GAPPY + " where unique_key is not null"),
        "planned_ingest_small": with_base(_GAPPY + " where unique_key is not null"),
        "planned_ingest_large": with_base(_GAPPY + " where unique_key is not null"),
        "failed_cells": with_base(_FAILED),
        "keyset_page_null_keys": with_base(
            f"select created_date, unique_key from ({_GAPPY}) order by created_date nulls last, unique_key nulls last"
            f" limit {BULK_PAGE_SIZE}"),
        # models
        "staging": with_base("select * from stg"),
        "enriched": with_base("select * from enr"),
        "fact": with_base("select * from fct"),
        "dim_agency": with_base("select distinct agency, agency_name from stg"),
        "dim_borough": with_base("select distinct borough from stg where borough is not null"),
        "dim_complaint_type": with_base("select distinct complaint_type, complaint_subtype from stg"),
        "calendar_days": with_base("select * from calendar where date_day in (select cast(created_date as date) from fct)"),
        "daily": with_base("select * from daily"),
        "geo_heatmap": with_base("select * from geo"),
        "agency_performance": with_base("select * from agency_perf"),
        # questions
        "overview": with_base(f"""
select s.total_records, s.complaint_types, s.agencies, s.boroughs, s.latest_created_at, s.avg_resolution_hours,
  m.updated_at as last_ingestion_at, m.last_created_date as ingestion_watermark
from (select count(*) as total_records, count(distinct complaint_type) as complaint_types,
        count(distinct agency) as agencies, count(distinct borough) as boroughs,
        max(created_at) as latest_created_at,
        cast(sum(us) as double) / ({_H} * cast(nullif(count(us), 0) as double)) as avg_resolution_hours
      from {_FCT_US}) s
left join (select updated_at, last_created_date from meta where source_name = 'service_requests') m on true"""),
        "daily_trends": with_base(
            f"select created_date, borough, cast(sum(complaint_count) as bigint) as complaint_count from daily"
            f" where {_window(TREND_DAYS)} group by 1, 2"),
        "top_types": with_base(f"""
select complaint_type, cast(sum(complaint_count) as bigint) as complaint_count,
  cast(sum(cast(complaint_count as decimal(38,0)) * coalesce(mu, 0)) as double) /
    ({_H} * cast(nullif(sum(case when mu is not null then complaint_count else 0 end), 0) as double))
    as avg_resolution_hours
from {_with_mu('daily')} where {_window(TOP_DAYS)} group by 1 order by 2 desc, 1 asc nulls last limit 10"""),
        "top_types_exact": with_base(f"""
select complaint_type, cast(sum(complaint_count) as bigint) as complaint_count,
  cast(sum(resolution_us_sum) as double) / ({_H} * cast(nullif(sum(closed_count), 0) as double))
    as avg_resolution_hours
from daily where {_window(TOP_DAYS)} group by 1 order by 2 desc, 1 asc nulls last limit 10"""),
        "geo_hotspots": with_base(f"""
select latitude_rounded as latitude, longitude_rounded as longitude,
  cast(sum(complaint_count) as bigint) as complaint_count, {_MEAN_OF_MEANS} as avg_resolution_hours,
  printf('Lat %.2f, Lon %.2f', cast(latitude_rounded as double), cast(longitude_rounded as double)) as location_label
from {_with_mu('geo')} where {_window(GEO_DAYS)} group by 1, 2 order by 3 desc, 1, 2 limit 800"""),
        "geo_hotspots_exact": with_base(f"""
select latitude_rounded as latitude, longitude_rounded as longitude,
  cast(sum(complaint_count) as bigint) as complaint_count,
  cast(sum(resolution_us_sum) as double) / ({_H} * cast(nullif(sum(closed_count), 0) as double))
    as avg_resolution_hours,
  printf('Lat %.2f, Lon %.2f', cast(latitude_rounded as double), cast(longitude_rounded as double)) as location_label
from geo where {_window(GEO_DAYS)} group by 1, 2 order by 3 desc, 1, 2 limit 800"""),
        "agency_trend": with_base(f"""
select r.agency, r.month, r.complaint_count, r.avg_resolution_hours
from recent r join (select agency from recent group by agency order by sum(complaint_count) desc, agency asc nulls last
                    limit 6) k on r.agency = k.agency""", [("recent", f"""
select agency, month, complaint_count, avg_resolution_hours from agency_perf
where month >= cast(date_trunc('month', date '{AS_OF}') - interval '{AGENCY_MONTHS}' month as timestamp)""")]),
        "borough_options": with_base(
            "select borough from (select distinct borough from stg where borough is not null)"
            " where borough <> '' order by borough"),
        "status_options": with_base(
            "select distinct status from fct where status is not null and status <> '' order by status"),
        "agency_options": with_base(
            "select agency from (select distinct agency, agency_name from stg)"
            " where agency is not null and agency <> '' order by agency"),
        "recent": with_base(
            f"select {rec} from fct order by created_at desc nulls first, unique_key desc limit {RECENT_LIMIT}"),
        "recent_filtered": with_base(
            f"select {rec} from fct where borough = '{RECENT_FILTER['borough']}' and status = '{RECENT_FILTER['status']}'"
            f" order by created_at desc nulls first, unique_key desc limit {RECENT_LIMIT}"),
        "heatmap_month": with_base(f"""
select c.year, c.month, g.latitude_rounded, g.longitude_rounded,
  cast(sum(g.complaint_count) as bigint) as total_complaints, {_MEAN_OF_MEANS} as avg_resolution_hours
from {_with_mu('geo')} g join calendar c on g.created_date = cast(c.date_day as timestamp)
group by 1, 2, 3, 4 order by 2, 1, 3, 4 limit 100"""),
        "latest_inspection": with_base(
            "select unique_key, closed_at, created_at, agency from fct"
            " order by created_at desc nulls first, unique_key desc limit 50"),
        "instant_close_by_agency": with_base(
            "select agency, count(*) filter (where is_instant_close) as instant_close_count,"
            " count(*) as complaint_count from fct group by agency"
            " having count(*) filter (where is_instant_close) > 0"),
        "ingestion_status": with_base(f"""
select source_name, updated_at, age_hours,
  case when updated_at is null then 'Unknown' when age_hours <= 24 then 'Healthy'
       when age_hours <= 72 then 'Stale' else 'Delayed' end as status
from (select source_name, last_created_date as updated_at,
        cast(date_diff('microsecond', last_created_date, {asof}) as double) / {_H} as age_hours
      from ({_batch_top('raw', 'agency')}))"""),
        "display_time": with_base(
            f"select unique_key, {_display('created_at')} as created_label, {_display('closed_at')} as closed_label"
            f" from fct"),
        # data tests
        "not_null_report": with_base(_not_null_sql()),
        "unique_report": with_base(_unique_sql()),
        "accepted_values_report": with_base(
            "select 'accepted_values' as test, 'int_requests_enriched' as model, 'resolution_bucket' as column_name,"
            " cast(count(*) filter (where resolution_bucket not in ('under_24h', '1-3_days', 'over_3_days')) as bigint)"
            " as failures, case when count(*) filter (where resolution_bucket not in"
            " ('under_24h', '1-3_days', 'over_3_days')) > 0 then 'fail' else 'pass' end as status from enr"),
        "unique_combo_report": with_base(
            "select 'unique_combination' as test, 'dim_complaint_type' as model,"
            " 'complaint_type,complaint_subtype' as column_name, count(*) as failures,"
            f" {_status('count(*)')} as status from (select complaint_type, complaint_subtype from"
            " (select distinct complaint_type, complaint_subtype from stg) group by all having count(*) > 1)"),
        "unique_by_batch": with_base(_by_batch("unique", "stg_requests", "unique_key", "", "unique_key is not null")),
        "unique_combo_by_batch": with_base(_by_batch("unique_combination", "dim_complaint_type", "complaint_type,complaint_subtype", "distinct", "true")),
        "freshness": with_base(f"""
select max_loaded_at, age_hours,
  case when max_loaded_at is null then 'error' when age_hours > 48 then 'error' when age_hours > 24 then 'warn'
       else 'pass' end as status
from (select max(created_date) as max_loaded_at,
        cast(date_diff('microsecond', max(created_date), {asof}) as double) / {_H} as age_hours from raw)"""),
    }
    for suffix in LAYOUTS.values():
        q |= {f"{name}_{suffix}": q[name] for name in BUILT_TABLES}
    q |= {f"{name}_delta": q[name] for name in DELTA_TABLES}
    q |= {f"{name}_published": q[name] for name in ("overview", "daily")}
    return q | {f"{name}_monthly": q[name] for name in ("overview", "recent")}
