"""Queries for the harmonising functions, filters, summaries and products, with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.datetimes import epoch_seconds, iso_utc
from ..operators import filters, silver
from ..operators.nearby import containing_regions
from ..products import chemistry, correlation, series, spatial
from ..session import table
from ..sources import providers
from . import unify

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF, AS_OF_YEAR = "2025-06-01 00:00:00", 2025


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


_D = "trim(date_measured)"
READINGS = f"""
raw as (select *,
  case when length({_D}) >= 10 and substr({_D}, 5, 1) in ('-', '/') then try_cast(replace(substr({_D}, 1, 10), '/', '-') as date)
       when length({_D}) >= 10 and substr({_D}, 3, 1) = '/' then try_cast(substr({_D}, 7, 4) || '-' || substr({_D}, 1, 2) || '-' || substr({_D}, 4, 2) as date)
       when length({_D}) between 4 and 6 and regexp_full_match({_D}, '[0-9]+') then date '1900-01-01' + cast({_D} as integer) end as day,
  case when length({_D}) >= 16 and substr({_D}, 11, 1) in ('T', ' ') then substr({_D}, 12, 8) else trim(time_measured) end as clock
  from observations),
rd as (select obs_id, source, id, parameter_name, parameter_value as value, parameter_units as units, cast(day as date) as day,
  cast(epoch(day) as bigint) + coalesce(try_cast(substr(clock, 1, 2) as integer), 0) * 3600 + coalesce(try_cast(substr(clock, 4, 2) as integer), 0) * 60 + coalesce(try_cast(substr(clock, 7, 2) as integer), 0) as ts
  from raw where parameter_value is not null and not isnan(parameter_value) and day is not null)"""
WELLS = """
wells as (select * from (select *, case when starts_with(source, 'WQP/') then 'WQP' else source end as source_key,
  row_number() over (partition by case when starts_with(source, 'WQP/') then 'WQP' else source end, id order by site_uid) as rn from sites where source is not null and id is not null) where rn = 1)"""


def _iso(x: str) -> str:
    return f"strftime(make_timestamp(({x}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def _hu(x: str, scale: float) -> str:
    return f"floor(round(({x}) * {scale}, 6) + 0.5) / {scale}"


def _days(fold: str) -> str:
    return f"days as (select source, id, parameter_name, day, {fold}(value) as v, count(*) as n from rd group by all)"


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.readings(table(spark, sf_dir, "observations"))


def _well_sql(sql: str) -> str:
    """The product of ``sql`` with its well's name and depth."""
    return f"with {WELLS} select q.*, w.name, w.well_depth, w.well_depth_units from ({sql}) q left join wells w on w.source_key = q.source and w.id = q.id"


def _with_well(product: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.with_well(product, table(spark, sf_dir, "sites"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).where("parameter_name = 'waterlevels'")


# --- summaries and flat series -------------------------------------------------------------------

_END = "substr({iso}, 1, 10) as {name}_date, substr({iso}, 12, 8) as {name}_time, {v} as {name}_value, {u} as {name}_units".format


@query(f"""with {READINGS}, {WELLS},
st as (select source, id, parameter_name, count(*) as nrecords, min(value) as min, max(value) as max, {_hu('avg(value)', 1000000.0)} as mean, min(ts) as e, max(ts) as l,
  first(value order by ts, obs_id) as first_v, last(value order by ts, obs_id) as last_v, first(units order by ts, obs_id) as first_u, last(units order by ts, obs_id) as last_u from rd group by all)
select st.source, st.id, parameter_name, last_u as parameter_units, nrecords, st.min, st.max, st.mean, {_END(iso=_iso('e'), name='earliest', v='first_v', u='first_u')}, {_END(iso=_iso('l'), name='latest', v='last_v', u='last_u')},
  w.name, w.usgs_site_id, w.alternate_site_id, w.latitude, w.longitude, w.horizontal_datum, w.elevation, w.elevation_units, w.well_depth, w.well_depth_units,
  case when parameter_name = 'tds' then case when last_v < 1000 then 'fresh' when last_v < 10000 then 'brackish' when last_v < 35000 then 'saline' else 'brine' end end as tds_class
from st join wells w on w.source_key = st.source and w.id = st.id""")
def summary_stats(spark, sf_dir):
    return silver.summaries(_readings(spark, sf_dir), table(spark, sf_dir, "sites"))


@query(f"""with {READINGS}, {WELLS}
select obs_id, rd.source, rd.id, rd.parameter_name, value as parameter_value, units as parameter_units, o.date_measured, o.time_measured, o.source_parameter_name, o.source_parameter_units, o.conversion_factor, o.approval_status, o.qualifier,
  {_iso('ts')} as datetime, rd.source || ':' || rd.id || ':' || cast(day as varchar) as feature_id, w.latitude, w.longitude
from rd join observations o using (obs_id) left join wells w on w.source_key = rd.source and w.id = rd.id""")
def timeseries_flat(spark, sf_dir):
    return silver.flat_series(table(spark, sf_dir, "observations"), table(spark, sf_dir, "sites"))


def _daily(reducer, sql_fold):
    def run(spark, sf_dir):
        d = silver.daily(_readings(spark, sf_dir), reducer)
        return d.select("source", "id", "parameter_name", F.col("day").cast("string").alias("day"), C.half_up(F.col("value"), 6).alias("value"), "n")

    run.__name__ = f"daily_{reducer}"
    query(f"with {READINGS}, {_days(sql_fold)} select source, id, parameter_name, cast(day as varchar) as day, {_hu("v", 1000000.0)} as value, n from days")(run)


for _r, _f in (("min", "min"), ("mean", "avg"), ("max", "max")):
    _daily(_r, _f)


# --- scalar functions ----------------------------------------------------------------------------


@query(f"""with x as (select result_id, lower(trim(parameter_name)) as p, lower(trim(source_parameter_units)) as u, case when parameter_name = 'waterlevels' then 'ft' when parameter_name in ('conductivity', 'specific_conductance') then 'us/cm' else 'mg/l' end as o, lower(trim(source_parameter_name)) as s, parameter_value as v from lab_results),
f as (select *, case when p = 'ph' then 1.0
  when p in ('conductivity', 'specific_conductance') then case when u in ('μmhos/cm', 'umho/cm', 'cm-1', 'micromhos per centimeter', 'mg/l', 'su', 'us/cm', 'us/cm @25c', 'µs/cm', 'μs/cm') then 1.0 end
  when o = 'mg/l' then case when u in ('mg/l caco3', 'mg/l caco3**') then case p when 'bicarbonate' then 1.22 when 'calcium' then 0.4 when 'carbonate' then 0.6 end
    when u = 'mg/l as n' then 4.427 when u in ('mg/l asno3', 'mg/l as no3') then 1.0 when u = 'ug/l as n' then 0.004427 when u = 'pci/l' then 0.00149 when u in ('ug/l', 'ppb') then 0.001
    when u = 'tons/ac ft' then 735.47 when u = 'ppm' then 1.0 when u = 'mg/l' then case when s in ('nitrate as n', 'nitrate (as n)') then 4.427 else 1.0 end end
  when o = 'ft' then case when u in ('m', 'meters') then 3.28084 when u in ('ft', 'feet') then 1.0 end end::double as factor from x)
select result_id, factor, {_hu("v * factor", 1000000.0)} as converted from f""")
def unit_convert(spark, sf_dir):
    t = table(spark, sf_dir, "lab_results")
    out = F.when(F.col("parameter_name") == "waterlevels", "ft").when(F.col("parameter_name").isin("conductivity", "specific_conductance"), "uS/cm").otherwise("mg/L")
    f = C.conversion_factor(F.col("parameter_name"), F.col("source_parameter_units"), out, F.col("source_parameter_name")).cast("double")
    return t.select("result_id", f.alias("factor"), C.half_up(F.col("parameter_value") * f, 6).alias("converted"))


@query("""select result_id, coalesce(case when regexp_matches(value_text, '^\\s*[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?\\s*$') then try_cast(trim(value_text) as double) end,
  case when regexp_matches(lower(trim(value_text)), 'nd|not detected|< mrl|< mdl|<mrl|<mdl') then 0.0 end) as value from lab_results""")
def nondetect_coerce(spark, sf_dir):
    return table(spark, sf_dir, "lab_results").select("result_id", C.coerce_value(F.col("value_text")).alias("value"))


_T = "split_part(trim(date_measured), '.', 1)"


@query(f"""with x as (select obs_id, {_T} as t from observations)
select obs_id, case when regexp_full_match(t, '[-+]?[0-9]{{1,6}}') then cast(date '1900-01-01' + cast(t as integer) as varchar)
  when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([T ][0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}}(Z|\\+00:00)?)?)?') then cast(try_cast(substr(t, 1, 10) as date) as varchar)
  when regexp_full_match(t, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}( [0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}})?)?') then cast(try_cast(replace(substr(t, 1, 10), '/', '-') as date) as varchar)
  when regexp_full_match(t, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') then cast(try_strptime(t, '%m/%d/%Y')::date as varchar)
  when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}') then t end as std_date,
  case when regexp_matches(t, '[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') and substr(t, 12, 8) <> '00:00:00' then substr(t, 12, 8) else '' end as std_time from x""")
def standardize_datetime(spark, sf_dir):
    d = F.col("date_measured")
    return table(spark, sf_dir, "observations").select("obs_id", C.standard_date(d).alias("std_date"), F.coalesce(C.standard_time(d), F.lit("")).alias("std_time"))


@query(f"with {READINGS} select obs_id, ts as epoch_s, {_iso('ts')} as iso from rd")
def epoch_parse(spark, sf_dir):
    return _readings(spark, sf_dir).select("obs_id", F.col("ts").alias("epoch_s"), iso_utc(F.col("ts")).alias("iso"))


@query("""with x as (select obs_id, approval_status as raw, lower(trim(approval_status)) as s from observations),
p as (select 'provisional|preliminary|working|estimated|unverified|unvalidated|raw|draft|in review|tentative|not released' as pv, 'approved|accepted|final|finalized|validated|verified|historical|published|reviewed|public release|released' as ap)
select obs_id, case when raw is null or raw = '' then 'unknown' when s = 'true' then 'approved' when s = 'false' then 'provisional'
  when regexp_full_match(s, ap) then 'approved' when regexp_full_match(s, pv) then 'provisional' when regexp_matches(s, pv) then 'provisional' when regexp_matches(s, ap) then 'approved' else 'unknown' end as status from x, p""")
def approval_status(spark, sf_dir):
    return table(spark, sf_dir, "observations").select("obs_id", C.approval_status(F.col("approval_status")).alias("status"))


@query("""select site_uid, round(case when lower(trim(well_depth_units)) in ('m', 'meters') then well_depth * 3.28084 else well_depth end, 4) as depth_ft,
  round(case when lower(trim(elevation_units)) in ('ft', 'feet') then elevation * 0.3048 else elevation end, 4) as elevation_m from sites where not isnan(coalesce(well_depth, 0)) and not isnan(coalesce(elevation, 0))""")
def length_units(spark, sf_dir):
    t = table(spark, sf_dir, "sites").where(~F.isnan(F.coalesce("well_depth", F.lit(0.0))) & ~F.isnan(F.coalesce("elevation", F.lit(0.0))))
    return t.select("site_uid", F.round(C.length_in(F.col("well_depth"), F.col("well_depth_units"), "ft"), 4).alias("depth_ft"), F.round(C.length_in(F.col("elevation"), F.col("elevation_units"), "m"), 4).alias("elevation_m"))


@query("""select site_uid, case when coalesce(source, '') = '' then id else source || ':' || id end as feature_id, case when starts_with(source, 'WQP/') then 'WQP' else source end as source_key from sites""")
def feature_id(spark, sf_dir):
    return table(spark, sf_dir, "sites").select("site_uid", C.feature_id(F.col("source"), F.col("id")).alias("feature_id"), C.source_key(F.col("source")).alias("source_key"))


_WQ = "(1 - 0.006768657997291 * power(sin(radians(latitude)), 2))"


@query("""with k as (select 6378206.4 as a, 1 / 294.978698214 as f, 6378137.0 - 6378206.4 as da, 1 / 298.257223563 - 1 / 294.978698214 as df),
x as (select site_uid, longitude as lon, latitude as lat, upper(trim(horizontal_datum)) = 'NAD27' as old, radians(latitude) as p, radians(longitude) as l, a, f, da, df, 2 * f - f * f as e2 from sites, k where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180),
y as (select *, sqrt(1 - e2 * pow(sin(p), 2)) as w from x)
select site_uid, round(case when old then lon + degrees((8.0 * sin(l) + 159.0 * cos(l)) / (a / w * cos(p))) else lon end, 7) as lon84,
  round(case when old then lat + degrees((8.0 * sin(p) * cos(l) - 159.0 * sin(p) * sin(l) + 175.0 * cos(p) + (a * df + f * da) * sin(2 * p)) / (a * (1 - e2) / pow(w, 3))) else lat end, 7) as lat84 from y""")
def datum_shift(spark, sf_dir):
    t = filters.sane_coordinates(table(spark, sf_dir, "sites"))
    lon, lat = C.to_wgs84(F.col("longitude"), F.col("latitude"), F.coalesce("horizontal_datum", F.lit("")))
    return t.select("site_uid", F.round(lon, 7).alias("lon84"), F.round(lat, 7).alias("lat84"))


@query("""select site_uid, round(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(34.0 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(34.0)) * pow(sin(radians(-106.0 - longitude) / 2), 2)))), 3) as metres
from sites where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180""")
def haversine(spark, sf_dir):
    t = filters.sane_coordinates(table(spark, sf_dir, "sites"))
    return t.select("site_uid", F.round(C.haversine(F.col("latitude"), F.col("longitude"), F.lit(34.0), F.lit(-106.0)), 3).alias("metres"))


@query(r"""with x as (select site_uid, regexp_replace(upper(trim(coalesce(usgs_site_id, ''))), '\s+', ' ', 'g') as n from sites)
select site_uid, array_to_string(list_filter(list_distinct([n, regexp_replace(n, '^(USGS-|USGS:|NWIS-|NWIS:)', '')]), lambda k: k <> '').list_sort(), '|') as keys from x""")
def match_keys(spark, sf_dir):
    return table(spark, sf_dir, "sites").select("site_uid", F.array_join(F.array_sort(C.match_keys(F.col("usgs_site_id"))), "|").alias("keys"))


@query(r"""with x as (select site_uid, regexp_extract_all(coalesce(alternate_site_id, ''), '(?:^|[^0-9])([0-9]{6}[ \t]?[0-9]{8,9})(?:[^0-9]|$)', 1) as k from sites)
select site_uid, array_to_string(list_sort(list_distinct(list_transform(k, lambda y: regexp_replace(y, '[ \t]', '', 'g')))), '|') as stations from x""")
def station_keys(spark, sf_dir):
    return table(spark, sf_dir, "sites").select("site_uid", F.array_join(F.array_sort(C.station_keys(F.col("alternate_site_id"))), "|").alias("stations"))


@query(r"""select site_uid, array_to_string(list_filter(regexp_split_to_array(coalesce(alternate_site_id, ''), '[,;|/\n\t ]+'), lambda t: t <> ''), '|') as refs from sites""")
def reference_tokens(spark, sf_dir):
    return table(spark, sf_dir, "sites").select("site_uid", F.array_join(C.references(F.col("alternate_site_id")), "|").alias("refs"))


@query(r"""select site_uid, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(upper(coalesce(name, '')), '[^\p{L}\p{N}]+'), lambda t: length(t) >= 3))), '|') as tokens from sites""")
def name_tokens(spark, sf_dir):
    return table(spark, sf_dir, "sites").select("site_uid", F.array_join(F.array_sort(C.name_tokens(F.col("name"))), "|").alias("tokens"))


# --- filters -------------------------------------------------------------------------------------


@query("select site_uid from sites where longitude > -107 and longitude < -105 and latitude > 33 and latitude < 35")
def bbox_filter(spark, sf_dir):
    return filters.in_box(table(spark, sf_dir, "sites"), -107, 33, -105, 35).select("site_uid")


@query("select site_uid from sites where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180 and upper(trim(coalesce(horizontal_datum, 'WGS84'))) in ('NAD27', 'NAD83', 'WGS84')")
def coordinate_sanity(spark, sf_dir):
    return filters.sane_coordinates(table(spark, sf_dir, "sites"), datum=True).select("site_uid")


@query(f"with {READINGS} select obs_id from rd where day between date '2015-01-01' and date '2019-12-31'")
def date_range_filter(spark, sf_dir):
    return filters.between_days(_readings(spark, sf_dir), "2015-01-01", "2019-12-31").select("obs_id")


@query("select obs_id from observations where source in ('USGS-NWIS', 'NMBGMR', 'WQP') and source not in ('WQP')")
def source_include_exclude(spark, sf_dir):
    return filters.sources(table(spark, sf_dir, "observations"), include=["USGS-NWIS", "NMBGMR", "WQP"], exclude=["WQP"]).select("obs_id")


@query("select obs_id, parameter_name from observations where parameter_name in ('calcium', 'magnesium')")
def parameter_filter(spark, sf_dir):
    return table(spark, sf_dir, "observations").where(F.col("parameter_name").isin("calcium", "magnesium")).select("obs_id", "parameter_name")


@query("select result_id from lab_results where value_text is not null and trim(value_text) <> '' and trim(value_text) <> '-999999' and date_measured is not null")
def clean_filter(spark, sf_dir):
    return filters.clean_results(table(spark, sf_dir, "lab_results")).select("result_id")


#: Lab results as the portal would deliver them: names, activities, codes and temperature bases.
_PORTAL = """portal as (select result_id, id as site, case parameter_name when 'tds' then 'Total dissolved solids' when 'conductivity' then 'Specific conductance' when 'specific_conductance' then 'Specific conductance' end as name, value_text as value,
  case when result_id % 11 > 0 then id || '/' || coalesce(date_measured, '') end as activity, ['70301', '70303', '70300', '30000'][cast(result_id % 4 as integer) + 1] as code,
  case when lower(source_parameter_units) like '%25c%' or lower(source_parameter_units) like '%25 deg c%' or result_id % 3 = 0 then ' 25 deg C ' end as basis from lab_results where trim(value_text) <> '')"""


def _portal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n, u = F.col("parameter_name"), F.col("result_id"), F.lower("source_parameter_units")
    name = F.when(p == "tds", "Total dissolved solids").when(p.isin("conductivity", "specific_conductance"), "Specific conductance")
    return table(spark, sf_dir, "lab_results").select(
        n, F.col("id").alias("MonitoringLocationIdentifier"), name.alias("CharacteristicName"), F.col("value_text").alias("ResultMeasureValue"), F.when(n % 11 > 0, F.concat("id", F.lit("/"), F.coalesce("date_measured", F.lit("")))).alias("ActivityIdentifier"),
        F.element_at(F.array(*map(F.lit, ("70301", "70303", "70300", "30000"))), (n % 4).cast("int") + 1).alias("USGSPCode"), F.when(u.contains("25c") | u.contains("25 deg c") | (n % 3 == 0), " 25 deg C ").alias("ResultTemperatureBasisText"),
    )


@query(f"with {_PORTAL} select result_id, case when trim(coalesce(basis, '')) in ('25 deg C', '25 Deg C') then 'specific_conductance' else 'conductivity' end as kind from portal where name = 'Specific conductance'")
def conductivity_split(spark, sf_dir):
    raw = _portal(spark, sf_dir)
    kinds = [providers.portal_results(raw, k).select("result_id", F.lit(k).alias("kind")) for k in ("conductivity", "specific_conductance")]
    return kinds[0].unionByName(kinds[1])


@query(f"""with {_PORTAL}, k as (select *, row_number() over (partition by site, activity order by case code when '70300' then 1 when '70301' then 2 when '70303' then 3 else 4 end, value desc) as r from portal where name = 'Total dissolved solids')
select site, activity, code, value from k where r = 1 or activity is null""")
def tds_dedup(spark, sf_dir):
    kept = providers.portal_results(_portal(spark, sf_dir), "tds")
    return kept.select(F.col("MonitoringLocationIdentifier").alias("site"), F.col("ActivityIdentifier").alias("activity"), F.col("USGSPCode").alias("code"), F.col("ResultMeasureValue").alias("value"))


@query(f"with {READINGS}, {WELLS} select site_uid from wells where exists (select 1 from rd where rd.source = wells.source_key and rd.id = wells.id) order by site_uid limit 100")
def site_limit(spark, sf_dir):
    w = silver.wells(table(spark, sf_dir, "sites"))
    return filters.first_sites_with_readings(w, _readings(spark, sf_dir), 100).select("site_uid")


@query(f"with {WELLS} select source_key, id, site_uid, name from wells")
def dedup_sites(spark, sf_dir):
    return silver.wells(table(spark, sf_dir, "sites")).select("source_key", "id", "site_uid", "name")


@query("""select 'sites' as origin, source, id, name, latitude, longitude, alternate_site_id from sites union all select 'pods', source, id, name, latitude, longitude, null from pod_sites""")
def union_sources(spark, sf_dir):
    a = table(spark, sf_dir, "sites").select(F.lit("sites").alias("origin"), "source", "id", "name", "latitude", "longitude", "alternate_site_id")
    b = table(spark, sf_dir, "pod_sites").select(F.lit("pods").alias("origin"), "source", "id", "name", "latitude", "longitude")
    return a.unionByName(b, allowMissingColumns=True)


@query("select result_id, source, id, parameter_name from lab_results l where not exists (select 1 from sites s where s.id = l.id and (s.source = l.source or (l.source = 'WQP' and starts_with(s.source, 'WQP/'))))")
def orphan_results(spark, sf_dir):
    w = silver.wells(table(spark, sf_dir, "sites")).select(F.col("source_key").alias("source"), "id")
    return table(spark, sf_dir, "lab_results").join(w, ["source", "id"], "left_anti").select("result_id", "source", "id", "parameter_name")


@query(f"with {READINGS}, {WELLS}, o as (select source, count(*) as observation_count, count(distinct id) as site_count from rd group by source), w as (select source_key as source, count(*) as record_count from wells group by source_key) select source, record_count, coalesce(site_count, 0) as site_count, coalesce(observation_count, 0) as observation_count from w left join o using (source)")
def source_stats(spark, sf_dir):
    r, w = _readings(spark, sf_dir), silver.wells(table(spark, sf_dir, "sites"))
    o = r.groupBy("source").agg(F.count(F.lit(1)).alias("o"), F.count_distinct("id").alias("s"))
    n = w.groupBy(F.col("source_key").alias("source")).agg(F.count(F.lit(1)).alias("record_count"))
    return n.join(o, "source", "left").select("source", "record_count", F.coalesce("s", F.lit(0).cast("long")).alias("site_count"), F.coalesce("o", F.lit(0).cast("long")).alias("observation_count"))


# --- chemistry -----------------------------------------------------------------------------------


def _wide(analytes: list[str], units: bool = False) -> str:
    last = f"lastv as (select source, id, parameter_name, last(value order by ts, obs_id) as v, cast(last(day order by ts, obs_id) as varchar) as d, last(units order by ts, obs_id) as u from rd where parameter_name in ({', '.join(repr(a) for a in analytes)}) group by all)"
    cells = ", ".join(f"max(case when parameter_name = '{a}' then v end) as {a}, max(case when parameter_name = '{a}' then d end) as {a}_date" + (f", max(case when parameter_name = '{a}' then u end) as {a}_units" if units else "") for a in analytes)
    return f"with {READINGS}, {last}, wide as (select source, id, {cells} from lastv group by all)"


_IONS = chemistry.MAJOR_IONS
_MEQ = {a: f"(coalesce({a}, 0.0) / {w})" for a, w in C.MEQ_WEIGHTS.items()}
_CAT, _AN = " + ".join(_MEQ[a] for a in chemistry.CATIONS), " + ".join(_MEQ[a] for a in chemistry.ANIONS)
_SIDES = f"sides as (select *, {_CAT} as cat, {_AN} as an from wide)"
_LIMITED = sorted(chemistry.LIMITS)


@query(_well_sql(f"{_wide(_IONS, units=True)} select * from wide"))
def major_chemistry_pivot(spark, sf_dir):
    return _with_well(chemistry.major_chemistry(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(
    f"{_wide(_LIMITED)} select source, id, "
    + ", ".join(f"{a}, {a}_date, case when {a} is not null then {chemistry.LIMITS[a][0]}::double end as {a}_mcl, case when {a} is not null then '{chemistry.LIMITS[a][1]}' end as {a}_mcl_type, {a} > {chemistry.LIMITS[a][0]} as {a}_exceeds" for a in _LIMITED)
    + ", cast("
    + " + ".join(f"coalesce(({a} > {chemistry.LIMITS[a][0]})::int, 0)" for a in _LIMITED)
    + " as integer) as exceedance_count, ("
    + " or ".join(f"coalesce({a} > {chemistry.LIMITS[a][0]}, false)" for a in _LIMITED)
    + ") as any_exceedance, concat_ws(',', "
    + ", ".join(f"case when {a} > {chemistry.LIMITS[a][0]} then '{a}' end" for a in _LIMITED)
    + ") as exceeded_analytes from wide"
))
def mcl_exceedance(spark, sf_dir):
    return _with_well(chemistry.exceedance(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""{_wide(['calcium', 'magnesium'])}, h as (select *, round(2.497 * calcium + 4.118 * magnesium, 1) as hardness_caco3 from wide)
select *, 'mg/L as CaCO3' as hardness_units, case when hardness_caco3 is null then 'insufficient' when hardness_caco3 < 60 then 'soft' when hardness_caco3 < 120 then 'moderate' when hardness_caco3 < 180 then 'hard' else 'very hard' end as hardness_class from h"""))
def hardness(spark, sf_dir):
    return _with_well(chemistry.hardness(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""{_wide(_IONS)}, {_SIDES}, s as (select *, cat > 0 and an > 0 as ok, 100 * {_MEQ['calcium']} / cat as ca, 100 * {_MEQ['magnesium']} / cat as mg, 100 * ({_MEQ['sodium']} + {_MEQ['potassium']}) / cat as na,
  100 * ({_MEQ['bicarbonate']} + {_MEQ['carbonate']}) / an as hco3, 100 * {_MEQ['chloride']} / an as cl, 100 * {_MEQ['sulfate']} / an as so4 from sides),
d as (select *, case when ca > 50 then 'Ca' when mg > 50 then 'Mg' when na > 50 then 'Na+K' else 'mixed' end as dc, case when hco3 > 50 then 'HCO3' when cl > 50 then 'Cl' when so4 > 50 then 'SO4' else 'mixed' end as da from s)
select source, id, round(cat, 3) as cation_meq_total, round(an, 3) as anion_meq_total, case when ok then dc || '-' || da else 'insufficient' end as water_type, case when ok then dc end as dominant_cation, case when ok then da end as dominant_anion,
  case when ok then round(ca, 1) end as ca_pct, case when ok then round(mg, 1) end as mg_pct, case when ok then round(na, 1) end as na_k_pct, case when ok then round(hco3, 1) end as hco3_pct, case when ok then round(cl, 1) end as cl_pct, case when ok then round(so4, 1) end as so4_pct,
  case when ok then round(100 * (cat - an) / (cat + an), 1) end as charge_balance_pct from d"""))
def water_type(spark, sf_dir):
    return _with_well(chemistry.water_type(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""{_wide(['sodium', 'calcium', 'magnesium'])}, b as (select *, ({_MEQ['calcium']} + {_MEQ['magnesium']}) / 2 as base from wide),
r as (select * exclude (base), case when sodium is not null and (calcium is not null or magnesium is not null) and base > 0 then round({_MEQ['sodium']} / sqrt(greatest(base, 0)), 2) end as sar from b)
select *, case when sar is null then 'insufficient' when sar < 10 then 'low' when sar < 18 then 'medium' when sar < 26 then 'high' else 'very high' end as sar_class from r"""))
def sar(spark, sf_dir):
    return _with_well(chemistry.sodium_adsorption(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""{_wide(_IONS)}, {_SIDES}, b as (select *, case when cat > 0 and an > 0 then round(100 * (cat - an) / (cat + an), 1) end as x from sides)
select source, id, round(cat, 3) as cation_meq_total, round(an, 3) as anion_meq_total, cast({' + '.join(f'({a} is not null)::int' for a in chemistry.CATIONS)} as integer) as n_cations_reported, cast({' + '.join(f'({a} is not null)::int' for a in chemistry.ANIONS)} as integer) as n_anions_reported,
  x as charge_balance_pct, case when x is null then 'insufficient' when abs(x) <= 5 then 'balanced' when abs(x) <= 10 then 'acceptable' else 'suspect' end as balance_class from b"""))
def ion_balance(spark, sf_dir):
    return _with_well(chemistry.ion_balance(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(
    f"{_wide(_LIMITED)}, t as (select *, cast("
    + " + ".join(f"({a} is not null)::int" for a in _LIMITED)
    + " as integer) as n, cast("
    + " + ".join(f"coalesce(({a} > {chemistry.LIMITS[a][0]})::int, 0)" for a in _LIMITED)
    + " as integer) as bad, "
    + " + ".join(f"case when {a} > {chemistry.LIMITS[a][0]} then {a} / {chemistry.LIMITS[a][0]} - 1 else 0.0 end" for a in _LIMITED)
    + " as over, concat_ws(',', "
    + ", ".join(f"case when {a} > {chemistry.LIMITS[a][0]} then '{a}' end" for a in _LIMITED)
    + ") as exceeded_analytes from wide), u as (select *, over / n as nse, 100.0 * bad / n as f1 from t), "
    + f"w as (select source, id, {', '.join(f'{a}, {a}_date' for a in _LIMITED)}, exceeded_analytes, n as n_analytes_tested, bad as n_exceeding, round(greatest(0.0, least(100.0, 100 - sqrt(2 * f1 * f1 + pow(nse / (0.01 * nse + 0.01), 2)) / 1.732)), 1) as wqi from u) "
    "select *, case when wqi is null then 'insufficient' when wqi >= 95 then 'excellent' when wqi >= 80 then 'good' when wqi >= 65 then 'fair' when wqi >= 45 then 'marginal' else 'poor' end as wqi_class from w"
))
def wqi(spark, sf_dir):
    return _with_well(chemistry.quality_index(_readings(spark, sf_dir)), spark, sf_dir)


# --- histories -----------------------------------------------------------------------------------


def _day_sql(fold: str, where: str) -> str:
    return f"""days as (select source, id, parameter_name, day, {fold}(value) as v, count(*) as n, cast(epoch(day) as bigint) as t from rd where {where} group by all),
seen as (select source, id, parameter_name, count(*) as record_count, cast(sum(n) as bigint) as observation_count, min(t) as f, max(t) as l, (max(t) - min(t)) / 31557600 as span from days group by all)"""


_LEVELS = "parameter_name = 'waterlevels'"
_TIMES = f"{_iso('f')} as first_observation_datetime, {_iso('l')} as last_observation_datetime"
#: Error function by a series of positive terms.
_TAIL = "case when {x} > 6 then 0.0 when {x} = 0 then 1.0 else 1 - 2 / sqrt(pi()) * exp(-{x} * {x}) * list_sum(list_transform(range(0, 200), lambda k: exp(2 * k * ln(2) + (2 * k + 1) * ln({x}) + lgamma(k + 1) - lgamma(2 * k + 2)))) end"


def _trend_sql(fold: str, where: str, units: str) -> str:
    return f"""with {READINGS}, {_day_sql(fold, where)},
fit as (select * from seen where record_count >= 10 or (record_count >= 4 and span >= 2)),
q as (select d.*, d.t / 31557600 as x from days d join fit using (source, id, parameter_name)),
pairs as (select a.source, a.id, a.parameter_name, sum(sign(b.v - a.v)) as s, median((b.v - a.v) / (b.x - a.x)) as slope from q a join q b on a.source = b.source and a.id = b.id and a.parameter_name = b.parameter_name and a.x < b.x group by all),
ties as (select source, id, parameter_name, sum(c * (c - 1) * (2 * c + 5)) as tie from (select source, id, parameter_name, v, count(*) as c from q group by all) group by all),
z as (select *, (record_count * (record_count - 1) * (2 * record_count + 5) - tie) / 18.0 as var from pairs join ties using (source, id, parameter_name) join fit using (source, id, parameter_name)),
y as (select *, case when var <= 0 or s = 0 then 0.0 else (s - sign(s)) / sqrt(var) end as zz from z)
select seen.source, seen.id, seen.parameter_name, seen.record_count, seen.observation_count, {_iso('seen.f')} as first_observation_datetime, {_iso('seen.l')} as last_observation_datetime, round(seen.span, 3) as span_years,
  {_hu('y.slope', 100.0)} as slope_per_year, '{units}' as slope_units, case when y.zz is null then 'not enough data' when abs(y.zz) <= 1.959963984540054 then 'stable' when y.zz > 0 then 'increasing' else 'decreasing' end as trend_category,
  {_hu(_TAIL.format(x='(abs(y.zz) / sqrt(2))'), 10000.0)} as mk_p_value, round(y.s / (y.record_count * (y.record_count - 1) / 2), 4) as mk_tau from seen left join y using (source, id, parameter_name)"""


@query(_well_sql(_trend_sql("min", _LEVELS, "ft/year")))
def waterlevel_trend(spark, sf_dir):
    return _with_well(series.trends(_levels(spark, sf_dir), "min"), spark, sf_dir)


@query(_well_sql(_trend_sql("avg", "parameter_name in ('arsenic', 'nitrate', 'tds')", "mg/L/year")))
def analyte_trend(spark, sf_dir):
    return _with_well(series.trends(_readings(spark, sf_dir).where(F.col("parameter_name").isin("arsenic", "nitrate", "tds")), "mean", "mg/L/year"), spark, sf_dir)


@query(f"""with {READINGS}, {WELLS}, s as (select source, id, count(*) as n, min(ts) as f, max(ts) as l from rd where {_LEVELS} group by all),
e as (select w.source_key as source, w.id, w.name, w.well_depth, w.well_depth_units, coalesce(n, 0) as record_count, f, l, cast(floor((epoch(timestamp '{AS_OF}') - l) / 86400.0) as bigint) as days_since_last from wells w left join s on s.source = w.source_key and s.id = w.id)
select source, id, name, well_depth, well_depth_units, record_count, {_TIMES}, days_since_last, case when record_count = 0 then 'no data' when days_since_last <= 365 then 'active' else 'stale' end as status from e""")
def monitoring_recency(spark, sf_dir):
    w = silver.wells(table(spark, sf_dir, "sites")).select(F.col("source_key").alias("source"), "id")
    return _with_well(series.recency(_levels(spark, sf_dir), AS_OF, wells=w), spark, sf_dir)


@query(_well_sql(f"""with {READINGS}, {_day_sql("min", "true")}
select source, id, parameter_name, observation_count, record_count, {_TIMES}, round(span, 3) as span_years, case when record_count > 1 then round(span * 365.25 / (record_count - 1), 1) end as mean_interval_days, case when span > 0 then round(observation_count / span, 2) end as observations_per_year from seen"""))
def data_density(spark, sf_dir):
    return _with_well(series.density(_readings(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""with {READINGS}, {_day_sql("min", _LEVELS)},
e as (select source, id, parameter_name, max(t) as end_t, arg_max(v, t) as end_v from days group by all),
n as (select d.*, end_t, end_v, abs(t - (end_t - 157788000)) as far from days d join e using (source, id, parameter_name)),
b as (select source, id, parameter_name, end_t, end_v, first(v order by far, t) filter (where t < end_t) as nv, first(t order by far, t) filter (where t < end_t) as nt, min(far) filter (where t < end_t) as nf from n group by all),
c as (select *, case when nf <= 78894000 then nv end as sv, case when nf <= 78894000 then nt end as st from b),
k as (select source, id, parameter_name, cast(sum((t >= st)::int) as bigint) as inside from days join c using (source, id, parameter_name) group by all),
r as (select *, case when record_count >= 2 then {_hu('end_v', 100.0)} end as dtw_end, {_hu('sv', 100.0)} as dtw_start from c join k using (source, id, parameter_name) join seen using (source, id, parameter_name)),
d as (select *, {_hu('dtw_end - dtw_start', 100.0)} as change_ft from r)
select source, id, parameter_name, 5.0::double as window_years, round((end_t - st) / 31557600, 3) as actual_window_years, dtw_start, dtw_end, {_iso('st')} as start_date, case when record_count >= 2 then {_iso('end_t')} end as end_date, change_ft, 'ft' as change_units,
  case when change_ft > 0 then 'declining' when change_ft < 0 then 'rising' when change_ft = 0 then 'stable' end as direction, coalesce(inside, 0) as n_observations_in_window, observation_count, case when change_ft is null then 'insufficient' else 'ok' end as status from d"""))
def level_change(spark, sf_dir):
    return _with_well(series.change(_levels(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""with {READINGS}, {_day_sql("min", _LEVELS)},
m as (select source, id, parameter_name, arg_max(v, day) as latest, min(v) as lo, max(v) as hi, median(v) as med from days group by all),
r as (select source, id, parameter_name, latest, lo, hi, med, sum((v < latest)::int) as less, sum((v = latest)::int) as same from days join m using (source, id, parameter_name) group by all),
p as (select *, case when record_count >= 10 then {_hu('100 * (less + 0.5 * same) / record_count', 10.0)} end as pct from r join seen using (source, id, parameter_name))
select source, id, parameter_name, record_count, observation_count, {_TIMES}, round(span, 3) as span_years, {_hu('latest', 100.0)} as latest_dtw, {_iso('l')} as latest_dtw_date, {_hu('lo', 100.0)} as min_dtw, {_hu('med', 100.0)} as median_dtw, {_hu('hi', 100.0)} as max_dtw, 'ft' as dtw_units, pct as dtw_percentile,
  case when pct is null then 'insufficient' when pct >= 90 then 'much below normal' when pct >= 75 then 'below normal' when pct <= 10 then 'much above normal' when pct <= 25 then 'above normal' else 'normal' end as status from p"""))
def level_status(spark, sf_dir):
    return _with_well(series.status(_levels(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""with {READINGS}, {_day_sql("min", _LEVELS)},
y as (select source, id, parameter_name, cast(year(day) as integer) as y, count(*) as d, sum(n) as o, case when count(*) >= 4 then max(v) - min(v) end as a from days group by source, id, parameter_name, year(day))
select source, id, parameter_name, cast(sum(d) as bigint) as record_count, cast(sum(o) as bigint) as observation_count, count(*) as n_years_with_data, cast(sum((d >= 4)::int) as bigint) as n_years_used, 'ft' as amplitude_units, {_hu('avg(a)', 100.0)} as mean_amplitude_ft,
  {_hu('max(a)', 100.0)} as max_amplitude_ft, first(y order by a desc, y) filter (where a is not null) as max_amplitude_year, {_hu('min(a)', 100.0)} as min_amplitude_ft, case when max(a) is null then 'insufficient' else 'ok' end as status from y group by all"""))
def seasonal_amplitude(spark, sf_dir):
    return _with_well(series.seasonal(_levels(spark, sf_dir)), spark, sf_dir)


@query(_well_sql(f"""with {READINGS}, {WELLS}, tr as ({_trend_sql("min", _LEVELS, "ft/year")}), {_day_sql("min", _LEVELS)},
m as (select source, id, parameter_name, arg_max(v, day) as latest, max(day) as last_day from days group by all),
j as (select m.*, tr.record_count, tr.observation_count, tr.span_years, tr.trend_category, tr.slope_per_year, case when not isnan(well_depth) then case when lower(trim(well_depth_units)) in ('m', 'meters') then well_depth * 3.28084 else well_depth end end as depth
  from m join tr using (source, id, parameter_name) left join wells w on w.source_key = m.source and w.id = m.id),
k as (select *, trend_category = 'increasing' and slope_per_year > 0 as falling from j), r as (select *, case when falling then {_hu('depth - latest', 100.0)} end as remaining from k), y as (select *, case when remaining > 0 then {_hu('remaining / slope_per_year', 10.0)} end as years from r)
select source, id, parameter_name, record_count, observation_count, span_years, case when trend_category <> 'not enough data' then trend_category end as trend_category, slope_per_year as slope_ft_per_year, {_hu('latest', 100.0)} as latest_dtw, {_iso('cast(epoch(last_day) as bigint)')} as latest_dtw_date, remaining as remaining_ft,
  years as years_to_depletion, cast(trunc(year(last_day) + years) as integer) as projected_depletion_year, case when trend_category = 'not enough data' then 'not enough data' when not coalesce(falling, false) then 'not declining' when depth is null then 'no well depth' when remaining <= 0 then 'dtw exceeds well depth' else 'projected' end as status from y"""))
def depletion_projection(spark, sf_dir):
    return _with_well(series.depletion(_levels(spark, sf_dir), table(spark, sf_dir, "sites")), spark, sf_dir)


# --- regions and crosswalk -----------------------------------------------------------------------

_OK = "latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180"
#: Even-odd rule over all rings of a region.
EDGES = r"""
rings as (select county_no, unnest(regexp_extract_all(geometry, '\(([^()]+)\)', 1)) as ring from counties),
numbered as (select county_no, row_number() over () as rid, string_split(ring, ',') as pts from rings),
vertices as (select county_no, rid, generate_subscripts(pts, 1) as i, unnest(pts) as pt from numbered),
xy as (select county_no, rid, i, cast(split_part(trim(pt), ' ', 1) as double) as x, cast(split_part(trim(pt), ' ', 2) as double) as y from vertices),
edges as (select county_no, x as x1, y as y1, coalesce(lead(x) over w, first_value(x) over w) as x2, coalesce(lead(y) over w, first_value(y) over w) as y2 from xy window w as (partition by rid order by i))"""


def _held(points: str) -> str:
    """held(uid, county_no) of points(uid, latitude, longitude)."""
    return f"""held as (select p.uid, e.county_no from {points} p join edges e on (e.y1 > p.latitude) <> (e.y2 > p.latitude) and p.longitude < e.x1 + (p.latitude - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
  group by p.uid, e.county_no having count(*) % 2 = 1)"""


_SITE_POINTS = f"pts as (select site_uid as uid, latitude, longitude from sites where {_OK})"
_WELL_POINTS = f"pts as (select site_uid as uid, latitude, longitude from wells where {_OK})"
_POD_POINTS = f"""firsts as (select * from (select *, row_number() over (partition by source, id order by pod_uid) as r from pod_sites where id is not null) where r = 1),
pts as (select pod_uid as uid, source, id, latitude, longitude, well_completion_date, well_depth, well_depth_units, try_cast(substr(well_completion_date, 1, 4) as integer) as y from firsts where {_OK})"""
_YEARS = list(range(AS_OF_YEAR - 9, AS_OF_YEAR + 1))
_POD_TABLE = (
    f"{EDGES}, {_POD_POINTS}, {_held('pts')}, one as (select uid, min(county_no) as county_no from held group by uid), "
    + "bins as (select county_no, "
    + ", ".join(f"cast(sum((y = {y})::int) as bigint) as b{y}" for y in _YEARS)
    + f" from pts join one using (uid) where y between {_YEARS[0]} and {_YEARS[-1]} group by county_no), "
    + "full_bins as (select c.county_no, c.name as county, c.fips, c.area_sq_km, "
    + ", ".join(f"coalesce(b{y}, 0) as year_{y}" for y in _YEARS)
    + " from counties c left join bins using (county_no)), "
    + "pods as (select *, "
    + " + ".join(f"year_{y}" for y in _YEARS)
    + " as total_recent_pods, case when greatest("
    + ", ".join(f"year_{y}" for y in _YEARS)
    + ") > 0 then coalesce("
    + ", ".join(f"case when year_{y} = greatest({', '.join(f'year_{x}' for x in _YEARS)}) then {y} end" for y in _YEARS)
    + ") end as peak_year, "
    + _hu("(" + " + ".join(f"({i} - 4.5::double) * year_{y}" for i, y in enumerate(_YEARS)) + ") / 82.5::double", 1000.0)
    + f" as trend_pods_per_year, year_{_YEARS[-1]} as latest_year_count from full_bins)"
)
_NORM = "regexp_replace(upper(trim(coalesce({}, ''))), '\\s+', ' ', 'g')".format
_BARE = "regexp_replace({}, '^(USGS-|USGS:|NWIS-|NWIS:)', '')".format
_STATIONS = "regexp_extract_all(regexp_replace({}, '([^0-9 \t])', '\\1\\1', 'g'), '(?:^|[^0-9])([0-9]{{6}}[ \t]?[0-9]{{8,9}})(?:[^0-9]|$)', 1)".format
#: The crosswalk's canonical wells, points of diversion among them, with what they are known by and refer to.
CANON = rf"""
sited as (select site_uid, source, id, name, latitude, longitude, elevation, elevation_units, well_depth, well_depth_units, usgs_site_id, alternate_site_id from sites
  union all select pod_uid, source, id, name, latitude, longitude, null, null, well_depth, well_depth_units, null, null from pod_sites),
c as (select * from (select *, {_NORM('source')} || ':' || trim(id) as site_key, row_number() over (partition by {_NORM('source')} || ':' || trim(id) order by site_uid) as rn from sited where source is not null and id is not null) where rn = 1),
named as (select distinct site_key, unnest([{_NORM('id')}, {_BARE(_NORM('id'))}, {_NORM('usgs_site_id')}, {_BARE(_NORM('usgs_site_id'))}]) as k from c),
alt as (select site_key, unnest(regexp_split_to_array(coalesce(alternate_site_id, ''), '[,;|/\n\t ]+')) as t from c),
own_numbers as (select site_key, regexp_replace(unnest(list_concat({_STATIONS("coalesce(id, '')")}, {_STATIONS("coalesce(usgs_site_id, '')")}, {_STATIONS("coalesce(name, '')")})), '[ \t]', '', 'g') as k from c),
other_numbers as (select site_key, regexp_replace(unnest(list_concat({_STATIONS("coalesce(alternate_site_id, '')")}, {_STATIONS("coalesce(usgs_site_id, '')")}, {_STATIONS("coalesce(name, '')")})), '[ \t]', '', 'g') as k from c),
known as (select site_key, k from named union select site_key, k from own_numbers),
refs as (select site_key, unnest([{_NORM('usgs_site_id')}, {_BARE(_NORM('usgs_site_id'))}]) as k from c union select site_key, unnest([{_NORM('t')}, {_BARE(_NORM('t'))}]) from alt union select site_key, k from other_numbers),
explicit as (select distinct least(r.site_key, k.site_key) as a, greatest(r.site_key, k.site_key) as b from refs r join known k using (k) where r.site_key <> k.site_key and regexp_matches(k, '[1-9]'))"""
_FT = "case when lower(trim({u})) in ('m', 'meters') then {v} * 3.28084 else {v} end".format
SPATIAL = rf"""
w as (select site_key, site_uid, source, latitude, longitude, case when not isnan(well_depth) then {_FT(v='well_depth', u='well_depth_units')} end as dep, case when not isnan(elevation) then {_FT(v='elevation', u='elevation_units')} end as ele,
  list_distinct(list_filter(regexp_split_to_array(upper(coalesce(name, '')), '[^\p{{L}}\p{{N}}]+') || regexp_split_to_array(upper(id), '[^\p{{L}}\p{{N}}]+'), lambda t: length(t) >= 3)) as tok from c where {_OK}),
near as (select x.site_key as a, y.site_key as b, x.source as a_source, y.source as b_source, abs(x.dep - y.dep) as dd, abs(x.ele - y.ele) as de, list_has_any(x.tok, y.tok) as tok,
  2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(y.latitude - x.latitude) / 2), 2) + cos(radians(x.latitude)) * cos(radians(y.latitude)) * pow(sin(radians(y.longitude - x.longitude) / 2), 2)))) as m
  from w x join w y on y.latitude between x.latitude - 0.0014 and x.latitude + 0.0014 and x.site_key < y.site_key and x.source <> y.source),
spatial as (select a, b, a_source, b_source, m as distance_m, least(0.9::double, 0.35::double + case when m <= 50 then 0.10 else 0 end + case when dd is not null then 0.25 else 0 end + case when de is not null then 0.12 else 0 end + case when tok then 0.10 else 0 end) as confidence
  from near where m <= 150 and coalesce(dd, 0) <= 50 and coalesce(de, 0) <= 20),
sides as (select a, b, b_source as s, distance_m, confidence from spatial union all select b, a, a_source, distance_m, confidence from spatial),
best as (select a, b from (select *, row_number() over (partition by a, s order by round(confidence, 9) desc, distance_m, b) as r from sides) where r = 1),
mutual as (select x.a, x.b from best x join best y on x.a = y.b and x.b = y.a where x.a < x.b)"""


@query(f"with {EDGES}, {_SITE_POINTS}, {_held('pts')} select uid as point_key, county_no as region_key from held")
def point_in_region(spark, sf_dir):
    return containing_regions(table(spark, sf_dir, "sites"), "site_uid", "latitude", "longitude", table(spark, sf_dir, "counties"), "county_no", "geometry")


@query(f"""with {WELLS}, {EDGES}, {_WELL_POINTS}, {_held('pts')}, one as (select uid, min(county_no) as county_no from held group by uid), n as (select county_no, count(*) as c from one group by county_no)
select county_no, name, fips, area_sq_km, coalesce(c, 0) as well_count, case when area_sq_km > 0 then round(coalesce(c, 0) / area_sq_km, 4) end as wells_per_sq_km from counties left join n using (county_no)""")
def well_density(spark, sf_dir):
    return spatial.density(table(spark, sf_dir, "sites"), table(spark, sf_dir, "counties"))


@query(f"with {WELLS}, {EDGES}, {_WELL_POINTS}, {_held('pts')} select count(*) as unassigned_well_count from pts where uid not in (select uid from held)")
def unassigned_wells(spark, sf_dir):
    return spatial.unassigned(table(spark, sf_dir, "sites"), table(spark, sf_dir, "counties"))


@query(f"with {_POD_TABLE} select * from pods")
def pod_age_by_county(spark, sf_dir):
    return spatial.completions_by_region(table(spark, sf_dir, "pod_sites"), table(spark, sf_dir, "counties"), AS_OF_YEAR)


@query(f"with {_POD_TABLE}, y as (unpivot (select {', '.join(f'year_{y}' for y in _YEARS)} from pods) on * into name year value n) select cast(substr(year, 6) as integer) as year, cast(sum(n) as bigint) as total from y group by all")
def pod_yearly_totals(spark, sf_dir):
    return spatial.yearly_totals(pod_age_by_county(spark, sf_dir))


@query(f"with {EDGES}, {_POD_POINTS}, {_held('pts')} select count(*) as unassigned_pod_count from pts where y between {_YEARS[0]} and {_YEARS[-1]} and uid not in (select uid from held)")
def unassigned_pods(spark, sf_dir):
    return spatial.unassigned_pods(table(spark, sf_dir, "pod_sites"), table(spark, sf_dir, "counties"), AS_OF_YEAR)


# counties by their number's remainder stand for basins, a layer without fips
@query(f"""with {WELLS}, {EDGES}, {_WELL_POINTS}, {_held('pts')}, one as (select uid, min('Basin ' || (county_no % 7)) as basin from held group by uid), n as (select basin, count(*) as c from one group by basin),
b as (select 'Basin ' || (county_no % 7) as basin, round(sum(area_sq_km), 2) as area_sq_km from counties group by 1)
select basin, area_sq_km, coalesce(c, 0) as well_count, case when area_sq_km > 0 then round(coalesce(c, 0) / area_sq_km, 4) end as wells_per_sq_km from b left join n using (basin)""")
def basin_density(spark, sf_dir):
    parts = table(spark, sf_dir, "counties").withColumn("basin", F.concat(F.lit("Basin "), (F.col("county_no") % 7).cast("string")))
    rings = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("county_no", F.regexp_replace("geometry", "^(MULTI)?POLYGON ?", "").alias("g")))), lambda x: x["g"]), ", ")
    basins = parts.groupBy("basin").agg(F.concat(F.lit("MULTIPOLYGON ("), rings, F.lit(")")).alias("geometry"), F.round(F.sum("area_sq_km"), 2).alias("area_sq_km"))
    return spatial.density(table(spark, sf_dir, "sites"), basins, "basin")


@query(f"with {_POD_TABLE} select county_no, county, trend_pods_per_year, total_recent_pods from pods order by trend_pods_per_year desc, total_recent_pods desc, county_no limit 1")
def fastest_growing(spark, sf_dir):
    return spatial.fastest_growing(pod_age_by_county(spark, sf_dir))


@query(f"with {_POD_TABLE} select county_no, county, trend_pods_per_year, total_recent_pods from pods where total_recent_pods > 0 order by trend_pods_per_year desc, county_no limit 1")
def fastest_growing_points(spark, sf_dir):
    return spatial.fastest_growing(pod_age_by_county(spark, sf_dir).where("total_recent_pods > 0"), by_total=False)


@query(f"""with {EDGES}, {_POD_POINTS}, {_held('pts')}, one as (select uid, min(county_no) as county_no from held group by uid)
select uid as pod_uid, source, id, latitude, longitude, y as completion_year, well_completion_date as completion_date, name as county, well_depth, well_depth_units from pts left join (select uid, name from one join counties using (county_no)) using (uid) where y between {_YEARS[0]} and {_YEARS[-1]}""")
def pod_age_points(spark, sf_dir):
    return spatial.completion_points(table(spark, sf_dir, "pod_sites"), table(spark, sf_dir, "counties"), AS_OF_YEAR)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.canonical(correlation.with_pods(table(spark, sf_dir, "sites"), table(spark, sf_dir, "pod_sites")))


@query(f"with {CANON} select a, b from explicit")
def explicit_links(spark, sf_dir):
    return correlation.explicit_links(_canonical(spark, sf_dir)).select("a", "b")


def _rounded_links(rows: DataFrame) -> DataFrame:
    return rows.drop("a_uid", "b_uid").withColumn("distance_m", F.round("distance_m", 3)).withColumn("confidence", F.round("confidence", 3))


@query(f"with {CANON}, {SPATIAL} select a, b, a_source, b_source, round(distance_m, 3) as distance_m, round(confidence, 3) as confidence from spatial")
def spatial_links(spark, sf_dir):
    return _rounded_links(correlation.spatial_links(_canonical(spark, sf_dir)))


@query(f"with {CANON}, {SPATIAL} select a, b, a_source, b_source, round(distance_m, 3) as distance_m, round(confidence, 3) as confidence from spatial join mutual using (a, b)")
def mutual_best(spark, sf_dir):
    return _rounded_links(correlation.mutual_best(correlation.spatial_links(_canonical(spark, sf_dir))))


_WALK = rf"""with recursive {CANON}, {SPATIAL},
links as (select a, b, 1 as e, 0 as s, null::double as best from explicit union all select a, b, 0, 1, confidence from spatial join mutual using (a, b)),
ab as (select a, b from links union select b, a from links),
reach as (select a as node, a as other from ab union select reach.node, ab.b from reach join ab on reach.other = ab.a),
root as (select node, min(other) as root from reach group by node),
per as (select root, max(e) as e, max(s) as s, max(best) as best from links join root on root.node = links.a group by root),
nodes as (select c.*, coalesce(root, site_key) as root, {_NORM('source')} as agency, {_NORM('source')} = 'NMOSEPOD' as is_ose_pod from c left join root on root.node = c.site_key),
groups as (select root, count(*) as cluster_size, count(distinct agency) as n_agencies, 'wc_' || substr(sha1(string_agg(site_key, '|' order by site_key)), 1, 12) as cluster_id, bool_or(is_ose_pod) as has_pod from nodes group by root),
others as (select x.site_key, y.site_key as other, y.agency, y.id, y.is_ose_pod from nodes x join nodes y using (root) where x.site_key <> y.site_key),
listed as (select site_key, string_agg(other, ',' order by other) as linked_site_ids, string_agg(distinct case when is_ose_pod then id end, ',' order by case when is_ose_pod then id end) as pods from others group by site_key),
per_agency as (select site_key, agency, '"' || agency || '": [' || string_agg('"' || id || '"', ', ' order by id) || ']' as part from others group by site_key, agency),
json as (select site_key, '{{' || string_agg(part, ', ' order by agency) || '}}' as linked_by_agency from per_agency group by site_key),
meet as (select m.root, p.id, 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(p.latitude - m.latitude) / 2), 2) + cos(radians(m.latitude)) * cos(radians(p.latitude)) * pow(sin(radians(p.longitude - m.longitude) / 2), 2)))) as m
  from (select * from nodes join groups using (root) where not has_pod and {_OK}) m join (select * from nodes where is_ose_pod and {_OK}) p on p.latitude between m.latitude - 0.0014 and m.latitude + 0.0014),
pod_near as (select root, first(id order by m, id) as near_pod from meet where m <= 150 group by root)
select site_key, source, id, name, well_depth, cluster_id, cluster_size, n_agencies, cluster_size - 1 as n_linked, coalesce(linked_site_ids, '') as linked_site_ids, coalesce(linked_by_agency, '{{}}') as linked_by_agency, coalesce(near_pod, pods, '') as ose_pod_ids,
  case when near_pod is not null then 'spatial' when pods is not null then 'explicit' else 'none' end as ose_pod_link_method, case when cluster_size = 1 then 'unmatched' when e = 1 and s = 1 then 'mixed' when e = 1 then 'explicit' else 'spatial' end as match_method,
  case when cluster_size = 1 then 0.0 when e = 1 then 0.95 else round(best, 3) end::double as match_confidence, is_ose_pod
from nodes join groups using (root) left join per using (root) left join listed using (site_key) left join json using (site_key) left join pod_near using (root)"""


@query(_WALK)
def well_correlation(spark, sf_dir):
    return correlation.crosswalk(table(spark, sf_dir, "sites"), table(spark, sf_dir, "pod_sites"))


@query("""with s as (select site_uid, latitude as la, longitude as lo from sites where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180),
p as (select pod_uid, latitude as la, longitude as lo from pod_sites where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0 and abs(latitude) <= 90 and abs(longitude) <= 180),
d as (select site_uid, pod_uid, 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(p.la - s.la) / 2), 2) + cos(radians(s.la)) * cos(radians(p.la)) * pow(sin(radians(p.lo - s.lo) / 2), 2)))) as m from s join p on p.la between s.la - 0.0014 and s.la + 0.0014)
select site_uid, first(pod_uid order by m, pod_uid) as pod_uid, round(min(m), 3) as distance_m from d where m <= 150 group by site_uid""")
def pod_nearest(spark, sf_dir):
    return correlation.nearest_pods(table(spark, sf_dir, "sites"), table(spark, sf_dir, "pod_sites"))


# --- landed rows to products as one plan ---------------------------------------------------------

_UNIFIED = f"""{WELLS},
u as (select *, lower(trim(parameter_name)) as p, lower(trim(source_parameter_units)) as un, lower(trim(source_parameter_name)) as sn, trim(value_text) as vt, split_part(trim(date_measured), '.', 1) as t,
  case when parameter_name = 'waterlevels' then 'ft' when parameter_name in ('conductivity', 'specific_conductance') then 'uS/cm' when parameter_name = 'ph' then '' else 'mg/L' end as units from lab_results),
f as (select *, case when regexp_matches(value_text, '^\\s*[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?\\s*$') then try_cast(vt as double) end as number,
  case when p = 'ph' then 1.0 when p in ('conductivity', 'specific_conductance') then case when un in ('μmhos/cm', 'umho/cm', 'cm-1', 'micromhos per centimeter', 'mg/l', 'su', 'us/cm', 'us/cm @25c', 'µs/cm', 'μs/cm') then 1.0 end
  when units = 'mg/L' then case when un in ('mg/l caco3', 'mg/l caco3**') then case p when 'bicarbonate' then 1.22 when 'calcium' then 0.4 when 'carbonate' then 0.6 end
    when un = 'mg/l as n' then 4.427 when un in ('mg/l asno3', 'mg/l as no3') then 1.0 when un = 'ug/l as n' then 0.004427 when un = 'pci/l' then 0.00149 when un in ('ug/l', 'ppb') then 0.001
    when un = 'tons/ac ft' then 735.47 when un = 'ppm' then 1.0 when un = 'mg/l' then case when sn in ('nitrate as n', 'nitrate (as n)') then 4.427 else 1.0 end end
  when units = 'ft' then case when un in ('m', 'meters') then 3.28084 when un in ('ft', 'feet') then 1.0 end end::double as factor,
  case when regexp_full_match(t, '[-+]?[0-9]{{1,6}}') then cast(cast(date '1900-01-01' + cast(t as integer) as date) as varchar)
  when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([T ][0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}}(Z|\\+00:00)?)?)?') then cast(try_cast(substr(t, 1, 10) as date) as varchar)
  when regexp_full_match(t, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}( [0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}})?)?') then cast(try_cast(replace(substr(t, 1, 10), '/', '-') as date) as varchar)
  when regexp_full_match(t, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') then cast(try_strptime(t, '%m/%d/%Y')::date as varchar)
  when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}') then t end as day,
  case when regexp_matches(t, '[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') and substr(t, 12, 8) <> '00:00:00' then substr(t, 12, 8) else coalesce(strftime(try_strptime(trim(time_measured), ['%H:%M:%S', '%H:%M']), '%H:%M:%S'), '00:00:00') end as clock from u),
g as (select *, coalesce(number, case when regexp_matches(lower(vt), 'nd|not detected|< mrl|< mdl|<mrl|<mdl') then 0.0 end) as coerced from f),
j as (select g.*, w.site_uid, coalesce(w.latitude is not null and w.longitude is not null and w.latitude <> 0 and w.longitude <> 0 and abs(w.latitude) <= 90 and abs(w.longitude) <= 180 and upper(trim(coalesce(w.horizontal_datum, 'WGS84'))) in ('NAD27', 'NAD83', 'WGS84'), false) as placed
  from g left join wells w on w.source_key = g.source and w.id = g.id),
r as (select *, case when value_text is null or vt = '' or vt = '-999999' then 'no value' when date_measured is null or trim(date_measured) = '' then 'no date' when coerced is null then 'unreadable value' when factor is null then 'unknown unit' when day is null then 'unreadable date'
  when site_uid is null then 'unknown well' when not placed then 'unusable coordinates' end as reason from j)"""


def _unified(spark: SparkSession, sf_dir: str) -> unify.Unified:
    return unify.unify(table(spark, sf_dir, "lab_results").drop("parameter_value", "parameter_units"), table(spark, sf_dir, "sites"))


@query(f"""with {_UNIFIED}, k as (select *, coerced * factor as value, number is not null as detected from r where reason is null),
s as (select source, id, parameter_name, min(site_uid) as site_uid, count(*) filter (where detected) as nrecords, min(value) filter (where detected) as min, max(value) filter (where detected) as max, {_hu('avg(value) filter (where detected)', 1000000.0)} as mean,
  first({{'d': day, 't': clock, 'v': value, 'u': units}} order by day, clock, value, value_text) as e, last({{'d': day, 't': clock, 'v': value, 'u': units}} order by day, clock, value, value_text) as l from k group by all)
select source, id, parameter_name, site_uid, nrecords, min, max, mean, e.d as earliest_date, e.t as earliest_time, e.v as earliest_value, e.u as earliest_units, l.d as latest_date, l.t as latest_time, l.v as latest_value, l.u as latest_units from s where nrecords > 0""")
def raw_to_summary(spark, sf_dir):
    return unify.summaries(_unified(spark, sf_dir).kept)


@query(f"with {_UNIFIED} select reason, source, count(*) as n from r where reason is not null group by all")
def raw_rejected(spark, sf_dir):
    return _unified(spark, sf_dir).rejected.groupBy("reason", "source").agg(F.count(F.lit(1)).alias("n"))
