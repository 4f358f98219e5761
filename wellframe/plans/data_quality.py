"""Queries over the landed tables: spikes, neighbours, regular grids and units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import nearby, regular_grid, spikes, unit_repair
from ..session import table
from .reference import _SITE_POINTS, EDGES, READINGS, _held, _hu


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that leave their series, are stuck or cannot occur."""
    return spikes.found(table(spark, sf_dir, "observations"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites within 150 m of one another, and the county of each site."""
    return nearby.found(table(spark, sf_dir, "sites"), table(spark, sf_dir, "counties"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods without reading inside the recorder series."""
    return regular_grid.missing_periods(table(spark, sf_dir, "observations"), table(spark, sf_dir, "sensor_streams"))


def p5_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regular series themselves, to six digits."""
    grid = regular_grid.regular_grid(table(spark, sf_dir, "observations"), table(spark, sf_dir, "sensor_streams"))
    return grid.withColumn("value", C.half_up(F.col("value"), 6))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lab results that state a unit other than the common one."""
    return unit_repair.found(table(spark, sf_dir, "lab_results"), table(spark, sf_dir, "unit_names"))


def p7_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lab result in its parameter's common unit."""
    return unit_repair.common_units(table(spark, sf_dir, "lab_results"), table(spark, sf_dir, "unit_names"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p5_found": p5_found, "p5_grid": p5_grid, "p7_found": p7_found, "p7_common": p7_common}
ORACLES: dict[str, str] = {
    "p2_found": f"""with {EDGES}, {_SITE_POINTS}, {_held("pts")},
d as (select p.uid as a, q.uid as b, 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(q.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude)) * cos(radians(q.latitude)) * pow(sin(radians(q.longitude - p.longitude) / 2), 2)))) as m
  from pts p join pts q on q.latitude between p.latitude - 0.00135 and p.latitude + 0.00135 and p.uid < q.uid)
select 'site' as kind, a as site_uid, b as other_key from d where m <= 150 union all select 'county', uid, county_no from held""",
    "p5_found": f"""with {READINGS},
r as (select distinct stream_id, step_minutes * 60 as st, cast(floor(ts / (step_minutes * 60)) as bigint) as p from rd join sensor_streams using (source, id, parameter_name)),
n as (select *, lead(p) over (partition by stream_id order by p) as q from r)
select stream_id, strftime(make_timestamp(x * st * 1000000), '%Y-%m-%dT%H:%M:%SZ') as period_start from (select stream_id, st, unnest(range(p + 1, q)) as x from n where q > p + 1)""",
    "p5_grid": f"""with {READINGS},
r as (select stream_id, step_minutes * 60 as st, cast(floor(ts / (step_minutes * 60)) as bigint) as p, avg(value) as v from rd join sensor_streams using (source, id, parameter_name) group by all),
n as (select *, lead(p) over w as q, lead(v) over w as nv, lag(p) over w as pp, lag(v) over w as pv from r window w as (partition by stream_id order by p)),
h as (select *, coalesce(q - p <= 13, false) as onward, coalesce(p - pp <= 13, false) as back, (q - p)::double as hr, (p - pp)::double as hl, (nv - v) / (q - p) as dr, (v - pv) / (p - pp) as dl from n),
s as (select *, case when onward and back then case when dl * dr > 0 then (3 * hr + 3 * hl) / ((2 * hr + hl) / dl + (hr + 2 * hl) / dr) else 0.0 end when back then dl when onward then dr else 0.0 end as m from h),
e as (select *, lead(m) over (partition by stream_id order by p) as nm, unnest(range(0, coalesce(q, p + 1) - p)) as k from s),
u as (select *, k / hr as u from e)
select stream_id, strftime(make_timestamp((p + k) * st * 1000000), '%Y-%m-%dT%H:%M:%SZ') as period_start, case when k = 0 then 'observed' when hr <= 13 then 'filled' else 'gap' end as status,
  {_hu("case when k = 0 then v when hr <= 13 then (1 + 2 * u) * (1 - u) * (1 - u) * v + u * (1 - u) * (1 - u) * hr * m + u * u * (3 - 2 * u) * nv + u * u * (u - 1) * hr * nm end", 1000000.0)} as value from u""",
}
