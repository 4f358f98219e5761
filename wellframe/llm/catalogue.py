"""Registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import components, encoding, leakage, linkage, percentiles, residue

#: The public byte-level vocabulary; it stays outside the repository.
VOCABULARY = os.environ.get("WELLFRAME_BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.json")
PERCENTS = [1, 5, 25, 50, 75, 95, 99]


def p3_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the readings per parameter."""
    return percentiles.percentiles(table(spark, sf_dir, "observations"), ["parameter_name"], "parameter_value", PERCENTS)


def p3_parameter_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the readings per parameter and source."""
    return percentiles.percentiles(table(spark, sf_dir, "observations"), ["parameter_name", "source"], "parameter_value", PERCENTS)


def p3_summary_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the summaries' means per parameter."""
    return percentiles.percentiles(table(spark, sf_dir, "summaries"), ["parameter_name"], "mean", PERCENTS)


def p3_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per parameter from the histograms of single days, with their error bound."""
    days = percentiles.histogram(table(spark, sf_dir, "observations"), ["parameter_name"], "parameter_value", [F.to_date("received_at")])
    return percentiles.histogram_percentiles(percentiles.merge(days, ["parameter_name"]), ["parameter_name"], PERCENTS)


def p3_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the summaries' means from the histograms of single runs, with their error bound."""
    runs = percentiles.histogram(table(spark, sf_dir, "summaries"), ["parameter_name"], "mean", [F.col("run_id")])
    return percentiles.histogram_percentiles(percentiles.merge(runs, ["parameter_name"]), ["parameter_name"], PERCENTS)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every site row that is linked with another."""
    return components.site_groups(table(spark, sf_dir, "sites"))


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching wells of the two site tables with their confidence."""
    return linkage.match(table(spark, sf_dir, "sites"), table(spark, sf_dir, "pod_sites"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that describe the same well."""
    return p6_matches(spark, sf_dir).select("site_uid", "pod_uid")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.encode(table(spark, sf_dir, "documents"), VOCABULARY)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items they share 13 consecutive words with."""
    return leakage.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with their alignment, edited copies included."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with leftovers in place of content, and of what kind."""
    return residue.residue(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with leftovers in place of content."""
    return p10_reasons(spark, sf_dir).select("doc_id")


QUERIES = {
    "p3_parameter": p3_parameter,
    "p3_parameter_source": p3_parameter_source,
    "p3_summary_mean": p3_summary_mean,
    "p3_days": p3_days,
    "p3_runs": p3_runs,
    "p4_found": p4_found,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_leaks": p9_leaks,
    "p10_found": p10_found,
    "p10_reasons": p10_reasons,
}


def _percentile_sql(source: str, value: str, groups: list[str]) -> str:
    cols = ", ".join(groups)
    cells = ", ".join(f"max(case when r = greatest(1, (n * {p} + 99) // 100) then v end) as p{p:02d}" for p in PERCENTS)
    return (
        f"with x as (select {cols}, {value} as v, row_number() over (partition by {cols} order by {value}) as r, count(*) over (partition by {cols}) as n "
        f"from {source} where {value} is not null and not isnan({value})) select {cols}, n, {cells} from x group by {cols}, n"
    )


def _bucket_sql(source: str, value: str, groups: list[str]) -> str:
    """The exact percentile, and the bucket of 10 fraction bits that holds it."""
    cols = ", ".join(groups)
    return (
        f"with x as (select {cols}, {value} as v, row_number() over (partition by {cols} order by {value}) as r, count(*) over (partition by {cols}) as n "
        f"from {source} where {value} is not null and not isnan({value})), p as (select unnest({PERCENTS}) as percent), "
        f"t as (select {cols}, cast(percent as integer) as percent, n, v, abs(v) as a from x, p where r = greatest(1, (n * percent + 99) // 100)), "
        "e as (select *, case when a = 0 then 0 when a / pow(2.0, floor(log2(a))) >= 2 then floor(log2(a)) + 1 when a / pow(2.0, floor(log2(a))) < 1 then floor(log2(a)) - 1 else floor(log2(a)) end as e from t), "
        "m as (select *, pow(2.0, e) / 1024 as w, pow(2.0, e - 52) as u, case when v < 0 then ceil(a / pow(2.0, e) * 1024) else floor(a / pow(2.0, e) * 1024) end / 1024 * pow(2.0, e) as s from e), "
        "b as (select *, case when v = 0 then 0.0 when v > 0 then s else -s end as lower, case when v = 0 then 4398046511103 * pow(2.0, -537) * pow(2.0, -537) when v > 0 then s + (w - u) else -(s - (w - u)) end as upper from m) "
        f"select {cols}, percent, n, lower, upper, (lower + upper) / 2 as value, (upper - lower) / 2 as error from b"
    )


P4_SQL = r"""
with recursive s as (select site_uid, id, usgs_site_id, source, regexp_replace(upper(trim(alternate_site_id)), '(^|[,;|/\s]|USGS[-:]|NWIS[-:])(\d{6}) (\d{9})($|[,;|/\s])', '\1\2\3\4', 'g') as alt from sites),
raw as (
  select site_uid, id as k, false as ref, true as known, '' as src from s
  union all select site_uid, usgs_site_id, true, true, '' from s
  union all select site_uid, unnest(regexp_split_to_array(alt, '[,;|/\s]+')), true, false, '' from s
  union all select site_uid, id, true, true, upper(trim(source)) || chr(1) from s where source is not null),
named as (select site_uid, ref, known, src, trim(regexp_replace(regexp_replace(upper(trim(k)), '^((USGS|NWIS)[-:])?(\d{6}) (\d{9})$', '\3\4'), '^(USGS|NWIS)[-:]', '')) as k from raw),
roles as (select site_uid, ref, known, src || k as k from named where regexp_matches(k, '[1-9]')),
keys as (select k, min(site_uid) as least from roles group by k having bool_or(ref) and bool_or(known) and min(site_uid) < max(site_uid)),
e as (select distinct least as a, site_uid as b from roles join keys using (k) where site_uid <> least),
b as (select a, b from e union select b, a from e),
reach as (select distinct a as site_uid, a as other from b union select reach.site_uid, b.b from reach join b on reach.other = b.a)
select site_uid, min(other) as group_uid from reach group by site_uid
"""

P9_SQL = r"""
with w as (select 'd' as kind, doc_id as id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from documents union all select 'i', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from eval_items),
g as (select distinct kind, id, array_to_string(words[n : n + 12], ' ') as run from (select kind, id, words, unnest(range(1, len(words) - 11)) as n from w where len(words) >= 13))
select distinct d.id as doc_id, i.id as item_id from g d join g i using (run) where d.kind = 'd' and i.kind = 'i'
"""

ORACLES = {
    "p3_parameter": _percentile_sql("observations", "parameter_value", ["parameter_name"]),
    "p3_parameter_source": _percentile_sql("observations", "parameter_value", ["parameter_name", "source"]),
    "p3_summary_mean": _percentile_sql("summaries", "mean", ["parameter_name"]),
    "p3_days": _bucket_sql("observations", "parameter_value", ["parameter_name"]),
    "p3_runs": _bucket_sql("summaries", "mean", ["parameter_name"]),
    "p4_found": P4_SQL,
    "p9_found": P9_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
