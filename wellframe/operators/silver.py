"""Canonical readings and sites from the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.datetimes import epoch_seconds, full_date, iso_utc


def readings(observations: DataFrame, more: list[str] = ()) -> DataFrame:
    """obs_id, source, id, parameter_name, value, units, ts (UTC seconds), day; without null, NaN or undated rows.

    Rows delivered again keep their row; order within a series is (ts, obs_id).
    """
    day = full_date(F.col("date_measured"))
    return observations.where(F.col("parameter_value").isNotNull() & ~F.isnan("parameter_value") & day.isNotNull()).select(
        "obs_id", "source", "id", "parameter_name", F.col("parameter_value").alias("value"), F.col("parameter_units").alias("units"),
        epoch_seconds(F.col("date_measured"), F.col("time_measured")).alias("ts"), day.alias("day"), *more,
    )


def wells(sites: DataFrame) -> DataFrame:
    """One row per (source key, id): the first delivered, coordinates on no condition."""
    rows = sites.where("source is not null and id is not null").withColumn("source_key", C.source_key(F.col("source")))
    cols = [c for c in rows.columns if c != "source_key"]
    first = rows.groupBy("source_key", F.col("id").alias("well_id")).agg(F.min_by(F.struct(*cols), F.col("site_uid")).alias("s"))
    return first.select("source_key", "s.*")


#: What an observation carries besides its value.
OBSERVED = ["date_measured", "time_measured", "source_parameter_name", "source_parameter_units", "conversion_factor", "approval_status", "qualifier"]


def flat_series(observations: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per dated reading with everything it carries, its time, its feature's id and its well's place (null for unknown wells)."""
    place = wells(sites).select(F.col("source_key").alias("source"), "id", "latitude", "longitude")
    fid = F.concat(C.feature_id(F.col("source"), F.col("id")), F.lit(":"), F.col("day").cast("string"))
    rows = readings(observations, OBSERVED).withColumns({"datetime": iso_utc(F.col("ts")), "feature_id": fid}).withColumnsRenamed({"value": "parameter_value", "units": "parameter_units"})
    return rows.drop("ts", "day").join(place, ["source", "id"], "left")


def with_well(product: DataFrame, sites: DataFrame) -> DataFrame:
    """A product by (source, id) with the well's name and depth; wells not in ``sites`` keep their row."""
    named = wells(sites).select(F.col("source_key").alias("source"), "id", "name", "well_depth", "well_depth_units")
    return product.join(named, ["source", "id"], "left")


def daily(rows: DataFrame, reducer: str = "mean") -> DataFrame:
    """One value per series and UTC day (min, mean or max) and the day's number of readings."""
    fold = {"min": F.min, "mean": F.avg, "max": F.max}[reducer]
    return rows.groupBy("source", "id", "parameter_name", "day").agg(fold("value").alias("value"), F.count(F.lit(1)).alias("n"))


def summaries(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Count, extremes, mean, earliest and latest reading per series with the well's attributes; wells without a row in ``sites`` give none."""
    at = F.struct("ts", "obs_id")
    stats = rows.groupBy("source", "id", "parameter_name").agg(
        F.count(F.lit(1)).alias("nrecords"), F.min("value").alias("min"), F.max("value").alias("max"), C.half_up(F.avg("value"), 6).alias("mean"),
        F.min_by(F.struct("value", "units", "ts"), at).alias("e"), F.max_by(F.struct("value", "units", "ts"), at).alias("l"),
    )

    def end(name: str, c: str) -> list:
        iso = iso_utc(F.col(f"{c}.ts"))
        return [F.substring(iso, 1, 10).alias(f"{name}_date"), F.substring(iso, 12, 8).alias(f"{name}_time"), F.col(f"{c}.value").alias(f"{name}_value"), F.col(f"{c}.units").alias(f"{name}_units")]

    out = stats.select("source", "id", "parameter_name", F.col("l.units").alias("parameter_units"), "nrecords", "min", "max", "mean", *end("earliest", "e"), *end("latest", "l"))
    attributes = ["name", "usgs_site_id", "alternate_site_id", "latitude", "longitude", "horizontal_datum", "elevation", "elevation_units", "well_depth", "well_depth_units"]
    named = wells(sites).select(F.col("source_key").alias("source"), "id", *attributes)
    tds = F.when(F.col("parameter_name") == "tds", C.tds_class(F.col("latest_value")))
    return out.join(named, ["source", "id"]).withColumn("tds_class", tds)


def latest_by_well(rows: DataFrame, analytes: list[str], units: bool = False) -> DataFrame:
    """One row per well: each analyte's latest value, day and, on request, units, in one pass and without a pivot."""
    kept = rows.where(F.col("parameter_name").isin(*analytes))
    pick = lambda a, c: F.when(F.col("parameter_name") == a, c)
    aggs = [F.max_by(pick(a, F.struct("value", *(["units"] if units else []), "day")), pick(a, F.struct("ts", "obs_id"))).alias(f"_{a}") for a in analytes]
    wide = kept.groupBy("source", "id").agg(*aggs)
    return wide.select("source", "id", *[x for a in analytes for x in (F.col(f"_{a}.value").alias(a), *([F.col(f"_{a}.units").alias(f"{a}_units")] if units else []), F.col(f"_{a}.day").cast("string").alias(f"{a}_date"))])
