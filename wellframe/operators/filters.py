"""Row filters over sites, readings and lab results. Null comparisons never keep a row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import inside, outline_distance_m, parse_wkt
from .nearby import containing_regions, usable_point

DATUMS = ["NAD27", "NAD83", "WGS84"]


def in_box(df: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Strictly inside; the comparisons reach the Parquet scan."""
    return df.where((F.col("longitude") > west) & (F.col("longitude") < east) & (F.col("latitude") > south) & (F.col("latitude") < north))


def sane_coordinates(df: DataFrame, datum: bool = False) -> DataFrame:
    """Neither null, 0 nor off the globe; with ``datum`` also of a known datum, null meaning WGS84."""
    kept = df.where(usable_point(F.col("latitude"), F.col("longitude")))
    return kept.where(F.upper(F.trim(F.coalesce("horizontal_datum", F.lit("WGS84")))).isin(*DATUMS)) if datum else kept


def in_area(df: DataFrame, key: str, regions: DataFrame, wkt: str = "geometry", boundary: bool = False) -> DataFrame:
    """Points inside one of the regions (WKT), by default strictly; rows without a key or usable coordinates drop out."""
    held = containing_regions(df.where(F.col(key).isNotNull()), key, "latitude", "longitude", regions.select(F.monotonically_increasing_id().alias("_area"), F.col(wkt).alias("_wkt")), "_area", "_wkt", boundary)
    return df.join(held.select(F.col("point_key").alias(key)).distinct(), key, "left_semi")


def near_area(df: DataFrame, key: str, regions: DataFrame, metres: float, wkt: str = "geometry", most_regions: int = 1_000) -> DataFrame:
    """Points inside one of the regions or at most ``metres`` from its outline (a state with its buffer).

    Distances are taken on a plane around the point (longitudes shortened by the latitude), which for buffers
    of some kilometres errs by less than a thousandth. At most ``most_regions`` outlines go to every task (checked).
    """
    rows = regions.select(wkt).limit(most_regions + 1).collect()
    if len(rows) > most_regions:
        raise ValueError(f"more than {most_regions} regions")
    shapes = df.sparkSession.sparkContext.broadcast([parse_wkt(None, r[0]) for r in rows])
    held = df.where(F.col(key).isNotNull() & usable_point(F.col("latitude"), F.col("longitude"))).select(F.col(key).alias("_key"), F.col("longitude").cast("double").alias("x"), F.col("latitude").cast("double").alias("y"))

    def run(batches):
        for batch in batches:
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            hit = np.zeros(len(x), bool)
            for shape in shapes.value:
                hit |= inside(shape, x, y) | (outline_distance_m(shape, x, y, metres) <= metres)
            yield batch.select(["_key"]).filter(pa.array(hit))

    near = held.mapInArrow(run, f"_key {df.schema[key].dataType.simpleString()}")
    return df.join(near.withColumnRenamed("_key", key).distinct(), key, "left_semi")


def between_days(rows: DataFrame, first: str, last: str) -> DataFrame:
    return rows.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def sources(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    kept = df.where(F.col("source").isin(*include)) if include else df
    return kept.where(~F.col("source").isin(*exclude)) if exclude else kept


def clean_results(results: DataFrame) -> DataFrame:
    """With a value as received that is neither blank nor the sentinel, and a date."""
    v = F.trim("value_text")
    return results.where(F.col("value_text").isNotNull() & (v != "") & (v != "-999999") & F.col("date_measured").isNotNull())


def first_sites_with_readings(wells: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` wells, by key, that have a reading."""
    seen = rows.select(F.col("source").alias("source_key"), "id")
    return wells.join(seen, ["source_key", "id"], "left_semi").orderBy("site_uid").limit(n)
