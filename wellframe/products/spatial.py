"""Counts and dates of wells per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.nearby import containing_regions, usable_point
from ..operators.silver import wells


def _placed(points: DataFrame, regions: DataFrame, key: str = "county_no") -> DataFrame:
    """uid -> the region's key, the first region that covers the point; boundaries belong to a region."""
    held = containing_regions(points, "uid", "latitude", "longitude", regions, key, "geometry", boundary=True)
    return held.groupBy(F.col("point_key").alias("uid")).agg(F.min("region_key").alias(key))


def _points(sites: DataFrame) -> DataFrame:
    one = wells(sites).where(usable_point(F.col("latitude"), F.col("longitude")))
    return one.withColumn("uid", F.col("site_uid"))


def density(sites: DataFrame, regions: DataFrame, key: str = "county_no") -> DataFrame:
    """The regions with wells per region and square kilometre, empty regions with 0.

    ``regions`` is any layer with ``key``, geometry (WKT) and area_sq_km (null or 0: no density); its other
    columns are kept.
    """
    counts = _placed(_points(sites), regions, key).groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    n = F.coalesce("_c", F.lit(0))
    kept = [c for c in regions.columns if c != "geometry"]
    return regions.select(*kept).join(counts, key, "left").select(*kept, n.alias("well_count"), F.when(F.col("area_sq_km") > 0, F.round(n / F.col("area_sq_km"), 4)).alias("wells_per_sq_km"))


def unassigned(sites: DataFrame, regions: DataFrame) -> DataFrame:
    points = _points(sites)
    return points.join(_placed(points, regions), "uid", "left_anti").agg(F.count(F.lit(1)).alias("unassigned_well_count"))


def first_pods(pods: DataFrame) -> DataFrame:
    held = ["pod_uid", "latitude", "longitude", "well_completion_date", "well_depth", "well_depth_units"]
    first = pods.where("id is not null").groupBy("source", F.col("id").alias("pod_id")).agg(F.min_by(F.struct(*held), "pod_uid").alias("s")).select("source", F.col("pod_id").alias("id"), "s.*")
    year = F.substring("well_completion_date", 1, 4).try_cast("int").alias("year")
    rows = first.withColumnRenamed("pod_uid", "uid").select("source", "id", "uid", "latitude", "longitude", "well_completion_date", "well_depth", "well_depth_units", year)
    return rows.where(usable_point(F.col("latitude"), F.col("longitude")))


def completions_by_region(pods: DataFrame, regions: DataFrame, as_of_year: int, years_back: int = 10) -> DataFrame:
    """Completed points per region and trailing year, with total, slope a year, peak year and the latest year's count."""
    years = list(range(as_of_year - years_back + 1, as_of_year + 1))
    points = first_pods(pods).where(F.col("year").between(years[0], years[-1]))
    found = points.join(_placed(points, regions), "uid")
    bins = found.groupBy("county_no").agg(*[F.sum((F.col("year") == y).cast("long")).alias(f"_{y}") for y in years])
    n = lambda y: F.coalesce(F.col(f"_{y}"), F.lit(0).cast("long"))
    mean = (len(years) - 1) / 2
    slope = sum(((i - mean) * n(y) for i, y in enumerate(years)), F.lit(0.0)) / sum((i - mean) ** 2 for i in range(len(years)))
    most = F.greatest(*[n(y) for y in years])
    peak = F.coalesce(*[F.when((n(y) == most) & (most > 0), y) for y in years])
    total = sum((n(y) for y in years), F.lit(0).cast("long"))
    return regions.select("county_no", F.col("name").alias("county"), "fips", "area_sq_km").join(bins, "county_no", "left").select(
        "county_no", "county", "fips", "area_sq_km", total.alias("total_recent_pods"), *[n(y).alias(f"year_{y}") for y in years], C.half_up(slope, 3).alias("trend_pods_per_year"), peak.alias("peak_year"), n(years[-1]).alias("latest_year_count")
    )


def yearly_totals(by_region: DataFrame) -> DataFrame:
    """(year, total) over all regions."""
    years = [c for c in by_region.columns if c.startswith("year_")]
    row = by_region.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in years])
    return row.select(F.explode(F.array(*[F.struct(F.lit(int(c[5:])).alias("year"), F.col(c).alias("total")) for c in years])).alias("t")).select("t.*")


def unassigned_pods(pods: DataFrame, regions: DataFrame, as_of_year: int, years_back: int = 10) -> DataFrame:
    """How many recently completed points no region covers."""
    points = first_pods(pods).where(F.col("year").between(as_of_year - years_back + 1, as_of_year))
    return points.join(_placed(points, regions), "uid", "left_anti").agg(F.count(F.lit(1)).alias("unassigned_pod_count"))


def fastest_growing(by_region: DataFrame, by_total: bool = True) -> DataFrame:
    """The region with the steepest slope, then (``by_total``) the larger total, then the smaller number."""
    rank = F.struct("trend_pods_per_year", *(["total_recent_pods"] if by_total else []), -F.col("county_no"))
    return by_region.agg(F.max_by(F.struct("county_no", "county", "trend_pods_per_year", "total_recent_pods"), rank).alias("b")).select("b.*")


def completion_points(pods: DataFrame, regions: DataFrame, as_of_year: int, years_back: int = 10) -> DataFrame:
    """Recently completed points with the region they lie in, if any."""
    points = first_pods(pods).where(F.col("year").between(as_of_year - years_back + 1, as_of_year))
    named = _placed(points, regions).join(regions.select("county_no", F.col("name").alias("county")), "county_no")
    return points.join(named.select("uid", "county"), "uid", "left").select(
        F.col("uid").alias("pod_uid"), "source", "id", "latitude", "longitude", F.col("year").alias("completion_year"), F.col("well_completion_date").alias("completion_date"), "county", "well_depth", "well_depth_units"
    )
