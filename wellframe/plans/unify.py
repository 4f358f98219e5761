"""From landed provider rows to readings, summaries and products as one plan.

Each row passes: clean filters, value, units, date, its well, the well's coordinates and bounds. The first
thing a row fails is its reason; rejected rows are a table of their own, not an exception.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.datetimes import iso_utc
from ..operators import silver
from ..operators.filters import DATUMS
from ..operators.nearby import containing_regions, usable_point
from ..sources import providers
from .catalog import Request

NEEDED = ["source", "id", "parameter_name", "value_text", "source_parameter_units", "date_measured", "time_measured"]


def output_units(parameter: Column) -> Column:
    """The unit a parameter is brought to."""
    return F.when(parameter == "waterlevels", "ft").when(parameter.isin("conductivity", "specific_conductance"), "uS/cm").when(parameter == "ph", "").otherwise("mg/L")


@dataclass
class Unified:
    """Readings with their values converted and their wells' attributes, and the rows that dropped out with their reason."""

    kept: DataFrame
    rejected: DataFrame


def unify(rows: DataFrame, sites: DataFrame, request: Request = Request(), area: DataFrame | None = None) -> Unified:
    """Canonical raw readings (``sources.providers.readings``) of wells into readings.

    Columns of ``kept``: those of the rows plus value, units, conversion_factor, detected (false where the text
    says not detected; such rows have value 0 and count only as earliest or latest), day, time, ts, site_uid and
    WGS84 coordinates. ``area`` (geometry as WKT) keeps wells inside one of its regions. Rows lacking a needed
    column raise ValueError; nulls in them do not. A well is the first row of its source and id.
    """
    lacking = providers.missing_columns(rows, NEEDED)
    if lacking:
        raise ValueError(f"rows lack {', '.join(lacking)}")
    request.validate()
    for names, keep in ((request.include, True), (request.exclude, False)):
        if names:
            rows = rows.where(F.col("source").isin(*names) if keep else ~F.col("source").isin(*names))
    if request.parameter:
        rows = rows.where(F.col("parameter_name") == request.parameter)
    wells = silver.wells(sites)
    lon, lat = C.to_wgs84(F.col("longitude"), F.col("latitude"), F.coalesce("horizontal_datum", F.lit("")))
    datum = F.upper(F.trim(F.coalesce("horizontal_datum", F.lit("WGS84"))))
    placed = usable_point(F.col("latitude"), F.col("longitude")) & datum.isin(*DATUMS)
    wells = wells.select(F.col("source_key").alias("_s"), F.col("id").alias("_i"), "site_uid", F.when(placed, lon).alias("lon84"), F.when(placed, lat).alias("lat84"), placed.alias("_placed"))
    inside = F.lit(True)
    if request.bbox:
        from .catalog import parse_box

        west, south, east, north = parse_box(request.bbox)
        inside = (F.col("lon84") > west) & (F.col("lon84") < east) & (F.col("lat84") > south) & (F.col("lat84") < north)
    if request.wkt is not None:
        area = rows.sparkSession.createDataFrame([(request.wkt,)], "geometry string")
    if area is not None:
        held = containing_regions(wells, "site_uid", "lat84", "lon84", area.withColumn("_area", F.monotonically_increasing_id()), "_area", "geometry", boundary=False).select(F.col("point_key").alias("site_uid")).distinct()
        wells = wells.join(held.withColumn("_held", F.lit(True)), "site_uid", "left")
        inside = inside & F.coalesce("_held", F.lit(False))
    wells = wells.withColumn("_inside", inside)
    text = F.trim("value_text")
    number = C.number(F.col("value_text"))
    units = output_units(F.col("parameter_name"))
    source_name = F.col("source_parameter_name") if "source_parameter_name" in rows.columns else F.lit(None).cast("string")
    factor = C.conversion_factor(F.col("parameter_name"), F.col("source_parameter_units"), units, source_name).cast("double")
    ready = rows.withColumns({"_number": number, "_coerced": C.coerce_value(F.col("value_text")), "conversion_factor": factor, "day": C.standard_date(F.col("date_measured")), "units": units})
    own_time = C.standard_time(F.col("date_measured"))
    clock = F.when(own_time != "", own_time).otherwise(F.coalesce(F.date_format(F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.trim("time_measured"))), "HH:mm:ss"), F.lit("00:00:00")))
    ready = ready.withColumn("time", clock).withColumn("ts", F.when(F.length("day") == 10, F.unix_date(F.col("day").try_cast("date")).cast("long") * 86400 + F.substring("time", 1, 2).cast("long") * 3600 + F.substring("time", 4, 2).cast("long") * 60 + F.substring("time", 7, 2).cast("long")))
    met = ready.join(wells, (ready["source"] == F.col("_s")) & (ready["id"] == F.col("_i")), "left")
    day = F.col("day")
    reason = (
        F.when(F.col("value_text").isNull() | (text == "") | (text == "-999999"), "no value").when(F.col("date_measured").isNull() | (F.trim("date_measured") == ""), "no date")
        .when(F.col("_coerced").isNull(), "unreadable value").when(F.col("conversion_factor").isNull(), "unknown unit").when(day.isNull(), "unreadable date")
        .when((day < request.start) if request.start else F.lit(False), "before the range").when((F.substring(day, 1, len(request.end or "")) > request.end) if request.end else F.lit(False), "after the range")
        .when(F.col("site_uid").isNull(), "unknown well").when(~F.col("_placed"), "unusable coordinates").when(~F.col("_inside"), "out of bounds")
    )
    met = met.withColumn("reason", reason)
    kept = met.where("reason is null").withColumns({"value": F.col("_coerced") * F.col("conversion_factor"), "detected": F.col("_number").isNotNull()})
    inner = ["_number", "_coerced", "_s", "_i", "_placed", "_inside", *(["_held"] if area is not None else [])]
    return Unified(kept.drop("reason", *inner), met.where("reason is not null").select(*rows.columns, "reason"))


def summaries(kept: DataFrame) -> DataFrame:
    """Per well and parameter: count, extremes and mean of the detected values; earliest and latest of all rows, those not detected as 0.

    Series without a detected value give no row. Rows are ordered by day and time, then by value and text, so
    that their order in files does not matter.
    """
    at = F.struct("day", "time", "value", "value_text")
    seen = F.when(F.col("detected"), F.col("value"))
    end = F.struct("day", "time", "value", "units")
    stats = kept.groupBy("source", "id", "parameter_name").agg(
        F.count(seen).alias("nrecords"), F.min(seen).alias("min"), F.max(seen).alias("max"), C.half_up(F.avg(seen), 6).alias("mean"), F.min_by(end, at).alias("e"), F.max_by(end, at).alias("l"), F.min("site_uid").alias("site_uid")
    )
    flat = [F.col(f"{c}.{f}").alias(f"{name}_{out}") for name, c in (("earliest", "e"), ("latest", "l")) for f, out in (("day", "date"), ("time", "time"), ("value", "value"), ("units", "units"))]
    return stats.where("nrecords > 0").select("source", "id", "parameter_name", "site_uid", "nrecords", "min", "max", "mean", *flat)


def flat(kept: DataFrame) -> DataFrame:
    """The readings in order of their wells and dates, with ISO times."""
    return kept.withColumn("datetime", F.when(F.col("ts").isNotNull(), iso_utc(F.col("ts")))).orderBy("source", "id", "date_measured")


@dataclass
class Gathered:
    """What several sources gave together, and what went wrong with those that gave nothing."""

    sites: DataFrame | None = None
    rows: DataFrame | None = None
    failed: dict[str, str] = field(default_factory=dict)


def gather(sources: dict[str, Callable[[], tuple[DataFrame, DataFrame | None]]], sites_only: bool = False) -> Gathered:
    """Sites and raw readings of all sources as one table each; a source that raises or is empty contributes nothing.

    A source is a function giving (sites, readings); readings may be None, and are not asked for with
    ``sites_only``.
    """
    out = Gathered()
    for name, source in sources.items():
        try:
            found, rows = source()
            if not providers.healthy(found):
                raise ValueError("no sites")
        except Exception as error:  # noqa: BLE001 - whatever a source raises, the others go on
            out.failed[name] = f"{type(error).__name__}: {error}"
            continue
        out.sites = found if out.sites is None else out.sites.unionByName(found, allowMissingColumns=True)
        if rows is not None and not sites_only:
            out.rows = rows if out.rows is None else out.rows.unionByName(rows, allowMissingColumns=True)
    return out
