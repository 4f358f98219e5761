"""Landed provider files into the canonical site and reading columns.

Each provider is a table of expressions over its raw rows, so adding one means adding expressions. Files are
read with an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .analytes import listed

SITE_COLUMNS = {
    "source": "string", "id": "string", "name": "string", "latitude": "double", "longitude": "double", "elevation": "double", "elevation_units": "string",
    "horizontal_datum": "string", "vertical_datum": "string", "usgs_site_id": "string", "alternate_site_id": "string", "formation": "string",
    "aquifer": "string", "well_depth": "double", "well_depth_units": "string", "well_completion_date": "string",
}
READING_COLUMNS = {
    "source": "string", "id": "string", "parameter_name": "string", "parameter_value": "double", "value_text": "string", "source_parameter_name": "string",
    "source_parameter_units": "string", "date_measured": "string", "time_measured": "string", "approval_status": "string", "qualifier": "string",
}


@dataclass(frozen=True)
class Provider:
    """Raw schemas and the expressions that make canonical rows; ``keep`` drops unusable readings."""

    site_schema: str = ""
    sites: dict[str, str] = field(default_factory=dict)
    reading_schema: str = ""
    readings: dict[str, str] = field(default_factory=dict)
    keep: str = "true"
    site_filter: str = "true"


_NUM = "try_cast({} as double)".format
_MS_DAY = "date_format(timestamp_millis({}), 'yyyy-MM-dd')".format
_MS_TIME = "date_format(timestamp_millis({}), 'HH:mm:ss')".format
_ST_SITE = "`@iot.id` string, name string, location struct<coordinates: array<double>>, properties struct<agency: string, stickup: double>"
_ST_OBS = "thing_id string, observation struct<result: string, phenomenonTime: string>, datastream struct<name: string, unitOfMeasurement: struct<symbol: string>, ObservedProperty: struct<name: string>>"


_agency = "(properties.agency is null or properties.agency = '{}')".format
#: A result below the reporting or detection limit counts as 0; otherwise its first word is the number.
_DWB_VALUE = "case when lower(observation.result) like '%< mrl%' or lower(observation.result) like '%< mdl%' then 0.0 else try_cast(split(observation.result, ' ')[0] as double) end"


def _sensorthings(source: str, elevation: str = "try_element_at(location.coordinates, 3)", allow: str = "true", value: str = _NUM("observation.result")) -> Provider:
    return Provider(
        _ST_SITE,
        {"source": f"'{source}'", "id": "`@iot.id`", "name": "name", "latitude": "location.coordinates[1]", "longitude": "location.coordinates[0]", "elevation": elevation, "elevation_units": "'m'", "horizontal_datum": "'WGS84'"},
        _ST_OBS,
        {"source": f"'{source}'", "id": "thing_id", "value_text": "observation.result", "parameter_value": value, "source_parameter_name": "coalesce(datastream.ObservedProperty.name, datastream.name)",
         "source_parameter_units": "datastream.unitOfMeasurement.symbol", "date_measured": "observation.phenomenonTime"},
        "observation.result is not null", allow,
    )


#: Field names of each provider's rows, its source tag, and wells whose depth it does not report.
PROVIDERS: dict[str, Provider] = {
    "nwis": Provider(
        "properties struct<monitoring_location_id: string, monitoring_location_name: string, altitude: string, vertical_datum: string, national_aquifer_code: string, well_constructed_depth: double>, geometry struct<coordinates: array<double>>",
        {"source": "'USGS-NWIS'", "id": "properties.monitoring_location_id", "name": "properties.monitoring_location_name", "latitude": "geometry.coordinates[1]", "longitude": "geometry.coordinates[0]",
         "elevation": _NUM("properties.altitude"), "elevation_units": "'ft'", "horizontal_datum": "'WGS84'", "vertical_datum": "properties.vertical_datum", "aquifer": "properties.national_aquifer_code",
         "well_depth": "properties.well_constructed_depth", "well_depth_units": "'ft'"},
        "properties struct<monitoring_location_id: string, value: string, time: string, unit_of_measure: string, approval_status: string, qualifier: array<string>>",
        {"source": "'USGS-NWIS'", "id": "properties.monitoring_location_id", "parameter_name": "'waterlevels'", "value_text": "properties.value", "parameter_value": _NUM("properties.value"), "source_parameter_units": "properties.unit_of_measure",
         "date_measured": "properties.time", "approval_status": "properties.approval_status", "qualifier": "case when properties.qualifier is not null then concat_ws(', ', properties.qualifier) end"},
        "properties.value is not null and trim(properties.value) not in ('', '-999999')",
    ),
    "nmbgmr": Provider(
        "properties struct<point_id: string, lonlat_datum: string, altitude_datum: string, site_id: string, alternate_site_id: string, formation: string, well_depth: double, well_depth_units: string>, geometry struct<coordinates: array<double>>",
        {"source": "'NMBGMR'", "id": "properties.point_id", "name": "properties.point_id", "latitude": "geometry.coordinates[1]", "longitude": "geometry.coordinates[0]", "elevation": "geometry.coordinates[2]", "elevation_units": "'m'",
         "horizontal_datum": "properties.lonlat_datum", "vertical_datum": "properties.altitude_datum", "usgs_site_id": "properties.site_id", "alternate_site_id": "properties.alternate_site_id",
         "formation": "coalesce(properties.formation, '')", "well_depth": "properties.well_depth", "well_depth_units": "coalesce(properties.well_depth_units, '')"},
        "PointID string, DepthToWaterBGS string, DepthToWaterBGSUnits string, DateMeasured string, TimeMeasured string, PublicRelease boolean, LevelStatus string",
        {"source": "'NMBGMR'", "id": "PointID", "parameter_name": "'waterlevels'", "value_text": "DepthToWaterBGS", "parameter_value": _NUM("DepthToWaterBGS"), "source_parameter_units": "DepthToWaterBGSUnits", "date_measured": "DateMeasured",
         "time_measured": "TimeMeasured", "approval_status": "cast(PublicRelease as string)", "qualifier": "LevelStatus"},
        "DepthToWaterBGS is not null and DateMeasured is not null",
    ),
    "nmbgmr_analytes": Provider(
        reading_schema="PointID string, SampleValue string, Units string, AnalyteMeaning string, Symbol string, info struct<CollectionDate: string, PublicRelease: boolean>",
        readings={"source": "'NMBGMR'", "id": "PointID", "value_text": "SampleValue", "parameter_value": _NUM("SampleValue"), "source_parameter_name": "AnalyteMeaning", "source_parameter_units": "Units", "date_measured": "info.CollectionDate",
                  "approval_status": "cast(info.PublicRelease as string)", "qualifier": "Symbol"},
    ),
    "wqp": Provider(
        "ProviderName string, MonitoringLocationIdentifier string, MonitoringLocationName string, LatitudeMeasure string, LongitudeMeasure string, `VerticalMeasure/MeasureValue` string, `VerticalMeasure/MeasureUnitCode` string, "
        "HorizontalCoordinateReferenceSystemDatumName string, VerticalCoordinateReferenceSystemDatumName string, AquiferName string, `WellDepthMeasure/MeasureValue` string, `WellDepthMeasure/MeasureUnitCode` string",
        {"source": "concat('WQP/', ProviderName)", "id": "MonitoringLocationIdentifier", "name": "MonitoringLocationName", "latitude": _NUM("LatitudeMeasure"), "longitude": _NUM("LongitudeMeasure"), "elevation": _NUM("`VerticalMeasure/MeasureValue`"),
         "elevation_units": "`VerticalMeasure/MeasureUnitCode`", "horizontal_datum": "HorizontalCoordinateReferenceSystemDatumName", "vertical_datum": "VerticalCoordinateReferenceSystemDatumName", "aquifer": "AquiferName",
         "well_depth": _NUM("`WellDepthMeasure/MeasureValue`"), "well_depth_units": "`WellDepthMeasure/MeasureUnitCode`"},
        "MonitoringLocationIdentifier string, CharacteristicName string, ResultMeasureValue string, `ResultMeasure/MeasureUnitCode` string, ActivityStartDate string, `ActivityStartTime/Time` string, ActivityIdentifier string, USGSPCode string, "
        "ResultTemperatureBasisText string, ResultStatusIdentifier string, MeasureQualifierCode string",
        {"source": "'WQP'", "id": "MonitoringLocationIdentifier", "value_text": "ResultMeasureValue", "parameter_value": _NUM("ResultMeasureValue"), "source_parameter_name": "CharacteristicName", "source_parameter_units": "`ResultMeasure/MeasureUnitCode`",
         "date_measured": "ActivityStartDate", "time_measured": "`ActivityStartTime/Time`", "approval_status": "ResultStatusIdentifier", "qualifier": "MeasureQualifierCode"},
        "coalesce(trim(ResultMeasureValue), '') <> ''",
    ),
    "isc": Provider(
        "id string, name string, latitude double, longitude double, groundSurfaceElevationFeet double",
        {"source": "'ISCSevenRivers'", "id": "id", "name": "name", "latitude": "latitude", "longitude": "longitude", "elevation": "groundSurfaceElevationFeet", "elevation_units": "'ft'"},
        "monitoringPointId string, depthToWaterFeet double, invalid boolean, dry boolean, dateTime long",
        {"source": "'ISCSevenRivers'", "id": "monitoringPointId", "parameter_name": "'waterlevels'", "value_text": "cast(depthToWaterFeet as string)", "parameter_value": "depthToWaterFeet", "source_parameter_units": "'ft'",
         "date_measured": _MS_DAY("dateTime"), "time_measured": _MS_TIME("dateTime")},
        "depthToWaterFeet is not null and not coalesce(invalid, false) and not coalesce(dry, false)",
    ),
    "isc_analytes": Provider(
        reading_schema="monitoringPointId string, analyte string, result string, units string, dateTime long",
        readings={"source": "'ISCSevenRivers'", "id": "monitoringPointId", "value_text": "result", "parameter_value": _NUM("result"), "source_parameter_name": "analyte", "source_parameter_units": "units", "date_measured": _MS_DAY("dateTime"), "time_measured": _MS_TIME("dateTime")},
        keep="result is not null",
    ),
    "bor": Provider(
        "attributes struct<_id: int, locationName: string, elevation: string, locationCoordinates: struct<coordinates: array<double>>, horizontalDatum: struct<_id: string>, verticalDatum: struct<_id: string>>",
        {"source": "'BOR-RISE'", "id": "cast(attributes._id as string)", "name": "attributes.locationName", "latitude": "attributes.locationCoordinates.coordinates[1]", "longitude": "attributes.locationCoordinates.coordinates[0]",
         "elevation": _NUM("attributes.elevation"), "elevation_units": "'ft'", "horizontal_datum": "attributes.horizontalDatum._id", "vertical_datum": "attributes.verticalDatum._id",
         "well_depth": "cast(try_element_at(map(3243, 1340, 3244, 190, 3245, 220, 3246, 185), attributes._id) as double)", "well_depth_units": "'ft'"},
        "attributes struct<result: string, dateTime: string, status: string, locationId: string, resultAttributes: struct<units: string>>",
        {"source": "'BOR-RISE'", "id": "attributes.locationId", "value_text": "attributes.result", "parameter_value": _NUM("attributes.result"), "source_parameter_units": "attributes.resultAttributes.units", "date_measured": "attributes.dateTime",
         "approval_status": "attributes.status"},
    ),
    "pods": Provider(
        "attributes struct<pod_file: string, elevation: double, aquifer: string, depth_well: double, start_date: long, finish_dat: long, pod_status: string, pod_basin: string>, geometry struct<x: double, y: double>",
        {"source": "'NMOSEPOD'", "id": "attributes.pod_file", "latitude": "geometry.y", "longitude": "geometry.x", "elevation": "attributes.elevation", "elevation_units": "'ft'", "aquifer": "attributes.aquifer", "well_depth": "attributes.depth_well",
         "well_depth_units": "'ft'", "well_completion_date": _MS_DAY("attributes.finish_dat")},
        site_filter="attributes.pod_status = 'ACT' and attributes.pod_basin not in ('SP', 'SD', 'LWD')",
    ),
    "dwb": _sensorthings("ST/DWB", value=_DWB_VALUE),
    "pvacd": _sensorthings("ST2/PVACD", allow=_agency("PVACD") + " and `@iot.id` between '9640' and '9650'"),
    "ebid": _sensorthings("ST2/EBID", allow=_agency("EBID")),
    "bernco": _sensorthings("ST2/BernCo", allow=_agency("BernCo") + " and `@iot.id` <> '9652'"),
    "cabq": _sensorthings("ST2/CABQ", "try_element_at(location.coordinates, 3) - coalesce(properties.stickup, 0) * 0.3048", _agency("CABQ")),
    "roswell": _sensorthings("ST2/NMOSE-Roswell", allow=_agency("OSE-Roswell")),
    "ckan": Provider(
        "Site_ID string, Latitude double, Longitude double, SurfaceElevation double",
        {"source": "'OSE-Roswell'", "id": "Site_ID", "name": "Site_ID", "latitude": "Latitude", "longitude": "Longitude", "elevation": "SurfaceElevation", "elevation_units": "'ft'"},
        "Site_ID string, `DTWGS` string, Date string, Time string",
        {"source": "'OSE-Roswell'", "id": "Site_ID", "parameter_name": "'waterlevels'", "value_text": "DTWGS", "parameter_value": _NUM("DTWGS"), "source_parameter_units": "'ft'", "date_measured": "Date", "time_measured": "Time"},
        "DTWGS is not null",
    ),
}

def read_json(spark: SparkSession, path: str, schema: str, selector: str | None = None) -> DataFrame:
    """JSON rows; with ``selector``, the rows of that array in each landed page."""
    if selector is None:
        return spark.read.schema(schema).json(path, multiLine=False)
    row = T._parse_datatype_string(schema)
    page = T.StructType([T.StructField(selector, T.ArrayType(row))])
    return spark.read.schema(page).json(path, multiLine=True).select(F.explode(selector).alias("r")).select("r.*")


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated rows with a header and no quoting; rows of nothing but nulls are dropped."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("enforceSchema", False).csv(path)
    return df.na.drop("all")


def _canonical(raw: DataFrame, exprs: dict[str, str], columns: dict[str, str]) -> DataFrame:
    return raw.selectExpr(*[f"cast({exprs.get(c, 'null')} as {kind}) as {c}" for c, kind in columns.items()])


def sites(provider: str, raw: DataFrame) -> DataFrame:
    """Canonical sites of raw rows, the first row per id."""
    p = PROVIDERS[provider]
    rows = _canonical(raw.where(p.site_filter), p.sites, SITE_COLUMNS).withColumn("_at", F.monotonically_increasing_id())
    first = rows.groupBy("id").agg(F.min_by(F.struct(*SITE_COLUMNS), "_at").alias("s"))
    return first.select("s.*")


def readings(provider: str, raw: DataFrame, parameter: str | None = None) -> DataFrame:
    """Canonical readings of raw rows without those the provider marks as unusable."""
    p = PROVIDERS[provider]
    rows = _canonical(raw.where(p.keep), p.readings, READING_COLUMNS)
    return rows.withColumn("parameter_name", F.coalesce("parameter_name", F.lit(parameter)))


def portal_results(raw: DataFrame, analyte: str) -> DataFrame:
    """Raw portal results of one analyte by the portal's rules.

    Names that stand for it, with a value. Specific conductance is what is given at 25 degrees, conductivity
    everything else, a missing basis included. Of dissolved solids measured several times in one activity the
    preferred code stays (70300, 70301, 70303, then any other; among equals the larger value text, so that
    order does not matter); activities without identifier are kept as they are.
    """
    rows = raw.where(F.trim("CharacteristicName").isin(*listed("wqp", analyte)) & (F.trim(F.coalesce("ResultMeasureValue", F.lit(""))) != ""))
    warm = F.trim(F.coalesce("ResultTemperatureBasisText", F.lit(""))).isin("25 deg C", "25 Deg C")
    if analyte == "specific_conductance":
        return rows.where(warm)
    if analyte == "conductivity":
        return rows.where(~warm)
    if analyte != "tds":
        return rows
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, ("70300", "70301", "70303"))), F.trim("USGSPCode")), F.lit(0))
    rank = F.when(rank == 0, 4).otherwise(rank)
    key = ["MonitoringLocationIdentifier", "ActivityIdentifier"]
    w = Window.partitionBy(*key).orderBy(rank, F.desc("ResultMeasureValue"))
    known = rows.where("ActivityIdentifier is not null").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return known.unionByName(rows.where("ActivityIdentifier is null"))


def joined_wells(locations: DataFrame, wells: DataFrame) -> DataFrame:
    """Locations with formation and depth of the wells table (by point_id), which the service gives one by one; locations without a well keep nulls."""
    one = wells.groupBy("point_id").agg(F.first("formation", True).alias("formation"), F.first("well_depth", True).alias("well_depth"), F.first("well_depth_units", True).alias("well_depth_units"))
    return locations.join(one, "point_id", "left")


def exploded(keyed: DataFrame, column: str) -> DataFrame:
    """(PointID, fields of the analyte) of rows that hold a map of point to list of analytes."""
    return keyed.select(F.explode(column).alias("PointID", "_list")).select("PointID", F.explode("_list").alias("_a")).select("PointID", "_a.*")


def catalog_items(locations: DataFrame, records: DataFrame, items: DataFrame, code: str) -> DataFrame:
    """(location_id, item_id) of the first item of each location whose parameter has the wanted code.

    ``locations`` (location_id, record_ids), ``records`` (record_id, item_ids) and ``items`` (item_id,
    parameter_code) are the service's three levels; the walk is two joins, first in the order listed.
    """
    level = locations.select("location_id", F.posexplode("record_ids").alias("_i", "record_id")).join(records, "record_id")
    level = level.select("location_id", "_i", F.posexplode("item_ids").alias("_j", "item_id")).join(items.where(F.col("parameter_code") == code), "item_id")
    return level.groupBy("location_id").agg(F.min_by("item_id", F.struct("_i", "_j")).alias("item_id"))


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    """Which of the needed columns a table lacks; a null value is no lack."""
    return [c for c in needed if c not in df.columns]


def healthy(df: DataFrame) -> bool:
    """True if a source has at least one row."""
    return not df.limit(1).isEmpty()
