"""Region layers, handed-over tables, and points as well-known binary."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import parse_wkt

FEATURES = "features array<struct<id: string, properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
_POINT = r"\[\s*(-?[0-9][0-9.eE+-]*)\s*,\s*(-?[0-9][0-9.eE+-]*)(?:\s*,[^\]\[]*)?\]"


def read_regions(spark: SparkSession, path: str, name: str, key: str | None = None) -> DataFrame:
    """(id, name, key, geometry as WKT) of the polygons of GeoJSON collections; ``name`` and ``key`` are properties.

    Heights are dropped; other kinds of geometry, and null ones, have a null geometry.
    """
    rows = spark.read.schema(FEATURES).json(path, multiLine=True).select(F.explode("features").alias("f"))
    body = F.translate(F.regexp_replace("f.geometry.coordinates", _POINT, "$1 $2"), "[]", "()")
    kind = F.upper("f.geometry.type")
    wkt = F.when(kind.isin("POLYGON", "MULTIPOLYGON"), F.concat(kind, F.lit(" "), body))
    prop = lambda p: F.col("f.properties")[p] if p else F.lit(None).cast("string")
    return rows.select(F.col("f.id").alias("id"), prop(name).alias("name"), prop(key).alias("key"), wkt.alias("geometry"))


def utm_metres(lon: np.ndarray, lat: np.ndarray, zone: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Eastings and northings on the WGS84 ellipsoid (transverse Mercator series to the sixth power)."""
    a, f, k0 = 6_378_137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (zone * 6 - 183))
    n = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    t, c, x = np.tan(phi) ** 2, ep2 * np.cos(phi) ** 2, lam * np.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * np.sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * np.sin(4 * phi) - (35 * e2**3 / 3072) * np.sin(6 * phi))
    east = k0 * n * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * x**5 / 120) + 500_000
    north = k0 * (m + n * np.tan(phi) * (x**2 / 2 + (5 - t + 9 * c + 4 * c**2) * x**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * x**6 / 720))
    return east, north


def area_sq_km(wkt: str | None, zone: int = 13) -> float | None:
    """Projected area of a region: of each polygon its first ring less the others; None without rings."""
    total, found = 0.0, False
    for polygon in re.findall(r"\(\([^()]+\)(?:\s*,\s*\([^()]+\))*\)", wkt or ""):
        for i, ring in enumerate(re.findall(r"\(([^()]+)\)", polygon)):
            region = parse_wkt(None, f"POLYGON (({ring}))")
            if len(region.x1):
                x, y = utm_metres(region.x1, region.y1, zone)
                found = True
                total += (1 if i == 0 else -1) * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2
    return round(total / 1e6, 2) if found else None


def with_area(regions: DataFrame, wkt: str = "geometry", zone: int = 13) -> DataFrame:
    """Regions with ``area_sq_km``; the layer's polygons are measured in batches."""
    schema = T.StructType([*regions.schema.fields, T.StructField("area_sq_km", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([area_sq_km(w, zone) for w in batch.column(wkt).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], [*batch.schema.names, "area_sq_km"])

    return regions.mapInArrow(run, schema)


def outline_json(wkt: str) -> str:
    """The outer ring as a polygon query of a map service."""
    region = parse_wkt(None, wkt[: wkt.index(")") + 1] if ")" in wkt else wkt)
    return json.dumps({"rings": [[[x, y] for x, y in zip(region.x1.tolist(), region.y1.tolist())]], "spatialReference": {"wkid": 4326}})


def write_tables(path: str, **tables: DataFrame) -> None:
    """Each table as Parquet under its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A handed-over table; one that was never written is empty."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def with_wkb(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Adds ``geometry``: the point as little-endian well-known binary, null without coordinates."""
    schema = T.StructType([*df.schema.fields, T.StructField("geometry", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (lon, lat))
            rows = np.zeros(len(x), np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")]))
            rows["order"], rows["kind"], rows["x"], rows["y"] = 1, 1, x, y
            raw = pa.Array.from_buffers(pa.binary(21), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
            ok = pa.array(~(np.isnan(x) | np.isnan(y)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.if_else(ok, raw, pa.scalar(None, pa.binary()))], [*batch.schema.names, "geometry"])

    return df.mapInArrow(run, schema)


def from_wkb(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Longitude and latitude of points in well-known binary, in place of the column."""
    kept = [c for c in df.columns if c != geometry]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(geometry).to_pylist()
            joined = b"".join(r if r is not None else bytes(5) + np.array([math.nan] * 2).tobytes() for r in raw)
            at = np.frombuffer(joined, np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(at["x"], from_pandas=True), pa.array(at["y"], from_pandas=True)], [*kept, "longitude", "latitude"])

    return df.mapInArrow(run, schema)


#: Digits that are shown of a column.
SHOWN = {"elevation": 2, "well_depth": 2, "latitude": 6, "longitude": 6, "min": 2, "max": 2, "mean": 2}


def displayed(df: DataFrame) -> DataFrame:
    """The table as it is shown: known columns rounded."""
    return df.withColumns({c: F.round(c, d) for c, d in SHOWN.items() if c in df.columns})
