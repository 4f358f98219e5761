"""Points near other points, and the region that contains a point.

Latitude is cut into strips that overlap by the search radius, strips into longitude blocks; the cells
are range-partitioned, sorted by longitude and swept: each point meets the points that follow it in
longitude as long as they can still be in reach, and distances are verified. A pair belongs to the
cell in which its smaller key is no copy, so it comes out once. Pairs leave a task as the sweep finds
them, and cells holding very many points are worked off in tiles. ``places_within`` gives the same result
as pairs of places with the points' membership, so that points at one place are not expanded into pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import EARTH_RADIUS_M, haversine_m, inside, parse_wkt

M_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180


def usable_point(lat: Column, lon: Column) -> Column:
    """True for coordinates that are neither null, NaN, 0 nor outside the globe."""
    ok = lambda c, most: c.isNotNull() & ~F.isnan(c) & (c != 0) & (F.abs(c) <= most)
    return F.coalesce(ok(lat, 90) & ok(lon, 180), F.lit(False))


def _sweep(cell: np.ndarray, key: np.ndarray, lat: np.ndarray, lon: np.ndarray, own: np.ndarray, tile: np.ndarray, pair: np.ndarray, radius: float, most: int = 500_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs within ``radius`` among rows sorted by cell and longitude, in parts of about ``most`` pairs.

    Step k compares every active row with the k-th after it, so no more than a step's pairs are held at once.
    """
    n = len(key)
    with np.errstate(divide="ignore"):
        share = np.sin(radius / EARTH_RADIUS_M) / np.maximum(1e-12, np.cos(np.radians(np.minimum(90, np.abs(lat) + radius / M_PER_DEGREE))))
    # a circle around a pole reaches every longitude
    reach = np.where(share < 1, np.degrees(np.arcsin(np.minimum(1, share))), 360.0)
    # near the poles a cell may hold a point twice, 360 degrees apart; only then can a pair come out twice
    order = np.lexsort((key, cell))
    again = (cell[order][1:] == cell[order][:-1]) & (key[order][1:] == key[order][:-1])
    twin = np.zeros(n, bool)
    twin[order[1:][again]] = twin[order[:-1][again]] = True
    held: list[tuple] = []
    twins: list[tuple] = []
    size = 0
    active, k = np.arange(n), 0
    while True:
        k += 1
        active = active[active + k < n]
        j = active + k
        keep = (cell[j] == cell[active]) & (lon[j] - lon[active] <= np.maximum(reach[active], reach[j]) * 1.000001)
        active = active[keep]
        if not len(active):
            break
        i, j = active, active + k
        cand = np.abs(lat[j] - lat[i]) <= radius / M_PER_DEGREE * 1.000001
        i, j = i[cand], j[cand]
        first = key[i] < key[j]
        cand = (key[i] != key[j]) & np.where(first, own[i], own[j])
        # in a cell worked off in tiles, tile pair (a, b) meets only rows of a with rows of b
        low, high = np.minimum(tile[i], tile[j]), np.maximum(tile[i], tile[j])
        cand &= (pair[i] < 0) | ((pair[i] >> 32 == low) & ((pair[i] & 0xFFFFFFFF) == high))
        i, j, first = i[cand], j[cand], first[cand]
        d = haversine_m(lat[i], lon[i], lat[j], lon[j])
        ok = d <= radius
        i, j, first, d = i[ok], j[ok], first[ok], d[ok]
        a, b, double = np.where(first, key[i], key[j]), np.where(first, key[j], key[i]), twin[i] | twin[j]
        if double.any():
            twins.append((a[double], b[double], d[double]))
            a, b, d = a[~double], b[~double], d[~double]
        held.append((a, b, d))
        size += len(a)
        if size >= most:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
    if twins:
        a, b, d = (np.concatenate(x) for x in zip(*twins))
        _, once = np.unique(np.column_stack([a, b]), axis=0, return_index=True)
        held.append((a[once], b[once], d[once]))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def pairs_within(points: DataFrame, key: str, lat: str, lon: str, radius_m: float, rows_per_part: int = 100_000, tile_rows: int = 20_000) -> DataFrame:
    """Pairs (left_key < right_key, distance_m) of points at most ``radius_m`` apart, each once.

    ``key`` must be a unique long; rows with a null key or without usable coordinates take no part.
    Points with the same coordinates are pairs at distance 0. Longitudes wrap at 180 degrees. Cells
    with more than ``tile_rows`` rows are split into pairs of tiles over several tasks; no point is
    left out. Other columns are ignored, an empty table gives an empty result.
    """
    total = points.select(key).count()
    height = 10 * radius_m / M_PER_DEGREE
    slack = radius_m / M_PER_DEGREE * 1.000001
    p = points.where(F.col(key).isNotNull() & usable_point(F.col(lat), F.col(lon))).select(F.col(key).cast("long").alias("key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    strip_of = lambda x: F.floor((x + 90) / height).cast("int")
    p = p.withColumn("home", strip_of(F.col("lat"))).withColumn("strip", F.explode(F.sequence(strip_of(F.col("lat") - slack), strip_of(F.col("lat") + slack))))
    # all blocks of a strip are as wide as the strip is high, at the strip's end that is nearer to a pole
    far = F.least(F.lit(90.0), F.greatest(F.abs(F.col("strip") * height - 90), F.abs((F.col("strip") + 1) * height - 90)) + slack)
    narrow = F.cos(F.radians(far))
    p = p.withColumn("blocks", F.greatest(F.lit(1), F.floor(360 * narrow / height).cast("int"))).withColumn("width", F.lit(360.0) / F.col("blocks"))
    m = F.when(narrow > math.sin(radius_m / EARTH_RADIUS_M), F.least(F.lit(180.0), F.degrees(F.asin(F.least(F.lit(1.0), math.sin(radius_m / EARTH_RADIUS_M) / narrow))) * 1.000001)).otherwise(180.0)
    block_of = lambda x: F.floor((x + 180) / F.col("width")).cast("int")
    p = p.withColumn("raw", F.explode(F.sequence(block_of(F.col("lon") - m), block_of(F.col("lon") + m))))
    turns = F.floor(F.col("raw") / F.col("blocks"))
    p = p.select(
        "key", "lat", (F.col("lon") - turns * 360).alias("lon"), "strip", F.pmod("raw", "blocks").alias("block"),
        ((F.col("home") == F.col("strip")) & (turns == 0) & (F.col("raw") == F.least(block_of(F.col("lon")), F.col("blocks") - 1)) | ((F.col("home") == F.col("strip")) & (F.col("lon") == 180) & (F.col("raw") == F.col("blocks")))).alias("own"),
    )
    crowded = p.groupBy("strip", "block").count().where(F.col("count") > tile_rows).select("strip", "block", F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles"))
    p = p.join(crowded, ["strip", "block"], "left")
    mine = F.pmod(F.xxhash64("key"), F.coalesce("tiles", F.lit(1))).cast("long")
    others = F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1)
    tile_pair = F.transform(others, lambda x: F.shiftleft(F.least(x.cast("long"), F.col("tile")), 32) + F.greatest(x.cast("long"), F.col("tile")))
    p = p.withColumn("tile", mine).withColumn("pair", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(tile_pair))).drop("tiles")
    parts = max(1, -(-3 * total // (2 * rows_per_part)))
    cells = p.repartitionByRange(parts, "strip", "block", "pair").sortWithinPartitions("strip", "block", "pair", "lon")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        c = {x: rows[x].to_numpy() for x in ("strip", "block", "pair", "key", "lat", "lon", "own", "tile")}
        change = (np.diff(c["strip"]) != 0) | (np.diff(c["block"]) != 0) | (np.diff(c["pair"]) != 0)
        for part in _sweep(np.r_[0, np.cumsum(change)], c["key"], c["lat"], c["lon"], c["own"].astype(bool), c["tile"], c["pair"], radius_m):
            for at in range(0, len(part[0]), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 200_000]) for x in part], ["left_key", "right_key", "distance_m"])

    return cells.mapInArrow(run, "left_key long, right_key long, distance_m double")


def places_within(points: DataFrame, key: str, lat: str, lon: str, radius_m: float) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): each point's place, and the pairs of places within ``radius_m``.

    A place is all points of exactly one latitude and longitude and is named by its smallest key;
    membership is (point_key, place_key, n_points). Points at one place are within any radius of one
    another, so the two tables say of every two points what ``pairs_within`` says. Counted on the map
    side, whatever share of the points one place has. Unusable rows and empty tables as there.
    """
    p = points.where(F.col(key).isNotNull() & usable_point(F.col(lat), F.col(lon))).select(F.col(key).cast("long").alias("point_key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    places = p.groupBy("lat", "lon").agg(F.min("point_key").alias("place_key"), F.count(F.lit(1)).alias("n_points"))
    return p.join(places, ["lat", "lon"]).select("point_key", "place_key", "n_points"), pairs_within(places, "place_key", "lat", "lon", radius_m)


def containing_regions(points: DataFrame, key: str, lat: str, lon: str, regions: DataFrame, region_key: str, wkt: str, boundary: bool = True, most_bytes: int = 8_000_000, cell_degrees: float = 0.5) -> DataFrame:
    """(point_key, region_key) for every region whose area holds the point.

    Up to ``most_bytes`` of region text (checked) travels to every task; a larger layer is joined by
    grid cells of its bounding boxes instead. Points without usable coordinates, and regions without
    readable rings, give no row. Points on a boundary count as ``boundary`` says. Repeated point keys
    give repeated rows; empty tables an empty result.
    """
    spark = points.sparkSession
    layer = regions.where(F.col(region_key).isNotNull()).select(F.col(region_key).alias("region_key"), F.col(wkt).alias("wkt"))
    p = points.where(usable_point(F.col(lat), F.col(lon))).select(F.col(key).alias("point_key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    kinds = f"point_key {p.schema['point_key'].dataType.simpleString()}, region_key {layer.schema['region_key'].dataType.simpleString()}"
    size = layer.agg(F.sum(F.length("wkt") + 16)).first()[0] or 0
    if size <= most_bytes:
        shapes = spark.sparkContext.broadcast([parse_wkt(r["region_key"], r["wkt"]) for r in layer.orderBy("region_key").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column("lon").to_numpy(), batch.column("lat").to_numpy()
                for shape in shapes.value:
                    hit = np.flatnonzero(inside(shape, x, y, boundary))
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([batch.column("point_key").take(pa.array(hit)), pa.array([shape.key] * len(hit), layer_type)], ["point_key", "region_key"])

        from pyspark.sql.pandas.types import to_arrow_type

        layer_type = to_arrow_type(layer.schema["region_key"].dataType)
        return p.mapInArrow(run, kinds)

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, w, *parse_wkt(k, w).bounds) for k, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [r for r in rows if r[2] <= r[4]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [batch.column(0).type, pa.string(), *[pa.float64()] * 4])], ["region_key", "wkt", "x0", "y0", "x1", "y1"])

    def cell(c: str) -> Column:
        return F.floor(F.col(c) / cell_degrees)

    boxed = layer.mapInArrow(boxes, f"region_key {layer.schema['region_key'].dataType.simpleString()}, wkt string, x0 double, y0 double, x1 double, y1 double")
    boxed = boxed.withColumn("cx", F.explode(F.sequence(cell("x0"), cell("x1")))).withColumn("cy", F.explode(F.sequence(cell("y0"), cell("y1"))))
    met = p.withColumn("cx", cell("lon")).withColumn("cy", cell("lat")).join(boxed, ["cx", "cy"]).where("lon between x0 and x1 and lat between y0 and y1")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("wkt").dictionary_encode()
            index, hit = codes.indices.to_numpy(), np.zeros(batch.num_rows, bool)
            x, y = batch.column("lon").to_numpy(), batch.column("lat").to_numpy()
            for i, text in enumerate(codes.dictionary.to_pylist()):
                at = np.flatnonzero(index == i)
                hit[at] = inside(parse_wkt(None, text), x[at], y[at], boundary)
            yield batch.select(["point_key", "region_key"]).filter(pa.array(hit))

    return met.select("point_key", "region_key", "lat", "lon", "wkt").mapInArrow(verify, kinds)


def found(sites: DataFrame, counties: DataFrame, radius_m: float = 150.0) -> DataFrame:
    """Rows (kind, site_uid, other_key): other sites in reach and the county a site lies in."""
    near = pairs_within(sites, "site_uid", "latitude", "longitude", radius_m)
    held = containing_regions(sites.where("site_uid is not null"), "site_uid", "latitude", "longitude", counties, "county_no", "geometry")
    return near.select(F.lit("site").alias("kind"), F.col("left_key").alias("site_uid"), F.col("right_key").alias("other_key")).unionByName(
        held.select(F.lit("county").alias("kind"), F.col("point_key").alias("site_uid"), F.col("region_key").cast("long").alias("other_key"))
    )
