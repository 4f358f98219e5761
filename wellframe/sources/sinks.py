"""Products as GeoJSON and Parquet; unchanged content is not written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import feature_id


def point(lon: str = "longitude", lat: str = "latitude", elevation: str | None = None) -> Column:
    """GeoJSON point, or null without coordinates."""
    coordinates = F.array(lon, lat) if elevation is None else F.when(F.col(elevation).isNull(), F.array(lon, lat)).otherwise(F.array(lon, lat, elevation))
    return F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), coordinates.alias("coordinates")))


def features(df: DataFrame, elevation: str | None = None) -> DataFrame:
    """One JSON text per row; nulls are kept as properties."""
    held = [c for c in df.columns if c not in ("latitude", "longitude", elevation)]
    body = F.struct(F.lit("Feature").alias("type"), feature_id(F.col("source"), F.col("id")).alias("id"), point(elevation=elevation).alias("geometry"), F.struct(*held).alias("properties"))
    return df.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def content_hash(df: DataFrame) -> str:
    """Order-independent digest of a table's rows, made of partial sums."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    got = df.select(F.xxhash64(row).alias("a"), F.xxhash64(F.lit(1), row).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("x"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")).first()
    return f"{got['n']}-{(got['x'] or 0) & 0xFFFFFFFFFFFFFFFF:016x}-{got['s'] or 0}"


def write_collection(df: DataFrame, path: str, collection: str, title: str, description: str, as_of: str, extra: dict[str, str] | None = None) -> dict[str, object]:
    """Features as JSON lines under ``path/features`` and the collection's envelope under ``path/collection``."""
    rows = features(df)
    rows.write.mode("overwrite").text(f"{path}/features")
    spark = df.sparkSession
    n = spark.read.text(f"{path}/features").count()
    envelope = {"type": "FeatureCollection", "id": collection, "title": title, "description": description, **(extra or {}), "timeStamp": as_of, "numberMatched": n, "numberReturned": n}
    fields = F.struct(*[F.lit(v).alias(k) for k, v in envelope.items()])
    spark.range(1).select(F.to_json(fields).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/collection")
    return envelope


def publish(df: DataFrame, root: str, product: str, as_of: str) -> bool:
    """Write a dated copy and move ``latest`` to it, unless the content is that of ``latest``."""
    spark: SparkSession = df.sparkSession
    digest = content_hash(df)
    marker = f"{root}/{product}/latest"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(marker)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) and spark.read.text(marker).first()["value"].split(" ")[0] == digest:
        return False
    df.write.mode("overwrite").parquet(f"{root}/{product}/{as_of}")
    spark.range(1).select(F.lit(f"{digest} {as_of}").alias("value")).coalesce(1).write.mode("overwrite").text(marker)
    return True


def latest(spark: SparkSession, root: str, product: str) -> DataFrame:
    as_of = spark.read.text(f"{root}/{product}/latest").first()["value"].split(" ")[1]
    return spark.read.parquet(f"{root}/{product}/{as_of}")


def bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("longitude").alias("west"), F.min("latitude").alias("south"), F.max("longitude").alias("east"), F.max("latitude").alias("north"))
