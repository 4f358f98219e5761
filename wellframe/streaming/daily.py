"""Daily values and running summaries over arriving readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_windows(events: DataFrame, key: str, ts: str, value: str, late: str = "2 days") -> DataFrame:
    """Per key and UTC day: min, max, mean and count; readings later than ``late`` are dropped."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), key).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.count(value).alias("n")
    ).select(key, F.to_date("w.start").alias("day"), "min", "max", "mean", "n")


def merge_summaries(old: DataFrame | None, batch: DataFrame, key: str, value: str) -> DataFrame:
    """Count, extremes and sum per key of the stored summaries and one more batch."""
    new = batch.groupBy(key).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"))
    both = new if old is None else old.select(new.columns).unionByName(new)
    return both.groupBy(key).agg(F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"))


def keep_summaries(events: DataFrame, key: str, value: str, root: str, checkpoint: str):
    """Writer that keeps ``root/<epoch>`` up to date; replaying a batch rewrites the same folder.

    The folder before the last one stays, as a replay starts from it; older ones are removed.
    """

    def upsert(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{root}/{epoch - 1}") if epoch > 0 else None
        merge_summaries(old, batch, key, value).write.mode("overwrite").parquet(f"{root}/{epoch}")
        stale = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{epoch - 2}")
        files = stale.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if epoch > 1 and files.exists(stale):
            files.delete(stale, True)

    return events.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
