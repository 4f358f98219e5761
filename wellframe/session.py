"""Session, table and working-folder helpers shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wellframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; any of them can be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent on a single machine (master ``local``, as in tests) a local folder is
    made and set; a cluster without it is refused, as its executors share no local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = "file://" + tempfile.mkdtemp(prefix="wellframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder, so lost executors cost only re-reading files."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager)


def cut_estimates(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, and the result also forgets how large the planner thought it would be.

    A checkpoint keeps its plan's estimated size. Joins multiply estimates, so a loop that joins its own
    state would raise them to a power each round, to numbers of any length in the driver's memory.
    """
    held = cut_lineage(df)
    spark = df.sparkSession
    plain = spark._jsparkSession.internalCreateDataFrame(held._jdf.queryExecution().toRdd(), held._jdf.schema(), False)
    return DataFrame(plain, spark)


def spread(df: DataFrame) -> DataFrame:
    """Over as many tasks as there are cores, where the files alone would keep most of them idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
