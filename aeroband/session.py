"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Zone-less timestamps are UTC by convention; epoch values are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Sizes are known only at run time: AQE coalesces small shuffle partitions, splits skewed join
    # partitions and turns a join with a small side into a broadcast join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python call sites in error messages cost several round trips to the JVM per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name="aeroband", master=None, **extra) -> SparkSession:
    """A session with this package's settings; cluster sizing is left to spark-submit or ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares (``spark.checkpoint.dir``).

    Only a local-mode session without that setting falls back to the machine's temporary folder: executors of
    a cluster could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="aeroband-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def written_once(df: DataFrame, **options) -> DataFrame:
    """``df`` as a table in the scratch folder, for results that several later plans read.

    Unlike a cache, the copy survives the loss of executors, and its file size gives Catalyst an estimate. ``options``
    go to the writer.
    """
    path = f"{scratch_folder(df.sparkSession)}/once"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
