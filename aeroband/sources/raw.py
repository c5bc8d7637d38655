"""Raw tables: append-only Parquet, partitioned by the date of ingest, with the schema in a file beside the batches: an
empty batch leaves no Parquet file that could tell it."""

import json
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.sources.files import Folder

PARTITION = "ingest_date"
SCHEMA_FILE = "_schema.json"


def append_raw(df: DataFrame, path: str) -> None:
    """Add one batch. Earlier batches, also of the same day, are never touched, so history only grows."""
    folder = Folder(df.sparkSession, path)
    if not folder.exists(SCHEMA_FILE):
        folder.write_text(SCHEMA_FILE, df.schema.json())
    dated = df.withColumn(PARTITION, F.col("ingested_at").cast("date"))
    dated.write.mode("append").partitionBy(PARTITION).parquet(path)


def read_raw(
    spark: SparkSession, path: str, schema: T.StructType | None = None, since: date | None = None
) -> DataFrame:
    """All batches, duplicates included, or those ingested on or after a date.

    Without ``schema``, that of the first batch is taken, empty or not. Nothing is inferred from files.
    """
    if schema is None:
        schema = T.StructType.fromJson(json.loads(Folder(spark, path).read_text(SCHEMA_FILE)))
    with_partition = T.StructType([*schema.fields, T.StructField(PARTITION, T.DateType())])
    df = spark.read.schema(with_partition).parquet(path)
    if since is not None:
        df = df.filter(F.col(PARTITION) >= F.lit(since))
    return df.select(*schema.names)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, typed."""
    return spark.createDataFrame([], schema)


def union_raw(*batches: DataFrame) -> DataFrame:
    """All batches under one another, duplicates kept."""
    return reduce(DataFrame.unionByName, batches)
