"""The daily refresh, driven by files: each run takes the raw batches of readings and of weather that landed since the
last one.

The raw table is the only state, as late and corrected readings are settled by keeping the newest ingest; so no
watermark is needed, and a restarted run continues from its checkpoint.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aeroband.plans.pipeline import Layout, date_of, refresh_touched
from aeroband.schemas import READINGS, WEATHER
from aeroband.session import written_once
from aeroband.sources.raw import PARTITION


def refresh_new_batches(spark: SparkSession, layout: Layout, checkpoint: str, publish: bool = True) -> int:
    """Refresh the dates touched by batches of either raw table that are new since the last call, then stop.

    The dates are those of the new rows themselves, so weather alone starts a refresh, and it does not matter in what
    order, or how late, the two tables were ingested.

    Returns the number of micro-batches that held rows. The models must have been built once.
    """
    refreshed = 0

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        nonlocal refreshed
        dates = written_once(batch.distinct())
        if dates.count():
            refresh_touched(spark, layout, dates, publish)
            refreshed += 1

    def landed(path: str, schema: T.StructType) -> DataFrame:
        dated = T.StructType([*schema.fields, T.StructField(PARTITION, T.DateType())])
        return date_of(spark.readStream.schema(dated).parquet(path))

    query = (
        landed(layout.readings, READINGS).union(landed(layout.weather, WEATHER)).writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return refreshed
