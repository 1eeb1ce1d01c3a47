"""Cleaned snapshots kept up to date from arriving bronze files.

The stream tells which snapshots got new files since the last run; its checkpoint is the
memory of what was seen. Each of those snapshots is then cleaned whole from bronze and
replaced, so a batch that is run again after a failure gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lendstrata.plans.medallion import load_cleaned
from lendstrata.sources.specs import SNAPSHOT, SourceSpec


def refresh_cleaned(
    spark: SparkSession, bronze_path: str, cleaned_path: str, checkpoint: str, spec: SourceSpec
) -> StreamingQuery:
    """Start a query that takes in all bronze files not seen before, then stops.

    Only the partition column of the new files is streamed. The changed snapshots, at most
    as many as the calendar has, become a partition filter on bronze.
    """

    def replace(batch: DataFrame, _: int) -> None:
        changed = [r[SNAPSHOT] for r in batch.distinct().collect()]
        load_cleaned(batch.sparkSession, bronze_path, cleaned_path, spec, changed, reload=True)

    return (
        spark.readStream.schema(spec.raw)
        .parquet(bronze_path)
        .select(SNAPSHOT)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
