"""Item usage kept current while interaction files keep landing in a folder.

The batch job recomputes per-item listeners and plays over the whole table. The streamed form reads
new Parquet files as they arrive. It keeps the per-item totals in Structured Streaming state
(checkpointed, so a restarted query resumes where it stopped) and emits changed items each
micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playlens.operators.stats import item_usage

INTERACTION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("track_id", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)


def usage_stream(spark: SparkSession, folder: str, schema: T.StructType = INTERACTION_SCHEMA,
                 max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming (track_id, unique_plays, total_plays) over the Parquet files of ``folder``."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)
    return item_usage(src)


def start_usage_stream(spark: SparkSession, folder: str, output: str, checkpoint: str,
                       available_now: bool = False) -> StreamingQuery:
    """Write the running totals to a Parquet table, rewritten each micro-batch with the full
    current state (``complete`` output through ``foreachBatch``, overwrite = idempotent)."""
    query = usage_stream(spark, folder).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    query = query.foreachBatch(lambda batch, _id: batch.write.mode("overwrite").parquet(output))
    return (query.trigger(availableNow=True) if available_now else query).start()
