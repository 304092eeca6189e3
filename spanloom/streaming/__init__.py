"""The stateless part of the pipeline over a stream of documents.

Linking and filtering keep no state across documents, so they run unchanged on
a file stream; folds work on arrays inside one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def document_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).parquet(folder)


def run_available(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Applies ``step`` to what has come since the last run and appends to ``out``; a batch
    that is run again replaces its own files."""

    def put(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
