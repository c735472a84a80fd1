"""Chapters as they arrive: a file stream runs the batch transforms and appends what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import EXTRACTION
from ..sources.writers import append_new


def follow(spark: SparkSession, source: str, target: str, state: str, transform: Callable[[DataFrame], DataFrame], keys: list[str], files_per_batch: int = 1000) -> StreamingQuery:
    """Process the extraction files that have arrived under ``source``, and stop; call again for later ones.

    Files already processed are known from ``state``; a batch run twice after a failure appends nothing twice, as rows whose
    ``keys`` are in ``target`` are left out. ``transform`` gets the extractions with ``_source_file``.
    """
    from pyspark.sql import functions as F

    arrived = spark.readStream.schema(EXTRACTION).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).json(source)

    def batch(df: DataFrame, _: int) -> None:
        append_new(transform(df), target, keys)

    named = arrived.withColumn("_source_file", F.col("_metadata.file_path"))
    return named.writeStream.foreachBatch(batch).option("checkpointLocation", state).trigger(availableNow=True).start()
