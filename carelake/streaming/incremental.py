"""Scheduled increments as a Structured Streaming run.

Each run takes the resource files that arrived since the last one and ends
(``availableNow``).  The stream checkpoint replaces the high-water mark.  A
micro-batch is appended to a store as one generation that carries the batch number:
it writes the rows it brings and nothing else, and a batch that is repeated after
its commit is recognised and left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from carelake.operators.generations import Store
from carelake.plans import jobs
from carelake.sources import schemas


def load_batch(resource: str, batch: DataFrame, batch_id: int, target: Store, as_of=None) -> dict | None:
    """Append one micro-batch; None if it was committed before.

    The checkpoint already decides what is new; versions still guard against old copies.
    """
    return jobs.load_increment(resource, batch, target, as_of, backdate_days=None, batch=batch_id)


def run_increments(
    spark: SparkSession, resource: str, source: str, target: Store, checkpoint: str,
    file_format: str = "json", as_of=None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load all new files below ``source`` into a store that was created before."""
    reader = spark.readStream.schema(schemas.resource_schema(resource)).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(source).writeStream
        .foreachBatch(lambda batch, batch_id: load_batch(resource, batch, batch_id, target, as_of))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
