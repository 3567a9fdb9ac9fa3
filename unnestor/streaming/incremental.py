"""Incremental load: new dump files as they arrive, through the batch load.

A Structured Streaming file source watches a folder of line-per-row dumps;
each micro-batch of documents goes through ``load_database`` in upsert mode,
so a document that arrives again replaces its earlier version in every table.
Replaying a micro-batch after a failure gives the same tables (keys are
derived from the data and the upsert is idempotent), and the stream's
progress is kept in the shared checkpoint folder.

Child rows are upserted by their keys like every other row: when a new
version of a document has fewer array elements, the rows of the positions it
no longer has are kept (a full refresh replaces them). Parquet has no
row-level update, so each micro-batch rewrites the tables it touches; this
suits modest increments on top of a full load.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.catalog import Catalog
from ..plans.pipeline import load_database
from ..plans.staging import checkpoint_root
from ..sinks.tables import Store
from ..sources.documents import document_lines


def start_incremental_load(
    spark: SparkSession,
    source_dir: str,
    catalog: Catalog,
    root: str,
    store: Store,
    quarantine: Store | None = None,
    order_by: str | Sequence[str] | None = None,
    mode: str = "strict",
    available_now: bool = False,
    processing_time: str | None = "1 minute",
    max_files_per_trigger: int | None = None,
    checkpoint_location: str | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query (``available_now=True``
    processes what is there and stops)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = document_lines(reader.load(source_dir), mode=mode)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_database(batch, catalog, root, store, mode=mode, load_mode="upsert",
                      order_by=order_by, quarantine=quarantine)

    location = checkpoint_location or f"{checkpoint_root(spark)}/unnestor-streams/{root}"
    writer = docs.writeStream.foreachBatch(load_batch).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.queryName(f"unnestor_{root}".replace("-", "_")).start()
