"""Incremental ingestion as Structured Streaming.

Landed files are the stream source; each micro-batch is upserted by primary
key into a versioned Parquet snapshot (see ``sources.sinks``). The streaming
checkpoint records which files were already read, so a stopped run resumes
where it stopped and a re-run with no new files does nothing; a late reading
for an old day is an ordinary upsert (no watermark drops it).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cityair.operators.merge import merge_upsert
from cityair.sources import sinks


def upsert_batch(batch: DataFrame, target_base: str, keys: Sequence[str],
                 ts: str = "ingested_at") -> int:
    """Merge one batch into the current snapshot and commit the next version.

    The version number is the committed version + 1: a retried batch whose
    commit never landed rewrites the same version, and a replayed batch that
    did commit re-merges to the same rows, so both are idempotent.
    """
    spark = batch.sparkSession
    current = sinks.current_version(spark, target_base)
    existing = None if current is None else sinks.read_snapshot(
        spark, target_base, batch.schema, current)
    merged = merge_upsert(existing, batch, keys, ts)
    version = 0 if current is None else current + 1
    sinks.write_snapshot(merged, target_base, version)
    return version


def upsert_stream(spark: SparkSession, source_dir: str, schema: StructType,
                  target_base: str, checkpoint_location: str, keys: Sequence[str],
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  fmt: str = "json", ts: str = "ingested_at",
                  max_files_per_trigger: int | None = None,
                  options: dict | None = None, partition_by: tuple | None = None,
                  wait: bool = True,
                  on_batch: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Read new files under ``source_dir`` and upsert them into ``target_base``.

    Runs with ``trigger(availableNow=True)``: everything landed so far is
    processed (in several micro-batches when ``max_files_per_trigger`` is
    set) and the query stops.

    ``partition_by=(column, expression)`` switches the sink from full
    versioned snapshots to a partitioned table where each batch rewrites only
    the partitions it touches (the form to use for a large fact table).
    ``on_batch`` runs after each batch's upsert, before the batch counts as done.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if partition_by:
            sinks.upsert_partitions(batch, target_base, keys, partition_by[0],
                                    partition_by[1], ts)
        else:
            upsert_batch(batch, target_base, keys, ts)
        if on_batch:
            on_batch(batch)

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def stream_pages(spark: SparkSession, pages_dir: str, measurements_path: str, ledger_path: str,
                 checkpoint_location: str, page_rows: int, run_ts=None,
                 max_files_per_trigger: int | None = None,
                 on_batch: Callable[[DataFrame, str], None] | None = None) -> StreamingQuery:
    """Load new page files (``schemas.DAY_PAGE``, JSON lines): each micro-batch
    upserts its readings and then enters its pages in the ledger, so a restart
    after a stop knows finished sensors from half-loaded ones.

    The ledger partition is named after the query and the batch; the query's id
    lives in its checkpoint, so a replayed batch overwrites its own rows and
    another query never does. ``on_batch(batch, load_id)`` runs after both
    (for instance a refresh of the city-day table).
    """
    from cityair import schemas
    from cityair.operators import ledger

    reader = spark.readStream.schema(schemas.DAY_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{own}-{batch_id}"
        ledger.load_pages(batch, measurements_path, ledger_path, load_id, page_rows, run_ts)
        if on_batch is not None:
            on_batch(batch, load_id)

    q = (reader.json(pages_dir).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
