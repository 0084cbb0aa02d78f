"""Writers: materialised models, reports, and versioned upsert snapshots.

Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir`` (filled with a scratch folder only when unset, as
in tests), never to a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from cityair.session import checkpoint_dir


def clustered(df: DataFrame, partition_by=()) -> DataFrame:
    """Group rows by their output partition before a partitioned write.

    Without it every task writes one file per partition value it holds
    (tasks x values small files). The ``rebalance`` hint shuffles by the
    partition columns and lets AQE split a hot value into several
    advisory-sized tasks and merge small ones, so files stay few and even.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cityair/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written files,
    not from the raw scans) and lets later readers prune columns and, with
    ``partition_by``, partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = clustered(df, partition_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # Read back with the explicit schema: an empty partitioned write has no
    # files to infer one from.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    w = clustered(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a model back with its explicit schema (an empty partitioned
    write cannot be read without one)."""
    return spark.read.schema(schema).parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Header CSV report in one file. Only for bounded results (one row per
    capital): ``coalesce(1)`` funnels the rows through one task."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# ---- versioned snapshots for the upsert ------------------------------------
COMMITS = StructType([StructField("version", LongType(), False),
                      StructField("committed_at", TimestampType(), True)])


def _commit_dir(base: str) -> str:
    return f"{base.rstrip('/')}/_commits"


def current_version(spark: SparkSession, base: str) -> int | None:
    """Latest committed snapshot version, read from the commit markers
    (a version counts only once its data write finished)."""
    try:
        marks = spark.read.schema(COMMITS).parquet(_commit_dir(base))
        row = marks.agg(F.max("version").alias("v")).first()
    except Exception as e:  # no commit yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e).lower():
            return None
        raise
    return None if row is None or row["v"] is None else int(row["v"])


def read_snapshot(spark: SparkSession, base: str, schema: StructType,
                  version: int | None = None) -> DataFrame | None:
    v = current_version(spark, base) if version is None else version
    if v is None:
        return None
    return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/v={v}")


def _plainly(df: DataFrame, write) -> None:
    write(df)


def write_snapshot(df: DataFrame, base: str, version: int, through=_plainly) -> None:
    """Write snapshot ``version`` then its commit marker. Re-running the same
    version overwrites both, so a retried batch is idempotent.

    ``through(df, write)`` runs the data write; ``loads.Watch`` gives ones that
    count what the write job writes."""
    spark = df.sparkSession
    through(df, lambda d: d.write.mode("overwrite").parquet(f"{base.rstrip('/')}/v={version}"))
    (spark.createDataFrame([(int(version),)], "version long")
          .select("version", F.current_timestamp().alias("committed_at"))
          .write.mode("overwrite").parquet(f"{_commit_dir(base)}/v={version}"))


# ---- partition-scoped upsert -------------------------------------------------
MAX_LISTED_PARTITIONS = 10_000


def upsert_partitions(batch: DataFrame, table_path: str, keys, partition_col: str,
                      partition_expr, ts: str = "ingested_at", through=_plainly) -> list:
    """Upsert ``batch`` into a Parquet table partitioned by ``partition_col``,
    rewriting only the partitions the batch touches.

    ``partition_expr`` derives the partition from the key (e.g. the month of
    ``date_utc``), so a key never moves between partitions. The touched
    partitions are read with partition pruning, merged with the batch,
    staged in the checkpoint folder (Spark cannot overwrite a path it is
    reading) and written back with dynamic partition overwrite; all other
    partitions are left as they are. Re-running a batch converges to the same
    table, so a retry after a failure is safe. It is not one commit: until it
    ends, a reader can see some partitions of the batch and not others.

    ``through(df, write)`` runs the write of the touched partitions (see
    ``write_snapshot``).

    Returns the touched partition values (a short list: one value per month
    present in the batch).
    """
    from cityair.operators.merge import merge_upsert

    spark = batch.sparkSession
    inc = batch.withColumn(partition_col, partition_expr)
    touched_df = inc.select(partition_col).distinct()
    touched = [r[0] for r in touched_df.limit(MAX_LISTED_PARTITIONS + 1).collect()]
    existing = None
    try:
        table = spark.read.schema(inc.schema).parquet(table_path)
        if len(touched) <= MAX_LISTED_PARTITIONS:
            existing = table.where(F.col(partition_col).isin(touched))
        else:  # too many to list: semi-join on the partition column instead
            existing = table.join(touched_df, partition_col, "left_semi")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e).lower():
            raise
    merged = merge_upsert(existing, inc, keys, ts)
    # Staging is only needed when the merge reads the table it overwrites.
    staged = merged if existing is None else materialize(
        merged, "upsert_stage", partition_by=(partition_col,))
    through(staged, lambda d: (
        clustered(d, (partition_col,)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).parquet(table_path)))
    return touched


def existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e).lower():
            raise
        return None


def replace_partitions(df: DataFrame, table_path: str, partition_by, table: DataFrame | None,
                       scope) -> None:
    """Make ``df`` the content of those partitions of a Parquet table that
    satisfy ``scope`` (a predicate on partition columns).

    ``df`` may read the table: it is staged in the checkpoint folder first.
    Partitions with rows are overwritten; those of the scope that have none
    any more are removed, which a dynamic overwrite alone would leave behind.
    Not one commit: a reader can see some partitions replaced before others.
    Repeating the call converges, so a retry after a failure is safe.
    """
    spark = df.sparkSession
    partition_by = list(partition_by)
    staged = materialize(df, "replace_stage", partition_by=tuple(partition_by))
    gone = []
    if table is not None:
        # One row a partition, on either side.
        gone = table.where(scope).select(*partition_by).distinct().exceptAll(
            staged.select(*partition_by).distinct()).collect()
    (clustered(staged, tuple(partition_by)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(table_path))
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog \
        .ExternalCatalogUtils.getPartitionPathString
    for row in gone:
        folder = "/".join(escape(c, row[c]) for c in partition_by)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            f"{table_path.rstrip('/')}/{folder}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# ---- bucketed tables ----------------------------------------------------------
def save_bucketed_table(df: DataFrame, table: str, buckets: int, key: str,
                        partition_by=(), path: str | None = None) -> DataFrame:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Two tables bucketed the same way on the join key join without moving
    either side: the use is the fact and the sensor dimension on
    ``sensor_id`` when the dimension is too large to broadcast. Bucket
    metadata lives in the catalog, so this needs a persistent metastore to
    outlive the session.
    """
    w = df.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
