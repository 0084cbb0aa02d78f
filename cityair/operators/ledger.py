"""Completion ledger of the paged reading load.

A sensor is finished once its last page was loaded, however many readings it
has: a sensor without readings is finished by one empty page, and one whose
third page failed is not, though it has readings. The ledger therefore keeps
a row a landed page (``schemas.PAGE_LEDGER``), not a fact about readings. It
is appended by the same step that upserts the readings, after them: a stop
in between loads the page again, which the upsert makes harmless.

The ledger is smaller than the fact by the page size. Each load writes its
rows under its own ``load=<id>`` partition and overwrites just that one, so a
retried batch never counts twice; the latest row of a page counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cityair import schemas
from cityair.functions.expressions import count_where
from cityair.operators.merge import newest_first, pick_per_key

FULL, LAST, FAILED = "full", "last", "failed"


def page_envelopes(pages: DataFrame) -> DataFrame:
    """The readings of landed pages, as ``flatten_measurements`` takes them."""
    return pages.select("sensor_id", F.explode("results").alias("reading"), "ingested_at")


def entries(pages: DataFrame, page_rows: int) -> DataFrame:
    """A ledger row for each landed page: ``failed`` with an error or without
    results, ``last`` with fewer than ``page_rows`` readings, else ``full``."""
    rows = F.size("results")
    state = (F.when(F.col("error").isNotNull() | F.col("results").isNull(), FAILED)
              .when(rows < page_rows, LAST).otherwise(FULL))
    return pages.select(
        F.col("sensor_id").cast("long").alias("sensor_id"), F.col("page").cast("int").alias("page"),
        F.coalesce(rows, F.lit(0)).cast("long").alias("rows"), state.alias("state"), "error",
        F.col("ingested_at").cast("timestamp").alias("ingested_at"))


def append(rows: DataFrame, path: str, load_id: str) -> None:
    """Write one load's entries; a retry of the load overwrites them."""
    rows.select(*schemas.PAGE_LEDGER.fieldNames()).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/load={load_id}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's current rows: the latest of each (sensor, page); of equal
    stamps a loaded page counts before a failed one. Empty before any load."""
    schema = schemas.with_fields(schemas.PAGE_LEDGER, ("load", StringType()))
    try:
        logged = spark.read.schema(schema).parquet(path)
    except Exception as e:  # nothing loaded yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e).lower():
            raise
        logged = spark.createDataFrame([], schema)
    return pick_per_key(logged.drop("load"), ["sensor_id", "page"],
                        [newest_first("ingested_at"), (F.col("state") == FAILED).cast("int")])


def progress(ledger: DataFrame) -> DataFrame:
    """A row a sensor: pages and readings loaded, and whether it is finished:
    its last page ``p`` is there and so are all of the pages before it."""
    ok = F.col("state").isin(FULL, LAST)
    # Pages after the last one belong to a longer search of an earlier run.
    ended = ledger.groupBy("sensor_id").agg(
        F.min(F.when(F.col("state") == LAST, F.col("page"))).alias("last_page"))
    upto = F.col("last_page").isNull() | (F.col("page") <= F.col("last_page"))
    return (ledger.join(ended, "sensor_id").groupBy("sensor_id", "last_page").agg(
                count_where(ok & upto).alias("pages_loaded"),
                F.sum(F.when(ok & upto, F.col("rows")).otherwise(0)).alias("rows_loaded"),
                count_where(F.col("state") == FAILED).alias("pages_failed"))
            .withColumn("finished", F.coalesce(F.col("pages_loaded") == F.col("last_page"),
                                               F.lit(False))))


def pending(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidate sensors that are not finished, with what is known of them:
    ``new`` without any page, ``failed`` where a page failed, ``half`` where
    pages are missing. The readings are not touched."""
    p = progress(ledger)
    state = (F.when(F.col("pages_loaded").isNull(), "new")
              .when(F.col("pages_failed") > 0, FAILED).otherwise("half"))
    return (candidates.join(p, "sensor_id", "left")
            .where(~F.coalesce("finished", F.lit(False)))
            .select(*candidates.columns,
                    F.coalesce("pages_loaded", F.lit(0)).cast("long").alias("pages_loaded"),
                    F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded"),
                    state.alias("state")))


def load_pages(pages: DataFrame, measurements_path: str, ledger_path: str, load_id: str,
               page_rows: int, run_ts=None) -> None:
    """One load of landed pages: readings are upserted by key into the
    month-partitioned fact, then the pages are entered in the ledger."""
    from cityair.operators.merge import month_of
    from cityair.sources import payloads, sinks

    days = payloads.flatten_measurements(page_envelopes(pages), run_ts)
    sinks.upsert_partitions(days, measurements_path, ["sensor_id", "date_utc"], "month",
                            month_of("date_utc"))
    append(entries(pages, page_rows), ledger_path, load_id)
