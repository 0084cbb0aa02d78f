"""The raw fact bucketed by sensor, for dimensions too large to broadcast.

Beyond the broadcast bound a join of the fact with its sensors would shuffle
the whole fact at every build. Here the fact is landed once by the hash of
``sensor_id`` (months as partitions, buckets within them), the sensor's city
likewise, and Spark joins bucket with bucket: only the load's own rows are
ever exchanged. An upsert rewrites the months it touches, keeping the
buckets. The bucket specification lives in the catalog entry; ``declare``
puts it there again for a session that starts on existing files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cityair import schemas
from cityair.operators.merge import merge_upsert, month_of
from cityair.plans import staging
from cityair.sources import sinks
from cityair.sources.namespaces import _text

KEY = "sensor_id"
FACT = schemas.with_fields(schemas.MEASUREMENTS_DAILY, ("month", StringType()))
PLACES = StructType([f for f in schemas.SENSORS.fields if f.name in (KEY, "location_id")]
                    + [schemas.STG_AIR_QUALITY["city"], schemas.STG_AIR_QUALITY["country"]])


def declare(spark: SparkSession, name: str, schema: StructType, path: str, buckets: int,
            partitions: tuple = ()) -> DataFrame:
    """Catalog entry of a Parquet table at ``path``, bucketed and sorted by
    sensor; files that are there are found, none is touched."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts}"
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {int(buckets)} BUCKETS "
              f"LOCATION {_text(path)}")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def upsert_fact(batch: DataFrame, name: str, buckets: int, through=sinks._plainly) -> list:
    """Upsert readings into the declared fact ``name``: the touched months are
    read with their buckets, merged and written back, one file a month and
    bucket. Not one commit; repeating a batch converges."""
    spark = batch.sparkSession
    inc = batch.withColumn("month", month_of("date_utc")).select(*FACT.fieldNames())
    touched = [r[0] for r in inc.select("month").distinct().collect()]
    table = spark.table(name)
    old = table.where(F.col("month").isin(touched))
    merged = merge_upsert(old, inc, [KEY, "date_utc"])
    staged = sinks.materialize(merged, "bucket_stage", partition_by=("month",))

    def write(df: DataFrame) -> None:
        # Tasks by bucket, as the table's hash has them: a file a month and bucket.
        (df.select(*FACT.fieldNames()).repartition(int(buckets), KEY).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").insertInto(name))

    through(staged, write)
    return touched


def replace_places(sensors: DataFrame, locations: DataFrame, name: str, buckets: int) -> None:
    """Write the sensors' cities (``staging.sensor_cities``) into the declared
    table ``name``."""
    dim = staging.sensor_cities(sensors, locations)
    dim = sinks.materialize(dim.select(*PLACES.fieldNames()), "places_stage")
    dim.repartition(int(buckets), KEY).write.mode("overwrite").insertInto(name)


def staged(spark: SparkSession, fact: str, places: str, weights: DataFrame) -> DataFrame:
    """Staging over the co-located tables: no exchange of the fact."""
    return staging.stg_air_quality(spark.table(fact), None, None, weights,
                                   dim=spark.table(places))
