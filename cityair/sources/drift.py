"""Drift of landed payloads against the schemas they are read with.

The typed readers keep the fields they know; a field that the source adds is
left out and one whose type changes reads as NULL or as a malformed record.
Here the same lines are parsed as VARIANT beside them, and every field that
occurs is counted by its path and type, level by level: an object's fields
and and an array's elements are the next level's rows. The counts are combined in
the tasks; the report has a row a path and type, whatever the input. Lines are
parsed once a level, which is as deep as the payload nests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, IntegralType,
                               NumericType, StructType, TimestampType)

from cityair.sources.sinks import materialize

MAX_DEPTH = 12
REPORT = ("path", "found", "records", "expected", "status")


def expected_types(schema: DataType, path: str = "") -> dict[str, str]:
    """Field path -> type a schema expects, nested ones included; an array's
    elements are at ``path[]``."""
    if isinstance(schema, StructType):
        out = {path: "OBJECT"} if path else {}
        for f in schema.fields:
            out |= expected_types(f.dataType, f"{path}.{f.name}" if path else f.name)
        return out
    if isinstance(schema, ArrayType):
        return {path: "ARRAY", **expected_types(schema.elementType, f"{path}[]")}
    if isinstance(schema, BooleanType):
        return {path: "BOOLEAN"}
    if isinstance(schema, IntegralType):
        return {path: "INTEGER"}
    if isinstance(schema, NumericType):
        return {path: "NUMBER"}
    if isinstance(schema, (DateType, TimestampType)):
        return {path: "STRING"}  # JSON has them as text
    return {path: "STRING"}


def _kind(v):
    """The JSON type of a variant."""
    text = F.schema_of_variant(v)
    return (F.when(text.startswith("OBJECT"), "OBJECT").when(text.startswith("ARRAY"), "ARRAY")
             .when(text == "BIGINT", "INTEGER")
             .when(text.startswith("DECIMAL") | (text == "DOUBLE") | (text == "FLOAT"), "NUMBER")
             .when(text == "VOID", "NULL").otherwise(text))


def field_counts(lines: DataFrame, column: str = "value", max_depth: int = MAX_DEPTH) -> DataFrame:
    """(path, found, records): how often each field occurs with each JSON type
    in the objects that the text ``column`` holds. Text that is no JSON counts
    as path ``''`` of type ``MALFORMED``."""
    spark = lines.sparkSession
    v = F.try_parse_json(F.col(column))
    level = lines.where(F.col(column).isNotNull()).select(F.lit("").alias("path"), v.alias("v"))
    found = None
    for _ in range(max_depth):
        kind = F.when(F.col("v").isNull(), "MALFORMED").otherwise(_kind(F.col("v")))
        typed = level.select("path", kind.alias("found"), "v")
        counts = typed.groupBy("path", "found").agg(F.count(F.lit(1)).alias("records"))
        counts = materialize(counts, "field_counts")  # a row a path and type
        found = counts if found is None else found.unionByName(counts)
        deeper = typed.where("found IN ('OBJECT', 'ARRAY')")
        if counts.where("found IN ('OBJECT', 'ARRAY')").isEmpty():
            break
        inner = deeper.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(
            "key", F.col("value").alias("inner")))
        path = (F.when(F.col("found") == "ARRAY", F.concat("path", F.lit("[]")))
                 .when(F.col("path") == "", F.col("key"))
                 .otherwise(F.concat("path", F.lit("."), "key")))
        level = inner.select(path.alias("path"), F.col("inner").alias("v"))
    return found


def drift_report(lines: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Fields of landed lines that differ from ``schema``: ``added`` ones that it
    doesn't name, ``retyped`` ones of another JSON type, ``malformed`` lines.

    An integer where a number is expected, and null anywhere, are no drift.
    What lies below an added or retyped field is reported with its own path.
    """
    spark = lines.sparkSession
    known = spark.createDataFrame([("", "OBJECT"), *expected_types(schema).items()],
                                  "path string, expected string")
    counts = field_counts(lines, column)
    same = (F.col("found") == F.col("expected")) | (F.col("found") == "NULL") | (
        (F.col("found") == "INTEGER") & (F.col("expected") == "NUMBER"))
    status = (F.when(F.col("found") == "MALFORMED", "malformed")
               .when(F.col("expected").isNull(), "added").when(~same, "retyped"))
    # ``known`` has a row a field of one schema: its size is fixed.
    return (counts.join(F.broadcast(known), "path", "left").withColumn("status", status)
                  .where("status IS NOT NULL").select(*REPORT))


def read_with_drift(spark: SparkSession, path, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The typed scan of landed JSON lines and, beside it, their drift report."""
    return spark.read.schema(schema).json(path), drift_report(spark.read.text(path), schema)
