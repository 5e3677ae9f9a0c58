"""Table scans and sinks: optional Parquet inputs, typed CSV intake, schema-keeping writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.session import stored


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A module output, or None when the module has not run (an absent table is a normal state)."""
    if not _exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a result table; an empty result is written too, so its schema is kept."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Overwrite a result table bucketed by ``key`` and register it as ``name``; returns the table.

    Rows are dealt by the bucket rule before the write, so a bucket is one
    file.  Tables with the same key and number of buckets are joined on that
    key without an exchange.  For tables of about one row per key: a hot
    key's bucket is one task, which a join through an exchange could split.
    """
    df.repartition(buckets, F.col(key)).write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


CORRUPT = "_corrupt"


def csv_to_parquet(spark: SparkSession, csv_path: str, schema: T.StructType, parquet_path: str,
                   quarantine_path: str | None = None) -> DataFrame:
    """Typed intake: read a headed CSV with an explicit schema (no inference) and store it as Parquet.

    Lines with a value that is not of its column's type, or with another
    number of fields, are stored as text (line) under ``quarantine_path``;
    without one the intake fails on the first such line.
    """
    reader = spark.read.option("header", True)
    if quarantine_path is None:
        write_table(reader.option("mode", "FAILFAST").schema(schema).csv(csv_path), parquet_path)
        return spark.read.parquet(parquet_path)
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = stored(reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                  .schema(marked).csv(csv_path), "csv-intake")
    write_table(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), parquet_path)
    write_table(rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line")), quarantine_path)
    return spark.read.parquet(parquet_path)
