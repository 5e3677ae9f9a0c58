"""Packed landing container: millions of small landed documents in few large files, bytes untouched.

A container is a folder of Parquet files, one sub-folder per bucket of
(source, record key).  The bucket follows from the key alone, so a reader of
one company opens that bucket's folder and nothing else; inside it rows are
sorted by key, so the file footers rule out all row groups but those with the
key.  The payload is a binary column: it is never decoded on the way in, and
its SHA-256 stands beside it.

Container columns: source, record_key, pulled_at, content, sha256, bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.sources.landing import PATH_PATTERN, PULL_STAMP_FORMAT
from dealsieve.sources.tables import _exists

CONTAINER_BUCKETS = 256
DOCUMENT = ["source", "record_key", "pulled_at", "sha256"]      # what tells one landed document from another
CONTAINER_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("record_key", T.StringType()),
    T.StructField("pulled_at", T.TimestampNTZType()), T.StructField("content", T.BinaryType()),
    T.StructField("sha256", T.StringType()), T.StructField("bucket", T.IntegerType())])


def bucket_of(source, record_key, buckets: int = CONTAINER_BUCKETS) -> Column:
    """Bucket of a (source, key); a constant where both are, so that a reader's filter prunes folders."""
    return F.pmod(F.xxhash64(source, record_key), F.lit(buckets)).cast("int")


def read_files(spark: SparkSession, root: str, sources: Sequence[str] | None = None) -> DataFrame:
    """(source, record_key, pulled_at, content) of the landed files, as bytes; other file names are left out.

    A file of no bytes holds no document: Spark's file scan passes over it,
    here as in ``read_landing``.
    """
    root = root.rstrip("/")
    paths = [f"{root}/{s}/*.json" for s in sources] if sources else [f"{root}/*/*.json"]
    files = spark.read.format("binaryFile").load(paths)
    at = F.try_to_timestamp(F.regexp_extract("path", PATH_PATTERN, 3), F.lit(PULL_STAMP_FORMAT))
    return files.select(F.regexp_extract("path", PATH_PATTERN, 1).alias("source"),
                        F.regexp_extract("path", PATH_PATTERN, 2).alias("record_key"),
                        at.cast("timestamp_ntz").alias("pulled_at"), "content") \
        .where(F.col("pulled_at").isNotNull())


def pack(documents: DataFrame, container: str, buckets: int = CONTAINER_BUCKETS) -> None:
    """Adds (source, record_key, pulled_at, content) rows to a container.

    Documents that the container already holds are left out, so a run that
    was cut off, or that sees the same files again, adds nothing twice; equal
    rows of one call all stay.  The rebalance lets AQE merge small buckets
    into one task and split a bucket with a hot key over several.  A
    container keeps the bucket number it was begun with: pass the same one.
    Null keys and contents are stored as they are.
    """
    spark = documents.sparkSession
    rows = documents.select("source", "record_key", "pulled_at", F.col("content").cast("binary").alias("content")) \
        .withColumn("sha256", F.sha2("content", 256)) \
        .withColumn("bucket", bucket_of("source", "record_key", buckets))
    if _exists(spark, container):
        held = spark.read.schema(CONTAINER_SCHEMA).parquet(container).select(*DOCUMENT).distinct()
        same = [rows[c].eqNullSafe(held[c]) for c in DOCUMENT]
        rows = rows.join(held, same, "left_anti")
    rows.hint("rebalance", "bucket") \
        .sortWithinPartitions("bucket", "source", "record_key", "pulled_at") \
        .write.mode("append").partitionBy("bucket").parquet(container)


def read_packed(spark: SparkSession, container: str, wanted: Sequence[tuple[str, str]] | None = None,
                buckets: int = CONTAINER_BUCKETS) -> DataFrame:
    """(source, record_key, pulled_at, content, sha256) of the container, or of the ``wanted`` (source, key) pairs.

    The wanted pairs are a reader's few; their buckets become a partition
    filter and their keys a filter on the sorted row groups.  The read fails
    where a content does not have its stored hash.
    """
    rows = spark.read.schema(CONTAINER_SCHEMA).parquet(container)
    if wanted is not None:
        hit = F.lit(False)
        for source, key in wanted:
            hit = hit | ((F.col("bucket") == bucket_of(F.lit(source), F.lit(key), buckets))
                         & (F.col("source") == source) & (F.col("record_key") == key))
        rows = rows.where(hit)
    intact = F.sha2("content", 256).eqNullSafe(F.col("sha256"))
    return rows.select("source", "record_key", "pulled_at",
                       F.when(intact, F.col("content")).otherwise(
                           F.raise_error(F.lit("packed document differs from its stored hash")).cast("binary"))
                       .alias("content"), "sha256")


def latest_packed(packed: DataFrame, keys: Sequence[str] = ("source", "record_key")) -> DataFrame:
    """Latest document per key, ties by content (a partial aggregate, no sort)."""
    best = F.max(F.struct("pulled_at", "content")).alias("b")
    return packed.groupBy(*keys).agg(best).select(*keys, "b.pulled_at", "b.content")
