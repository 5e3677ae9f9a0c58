"""Incremental landing zone: new raw pulls as a Structured Streaming file source.

Each micro-batch parses source, key and pull time from the file path and
merges the batch into a latest-pull table.  Pulls may land in any order: there
is no event-time watermark, so a late or backfilled pull is never dropped.  The
merge is a max over (pull time, payload), which is idempotent, so a repeated
file or a batch run again after a failure gives the same table and no
duplicate state has to be kept.

The table is kept as ``BUCKETS`` key buckets.  A batch rewrites only the
buckets it touches, each into a new version folder, and then moves a small
pointer file to the new set of versions; a reader sees the old set or the new
one, never a mixture, and a crash before the move leaves the old table whole.
Folders that a merge replaced are removed by the merge after it, so a reader
that took the pointer just before a move still finds its files.

Query progress lives under the checkpoint location, which must be shared
storage on a cluster.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dealsieve.session import checkpoint_dir
from dealsieve.sources.landing import PATH_PATTERN, PULL_STAMP_FORMAT, latest_pull

BUCKETS = 64
TABLE_SCHEMA = "source string, record_key string, pulled_at timestamp_ntz, payload string"
POINTER = "current.json"


def landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """Streaming (source, record_key, pulled_at, payload) over ``<root>/<source>/*.json``."""
    raw = (spark.readStream.format("text").option("wholetext", True)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .load(f"{root.rstrip('/')}/*/*.json")
           .select("value", F.col("_metadata.file_path").alias("path")))
    return raw.select(
        F.regexp_extract("path", PATH_PATTERN, 1).alias("source"),
        F.regexp_extract("path", PATH_PATTERN, 2).alias("record_key"),
        F.to_timestamp_ntz(F.regexp_extract("path", PATH_PATTERN, 3), F.lit(PULL_STAMP_FORMAT)).alias("pulled_at"),
        F.col("value").alias("payload"))


class LatestPullTable:
    """A latest-pull table: bucket folders by version, and a pointer to the current ones."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._at = lambda name: jvm.Path(f"{self.path}/{name}")
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _current(self) -> tuple[dict[int, str], list[str]]:
        """Folder of each bucket that has rows, and the folders that the last merge replaced."""
        if not self._files.exists(self._at(POINTER)):
            return {}, []
        stored = json.loads(self.spark.read.text(f"{self.path}/{POINTER}", wholetext=True).first().value)
        return {int(k): v for k, v in stored["folders"].items()}, stored["replaced"]

    def _point_to(self, folders: dict[int, str], replaced: list[str], version: str) -> None:
        """Write the next pointer beside the current one, then rename it into place."""
        fresh = self._at(f"_next-{version}.json")
        out = self._files.create(fresh, True)
        out.write(json.dumps({"folders": folders, "replaced": replaced}).encode())
        out.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._at("").toUri(), self.spark._jsc.hadoopConfiguration())
        renames = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        renames[0] = options
        context.rename(fresh, self._at(POINTER), renames)

    def read(self) -> DataFrame:
        """The current table."""
        folders = sorted(self._current()[0].values())
        reader = self.spark.read.schema(TABLE_SCHEMA)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else \
            self.spark.createDataFrame([], TABLE_SCHEMA)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Fold a batch into the buckets its keys fall into."""
        bucket = F.pmod(F.xxhash64("source", "record_key"), F.lit(BUCKETS)).cast("int")
        rows = batch.select("source", "record_key", "pulled_at", "payload").withColumn("bucket", bucket)
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())      # at most BUCKETS numbers
        if not touched:
            return
        current, outdated = self._current()
        old = [f"{self.path}/{current[b]}" for b in touched if b in current]
        if old:
            rows = rows.unionByName(self.spark.read.schema(TABLE_SCHEMA).parquet(*old).withColumn("bucket", bucket))
        version = f"batch-{batch_id:09d}-{uuid.uuid4().hex}"     # a batch run again writes a folder of its own
        latest_pull(rows, ("bucket", "source", "record_key")) \
            .write.partitionBy("bucket").parquet(f"{self.path}/{version}")
        now = current | {b: f"{version}/bucket={b}" for b in touched}
        self._point_to(now, [current[b] for b in touched if b in current], version)
        for folder in outdated:
            self._files.delete(self._at(folder), True)


def start_latest_pull_table(spark: SparkSession, root: str, table_path: str, checkpoint: str | None = None,
                            available_now: bool = True) -> StreamingQuery:
    """Run the landing stream into the latest-pull table (read it with ``LatestPullTable(...).read()``).

    ``available_now`` processes everything present and stops (batch-like
    backfill); otherwise it keeps running with the default trigger.
    """
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/landing_stream"

    def fold(batch: DataFrame, batch_id: int) -> None:
        LatestPullTable(batch.sparkSession, table_path).merge(batch, batch_id)
    writer = landing_stream(spark, root).writeStream.foreachBatch(fold).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
