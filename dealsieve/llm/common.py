"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the word rules, as a regular expression class (fixed value).
WHITE = r"[\x20\x09-\x0D]+"


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to the Python workers by value, so they need no package install."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def _worker_store() -> dict[str, tuple[Any, Any]]:
    """What this Python worker keeps from task to task; Spark reuses its workers, a new one begins with nothing."""
    return vars(sys.modules.setdefault("_dealsieve_worker", types.ModuleType("_dealsieve_worker"))) \
        .setdefault("kept", {})


def from_worker(kind: str, key: Any) -> Any:
    """Take the object that an earlier task of this worker left under ``kind`` and ``key``, or None.

    It is taken out, so a task that fails half-way leaves nothing behind.
    """
    held, kept = _worker_store().pop(kind, (None, None))
    return kept if held == key else None


def to_worker(kind: str, key: Any, kept: Any) -> None:
    """Leave an object to the worker's next task; a worker keeps one object of each kind."""
    _worker_store()[kind] = key, kept


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session (tests, one machine) without that setting gets a private
    temporary folder; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks of the stage
    that runs, and every later step reads the table instead of recomputing it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """The table itself, with the session's Arrow batches held to ``BATCH_BYTES``.

    By default a batch holds 10,000 rows whatever their size; rows with long
    texts need a bound in bytes.  Results do not depend on it.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key, None) or ""
    if now[:-1].isdigit() and int(now[:-1]) > BATCH_BYTES:
        conf.set(key, f"{BATCH_BYTES}b")
    return df


def text_or_empty(column: str = "text"):
    """The text column with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


ship_by_value(__name__)
