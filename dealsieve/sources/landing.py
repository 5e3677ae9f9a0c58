"""Raw landing zone: documents kept exactly as pulled, one file per pull.

Layout ``<root>/<source>/<safe key>_<yyyyMMddTHHmmssZ>.json``.  The scan takes
source, key and pull time from the file path (``_metadata.file_path``) and
keeps the payload untouched.  Failed pulls are appended to a text log, one
``<stamp> <source> <key> <reason>`` line each.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealsieve.functions.names import safe_key

PULL_STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
PATH_PATTERN = r"/([^/]+)/([^/]+)_(\d{8}T\d{6}Z)\.json$"


def read_landing(spark: SparkSession, root: str, sources: Sequence[str] | None = None) -> DataFrame:
    """(source, record_key, pulled_at, payload) from the landing folders.

    ``sources`` restricts the scan to those sub-folders (path pruning).
    """
    root = root.rstrip("/")
    paths = [f"{root}/{s}/*.json" for s in sources] if sources else [f"{root}/*/*.json"]
    raw = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return raw.select(
        F.regexp_extract("path", PATH_PATTERN, 1).alias("source"),
        F.regexp_extract("path", PATH_PATTERN, 2).alias("record_key"),
        F.to_timestamp_ntz(F.regexp_extract("path", PATH_PATTERN, 3), F.lit(PULL_STAMP_FORMAT)).alias("pulled_at"),
        F.col("value").alias("payload"))


def parse_failure_log(lines: DataFrame, sources: Sequence[str], spaced_key_sources: Sequence[str] = (),
                      value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(failures, quarantined lines) from failure-log lines.

    Failures are (failed_at, source, record_key, reason, detail).  Sources are
    matched against the known list, so a line is parsed even when the reason
    has spaces.  For sources whose keys are numbers the key is the first word
    after the source.  For sources keyed by names (which may hold spaces) key
    and reason cannot be told apart from the line alone: the key is left null
    and ``detail`` keeps "<key> <reason>" for ``landing_gaps`` to resolve
    against the expected keys.  Lines of any other form, or with a time that
    is none, are returned as (line).
    """
    alternatives = "|".join(re.escape(x) for x in sorted({*sources, *spaced_key_sources}, key=lambda x: (-len(x), x)))
    pattern = rf"^(\d{{8}}T\d{{6}}Z) ({alternatives}) (.*)$"
    at = F.try_to_timestamp(F.regexp_extract(value, pattern, 1), F.lit(PULL_STAMP_FORMAT)).cast("timestamp_ntz")
    parsed = lines.select(F.col(value).alias("line"), at.alias("failed_at"),
                          F.regexp_extract(value, pattern, 2).alias("source"),
                          F.regexp_extract(value, pattern, 3).alias("detail"))
    good = F.coalesce((F.col("source") != "") & F.col("failed_at").isNotNull(), F.lit(False))
    spaced = F.col("source").isin(list(spaced_key_sources)) if spaced_key_sources else F.lit(False)
    first = F.regexp_extract("detail", r"^(\S+)", 1)
    rest = F.regexp_extract("detail", r"^\S+ ?(.*)$", 1)
    failures = parsed.where(good).select("failed_at", "source",
                                         F.when(~spaced, first).alias("record_key"),
                                         F.when(~spaced, rest).alias("reason"),
                                         "detail")
    return failures, parsed.where(~good).select("line")


def latest_pull(raw: DataFrame, keys: Sequence[str] = ("source", "record_key")) -> DataFrame:
    """Latest pull per (source, key), ties broken by payload (a partial aggregate, no sort)."""
    best = F.max(F.struct("pulled_at", "payload")).alias("b")
    return raw.groupBy(*keys).agg(best).select(*keys, "b.pulled_at", "b.payload")


def previous_value(df: DataFrame, keys: Sequence[str], order: str, value: str,
                   bucket=lambda t: F.date_trunc("day", t)) -> DataFrame:
    """Adds ``prev_<value>``: the value of the row just before in ``order`` within ``keys``.

    Two levels so that one very hot key is not sorted in a single task: a lag
    inside (keys, day) partitions, and for each day's first row the last value
    of the latest earlier day, from one summary row per (keys, day).
    Rows with equal ``order`` values are ordered by ``value``.
    """
    k, b = list(keys), "_bucket"
    rows = df.withColumn(b, bucket(F.col(order)))
    inner = Window.partitionBy(*k, b).orderBy(order, value)
    rows = rows.withColumn("_lag", F.lag(value).over(inner))
    days = rows.groupBy(*k, b).agg(F.max(F.struct(order, value)).alias("_last"))
    earlier = Window.partitionBy(*k).orderBy(b)
    days = days.select(*k, b, F.lag("_last").over(earlier).alias("_prev_day"))
    out = rows.join(days, [*k, b], "left")
    return out.withColumn(f"prev_{value}", F.coalesce("_lag", F.col("_prev_day")[value])) \
        .drop("_lag", "_prev_day", b)


def pull_changes(raw: DataFrame) -> DataFrame:
    """Each pull with its payload hash and whether it differs from the previous pull of the record."""
    hashed = raw.select("source", "record_key", "pulled_at", F.md5("payload").alias("payload_hash"))
    prev = previous_value(hashed, ["source", "record_key"], "pulled_at", "payload_hash")
    return prev.select("source", "record_key", "pulled_at", "payload_hash",
                       F.col("prev_payload_hash").isNull().alias("first_pull"),
                       F.coalesce(F.col("prev_payload_hash") != F.col("payload_hash"), F.lit(False)).alias("changed"))


def landing_gaps(expected: DataFrame, landed: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Expected (source, record_key) pairs with no landed pull, with the latest failure if logged.

    Keys are compared through the file-name rule (``safe_key``) of the
    expected key, never by parsing the landed name back.  A failure line of a
    name-keyed source belongs to the longest expected key it begins with.
    """
    exp = expected.select("source", "record_key").distinct().withColumn("_sk", safe_key("record_key"))
    got = landed.select("source", safe_key("record_key").alias("_sk")).distinct()
    gaps = exp.join(got, ["source", "_sk"], "left_anti").drop("_sk")
    if failures is None:
        return gaps.select("source", "record_key", F.lit(None).cast("timestamp_ntz").alias("last_failed_at"),
                           F.lit(None).cast("string").alias("reason"))
    keyed = failures.where(F.col("record_key").isNotNull())
    # Name-keyed lines: a line's possible keys are its prefixes that end before a blank; each is looked up
    # among the expected keys, and the longest that is one is the line's key.
    spaced = failures.where(F.col("record_key").isNull()).select("source", "failed_at", "detail")
    words = F.split("detail", " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, 1, n), " "))
    tried = spaced.where(F.size(words) > 1).select("source", "failed_at", "detail",
                                                   F.explode(prefixes).alias("record_key"))
    resolved = (tried.join(expected.select("source", "record_key").distinct(), ["source", "record_key"])
                .groupBy("source", "failed_at", "detail")
                .agg(F.max_by("record_key", F.length("record_key")).alias("record_key"))
                .select("source", "record_key", "failed_at",
                        F.expr("substring(detail, length(record_key) + 2)").alias("reason")))
    fails = keyed.select("source", "record_key", "failed_at", "reason").unionByName(resolved)
    last = fails.groupBy("source", "record_key").agg(F.max(F.struct("failed_at", "reason")).alias("f"))
    return gaps.join(last, ["source", "record_key"], "left").select(
        "source", "record_key", F.col("f.failed_at").alias("last_failed_at"), F.col("f.reason").alias("reason"))
