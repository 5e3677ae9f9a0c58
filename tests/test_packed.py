"""Packed landing container, and the membership table of buying authorities."""

import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dealsieve.operators import facts
from dealsieve.sources import landing, packed

FILES = {("charges", "0001", "20240101T000000Z"): b'{"items": []}',
         ("charges", "0001", "20240301T000000Z"): b"\xff\xfe broken \x00 bytes",
         ("charges", "0002", "20240101T000000Z"): b" ",
         ("tenders", "smith_ltd", "20240102T120000Z"): "{\"n\": \"é\"}\r\n".encode(),
         ("tenders", "0001", "20240105T000000Z"): b"x" * 3_000_000}


def land(root, files):
    for (source, key, stamp), payload in files.items():
        os.makedirs(os.path.join(root, source), exist_ok=True)
        with open(os.path.join(root, source, f"{key}_{stamp}.json"), "wb") as fh:
            fh.write(payload)


def held(rows):
    return Counter((r.source, r.record_key, r.pulled_at.strftime("%Y%m%dT%H%M%SZ"), bytes(r.content), r.sha256)
                   for r in rows.collect())


def test_files_packed_and_read_back(spark, tmp_dir):
    root, box = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "box")
    land(root, FILES)
    # Neither is a document: a name without a time, and a file of no bytes.
    land(root, {("charges", "no-stamp", "later"): b"{}", ("charges", "0003", "20240101T000000Z"): b""})
    packed.pack(packed.read_files(spark, root), box)
    want = Counter((*name, data, hashlib.sha256(data).hexdigest()) for name, data in FILES.items())
    assert held(packed.read_packed(spark, box)) == want
    # The same files and a new one: only the new one is added.
    new = {("charges", "0002", "20240401T000000Z"): b"new"}
    land(root, new)
    packed.pack(packed.read_files(spark, root), box)
    want += Counter((*name, data, hashlib.sha256(data).hexdigest()) for name, data in new.items())
    assert held(packed.read_packed(spark, box)) == want
    assert held(packed.read_packed(spark, box, [("charges", "0002"), ("tenders", "none")])) == \
        Counter({k: v for k, v in want.items() if k[:2] == ("charges", "0002")})
    latest = {(r.source, r.record_key): bytes(r.content) for r in
              packed.latest_packed(packed.read_packed(spark, box)).collect()}
    assert latest[("charges", "0001")] == b"\xff\xfe broken \x00 bytes" and latest[("charges", "0002")] == b"new"


def test_one_company_opens_its_bucket_only(spark, tmp_dir):
    box = os.path.join(tmp_dir, "box")
    rows = spark.range(2000).select(F.lit("charges").alias("source"), F.col("id").cast("string").alias("record_key"),
                                    F.lit("2024-01-01").cast("timestamp_ntz").alias("pulled_at"),
                                    F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    packed.pack(rows, box, 16)
    one = packed.read_packed(spark, box, [("charges", "77")], 16)
    assert [bytes(r.content) for r in one.collect()] == [b"77"]
    plan = one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pruned = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "bucket" in pruned and "EqualTo(record_key,77)" in pushed
    assert packed.read_packed(spark, box).count() == 2000


def test_repeats_nulls_and_nothing(spark, tmp_dir):
    schema = "source string, record_key string, pulled_at timestamp_ntz, content binary, bucket string"
    box = os.path.join(tmp_dir, "box")
    rows = spark.createDataFrame([("s", "k", None, None, "own"), ("s", "k", None, None, "own"),
                                  (None, None, None, bytearray(b"a"), None)], schema)
    packed.pack(rows, box)
    packed.pack(rows, box)
    assert packed.read_packed(spark, box).count() == 3
    empty = os.path.join(tmp_dir, "empty")
    packed.pack(rows.limit(0), empty)
    assert packed.read_packed(spark, empty).count() == 0


def test_a_changed_container_fails(spark, tmp_dir):
    box = os.path.join(tmp_dir, "box")
    spark.createDataFrame([("s", "k", None, bytearray(b"changed"), "0" * 64, 3)], packed.CONTAINER_SCHEMA) \
        .write.partitionBy("bucket").parquet(box)
    with pytest.raises(Exception, match="stored hash"):
        packed.read_packed(spark, box).collect()


def test_container_and_landing_scan_agree(spark, tmp_dir):
    root, box = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "box")
    land(root, {k: v for k, v in FILES.items() if b"\xff" not in v})
    packed.pack(packed.read_files(spark, root), box)
    boxed = packed.read_packed(spark, box).select("source", "record_key", "pulled_at",
                                                  F.decode("content", "UTF-8").alias("payload"))
    raw = landing.read_landing(spark, root)
    assert boxed.exceptAll(raw).count() == 0 and raw.exceptAll(boxed).count() == 0


def test_authorities_of_a_huge_company(spark):
    """A company with a third of all notices and thousands of authorities is ranked in several tasks."""
    hot = spark.range(30_000).select(F.lit("hot").alias("company_number"), F.lit("2024-01-01").alias("awardedDate"),
                                     F.concat(F.lit("Body "), (F.col("id") % 5000).cast("string")).alias("organisationName"))
    rest = spark.range(60_000).select((F.col("id") % 900).cast("string").alias("company_number"),
                                      F.lit("2024-02-01").alias("awardedDate"),
                                      F.when(F.col("id") % 7 > 0, F.concat(F.lit("Body "), F.col("id") % 4))
                                      .alias("organisationName"))
    odd = spark.createDataFrame([("1", None, "Z"), ("1", "", "Z"), (None, "2024-01-01", "Z")],
                                "company_number string, awardedDate string, organisationName string")
    rows = hot.unionByName(rest).unionByName(odd)
    got = {}
    for r in facts.award_authorities(rows).collect():
        got.setdefault(r.company_number, []).append((r.place, r.authority, r.award_count))
    plain = {}
    for r in rows.collect():
        if r.company_number is not None and r.awardedDate:
            plain.setdefault(r.company_number, Counter())[r.organisationName or ""] += 1
    assert {c: [(i, a, n[a]) for i, a in enumerate(sorted(n))] for c, n in plain.items()} == \
        {c: sorted(v) for c, v in got.items()}
    companies = spark.createDataFrame([("hot", "Hot"), ("1", "One")], "company_number string, company_name string")
    lists = {r.company_number: r for r in facts.award_summary(companies, rows).collect()}
    assert lists["hot"].buying_authorities == sorted(plain["hot"]) and lists["hot"].award_count == 30_000
    assert facts.award_authorities(odd).count() == 0
