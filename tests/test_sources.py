"""Scans and sinks: optional tables, schema-keeping writes, typed CSV intake, landing zone, failure log."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.sources import landing, register, tables


def test_absent_table_is_none(spark, tmp_dir):
    assert tables.load_table(spark, os.path.join(tmp_dir, "missing")) is None


def test_empty_write_keeps_schema(spark, tmp_dir):
    from dealsieve.schemas import RESOLVED_MATCHES
    path = os.path.join(tmp_dir, "audit")
    tables.write_table(spark.createDataFrame([], RESOLVED_MATCHES), path)
    back = tables.load_table(spark, path)
    assert back.count() == 0 and back.columns == RESOLVED_MATCHES.names


def test_csv_intake_keeps_leading_zeros(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "targets.csv")
    with open(csv, "w") as fh:
        fh.write("company_number,company_name,extra\n00012345,Acme Ltd,x\n,Blank Number,y\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["company_number", "company_name", "extra"]])
    df = tables.csv_to_parquet(spark, csv, schema, os.path.join(tmp_dir, "targets"))
    assert sorted((r.company_number or "") for r in df.collect()) == ["", "00012345"]
    supplied = register.load_supplied_targets(spark, csv)
    assert "extra" in supplied.columns
    assert register.load_supplied_targets(spark, os.path.join(tmp_dir, "none.csv")) is None


def test_route_choice(spark):
    reg = spark.createDataFrame([("00000001", "A", "active", ["41201"], ("PC1", "Leeds"))],
                                "company_number string, company_name string, company_status string, "
                                "sic_codes array<string>, registered_office_address struct<postal_code:string,locality:string>")
    supplied = spark.createDataFrame([("X",)], "company_name string")
    df, route = register.build_candidate_list(supplied, reg, ["41201"], "leeds")
    assert route == register.SUPPLIED_FILE_ROUTE and df.count() == 1
    df, route = register.build_candidate_list(None, reg, ["41201"], "leeds")
    assert route == register.REGISTER_SEARCH_ROUTE and df.first().sic_code == "41201"
    crit = register.selection_criteria(df, route, ["41201"], "leeds", drawn_at="2026-01-01T00:00:00Z").first()
    assert crit.candidate_count == 1 and crit.sic_codes == "41201"


def _land(root, source, key, stamp, payload):
    folder = os.path.join(root, source)
    os.makedirs(folder, exist_ok=True)
    safe = key.lower().replace(" ", "_").replace("/", "_")
    with open(os.path.join(folder, f"{safe}_{stamp}.json"), "w") as fh:
        fh.write(json.dumps(payload))


def test_landing_scan_latest_and_changes(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    _land(root, "charges", "0001", "20240101T000000Z", {"items": []})
    _land(root, "charges", "0001", "20240201T000000Z", {"items": [1]})
    _land(root, "charges", "0001", "20240301T000000Z", {"items": [1]})
    _land(root, "tenders", "Smith/Jones Ltd", "20240101T120000Z", {"noticeList": []})
    raw = landing.read_landing(spark, root)
    assert raw.count() == 4
    latest = {(r.source, r.record_key): r.pulled_at for r in landing.latest_pull(raw).collect()}
    assert latest[("charges", "0001")] == dt.datetime(2024, 3, 1)
    assert ("tenders", "smith_jones_ltd") in latest
    changes = sorted(landing.pull_changes(raw.where(F.col("source") == "charges")).collect(), key=lambda r: r.pulled_at)
    assert [(r.first_pull, r.changed) for r in changes] == [(True, False), (False, True), (False, False)]
    assert landing.read_landing(spark, root, ["tenders"]).count() == 1


def test_failure_log_and_gaps(spark):
    lines = spark.createDataFrame([
        ("20240101T000000Z companies_house_charges 0002 404 Client Error: Not Found",),
        ("20240102T000000Z contracts_finder Smith Jones Ltd HTTP 500 Server Error",),
        ("garbage line",)], "value string")
    fails, broken = landing.parse_failure_log(lines, ["companies_house_charges"], ["contracts_finder"])
    assert fails.count() == 2 and [r.line for r in broken.collect()] == ["garbage line"]
    expected = spark.createDataFrame([("companies_house_charges", "0001"), ("companies_house_charges", "0002"),
                                      ("contracts_finder", "Smith Jones Ltd")], "source string, record_key string")
    landed = spark.createDataFrame([("companies_house_charges", "0001")], "source string, record_key string")
    gaps = {(r.source, r.record_key): r.reason for r in landing.landing_gaps(expected, landed, fails).collect()}
    assert gaps == {("companies_house_charges", "0002"): "404 Client Error: Not Found",
                    ("contracts_finder", "Smith Jones Ltd"): "HTTP 500 Server Error"}


def test_landing_stream_latest_table(spark, tmp_dir):
    from dealsieve.streaming.landing_stream import LatestPullTable, start_latest_pull_table
    root = os.path.join(tmp_dir, "raw")
    _land(root, "charges", "0001", "20240101T000000Z", {"v": 1})
    _land(root, "charges", "0001", "20240105T000000Z", {"v": 2})
    _land(root, "charges", "0002", "20240103T000000Z", {"v": 3})
    table = os.path.join(tmp_dir, "latest")
    q = start_latest_pull_table(spark, root, table, checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    read = lambda: {r.record_key: json.loads(r.payload)["v"] for r in LatestPullTable(spark, table).read().collect()}
    assert read() == {"0001": 2, "0002": 3}
    time.sleep(1)
    _land(root, "charges", "0002", "20240110T000000Z", {"v": 4})
    q = start_latest_pull_table(spark, root, table, checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    assert read() == {"0001": 2, "0002": 4}
    time.sleep(1)
    # Backfills in any order: an older pull of a new key counts, one of a known key does not.
    _land(root, "charges", "0003", "20200101T000000Z", {"v": 5})
    _land(root, "charges", "0001", "20200101T000000Z", {"v": 6})
    q = start_latest_pull_table(spark, root, table, checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    assert read() == {"0001": 2, "0002": 4, "0003": 5}
    # The same pulls again through a new query (a lost checkpoint) change nothing.
    q = start_latest_pull_table(spark, root, table, checkpoint=os.path.join(tmp_dir, "ckpt2"))
    q.awaitTermination(120)
    assert read() == {"0001": 2, "0002": 4, "0003": 5}


def test_failure_lines_belong_to_the_longest_key(spark):
    lines = spark.createDataFrame([("20240102T000000Z cf Smith Jones Ltd HTTP 500 Server Error",)], "value string")
    fails, _ = landing.parse_failure_log(lines, [], ["cf"])
    expected = spark.createDataFrame([("cf", "Smith Jones"), ("cf", "Smith Jones Ltd")], "source string, record_key string")
    landed = spark.createDataFrame([], "source string, record_key string")
    gaps = {r.record_key: r.reason for r in landing.landing_gaps(expected, landed, fails).collect()}
    assert gaps == {"Smith Jones": None, "Smith Jones Ltd": "HTTP 500 Server Error"}
    # The longest key keeps the line even when that key itself has landed.
    landed = spark.createDataFrame([("cf", "Smith Jones Ltd")], "source string, record_key string")
    gaps = {r.record_key: r.reason for r in landing.landing_gaps(expected, landed, fails).collect()}
    assert gaps == {"Smith Jones": None}


def test_csv_intake_quarantines_bad_lines(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "n.csv")
    with open(csv, "w") as fh:
        fh.write("company_number,headcount\n0001,5\n0002,many\n0003,7,extra\n")
    schema = T.StructType([T.StructField("company_number", T.StringType()), T.StructField("headcount", T.LongType())])
    out = tables.csv_to_parquet(spark, csv, schema, os.path.join(tmp_dir, "n"), os.path.join(tmp_dir, "bad"))
    assert [(r.company_number, r.headcount) for r in out.collect()] == [("0001", 5)]
    assert sorted(r.line for r in spark.read.parquet(os.path.join(tmp_dir, "bad")).collect()) == ["0002,many", "0003,7,extra"]
    with pytest.raises(Exception):
        tables.csv_to_parquet(spark, csv, schema, os.path.join(tmp_dir, "n2"))


def test_register_search_is_whole_unless_capped(spark):
    reg = spark.range(700).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"),
                                  F.lit("A").alias("company_name"), F.lit("active").alias("company_status"),
                                  F.array(F.lit("1")).alias("sic_codes"),
                                  F.struct(F.lit("P").alias("postal_code"), F.lit("Leeds").alias("locality"))
                                  .alias("registered_office_address"))
    assert register.register_search(reg, ["1"]).count() == 700
    capped = register.register_search(reg, ["1"], maximum_results=register.MAXIMUM_SEARCH_RESULTS)
    assert capped.count() == 500 and capped.agg(F.max("company_number")).first()[0] == "00000499"


def test_briefs_and_dispatch_log_round_trip(spark, tmp_dir):
    from dealsieve.operators import briefs
    rendered = spark.createDataFrame([("1", "Scored. x"), ("2", "ABSTAINED. y")], "company_number string, brief_text string")
    briefs.write_briefs(rendered, os.path.join(tmp_dir, "briefs"))
    back = tables.load_table(spark, os.path.join(tmp_dir, "briefs"))
    queue = briefs.dispatch_queue(back, spark.createDataFrame([("a@x",)], "recipient string"))
    for _ in range(2):
        briefs.append_dispatch_log(queue, os.path.join(tmp_dir, "log"))
    log = spark.read.parquet(os.path.join(tmp_dir, "log"))
    assert log.columns == ["sent_at", "recipient", "brief", "outcome"]
    assert sorted((r.recipient, r.brief, r.outcome) for r in log.collect()) == 2 * [("a@x", "1", "queued")] + 2 * [
        ("none", "2", "skipped_abstained")]


def test_source_names_are_taken_literally(spark):
    lines = spark.createDataFrame([("20240101T000000Z a.b(c)+ 7 timed out",), ("20240101T000000Z axb(c)+ 7 timed out",)], "value string")
    fails, broken = landing.parse_failure_log(lines, ["a.b(c)+", "a"])
    assert [(r.source, r.record_key, r.reason) for r in fails.collect()] == [("a.b(c)+", "7", "timed out")]
    assert broken.count() == 1
