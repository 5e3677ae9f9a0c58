"""Register and portal documents flattened into fact tables.

Inputs are (company_number, payload) tables: payload is the JSON document as
landed (see ``sources.landing``).  Parsing uses ``from_json`` with explicit
schemas; flattening uses higher-order array functions and ``explode``, so
every step stays in the JVM and runs per row with no grouping, except the
award tables, which start from one partial aggregate per company and authority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve import schemas as S
from dealsieve.session import stored

# Register kind that marks a corporate controller (fixed value).
CORPORATE_CONTROLLER_KIND = "corporate-entity-person-with-significant-control"


def parse(docs: DataFrame, schema: T.StructType, payload: str = "payload", alias: str = "doc") -> DataFrame:
    """Parse the payload column with an explicit schema.

    A document that is no JSON object parses to null.  The flattening
    functions below skip such documents instead of defaulting their fields;
    ``unreadable`` returns them.
    """
    return docs.withColumn(alias, F.get(_document(payload, schema), F.lit(0))).drop(payload)


def readable(docs: DataFrame, schema: T.StructType, payload: str = "payload", alias: str = "doc") -> DataFrame:
    """The documents that parse, as ``parse`` gives them.  A filter on the parsed column would parse again."""
    return docs.withColumn(alias, F.explode(_document(payload, schema))).drop(payload)


CORRUPT = "_corrupt"


def _document(payload: str, schema: T.StructType):
    """The parsed document in an array, empty where the payload is missing, cut off or not of the schema's types.

    The text is parsed once: the lambdas look at the parsed record, where
    conditions on ``from_json`` itself parse the text for each of their uses.
    """
    checked = F.from_json(F.col(payload), T.StructType([*schema.fields, T.StructField(CORRUPT, S.S)]),
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    whole = F.filter(F.array(checked), lambda c: c.isNotNull() & c[CORRUPT].isNull() & F.col(payload).rlike(r"^\s*\{"))
    return F.transform(whole, lambda c: F.struct(*[c[f.name].alias(f.name) for f in schema.fields]))


def unreadable(docs: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """The documents that do not parse, payload untouched (the quarantine of a document table)."""
    return docs.where(F.size(_document(payload, schema)) == 0)


def filing_records(profiles: DataFrame, officers: DataFrame | None = None,
                   filing_history: DataFrame | None = None) -> DataFrame:
    """One flat row per profiled company: name, address line 1, postcode, incorporation date,
    SIC codes (default []), officer names (default []), filing count (default 0).

    Each input holds one document per company; officers and filing history
    are optional left joins on the company number.
    """
    prof = readable(profiles, S.PROFILE_PAYLOAD, alias="p")
    out = prof.select(
        "company_number",
        F.col("p.company_name").alias("company_name"),
        F.col("p.registered_office_address.address_line_1").alias("registered_address"),
        F.col("p.registered_office_address.postal_code").alias("registered_postcode"),
        F.col("p.date_of_creation").alias("incorporation_date"),
        F.coalesce(F.col("p.sic_codes"), F.array().cast("array<string>")).alias("sic_codes"))
    if officers is not None:
        off = parse(officers, S.OFFICERS_PAYLOAD, alias="o").select(
            "company_number", F.transform("o.items", lambda x: x["name"]).alias("officer_names"))
        out = out.join(off, "company_number", "left")
    else:
        out = out.withColumn("officer_names", F.lit(None).cast("array<string>"))
    if filing_history is not None:
        hist = parse(filing_history, S.FILING_HISTORY_PAYLOAD, alias="h").select(
            "company_number", F.col("h.total_count").alias("filing_count"))
        out = out.join(hist, "company_number", "left")
    else:
        out = out.withColumn("filing_count", F.lit(None).cast("long"))
    return out.select(
        "company_number", "company_name", "registered_address", "registered_postcode", "incorporation_date",
        "sic_codes",
        F.coalesce("officer_names", F.array().cast("array<string>")).alias("officer_names"),
        F.coalesce("filing_count", F.lit(0).cast("long")).alias("filing_count"))


def charges(charge_docs: DataFrame) -> DataFrame:
    """One row per charge; persons-entitled names default to ''; no charge, no row."""
    doc = readable(charge_docs, S.CHARGES_PAYLOAD, alias="d")
    item = doc.select("company_number", F.explode("d.items").alias("c"))
    persons = F.transform(F.coalesce(F.col("c.persons_entitled"), F.array()),
                          lambda p: F.coalesce(p["name"], F.lit("")))
    return item.select(
        "company_number",
        F.col("c.created_on").alias("created_on"),
        F.col("c.status").alias("status"),
        F.col("c.classification.description").alias("classification"),
        persons.cast("array<string>").alias("persons_entitled"),
        F.col("c.particulars.description").alias("description"))


def ownership(controller_docs: DataFrame, corporate_kind: str = CORPORATE_CONTROLLER_KIND) -> DataFrame:
    """Corporate controllers' names and the group flag per company ([] and false when none).

    An unreadable document says nothing about the company, so it gives no row.
    """
    doc = readable(controller_docs, S.CONTROLLERS_PAYLOAD, alias="d")
    items = F.coalesce(F.col("d.items"), F.array().cast(S.CONTROLLERS_PAYLOAD["items"].dataType))
    names = F.transform(F.filter(items, lambda x: x["kind"] == corporate_kind), lambda x: x["name"])
    return doc.select("company_number", names.alias("corporate_controllers")) \
        .withColumn("part_of_group", F.size("corporate_controllers") > 0)


def notices(notice_docs: DataFrame) -> DataFrame:
    """One row per notice, unwrapped: the ``item`` record when present, else the notice itself."""
    doc = readable(notice_docs, S.NOTICES_PAYLOAD, alias="d")
    n = doc.select("company_number", F.explode("d.noticeList").alias("n"))
    unwrapped = F.coalesce(F.col("n.item"), F.struct(F.col("n.awardedDate").alias("awardedDate"),
                                                     F.col("n.organisationName").alias("organisationName")))
    return n.select("company_number", unwrapped.alias("item")) \
        .select("company_number", "item.awardedDate", "item.organisationName")


def _authority_awards(notice_rows: DataFrame) -> DataFrame:
    """(company, authority) pairs with their awards and latest award date: a partial aggregate, so a company
    with a huge history is combined before its rows travel, and pairs travel by both names."""
    awarded = notice_rows.where(F.col("awardedDate").isNotNull() & (F.col("awardedDate") != ""))
    return awarded.select("company_number", "awardedDate", F.coalesce("organisationName", F.lit("")).alias("authority")) \
        .groupBy("company_number", "authority") \
        .agg(F.count(F.lit(1)).alias("award_count"), F.max("awardedDate").alias("most_recent_award_date"))


def award_summary(companies: DataFrame, notice_rows: DataFrame) -> DataFrame:
    """Per company: awards (non-empty award date), latest award date (string order),
    sorted distinct buying authorities (missing name -> '').  Companies with no
    award keep 0 / null / [].  The list is made of the distinct pairs, never of
    notices; ``award_authorities`` is its form as a table, for companies whose
    list is too long for one row.
    """
    per = _authority_awards(notice_rows).groupBy("company_number").agg(
        F.sum("award_count").alias("award_count"),
        F.max("most_recent_award_date").alias("most_recent_award_date"),
        F.sort_array(F.collect_list("authority")).alias("buying_authorities"))
    return companies.select("company_number", "company_name").join(per, "company_number", "left").select(
        "company_number", "company_name",
        F.coalesce("award_count", F.lit(0).cast("long")).alias("award_count"),
        "most_recent_award_date",
        F.coalesce("buying_authorities", F.array().cast("array<string>")).alias("buying_authorities"))


def award_authorities(notice_rows: DataFrame) -> DataFrame:
    """Membership table of buying authorities: (company_number, place, authority, award_count,
    most_recent_award_date), ``place`` counting a company's authorities from 0 in name order.

    Two levels, so that no task ranks a whole company: the distinct pairs are
    dealt into ranges of (company, authority) and stored, places are counted
    inside each range, and a company's earlier ranges are added from one
    count per company and range.  Notices without a company are left out.
    """
    pairs = _authority_awards(notice_rows.where(F.col("company_number").isNotNull()))
    dealt = stored(pairs.repartitionByRange("company_number", "authority")
                   .withColumn("_range", F.spark_partition_id()), "award-authorities")
    held = dealt.groupBy("company_number", "_range").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy("company_number").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("company_number", "_range", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("company_number", "_range").orderBy("authority")
    return dealt.withColumn("_place", F.row_number().over(inside) - 1) \
        .join(offsets, ["company_number", "_range"]) \
        .select("company_number", (F.col("_before") + F.col("_place")).alias("place"), "authority",
                "award_count", "most_recent_award_date")


# Accepted forms of an award date, besides ISO times with or without an offset (which Spark reads itself).
AWARD_TIME_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"]


def award_time(text):
    """The award time as UTC wall time: a date, a local time or a time with an offset; null for any other text."""
    offset = F.col(text).rlike(r"T.*(Z|[+-]\d\d:?\d\d)$")
    local = F.coalesce(*[F.try_to_timestamp(F.col(text), F.lit(f)).cast("timestamp_ntz") for f in AWARD_TIME_FORMATS])
    instant = F.to_utc_timestamp(F.try_to_timestamp(F.col(text)), F.current_timezone()).cast("timestamp_ntz")
    return F.when(offset, instant).otherwise(local)


def undated_awards(notice_rows: DataFrame) -> DataFrame:
    """Notices with an award date that is none (they are in no as-of count)."""
    named = F.col("awardedDate").isNotNull() & (F.col("awardedDate") != "")
    return notice_rows.where(named & award_time("awardedDate").isNull())


def awards_as_of(notice_rows: DataFrame, decisions: DataFrame, key: str = "company_number",
                 decision_date: str = "decision_date") -> DataFrame:
    """Award count and latest award time known at each decision date (the point-in-time
    form of the award summary: an all-time count would leak later awards).

    Awards are first counted per (company, award time) - a partial aggregate,
    so a company with a huge award history is combined map-side - then joined
    to the distinct decisions and summed; every input decision row is kept.
    Dates, local times and times with an offset all count; ``undated_awards``
    returns what is none of these.
    """
    at = award_time("awardedDate")
    awarded = notice_rows.where(F.col("awardedDate").isNotNull() & (F.col("awardedDate") != "")) \
        .select(key, at.alias("award_at")).where(F.col("award_at").isNotNull())
    per_time = awarded.groupBy(key, "award_at").agg(F.count(F.lit(1)).alias("n"))
    wanted = decisions.select(key, decision_date).distinct()
    known = (per_time.join(wanted, key).where(F.col("award_at") <= F.col(decision_date))
             .groupBy(key, decision_date)
             .agg(F.sum("n").alias("award_count"), F.max("award_at").alias("latest_award_at")))
    return decisions.join(known, [key, decision_date], "left").select(
        *decisions.columns, F.coalesce("award_count", F.lit(0)).cast("long").alias("award_count"),
        "latest_award_at")
