"""Views that map the driver's generic tables onto this library's domain tables.

Every view is a lazy DataFrame over the parquet files, so column pruning and
filter pushdown reach the scan.  Constants below shape the test views; the
matching oracle SQL in ``plans.oracle`` uses the same values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Decision dates used by the point-in-time views (fixed values).
DECISION_DATES = ["1997-01-01", "1999-01-01", "2001-01-01", "2024-01-15"]
# Snapshot date stamped on register facts that carry no date of their own.
OWNERSHIP_SNAPSHOT_DATE = "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def company_id(col: str):
    return F.col(col).cast("string")


# ---------------------------------------------------------------- point in time

def decisions(spark, sf_dir) -> DataFrame:
    """Every ordering customer x the fixed decision dates (a generator, not a join)."""
    customers = table(spark, sf_dir, "orders").select(company_id("o_custkey").alias("company_number")).distinct()
    dates = F.array(*[ntz(d) for d in DECISION_DATES])
    return customers.select("company_number", F.explode(dates).alias("decision_date"))


def filings_facts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        company_id("o_custkey").alias("company_number"), F.col("o_orderdate").alias("fact_date"),
        "o_orderkey", "o_totalprice", "o_orderstatus")


def tenders_facts(spark, sf_dir) -> DataFrame:
    return (table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
            .select(company_id("user_id").alias("company_number"), F.col("ts").alias("fact_date"),
                    "event_id", "value"))


def charges_facts(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .select(company_id("o_custkey").alias("company_number"), F.col("l_shipdate").alias("fact_date"),
                    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))


def ownership_facts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        company_id("c_custkey").alias("company_number"), ntz(OWNERSHIP_SNAPSHOT_DATE).alias("fact_date"),
        "c_mktsegment", "c_nationkey")


FACT_TIE_KEYS = {
    "filings": ["o_orderkey"],
    "tenders": ["event_id"],
    "charges": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    "ownership": [],
}


def fact_tables(spark, sf_dir) -> dict:
    builders = {"filings": filings_facts, "tenders": tenders_facts,
                "charges": charges_facts, "ownership": ownership_facts}
    return {name: (build(spark, sf_dir), FACT_TIE_KEYS[name]) for name, build in builders.items()}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------------------- scores, valuation, validation

def balance_sheets(spark, sf_dir) -> DataFrame:
    """Per-supplier figures summed from its line items.

    EBIT is withheld (null) by suppliers with a negative balance, and suppliers
    of nation 7 file zero total assets, so both score forms and the null
    score are exercised.
    """
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    sums = li.groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.sum("l_extendedprice").alias("gross"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
        F.sum("l_quantity").alias("qty"))
    j = sup.join(sums, sup.s_suppkey == sums.l_suppkey, "left")
    return j.select(
        company_id("s_suppkey").alias("company_number"),
        (F.col("net") - F.col("gross") * 0.5).alias("working_capital"),
        (F.col("s_acctbal") * 10).alias("retained_earnings"),
        F.when(F.col("s_acctbal") >= 0, F.col("disc")).alias("ebit"),
        (F.col("qty") * 10).alias("book_value_of_equity"),
        F.col("tax").alias("total_liabilities"),
        F.when(F.col("s_nationkey") == 7, F.lit(0.0)).otherwise(F.col("gross")).alias("total_assets"))


def headcounts(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return c.select(
        company_id("c_custkey").alias("company_number"),
        company_id("c_nationkey").alias("industry_code"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100) + 1).cast("double").alias("filed_headcount"),
        (F.col("c_acctbal") * ((F.col("c_nationkey") % 5) + 1) * 400).alias("multiples_revenue_estimate"))


def benchmarks(spark, sf_dir) -> DataFrame:
    """Revenue per employee per nation; MIDDLE EAST nations have none, EUROPE nations two."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name") != "MIDDLE EAST")
    first = j.select(company_id("n_nationkey").alias("industry_code"),
                     (F.lit(50000.0) + F.col("n_nationkey") * 1000).alias("revenue_per_employee"),
                     F.lit(1).cast("long").alias("benchmark_order"))
    second = j.where(F.col("r_name") == "EUROPE").select(
        company_id("n_nationkey").alias("industry_code"), F.lit(999.0).alias("revenue_per_employee"),
        F.lit(2).cast("long").alias("benchmark_order"))
    return first.unionByName(second)


def peers(spark, sf_dir) -> DataFrame:
    """Parts as peers, with rare codes: codes that start with 5 keep only parts whose key's digits
    thin them to a handful, so that every peer count from 1 up is met at each prefix length."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    code = F.lpad(((F.col("p_size") * 97) % 1000).cast("string"), 3, "0")
    thinned = F.col("p_partkey") % (F.col("p_size") * 3 + 7) == 0
    return p.where(~F.substring(code, 1, 1).isin("4", "5", "6", "7", "8") | thinned).select(
        code.alias("industry_code"), (F.col("p_retailprice") / 100).alias("multiple"))


def valuation_targets(spark, sf_dir) -> DataFrame:
    """Suppliers with a derived code: nation 0 short codes, nation 1 empty, nation 2 unknown letters,
    nation 3 two rows each."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    code = F.lpad(((F.col("s_suppkey") * 37) % 1000).cast("string"), 3, "0")
    industry = (F.when(F.col("s_nationkey") == 0, F.substring(code, 1, 2))
                .when(F.col("s_nationkey") == 1, F.lit(""))
                .when(F.col("s_nationkey") == 2, F.concat(F.lit("X"), code))
                .otherwise(code))
    first = s.select(company_id("s_suppkey").alias("company_number"), industry.alias("industry_code"),
                     F.col("s_acctbal").alias("scaling_value"))
    # Nation 3 files a second line of business: another code and value under the same number.
    second = s.where(F.col("s_nationkey") == 3).select(
        company_id("s_suppkey").alias("company_number"),
        F.lpad(((F.col("s_suppkey") * 53) % 1000).cast("string"), 3, "0").alias("industry_code"),
        (F.col("s_acctbal") * 2).alias("scaling_value"))
    return first.unionByName(second)


def estimates(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_discount", "l_tax")
    est = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    width = F.when(F.col("l_returnflag") == "R", F.lit(0.10)).otherwise(F.lit(0.05))
    return li.select(F.col("l_returnflag").alias("method_name"), est.alias("estimated_value"),
                     (F.col("l_extendedprice") * (1 - F.col("l_tax"))).alias("filed_value"),
                     (est * (1 - width)).alias("interval_lower"), (est * (1 + width)).alias("interval_upper"))


# ---------------------------------------------------------------- register and portal documents

MKT_SIC = {"AUTOMOBILE": "29100", "BUILDING": "41201", "FURNITURE": "31090",
           "HOUSEHOLD": "47590", "MACHINERY": "28990"}


def _mkt_sic():
    expr = None
    for seg, code in MKT_SIC.items():
        expr = (F.when(F.col("c_mktsegment") == seg, F.lit(code)) if expr is None
                else expr.when(F.col("c_mktsegment") == seg, F.lit(code)))
    return expr


def companies(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.select(company_id("c_custkey").alias("company_number"), F.col("c_name").alias("company_name"))


def profile_docs(spark, sf_dir) -> DataFrame:
    """Register profile per customer; HOUSEHOLD profiles carry no SIC codes."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    sic = F.when(F.col("c_mktsegment") != "HOUSEHOLD",
                 F.array(F.concat(F.lit("4"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")), _mkt_sic()))
    doc = F.struct(
        F.col("c_name").alias("company_name"),
        F.concat(F.lit("19"), (F.col("c_nationkey") + 70).cast("string"), F.lit("-01-15")).alias("date_of_creation"),
        sic.alias("sic_codes"),
        F.struct(F.concat(F.lit("Unit "), F.col("c_custkey").cast("string")).alias("address_line_1"),
                 F.concat(F.lit("PC"), F.col("c_nationkey").cast("string")).alias("postal_code"))
        .alias("registered_office_address"))
    return c.select(company_id("c_custkey").alias("company_number"), F.to_json(doc).alias("payload"))


def officer_docs(spark, sf_dir) -> DataFrame:
    """Officer lists; AUTOMOBILE customers have no officers document at all."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment") \
        .where(F.col("c_mktsegment") != "AUTOMOBILE")
    items = F.array(F.struct(F.concat(F.col("c_name"), F.lit(" director")).alias("name")),
                    F.struct(F.concat(F.lit("Secretary "), F.col("c_mktsegment")).alias("name")))
    return c.select(company_id("c_custkey").alias("company_number"),
                    F.to_json(F.struct(items.alias("items"))).alias("payload"))


def filing_history_docs(spark, sf_dir) -> DataFrame:
    """Filing count per customer = its number of orders; customers without orders have no document."""
    o = table(spark, sf_dir, "orders").select("o_custkey")
    cnt = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_count"))
    return cnt.select(company_id("o_custkey").alias("company_number"),
                      F.to_json(F.struct("total_count")).alias("payload"))


def charge_docs(spark, sf_dir) -> DataFrame:
    """One charges document per order, one charge per line item (an order has at most 7)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                                                 "l_returnflag", "l_linestatus", "l_shipdate")
    charge = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_on"),
        F.when(F.col("l_linestatus") == "O", F.lit("outstanding")).otherwise(F.lit("fully-satisfied")).alias("status"),
        F.when(F.col("l_returnflag") != "N",
               F.struct(F.concat(F.lit("flag "), F.col("l_returnflag")).alias("description"))).alias("classification"),
        F.array(F.struct(F.when(F.col("l_linenumber") != 1,
                                F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string"))).alias("name")))
        .alias("persons_entitled"),
        F.when(F.col("l_quantity") > 25,
               F.struct(F.concat(F.lit("qty "), F.col("l_quantity").cast("int").cast("string")).alias("description")))
        .alias("particulars"))
    per_order = li.groupBy("l_orderkey").agg(F.collect_list(charge).alias("items"))
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey).select(
        company_id("o_custkey").alias("company_number"), F.to_json(F.struct("items")).alias("payload"))


def controller_docs(spark, sf_dir) -> DataFrame:
    """A corporate controller for customers with balance above 5000; always one individual.
    The documents of customers divisible by 50 are cut off (unreadable)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    corp = F.when(F.col("c_acctbal") > 5000, F.struct(
        F.concat(F.col("c_mktsegment"), F.lit(" Holdings")).alias("name"),
        F.lit("corporate-entity-person-with-significant-control").alias("kind")))
    person = F.struct(F.concat(F.lit("Person "), F.col("c_custkey").cast("string")).alias("name"),
                      F.lit("individual-person-with-significant-control").alias("kind"))
    items = F.filter(F.array(corp, person), lambda x: x.isNotNull())
    whole = F.to_json(F.struct(items.alias("items")))
    return c.select(company_id("c_custkey").alias("company_number"),
                    F.when(F.col("c_custkey") % 50 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("payload"))


def notice_docs(spark, sf_dir) -> DataFrame:
    """Every event is a portal notice of its user: purchases and signups are awards
    (signups without an authority name); purchase and view notices come wrapped in ``item``."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "props")
    k = F.get_json_object("props", "$.k")
    awarded = F.col("event_type").isin("purchase", "signup")
    # Four forms of the date, by event: local time, date only, UTC, and an offset of one hour.
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    form = (F.when(F.col("event_id") % 4 == 0, local)
            .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd"))
            .when(F.col("event_id") % 4 == 2, F.concat(local, F.lit("Z")))
            .otherwise(F.concat(local, F.lit("+01:00"))))
    fields = F.struct(F.when(awarded, form).alias("awardedDate"),
                      F.when(F.col("event_type") != "signup", F.concat(F.lit("Authority "), k)).alias("organisationName"))
    wrapped = F.col("event_type").isin("purchase", "view")
    notice = F.struct(F.when(wrapped, fields).alias("item"),
                      F.when(~wrapped, fields["awardedDate"]).alias("awardedDate"),
                      F.when(~wrapped, fields["organisationName"]).alias("organisationName"))
    return e.select(company_id("user_id").alias("company_number"),
                    F.to_json(F.struct(F.array(notice).alias("noticeList"))).alias("payload"))


# ---------------------------------------------------------------- landing zone

LANDING_SOURCES = ["click", "view", "purchase", "signup"]


def raw_pulls(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "props") \
        .where(F.col("event_type").isin(LANDING_SOURCES))
    return e.select(F.col("event_type").alias("source"), company_id("user_id").alias("record_key"),
                    F.col("ts").alias("pulled_at"), F.col("props").alias("payload"))


NAME_SOURCE = "registry"        # a landing source keyed by company names


def landed_pulls(spark, sf_dir) -> DataFrame:
    """The raw pulls without those that failed: users divisible by 5 never landed a click or view."""
    return raw_pulls(spark, sf_dir).where(
        ~((F.col("record_key").cast("long") % 5 == 0) & F.col("source").isin("click", "view")))


def expected_pulls(spark, sf_dir) -> DataFrame:
    """Every customer is expected from every landing source (a generator over a fixed list), and customers
    divisible by 10 under two nested names from the name-keyed source."""
    by_number = companies(spark, sf_dir).select(
        F.explode(F.array(*[F.lit(s) for s in LANDING_SOURCES])).alias("source"),
        F.col("company_number").alias("record_key"))
    nested = companies(spark, sf_dir).where(F.col("company_number").cast("long") % 10 == 0).select(
        F.lit(NAME_SOURCE).alias("source"),
        F.explode(F.array(F.col("company_name"), F.concat("company_name", F.lit(" Ltd")))).alias("record_key"))
    return by_number.unionByName(nested)


def failure_log_lines(spark, sf_dir) -> DataFrame:
    """Error events written as failure-log lines (reasons contain spaces); one line per customer divisible by
    10 names the longer of its two keys, and every 97th error event left a broken line."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts", "props") \
        .where(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k").cast("int")
    source = F.element_at(F.array(*[F.lit(s) for s in LANDING_SOURCES]), (k % 4) + 1)
    reason = F.concat(F.lit("HTTP "), (k % 4 + 500).cast("string"), F.lit(" Server Error"))
    line = F.concat_ws(" ", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), source, F.col("user_id").cast("string"), reason)
    numbered = e.select(F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("broken "), line)).otherwise(line).alias("value"))
    named = companies(spark, sf_dir).where(F.col("company_number").cast("long") % 10 == 0).select(
        F.concat(F.lit(f"20240101T000000Z {NAME_SOURCE} "), "company_name", F.lit(" Ltd HTTP 500 Server Error"))
        .alias("value"))
    return numbered.unionByName(named)


# ---------------------------------------------------------------- register search, websites

SEARCH_SIC_CODES = ["41201", "28990"]
SEARCH_LOCATION = "nation_1"
WEB_TERMS = {
    "open_license": ["mit license", "apache license", "license"],
    "licensed_use": ["licensed under"],
    "tracking_script": ["track("],
    "example_host": ["example.com", "example.org"],
}


# The claim measured by the extractor check, its variants, and the text a hand check finds in the raw page
# (test parameters, chosen so that some claims are wrong and some are missed).
CHECK_TERM = ("claim", ["the and"])
CHECK_LABEL = "and.<"


def register(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("company_number"),
        F.col("c_name").alias("company_name"),
        F.when(F.col("c_acctbal") < 0, F.lit("dissolved")).otherwise(F.lit("active")).alias("company_status"),
        F.array(F.concat(F.lit("4"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")), _mkt_sic()).alias("sic_codes"),
        F.struct(F.concat(F.lit("PC"), F.col("c_nationkey").cast("string")).alias("postal_code"),
                 F.col("n_name").alias("locality")).alias("registered_office_address"))


def web_companies(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.select(company_id("page_id").alias("company_number"),
                    F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("company_name"),
                    F.col("url").alias("website_url"), "html")


# ---------------------------------------------------------------- names and resolution

def name_records(spark, sf_dir) -> DataFrame:
    """Company-like records from documents: the first sentence is the name."""
    from dealsieve.functions.text import first_sentence
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return d.select("doc_id", first_sentence("text").alias("company_name"),
                    F.col("source").alias("postcode"), F.col("lang").alias("sic_code"))


def register_records(spark, sf_dir) -> DataFrame:
    r = name_records(spark, sf_dir)
    return r.select(F.concat(F.lit("DOC"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("company_number"),
                    "company_name", "postcode", "sic_code", F.lit(None).cast("string").alias("website_url"))


def resolution_candidates(spark, sf_dir) -> DataFrame:
    """Planted name variants of the register records, by language: English adds a legal
    suffix, French is upper-cased, German loses its first character, Spanish loses its
    postcode.  Candidates from sources src0 and src1 already carry their number."""
    r = name_records(spark, sf_dir)
    name = (F.when(F.col("sic_code") == "en", F.concat(F.col("company_name"), F.lit(" Ltd")))
            .when(F.col("sic_code") == "fr", F.upper("company_name"))
            .when(F.col("sic_code") == "de", F.expr("substring(company_name, 2)"))
            .otherwise(F.col("company_name")))
    number = F.when(F.col("postcode").isin("src0", "src1"),
                    F.concat(F.lit("DOC"), F.lpad(F.col("doc_id").cast("string"), 7, "0")))
    return r.select(F.col("doc_id").alias("candidate_id"), number.alias("company_number"), name.alias("company_name"),
                    F.when(F.col("sic_code") != "es", F.col("postcode")).alias("postcode"), "sic_code",
                    F.lit(None).cast("string").alias("website_url"))


def resolution_truth(spark, sf_dir) -> DataFrame:
    r = name_records(spark, sf_dir)
    return r.select(F.col("doc_id").alias("candidate_id"),
                    F.concat(F.lit("DOC"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("true_number"))


def given_scores(spark, sf_dir) -> DataFrame:
    """Line items as scored (candidate, reference) pairs: the order is the candidate, the supplier the reference."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_discount")
    return li.select(F.col("l_orderkey").alias("candidate"), F.col("l_suppkey").alias("reference"),
                     F.col("l_linenumber").alias("reference_order"), (F.col("l_discount") * 10).alias("score"))


def given_ratios(spark, sf_dir) -> DataFrame:
    """Customers beside their orders as record pairs with a given name ratio; blanks and nulls in the fields."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    j = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey")
    pc = F.concat(F.lit("PC"), F.col("c_nationkey").cast("string"))
    return j.select(
        "o_orderkey", ((key % 101) / 100.0).alias("ratio"),
        F.when(key % 7 == 0, F.lit(" ")).when(key % 7 != 1, pc).alias("pc_one"),
        F.when(key % 5 == 0, F.lit("PC1")).when(key % 5 != 1, pc).alias("pc_two"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("sic_one"),
        F.when(F.col("o_orderstatus") == "O", F.col("c_mktsegment")).otherwise(F.lit("BUILDING")).alias("sic_two"))


def given_predictions(spark, sf_dir) -> DataFrame:
    """Orders as classified companies: a confidence in hundredths, a predicted and a filed (or missing) code."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return o.select(company_id("o_orderkey").alias("company_number"), F.col("o_orderstatus").alias("predicted_code"),
                    ((F.col("o_orderkey") % 100) / 100.0).alias("confidence"),
                    F.when(F.col("o_orderkey") % 11 != 0, F.when(F.col("o_orderkey") % 4 == 0, F.lit("X"))
                           .otherwise(F.col("o_orderstatus"))).alias("filed_sic_code"))


# ---------------------------------------------------------------- text, credit, similar companies

KEYWORDS = ["the", "and", "de", "der", "que", "license"]
# Words of the text flags that occur in the driver's prose.
FLAG_WORDS = ["not", "no", "nicht", "pas", "never"]
FLAG_PATTERN = "licen"
NEAREST_K = 5
QUERY_STEP = 20          # a search asks for every row whose id is divisible by this


def labelled_text(spark, sf_dir) -> DataFrame:
    """Documents labelled by language; sources src3/src7 file a wrong code, src5 none."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    filed = (F.when(F.col("source").isin("src3", "src7"), F.lit("xx"))
             .when(F.col("source") == "src5", F.lit(None).cast("string")).otherwise(F.col("lang")))
    return d.select(company_id("doc_id").alias("company_number"), F.col("text").alias("website_text"),
                    F.col("lang").alias("industry_code"), filed.alias("filed_sic_code"))


def credit_training(spark, sf_dir) -> DataFrame:
    """Labelled documents as borrowers: length and layout ratios, two text flags, default = low quality."""
    from dealsieve.operators.text_models import text_features
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = lab.join(d, "doc_id")
    feats = text_features(j.select("doc_id", "text"), negative_words=FLAG_WORDS, going_concern_pattern=FLAG_PATTERN)
    return j.join(feats, "doc_id").select(
        "doc_id",
        (F.col("n_chars") / 1000.0).alias("current_ratio"),
        F.try_divide(F.col("n_tokens").cast("double"), F.col("n_chars").cast("double")).alias("gearing"),
        (F.col("n_lines") / 10.0).alias("retained_earnings_to_assets"),
        "report_negative_language_flag", "going_concern_flag",
        (1 - F.col("quality")).alias("defaulted_within_year"))


def auc_scores(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lab.join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        (F.col("n_chars").cast("double") / (F.col("n_chars") + 1000).cast("double")).alias("score"))


def similar_items(spark, sf_dir) -> DataFrame:
    """Parts as companies; every 13th has no size, so it has no distance to any other."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand", "p_type")
    return p.select("p_partkey", F.when(F.col("p_partkey") % 13 != 0, F.col("p_size")).cast("double").alias("size"),
                    (F.col("p_retailprice") / 100).alias("price"), "p_brand", "p_type")


def similar_queries(spark, sf_dir) -> DataFrame:
    """Every part whose key is divisible by ``QUERY_STEP``, at any table size."""
    return similar_items(spark, sf_dir).where(F.col("p_partkey") % QUERY_STEP == 0)


def portfolio(spark, sf_dir) -> DataFrame:
    """Parts the firm has worked with: those on returned line items."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    return li.where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("p_partkey"))


# ---------------------------------------------------------------- briefs, dossier

SCREENED_HEADER = ("company_number,company_name,probability,interval_lower,interval_upper,"
                   "abstention_status,top_drivers,comparable_companies,counterfactual_levers")


def screened_lines(spark, sf_dir) -> DataFrame:
    """The screened-candidate CSV as text lines: a header, then one line per customer.

    BUILDING customers list two comparables joined by a comma, so their lines
    have ten fields and must be quarantined.  Numbers are formatted from
    integers so every engine prints them alike.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    frac = lambda e: F.concat(F.lit("0."), F.lpad(e.cast("string"), 3, "0"))
    comparables = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("n_name"), F.lit(", "), F.col("n_name"))) \
        .otherwise(F.col("n_name"))
    levers = F.when(F.col("c_nationkey") % 2 == 0, F.lit("reduce gearing")).otherwise(F.lit("extend credit terms"))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name",
                       frac((F.col("c_custkey") * 37) % 1000), frac((F.col("c_custkey") * 17) % 500),
                       frac((F.col("c_custkey") * 17) % 500 + 499),
                       F.when(F.col("c_acctbal") < 0, F.lit("abstained")).otherwise(F.lit("scored")),
                       "c_mktsegment", comparables, levers)
    header = spark.createDataFrame([(SCREENED_HEADER,)], "value string")
    return header.unionByName(j.select(line.alias("value")))


def recipients(spark, sf_dir) -> DataFrame:
    """One mailbox per region."""
    r = table(spark, sf_dir, "region").select("r_name")
    return r.select(F.concat(F.lower("r_name"), F.lit("@example.org")).alias("recipient"))
