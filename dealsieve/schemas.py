"""Explicit schemas for every domain table, plus entry-point hygiene helpers.

Ids and codes are strings (leading zeros matter).  Doubles have NaN turned
into null on entry: Spark orders NaN above every number and treats NaN = NaN,
which would silently change comparisons and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L, I, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def strings(*names):
    return [(n, S) for n in names]


COMPANY = _struct(*strings("company_number", "company_name", "postcode", "sic_code", "website_url"))
RESOLVED_MATCHES = _struct(("candidate_name", S), ("matched_name", S), ("score", D), ("accepted", B))
DECISIONS = _struct(("company_number", S), ("decision_date", TS))
BALANCE_SHEETS = _struct(("company_number", S), ("working_capital", D), ("retained_earnings", D), ("ebit", D),
                         ("book_value_of_equity", D), ("total_liabilities", D), ("total_assets", D))
PEER_MULTIPLES = _struct(("industry_code", S), ("multiple", D))
VALUATION_TARGETS = _struct(("company_number", S), ("industry_code", S), ("scaling_value", D))
FILED_HEADCOUNTS = _struct(("company_number", S), ("industry_code", S), ("filed_headcount", D),
                           ("multiples_revenue_estimate", D))
BENCHMARKS = _struct(("industry_code", S), ("revenue_per_employee", D), ("benchmark_order", L))
ESTIMATES = _struct(("method_name", S), ("estimated_value", D), ("filed_value", D),
                    ("interval_lower", D), ("interval_upper", D))
SCREENED_FIELDS = ["company_number", "company_name", "probability", "interval_lower", "interval_upper",
                   "abstention_status", "top_drivers", "comparable_companies", "counterfactual_levers"]
SCREENED_OPTIONAL_FIELD = "lever_evidence_type"
DISPATCH_LOG = _struct(("sent_at", TS), ("recipient", S), ("brief", S), ("outcome", S))

# Payload shapes of the register / portal documents (read with from_json).
PROFILE_PAYLOAD = T.StructType([
    T.StructField("company_name", S), T.StructField("date_of_creation", S),
    T.StructField("sic_codes", T.ArrayType(S)),
    T.StructField("registered_office_address", _struct(("address_line_1", S), ("postal_code", S))),
])
OFFICERS_PAYLOAD = T.StructType([T.StructField("items", T.ArrayType(_struct(("name", S))))])
FILING_HISTORY_PAYLOAD = T.StructType([T.StructField("total_count", L)])
CHARGE_ITEM = T.StructType([
    T.StructField("created_on", S), T.StructField("status", S),
    T.StructField("classification", _struct(("description", S))),
    T.StructField("persons_entitled", T.ArrayType(_struct(("name", S)))),
    T.StructField("particulars", _struct(("description", S))),
])
CHARGES_PAYLOAD = T.StructType([T.StructField("items", T.ArrayType(CHARGE_ITEM))])
CONTROLLERS_PAYLOAD = T.StructType([T.StructField("items", T.ArrayType(_struct(("name", S), ("kind", S))))])
NOTICE_FIELDS = _struct(("awardedDate", S), ("organisationName", S))
NOTICE = T.StructType([T.StructField("item", NOTICE_FIELDS), T.StructField("awardedDate", S),
                       T.StructField("organisationName", S)])
NOTICES_PAYLOAD = T.StructType([T.StructField("noticeList", T.ArrayType(NOTICE))])

def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN by null in every floating column (or the ones named)."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = floating if columns is None else floating.intersection(columns)
    if not targets:
        return df
    return df.select(*[
        F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(D)).alias(c) if c in targets else F.col(f"`{c}`")
        for c in df.columns
    ])


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> None:
    """Fail early, on the driver, when a caller passes a table without needed columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
