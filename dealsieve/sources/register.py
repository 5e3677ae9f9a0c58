"""Candidate list: supplied target file or a register search, and the selection record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Search rule and route names (fixed values).
MAXIMUM_SEARCH_RESULTS = 500      # the cap of a paged search, for callers that ask for it
ACTIVE_COMPANY_STATUS = "active"
SUPPLIED_FILE_ROUTE = "supplied_target_file"
REGISTER_SEARCH_ROUTE = "companies_house_advanced_search"


def load_supplied_targets(spark: SparkSession, path: str) -> DataFrame | None:
    """The hand-supplied CSV (header row), every column read as a string; None when absent.

    Only ``company_name`` is required; other columns pass through.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return None
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if "company_name" not in df.columns:
        raise ValueError(f"{path} has no company_name column")
    return df


def register_search(register: DataFrame, sic_codes: Sequence[str] | None = None, location: str | None = None,
                    maximum_results: int | None = None) -> DataFrame:
    """Active companies with any of the SIC codes, located at ``location``.

    All of them, unless ``maximum_results`` asks for the first by company
    number (a top-k, planned as TakeOrderedAndProject: per-partition top-k,
    then a merge).  Projection: number, name, postcode, first SIC code or
    null, no website.
    """
    rows = register.where(F.col("company_status") == ACTIVE_COMPANY_STATUS)
    if sic_codes:
        rows = rows.where(F.arrays_overlap(F.col("sic_codes"), F.array(*[F.lit(c) for c in sic_codes])))
    if location:
        rows = rows.where(F.lower(F.col("registered_office_address.locality")).contains(location.lower()))
    found = candidate_projection(rows)
    return found if maximum_results is None else found.orderBy("company_number").limit(maximum_results)


def candidate_projection(rows: DataFrame) -> DataFrame:
    return rows.select(
        "company_number", "company_name",
        F.col("registered_office_address.postal_code").alias("postcode"),
        F.try_element_at(F.col("sic_codes"), F.lit(1)).alias("sic_code"),
        F.lit(None).cast(T.StringType()).alias("website_url"))


def build_candidate_list(supplied: DataFrame | None, register: DataFrame, sic_codes=None, location=None,
                         maximum_results: int | None = None) -> tuple[DataFrame, str]:
    """A supplied target list overrides the search; the two are never combined."""
    if supplied is not None:
        return supplied, SUPPLIED_FILE_ROUTE
    return register_search(register, sic_codes, location, maximum_results), REGISTER_SEARCH_ROUTE


def selection_criteria(candidates: DataFrame, route: str, sic_codes: Sequence[str] | None,
                       location: str | None, drawn_at=None) -> DataFrame:
    """One-row record of how the list was drawn; the count is an aggregate, not a driver loop."""
    drawn = F.current_timestamp() if drawn_at is None else F.lit(drawn_at)
    return candidates.agg(F.count(F.lit(1)).alias("candidate_count")).select(
        F.lit(route).alias("route"),
        F.lit(",".join(sic_codes) if sic_codes else None).cast("string").alias("sic_codes"),
        F.lit(location).cast("string").alias("location"),
        "candidate_count",
        drawn.alias("drawn_at"))
