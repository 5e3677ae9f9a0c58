"""Distress scores (Z'') and the headcount revenue cross-check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.functions import finance as fin
from dealsieve.schemas import nan_to_null, require_columns


def distress_scores(balance_sheets: DataFrame) -> DataFrame:
    """Full form when EBIT is filed, else the reduced form, labelled by form.

    A NaN EBIT counts as missing (NaN is nulled on entry), so it selects the
    reduced form instead of producing a NaN "full" score.
    """
    require_columns(balance_sheets, ["company_number", "working_capital", "retained_earnings", "ebit",
                                     "book_value_of_equity", "total_liabilities", "total_assets"], "balance_sheets")
    bs = nan_to_null(balance_sheets)
    has_ebit = F.col("ebit").isNotNull()
    full = fin.full_distress_score("working_capital", "retained_earnings", "ebit", "book_value_of_equity",
                                   "total_liabilities", "total_assets")
    reduced = fin.reduced_distress_score("working_capital", "retained_earnings", "book_value_of_equity",
                                         "total_liabilities", "total_assets")
    return bs.select(
        "company_number",
        F.when(has_ebit, full).otherwise(reduced).alias("distress_score"),
        F.when(has_ebit, F.lit(fin.FULL_SCORE_LABEL)).otherwise(F.lit(fin.REDUCED_SCORE_LABEL)).alias("score_form"),
    )


def first_benchmark(benchmarks: DataFrame, order_col: str = "benchmark_order") -> DataFrame:
    """One benchmark per industry: the first by ``order_col`` (a partial aggregate, no sort)."""
    return (benchmarks.where(F.col("industry_code").isNotNull())
            .groupBy("industry_code")
            .agg(F.min_by("revenue_per_employee", F.struct(order_col, "revenue_per_employee"))
                 .alias("revenue_per_employee")))


def revenue_cross_checks(headcounts: DataFrame, benchmarks: DataFrame,
                         order_col: str = "benchmark_order") -> DataFrame:
    """Headcount x sector benchmark against the multiples estimate.

    Industries without a benchmark give a null estimate and an unusable row;
    non-positive estimates are treated as missing.
    """
    require_columns(headcounts, ["company_number", "industry_code", "filed_headcount",
                                 "multiples_revenue_estimate"], "headcounts")
    hc = nan_to_null(headcounts)
    bench = first_benchmark(nan_to_null(benchmarks), order_col)
    joined = hc.join(bench, "industry_code", "left")
    headcount_estimate = fin.estimate_revenue("filed_headcount", "revenue_per_employee")
    ratio = fin.disagreement_ratio("multiples_revenue_estimate", headcount_estimate)
    return joined.select(
        "company_number",
        headcount_estimate.alias("headcount_revenue_estimate"),
        "multiples_revenue_estimate",
        ratio.alias("disagreement_ratio"),
        fin.revenue_usable(ratio).alias("revenue_usable"),
    )
